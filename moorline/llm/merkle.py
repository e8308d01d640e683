"""Merkle manifest of a dataset, and proofs by a recursive query.

Every row is a leaf: the hash of its columns.  Leaves are ordered by group and
identifier; inside a group three consecutive nodes become the hash of their hashes, level
by level, until one is left.  These subroots, ordered by group, are folded likewise into one root.

``build`` writes every level as node rows: node, its parent, its hash, and the hashes that stand
before and after it in its run, so a node needs nothing but its own row to compute its parent.
Nodes of a subtree and of the tree above it are linked alike: the way from a leaf to
the root is a chain of parents.  Positions come from a range partitioning with
offsets per partition, so a group of any size is spread over all tasks.

``climb`` ascends with one recursive query: every step joins the nodes that the leaves have reached with
their ways up, appends the siblings on that way to the leaf's path and folds the claimed hash along it.  A way
is ``STEP`` parent links in a row, joined once for every ``STEP``-th level, so a leaf is moved once per
way and not once per level; the first link needs no step, since every leaf has its own.

Defined results: a null column counts as ``-``, an empty one as ``0:``; null groups and null
identifiers come first and are ordered like any other; rows that repeat an identifier are
ordered by their hash, equal rows are leaves of their own and interchangeable; texts of any
length are hashed whole; a group of one row is its own subroot, one group's subroot is the root,
with no siblings; an empty table has no rows and no root; columns that are not named are not
read, whatever their names.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.joins import broadcast_if_bounded, literal_broadcast
from .common import BROADCAST_ROWS, work_uri, written

ARITY = 3
# Levels that a step of the recursion climbs.
STEP = 4
# A node is named by its level (upper bits) and its position there; the tree over the subroots starts at TOP.
LEVEL_BITS, TOP = 56, 64
NODES = ("tree bigint, n bigint, idx bigint, node bigint, parent bigint, hash binary, "
         "before binary, after binary, up binary")


@dataclass
class Manifest:
    """``leaves``: at, id, group, tree, node, leaf, claim.  ``nodes``: NODES.  ``subroots``: tree,
    node, hash.  ``root``: the root's hash, None for an empty table."""
    leaves: DataFrame
    nodes: DataFrame
    subroots: DataFrame
    root: bytes | None


def fields(columns: list[Column]) -> Column:
    """The hashed text of a row: per column its byte count, ``:`` and value, or ``-`` if null."""
    values = [c.cast("string") for c in columns]
    return F.concat(*[F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values])


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _hex(binary: Column) -> Column:
    return F.lower(F.hex(binary))


def numbered(df: DataFrame, order: list[str]) -> DataFrame:
    """The rows, written, with ``at``: their position from 0 in the given order."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = written(df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                   .withColumn("at", F.monotonically_increasing_id()), "merkle-order")
    part = F.shiftright("at", 33)
    first, offsets = 0, []
    for r in sorted(rows.groupBy(part.alias("part")).count().collect()):    # one row per partition
        offsets.append((r["part"], first))
        first += r["count"]
    offsets = spark.createDataFrame(offsets, "part bigint, offset bigint")
    return rows.withColumn("part", part).join(literal_broadcast(offsets), "part") \
        .withColumn("at", F.col("offset") + F.col("at").bitwiseAND((1 << 33) - 1)).drop("part", "offset")


def _level(rows: DataFrame, level: int) -> DataFrame:
    """Node rows of one level from (tree, n, idx, node, hash)."""
    run = F.floor(F.col("idx") / ARITY)
    runs = rows.where("n > 1").groupBy("tree", "n", run.alias("run")) \
        .agg(F.sort_array(F.collect_list(F.struct("idx", "node", "hash"))).alias("kids")) \
        .withColumn("up", digest(F.array_join(F.transform("kids", lambda k: _hex(k["hash"])), "")))
    kids = runs.select("tree", "n", "run", "up", "kids", F.posexplode("kids").alias("place", "kid"))

    empty = F.lit(b"")

    def others(places, stands):
        return F.concat(*[F.when(stands(j), F.coalesce(F.get("kids", F.lit(j))["hash"], empty)).otherwise(empty)
                          for j in places])
    return kids.select("tree", "n", "kid.idx", "kid.node", (F.lit((level + 1) << LEVEL_BITS) + F.col("tree") + F.col("run")).alias("parent"),
                       "kid.hash", others(range(ARITY - 1), lambda j: F.col("place") > j).alias("before"),
                       others(range(1, ARITY), lambda j: F.col("place") < j).alias("after"), "up")


def _fold(rows: DataFrame, level: int, most: int, path: str) -> None:
    """Write the levels above ``rows`` (tree, n, idx, node, hash); the largest tree has ``most`` leaves."""
    spark = rows.sparkSession
    while most > 1:
        _level(rows, level).write.parquet(f"{path}/level={level}")
        done = spark.read.schema(NODES).parquet(f"{path}/level={level}")
        rows = done.where(F.col("idx") % ARITY == 0).select(
            "tree", F.floor((F.col("n") + ARITY - 1) / ARITY).alias("n"), F.floor(F.col("idx") / ARITY).alias("idx"),
            F.col("parent").alias("node"), F.col("up").alias("hash"))
        most, level = -(-most // ARITY), level + 1


def _roots(rows: DataFrame, nodes: DataFrame | None) -> DataFrame:
    """(tree, node, hash) of the last node of every tree."""
    out = rows.where("n = 1").select("tree", "node", "hash")
    if nodes is not None:
        last = nodes.where(f"n <= {ARITY} and idx = 0")
        out = out.unionByName(last.select("tree", F.col("parent").alias("node"), F.col("up").alias("hash")))
    return out


def build(docs: DataFrame, columns: list[str], id_col="doc_id", group_col="source",
          claim: dict[str, Column] | None = None) -> Manifest:
    """Build the manifest of ``docs`` over ``columns``.  ``claim`` gives other values for
    some columns; their hash is kept beside the leaf, to be proved or refuted by ``climb``."""
    spark = docs.sparkSession
    claimed = [(claim or {}).get(c, F.col(c)) for c in columns]
    leaves = written(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(group_col).alias("group"),
        digest(fields([F.col(c) for c in columns])).alias("leaf"), digest(fields(claimed)).alias("claim")), "merkle-leaves")
    placed = numbered(leaves, ["group", "id", "leaf", "row"])
    trees = written(placed.groupBy("group").agg(F.min("at").alias("tree"), F.count(F.lit(1)).alias("n")), "merkle-trees")
    most = trees.agg(F.max("n"), F.count(F.lit(1))).first()
    own = broadcast_if_bounded(trees.select(F.col("group").alias("of"), "tree", "n"), BROADCAST_ROWS)
    placed = written(placed.join(own, F.col("group").eqNullSafe(F.col("of")))
                     .select("at", "id", "group", "tree", "n", F.col("at").alias("node"), "leaf", "claim"), "merkle-placed")
    rows = placed.select("tree", "n", (F.col("at") - F.col("tree")).alias("idx"), "node", F.col("leaf").alias("hash"))

    lower, upper = work_uri(spark, "merkle-nodes"), work_uri(spark, "merkle-top")
    nodes = top = None
    if (most[0] or 0) > 1:
        _fold(rows, 0, most[0], lower)
        nodes = spark.read.schema(NODES).parquet(*[f"{lower}/level={i}" for i in range(_height(most[0]))])
    subroots = written(_roots(rows, nodes), "merkle-subroots")
    ranked = numbered(trees.select("tree"), ["tree"]).withColumnRenamed("at", "idx")
    rows = subroots.join(ranked, "tree").select(F.lit(0).cast("bigint").alias("tree"), F.lit(most[1]).alias("n"), "idx", "node", "hash")
    if most[1] > 1:
        _fold(rows, TOP, most[1], upper)
        top = spark.read.schema(NODES).parquet(*[f"{upper}/level={TOP + i}" for i in range(_height(most[1]))])
        nodes = top if nodes is None else nodes.unionByName(top)
    root = _roots(rows, top).first()
    return Manifest(placed, spark.createDataFrame([], NODES) if nodes is None else nodes, subroots,
                    None if root is None else bytes(root["hash"]))


def _height(n: int) -> int:
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


def _ways(nodes: DataFrame) -> DataFrame:
    """(node, target, way): the links from a node over up to STEP parents; from every STEP-th level
    below the subroots, and from all nodes above."""
    level = F.shiftright("node", LEVEL_BITS)
    links = nodes.select("node", "parent", F.struct("before", "after").alias("link"))
    ways = links.where((level >= TOP) | (level % STEP == 1)).select("node", F.col("parent").alias("target"), F.array("link").alias("way"))
    for _ in range(STEP - 1):
        above = links.select(F.col("node").alias("target"), "parent", F.col("link").alias("next"))
        ways = ways.join(above, "target", "left").select(
            "node", F.coalesce("parent", "target").alias("target"),
            F.when(F.col("next").isNull(), F.col("way")).otherwise(F.concat("way", F.array("next"))).alias("way"))
    return ways


_FOLD = "aggregate({way}, {hash}, (h, x) -> unhex(sha2(concat(lower(hex(x.before)), lower(hex(h)), lower(hex(x.after))), 256)))"
_BESIDE = "aggregate({way}, X'', (b, x) -> concat(b, x.before, x.after))"
_CLIMB = """
WITH RECURSIVE climb(at, node, step, folded, beside) AS (
  SELECT at, node, 0, folded, beside FROM {{leaves}}
  UNION ALL
  SELECT c.at, w.target, c.step + 1, {fold}, {beside}
  FROM climb c JOIN {{ways}} w ON c.node = w.node)
SELECT at, step, folded, beside FROM climb""".format(fold=_FOLD.format(way="w.way", hash="c.folded"), beside=_BESIDE.format(way="w.way"))
# The recursion ends at the root, from where no way leads; it is bounded by the height and not by rows.
_LIMITS = {"spark.sql.cteRecursionRowLimit": "-1", "spark.sql.cteRecursionLevelLimit": str(2 * TOP)}


def climb(manifest: Manifest) -> DataFrame:
    """Per leaf: at, folded (the root that its claim leads to) and siblings (the hashes beside its way, joined
    level by level).  The session's limits of recursion are lifted, since the result is read lazily."""
    spark = manifest.leaves.sparkSession
    for k, v in _LIMITS.items():
        spark.conf.set(k, v)
    names = {k: f"merkle_{k}_{uuid.uuid4().hex}" for k in ("leaves", "ways")}
    own = manifest.nodes.where(F.shiftright("node", LEVEL_BITS) == 0).select("node", "parent", F.array(F.struct("before", "after")).alias("way"))
    first = manifest.leaves.select("at", "node", "claim").join(own, "node", "left")
    first.select("at", F.coalesce("parent", "node").alias("node"),
                 F.expr("CASE WHEN way IS NULL THEN claim ELSE " + _FOLD.format(way="way", hash="claim") + " END").alias("folded"),
                 F.expr("CASE WHEN way IS NULL THEN X'' ELSE " + _BESIDE.format(way="way") + " END").alias("beside")) \
        .createOrReplaceTempView(names["leaves"])
    written(_ways(manifest.nodes.where(F.shiftright("node", LEVEL_BITS) > 0)), "merkle-ways").createOrReplaceTempView(names["ways"])
    path = spark.sql(_CLIMB.format(**names))
    for name in names.values():
        spark.catalog.dropTempView(name)
    way = F.sort_array(F.collect_list(F.struct("step", "beside")))
    return path.groupBy("at").agg(F.max_by("folded", "step").alias("folded"), way.alias("way")) \
        .select("at", "folded", F.transform("way", lambda x: x["beside"]).alias("siblings"))


def verify(manifest: Manifest, id_col="doc_id") -> DataFrame:
    """One row per leaf: its identifier, leaf, subroot, root and folded_root (lowercase hex),
    siblings (array<binary>, joined level by level) and whether the claim leads to the root."""
    subroots = manifest.subroots.select("tree", F.col("hash").alias("subroot"))
    root = F.lit(manifest.root.hex() if manifest.root else None).cast("string")
    return manifest.leaves.join(broadcast_if_bounded(subroots, BROADCAST_ROWS), "tree").join(climb(manifest), "at").select(
        F.col("id").alias(id_col), _hex(F.col("leaf")).alias("leaf"), _hex(F.col("subroot")).alias("subroot"), root.alias("root"),
        "siblings", _hex(F.col("folded")).alias("folded_root"), (_hex(F.col("folded")) == root).alias("verified"))
