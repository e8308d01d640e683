"""Near-duplicate detection with SetSketch registers.

A document's set is its distinct word shingles.  Its sketch has ``BANDS * ROWS``
registers ``clip(floor(1 - log_b(min h_i)), 0, q + 1)`` with h_i ~ Exp(a): truncated
minima on an exponential scale, so two sketches merge by the maximum of each
register, and equal registers are the more likely the more similar the sets are.

1. ``sketches`` reads every whole text once and writes set size, a 128-bit set key and
   the banded registers.  Documents with equal sets form one class before
   anything else is compared.
2. Classes that share a band meet.  In every band bucket the members are
   compared with two leaders only (the member that shares most buckets and the
   smallest one).  Size ratio and the joint maximum likelihood of the registers
   discard pairs that are clearly apart; the rest is confirmed on the full sets.
3. Components of the confirmed links are built.  Buckets whose members all lie
   in one component are finished; in the others the members outside the bucket's
   main component are compared with all members of other components that such
   buckets bring together, block by block and on the full sets, so no link that
   could join two components is lost and no list of pairs arises.

A band of six registers agrees with probability 0.41 at similarity 0.85, so a
linked pair shares none of the 32 bands with probability 5e-8 (1.5e-5 at 0.8).

Defined results: null, empty or blank text is the empty set: component_id is
its own doc_id and it is kept.  A null doc_id cannot be linked: component_id is null
unless its set equals that of identified rows, kept is true for none of the
latter.  Rows that repeat a doc_id are one node.  Texts and words of any length are read
whole; of equal sets the smallest doc_id stands for all; an empty table has no rows; other
columns are not read, whatever their names.  Words are hashed with BLAKE2b, so two
shingles share their 64 bits by chance only (2^-64 for a pair).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.joins import broadcast_if_bounded
from .common import BROADCAST_ROWS, SPACE_WORDS, bounded_arrow, cut, shingle_hashes, word_hashes, written
from .components import connected_components

BANDS, ROWS = 32, 6
B, A, Q = 1.2, 20.0, 254
# Natural-log likelihood by which the threshold may fall behind the best
# similarity before a pair is discarded unseen (5 standard deviations).
DISCARD = 12.5
# Members of a component that a task holds at a time when the rest of a bucket is compared.
BLOCK = 300

_MULT = np.random.default_rng(20240116).integers(1, 2 ** 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = np.arange(ROWS, dtype=np.uint64) * np.uint64(8)


def registers(values: np.ndarray) -> np.ndarray:
    """Registers (uint8) of a set of 64-bit hashes; merge sets by np.maximum."""
    least = np.full(len(_MULT), np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(values), 512):
        np.minimum(least, (values[i:i + 512, None] * _MULT).min(axis=0), out=least)
    u = ((least >> np.uint64(32)).astype(np.float64) + 0.5) / 2.0 ** 32
    h = -np.log1p(-u) / A
    return np.clip(np.floor(1 - np.log(h) / np.log(B)), 0, Q + 1).astype(np.uint8)


def band_keys(regs: np.ndarray) -> np.ndarray:
    """One long per band: band number above the six registers' bytes."""
    packed = (regs.reshape(-1, BANDS, ROWS).astype(np.uint64) << _SHIFTS).sum(axis=2, dtype=np.uint64)
    return (packed | (np.arange(BANDS, dtype=np.uint64) << np.uint64(48))).astype(np.int64)


def band_registers(bands: np.ndarray) -> np.ndarray:
    """Back from band keys (n x BANDS) to registers (n x BANDS * ROWS)."""
    b = bands.astype(np.uint64)
    return ((b[:, :, None] >> _SHIFTS) & np.uint64(255)).astype(np.uint8).reshape(len(b), -1)


def _p(x):
    return -np.log1p(-np.clip(x, 0, 1) * (B - 1) / B) / np.log(B)


def log_likelihood(j, more, less, equal, n_a, n_b):
    """Log likelihood of similarity ``j`` given how many registers of a are larger,
    smaller and equal, and both set sizes."""
    u = n_a / (n_a + n_b)
    up, down = np.clip(_p(u - (1 - u) * j), 1e-12, 1), np.clip(_p((1 - u) - u * j), 1e-12, 1)
    return more * np.log(up) + less * np.log(down) + equal * np.log(np.clip(1 - up - down, 1e-12, 1))


def estimate(regs_a, regs_b, n_a, n_b, grid: int = 101):
    """Maximum-likelihood similarity per pair (on a grid) and its log likelihood."""
    more, less = (regs_a > regs_b).sum(1), (regs_a < regs_b).sum(1)
    equal = regs_a.shape[1] - more - less
    top = np.minimum(n_a, n_b) / np.maximum(n_a, n_b)
    best, at = np.full(len(more), -np.inf), np.zeros(len(more))
    for g in np.linspace(0, 1, grid):
        ll = log_likelihood(g * top, more, less, equal, n_a, n_b)
        at, best = np.where(ll > best, g * top, at), np.maximum(best, ll)
    return at, best, (more, less, equal)


def _sets(text: pa.Array, k: int):
    """Sorted distinct shingle hashes of each text."""
    words, at = word_hashes(text, SPACE_WORDS)
    for i in range(len(text)):
        yield np.unique(shingle_hashes(words[at[i]:at[i + 1]], k))


def _key(values: np.ndarray) -> bytes | None:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest() if len(values) else None


def sketches(docs: DataFrame, k: int, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, n (set size), key (128-bit set digest, null if empty), bands (null if empty)."""
    def run(batches):
        for batch in batches:
            n, keys, bands = [], [], []
            for s in _sets(batch.column(1), k):
                n.append(len(s))
                keys.append(_key(s))
                bands.append(band_keys(registers(s))[0] if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "n", "key", "bands"])
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(run, "doc_id bigint, n bigint, key binary, bands array<bigint>")


def _equal_registers(a, b):
    """Number of equal registers of two band arrays, in SQL: the bytes of x XOR y
    are folded to one bit each and counted."""
    m1, m2, m4 = (F.lit(int(h * 6, 16)) for h in ("01", "03", "0f"))

    def differing(x, y):
        z = x.bitwiseXOR(y)
        z = z.bitwiseOR(F.shiftright(z, 4)).bitwiseAND(m4)
        z = z.bitwiseOR(F.shiftright(z, 2)).bitwiseAND(m2)
        return F.bit_count(z.bitwiseOR(F.shiftright(z, 1)).bitwiseAND(m1)).cast("int")
    return F.lit(BANDS * ROWS) - F.aggregate(F.zip_with(a, b, differing), F.lit(0), lambda s, x: s + x)


def least_equal(num: int, den: int) -> int:
    """Fewest equal registers with which equal-sized sets are still not discarded."""
    m, t = BANDS * ROWS, num / den
    for equal in range(m + 1):
        diff = (m - equal) / 2
        ll = [log_likelihood(np.float64(j), diff, diff, equal, 1.0, 1.0) for j in np.linspace(0, 1, 201)]
        if max(ll) - log_likelihood(np.float64(t), diff, diff, equal, 1.0, 1.0) <= DISCARD:
            return equal
    return m


def _plausible(pairs: DataFrame, num: int, den: int) -> DataFrame:
    """Drop pairs (a, b, na, nb, ba, bb) that the joint likelihood puts clearly below the threshold."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            na, nb = (batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in (2, 3))
            ra, rb = (band_registers(batch.column(i).flatten().to_numpy().reshape(-1, BANDS)) for i in (4, 5))
            at, best, counts = estimate(ra, rb, na, nb)
            top = np.minimum(na, nb) / np.maximum(na, nb)
            fits = (at >= num / den) | (best - log_likelihood(np.minimum(num / den, top), *counts, na, nb) <= DISCARD)
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(fits)) for i in (0, 1)], names=["a", "b"])
    return pairs.select("a", "b", "na", "nb", "ba", "bb").mapInArrow(run, "a bigint, b bigint")


def _full_sets(docs: DataFrame, needed: DataFrame, k: int) -> DataFrame:
    """(id, s): the whole sets, as sorted 64-bit hashes, of the documents in ``needed`` (id)."""
    def sets(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([s.tobytes() for s in _sets(batch.column(1), k)], pa.binary())],
                names=["id", "s"])
    return written(docs.select(F.col("doc_id").alias("id"), "text")
                   .join(broadcast_if_bounded(needed, BROADCAST_ROWS), "id", "left_semi")
                   .mapInArrow(sets, "id bigint, s binary").distinct(), "near-sets")


def _confirm(pairs: DataFrame, docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose full sets pass the threshold, as (u, v)."""
    pairs = cut(pairs)
    needed = cut(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct())

    def compare(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(den * both >= num * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(keep, pa.bool_())) for i in (0, 1)],
                                             names=["u", "v"])

    full = _full_sets(docs, needed, k)
    both = pairs.join(full.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a") \
        .join(full.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b")
    return both.select("a", "b", "sa", "sb").mapInArrow(compare, "u bigint, v bigint")


def _overlaps(x: list, z: list, num: int, den: int):
    """Pairs (i, j) of two lists of (cid, label, set) with different labels whose sets
    pass the threshold.  All intersection sizes of one set with the other list come
    from the list's inverted index, so no pair is looked at by itself."""
    sizes = np.array([len(s) for _, _, s in z])
    owner = np.repeat(np.arange(len(z)), sizes)
    values = np.concatenate([s for _, _, s in z])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    labels = np.array([label for _, label, _ in z])
    for i, (_, label, s) in enumerate(x):
        first, last = np.searchsorted(values, s, "left"), np.searchsorted(values, s, "right")
        many = last - first
        at = np.repeat(first - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
        both = np.bincount(owner[at], minlength=len(z))
        for j in np.flatnonzero((den * both >= num * (len(s) + sizes - both)) & (labels != label)):
            yield i, j


def _rest_links(members: DataFrame, sets: DataFrame, num: int, den: int, block: int = BLOCK) -> DataFrame:
    """Links between the rows of ``members`` (grp, cid, label, rest) with ``rest`` and all
    rows of their group that have another label, as (u, v).

    A group is cut into blocks of about ``block`` members; a task holds one block of
    the rest and one of the group at a time and returns confirmed links only.
    """
    size = members.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("rest").cast("int")).alias("n_rest")) \
        .select("grp", F.ceil(F.col("n") / block).cast("int").alias("blocks"),
                F.ceil(F.col("n_rest") / block).cast("int").alias("rest_blocks"))
    rows = members.join(broadcast_if_bounded(cut(size), BROADCAST_ROWS), "grp")
    own = F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")
    own_rest = F.pmod(F.xxhash64("cid"), F.col("rest_blocks")).cast("int")
    z = rows.select("grp", F.explode(F.sequence(F.lit(0), F.col("rest_blocks") - 1)).alias("i"), own.alias("j"),
                    F.lit(1).alias("side"), "cid", "label")
    x = rows.where("rest").select("grp", own_rest.alias("i"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j"),
                                  F.lit(0).alias("side"), "cid", "label")
    units = x.unionByName(z).join(sets.withColumnRenamed("id", "cid"), "cid")
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        unit, held = None, ([], [])

        def links():
            out = [(held[0][i][0], held[1][j][0]) for i, j in _overlaps(*held, num, den)] if held[0] and held[1] else []
            return pa.RecordBatch.from_arrays([pa.array([min(p) for p in out], pa.int64()),
                                               pa.array([max(p) for p in out], pa.int64())], names=["u", "v"])
        for batch in batches:
            for r in batch.to_pylist():
                key = (r["grp"], r["i"], r["j"])
                if key != unit:
                    yield links()
                    unit, held = key, ([], [])
                held[r["side"]].append((r["cid"], r["label"], np.frombuffer(r["s"], np.uint64)))
        yield links()

    return units.repartition(parts, "grp", "i", "j").sortWithinPartitions("grp", "i", "j") \
        .mapInArrow(run, "u bigint, v bigint").distinct()


def near_dedup(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5, id_col="doc_id", text_col="text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.  Sets are
    linked when ``den * intersection >= num * union`` (0.8 and five words unless
    a caller says otherwise)."""
    docs = bounded_arrow(docs).select(F.col(id_col).cast("bigint").alias("doc_id"),
                                      F.col(text_col).cast("string").alias("text"))
    sketched = written(sketches(docs, k), "near-sketches")
    classes = sketched.where("key is not null").groupBy("key").agg(
        F.min("doc_id").alias("cid"), F.count(F.lit(1)).alias("members"),
        F.min_by("bands", "doc_id").alias("bands"), F.max("n").alias("n"))
    classes = written(classes, "near-classes")
    nodes = classes.where("cid is not null").select("cid", "n", "bands")

    # Band buckets of more than one class.
    buckets = nodes.select("cid", F.explode("bands").alias("band"))
    shared = buckets.groupBy("band").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    buckets = written(buckets.join(shared, "band"), "near-buckets")
    degree = buckets.groupBy("cid").agg(F.sum("size").alias("degree"))
    ranked = buckets.join(degree, "cid")
    leaders = ranked.groupBy("band").agg(F.max_by("cid", F.struct("degree", -F.col("cid"))).alias("central"),
                                         F.min("cid").alias("first"))
    star = buckets.join(leaders, "band").select("cid", F.explode(F.array("central", "first")).alias("leader")) \
        .where("cid != leader").select(F.least("cid", "leader").alias("a"), F.greatest("cid", "leader").alias("b"))
    tried = cut(star.distinct())

    def side(x):
        return nodes.select(F.col("cid").alias(x), F.col("n").alias("n" + x), F.col("bands").alias("b" + x))

    ratio = den * F.least("na", "nb") >= num * F.greatest("na", "nb")
    alike = _equal_registers(F.col("ba"), F.col("bb")) >= least_equal(num, den)
    near = tried.join(side("a"), "a").join(side("b"), "b").where(ratio).where(alike)
    links = cut(_confirm(_plausible(near, num, den), docs, k, num, den))
    roots = connected_components(links)

    # Buckets that hold several components: members outside the main one meet the others.
    labelled = buckets.join(roots.withColumnRenamed("node", "cid"), "cid", "left") \
        .select("band", "cid", F.coalesce("root", "cid").alias("label"))
    counted = labelled.groupBy("band", "label").agg(F.count(F.lit(1)).alias("c"))
    open_ = counted.groupBy("band").agg(F.max_by("label", F.struct("c", -F.col("label"))).alias("grp"),
                                        F.count(F.lit(1)).alias("parts"), F.sum("c").alias("size")) \
        .where("parts > 1 and size > 2").select("band", "grp")
    rest = cut(labelled.join(open_, "band").select("grp", "cid", "label", (F.col("label") != F.col("grp")).alias("rest"))
               .distinct())
    sets = _full_sets(docs, cut(rest.select(F.col("cid").alias("id")).distinct()), k)
    more = cut(_rest_links(rest, sets, num, den))
    if not more.isEmpty():
        roots = connected_components(roots.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(more))

    grouped = classes.join(roots.withColumnRenamed("node", "cid"), "cid", "left") \
        .select("key", F.coalesce("root", "cid").alias("component"), "members", "cid") \
        .where("members > 1 or component != cid").select("key", "component")
    return sketched.select("doc_id", "n", "key").join(grouped, "key", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")) \
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))


def keep_rows(docs: DataFrame, id_col="doc_id", text_col="text", **how) -> DataFrame:
    """The input rows with one document per component, with all their columns.  Rows without an identifier
    of their own (null, or repeated) are told apart by identifier and text."""
    print_ = F.sha2(F.concat_ws(":", docs[id_col].cast("string"), F.coalesce(docs[text_col].cast("string"), F.lit(""))), 256)
    shared = cut(docs.groupBy(docs[id_col].cast("bigint").alias("__shared")).agg(F.count(F.lit(1)).alias("n"))
                 .where("n > 1 and __shared is not null").select("__shared"))
    known = docs.join(broadcast_if_bounded(shared, BROADCAST_ROWS), docs[id_col].cast("bigint") == F.col("__shared"), "left")
    # Their nodes lie above all identifiers in use, so that an identified document is preferred.
    own = F.lit(1 << 62) + F.conv(F.substring(print_, 1, 15), 16, 10).cast("bigint")
    nodes = known.withColumn("__node", F.when(F.col("__shared").isNull() & docs[id_col].isNotNull(), docs[id_col].cast("bigint"))
                             .otherwise(own)).drop("__shared")
    gone = cut(near_dedup(nodes, id_col="__node", text_col=text_col, **how).where("not kept").select(F.col("doc_id").alias("__gone")).distinct())
    return nodes.join(broadcast_if_bounded(gone, BROADCAST_ROWS), F.col("__node") == F.col("__gone"), "left_anti").drop("__node")
