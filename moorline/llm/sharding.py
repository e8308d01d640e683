"""Sharding by fixed virtual slots.

Records are hashed into thousands of slots; bytes and rows are added up per slot;
a versioned map says which shard holds which slot.  Rebalancing edits the map: it
moves single slots from the fullest to the emptiest shard until the sizes are near
equal, and writes the result as the next version.  The law is ``bytes``.

Equal texts are a group.  They hash alike and stay in one slot and shard; only a group larger than a
shard is split, row by row, into as few parts as fit.  Groups above ``1 / SPREAD`` of a shard (there
are at most ``SPREAD`` a shard) get slots of their own, the rest is hashed into the other slots, so large
groups never meet in one slot and small ones even the shards out around them.

Only the slot table (``slots`` rows, a parameter) reaches the driver.  Positions within a shard are
numbered in pieces of a slot, as many as its rows ask for, so no task holds a shard or a hot slot.

Defined results: null text has no bytes and the checksum of the empty text, and is
a copy of it; rows that repeat an identifier get positions of their own; a null
identifier is placed like any other; texts of any length are measured whole; groups and slots of equal
size are told apart by their hash, so placing does not depend on the order of rows; an empty table
gives no rows and an even map; other columns are not read, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.joins import literal_broadcast
from .common import cut, work_uri

SLOTS, SHARDS, ROW_BYTES, SPREAD = 4096, 24, 8, 16
MAP = "slot int, shard int"


class SlotMap:
    """Versions of a slot-to-shard map as tables ``version=<n>`` in a shared folder."""

    def __init__(self, spark: SparkSession, path: str, slots: int = SLOTS):
        self.spark, self.path, self.slots = spark, path, slots

    def create(self, shards: int) -> list[int]:
        return self.save(0, [s * shards // self.slots for s in range(self.slots)])

    def save(self, version: int, shard_of: list[int]) -> list[int]:
        self.spark.createDataFrame(list(enumerate(shard_of)), MAP).coalesce(1) \
            .write.mode("errorifexists").parquet(f"{self.path}/version={version}")
        return shard_of

    def load(self, version: int) -> list[int]:
        rows = self.spark.read.schema(MAP).parquet(f"{self.path}/version={version}").collect()
        return [r.shard for r in sorted(rows)]


def rebalance(shard_of: list[int], bytes_of: list[int], shards: int) -> list[int]:
    """Edit a map: move or swap single slots between the fullest and the emptiest
    shard while that brings them nearer to each other."""
    shard_of = list(shard_of)
    held = [set() for _ in range(shards)]
    for s, k in enumerate(shard_of):
        held[k].add(s)
    load = [sum(bytes_of[s] for s in x) for x in held]
    while True:
        high, low = max(range(shards), key=lambda k: (load[k], -k)), min(range(shards), key=lambda k: (load[k], k))
        gap = load[high] - load[low]
        near = [(abs(gap - 2 * bytes_of[s]), s) for s in held[high] if 0 < bytes_of[s] < gap]
        if near:
            _, s = min(near)
            moves = [(s, high, low)]
        else:
            # No single slot is small enough: the pair whose difference comes nearest to half the gap.
            by_size = sorted(held[low], key=lambda t: (bytes_of[t], t))
            swaps = [(abs(gap - 2 * (bytes_of[s] - bytes_of[t])), s, t) for s in held[high] for t in by_size
                     if 0 < bytes_of[s] - bytes_of[t] < gap]
            if not swaps:
                return shard_of
            _, s, t = min(swaps)
            moves = [(s, high, low), (t, low, high)]
        for s, a, b in moves:
            held[a].discard(s)
            held[b].add(s)
            load[a] -= bytes_of[s]
            load[b] += bytes_of[s]
            shard_of[s] = b


def slotted(docs: DataFrame, slots: int = SLOTS, shards: int = SHARDS, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, size, text_crc32, row and vslot of every row, written."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = cut(docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                           (F.octet_length(text) + ROW_BYTES).cast("bigint").alias("size"),
                           F.crc32(text).alias("text_crc32"), F.sha2(text, 256).alias("copies"),
                           F.monotonically_increasing_id().alias("row")))
    share = (rows.agg(F.sum("size")).first()[0] or 0) / shards
    # At most shards * SPREAD groups can be larger than 1 / SPREAD of a shard.
    large = rows.groupBy("copies").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")) \
        .where((F.col("n") > 1) & (F.col("bytes") * SPREAD > share)).collect() if share else []
    parted, own = [], 0
    for r in sorted(large, key=lambda r: (-r.bytes, r.copies)):
        parts = math.ceil(r.bytes / share) if r.bytes > share else 1
        if parts > 1:
            parts *= SPREAD         # parts of a sixteenth even the shards out
        if own + parts > slots // 2:
            break
        parted.append((r.copies, own, parts))
        own += parts
    parted = rows.sparkSession.createDataFrame(parted, "copies string, first int, parts int")
    part = F.pmod(F.xxhash64("row"), F.col("parts")).cast("int")
    hashed = F.pmod(F.xxhash64("copies"), F.lit(slots - own)).cast("int") + own
    return rows.join(literal_broadcast(parted), "copies", "left").select(
        "doc_id", "size", "text_crc32", "row", F.coalesce(F.col("first") + part, hashed).alias("vslot"))


def assign(docs: DataFrame, slots: int = SLOTS, shards: int = SHARDS, id_col="doc_id", text_col="text",
           slot_map: SlotMap | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot (position in the shard), grown_shard, vslot."""
    spark = docs.sparkSession
    rows = cut(slotted(docs, slots, shards, id_col, text_col))
    stats = {r.vslot: r for r in rows.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).collect()}
    bytes_of = [stats[s].bytes if s in stats else 0 for s in range(slots)]
    slot_map = slot_map or SlotMap(spark, work_uri(spark, "slot-map"), slots)
    shard_of = slot_map.save(1, rebalance(slot_map.create(shards), bytes_of, shards))
    # A slot with more rows than the mean is numbered in pieces; there are at most twice as many pieces as slots.
    mean = max(1, sum(r.n for r in stats.values()) // slots)
    pieces = spark.createDataFrame([(s, -(-r.n // mean)) for s, r in stats.items()], "vslot int, pieces long")
    rows = rows.join(literal_broadcast(pieces), "vslot").withColumn("piece", F.pmod(F.xxhash64("row", F.lit(1)), F.col("pieces")))
    first, filled = [], [0] * shards
    for r in sorted(rows.groupBy("vslot", "piece").agg(F.count(F.lit(1)).alias("n")).collect()):
        first.append((r.vslot, r.piece, shard_of[r.vslot], filled[shard_of[r.vslot]]))
        filled[shard_of[r.vslot]] += r.n
    places = spark.createDataFrame(first, "vslot int, piece long, shard int, first long")
    nth = F.row_number().over(Window.partitionBy("vslot", "piece").orderBy("row"))
    return rows.withColumn("nth", nth).join(literal_broadcast(places), ["vslot", "piece"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("first") + F.col("nth") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "vslot")


def write_shards(docs: DataFrame, path: str, slots: int = SLOTS, shards: int = SHARDS, id_col="doc_id",
                 text_col="text") -> DataFrame:
    """Write the whole rows into ``path/shard=<k>`` (several files a shard) and return the
    assignment.  If the rows have a column ``shard``, the folders are named ``_shard=<k>``."""
    name = "shard"
    while name in docs.columns:
        name = "_" + name
    where = cut(assign(docs, slots, shards, id_col, text_col))
    placed = where.select(F.col("doc_id").alias("__id"), F.col("text_crc32").alias("__crc"), F.col("size").alias("__size"),
                          F.col("shard").alias(name), F.col("vslot").alias("__vslot")).distinct()
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    docs.join(placed, docs[id_col].cast("bigint").eqNullSafe(F.col("__id")) & (F.crc32(text) == F.col("__crc"))
              & (F.octet_length(text) + ROW_BYTES == F.col("__size"))) \
        .repartition(name, "__vslot").drop("__id", "__crc", "__size", "__vslot") \
        .write.partitionBy(name).parquet(path)
    return where
