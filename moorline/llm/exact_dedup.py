"""Exact deduplication by a stateful stream.

``land`` writes one small record per document (digest, stable identifier,
content locator).  ``dedup_stream`` reads such a landing folder as a stream and
keeps, per digest and without expiry, the largest identifier, the number of
rows and the locator of the retained content in a disk-backed (RocksDB) keyed
state; partial aggregation runs before the shuffle, so a digest that a third
of all rows share reaches its state as one row per task.  ``exact_dedup`` runs
the stream over everything landed, then compares the full bytes of every hit
with the retained content; digests whose bytes differ are grouped by the text
itself, so a collision of digests never joins two texts.

Defined results: null text is the empty text; a null identifier never wins over
another one (a group of null identifiers only has keep_id null and kept false);
rows repeated under the identifier that stays are the same document and are all
marked kept (``keep_rows`` returns one of them); texts of any length are compared whole; an empty table gives no rows; other columns are not read, so their
names may clash with any name used here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.joins import broadcast_if_bounded
from .common import BROADCAST_ROWS, cut, work_uri, written

# State on disk; all state partitions of an executor share one bounded cache and
# write buffer, so memory doesn't grow with the number of partitions or keys, and
# none reserves disk ahead of its use (4 MB a partition otherwise).  A store is closed when its task
# ends, so an executor holds as many as it has tasks, and none after the stream.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "4",
    "spark.sql.streaming.stateStore.rocksdb.maxWriteBufferNumber": "2",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
LANDED = "digest binary, doc_id bigint, locator string"
FILES_PER_TRIGGER = 4096


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def land(docs: DataFrame, path: str, id_col="doc_id", text_col="text", digest=sha256) -> None:
    """Append (digest, doc_id, locator) of every row to a landing folder."""
    (docs.select(digest(F.coalesce(F.col(text_col), F.lit(""))).alias("digest"),
                 F.col(id_col).cast("bigint").alias("doc_id"), F.input_file_name().alias("locator"))
     .write.mode("append").parquet(path))


def dedup_stream(spark: SparkSession, landing: str, state: str, log: str,
                 files_per_trigger: int = FILES_PER_TRIGGER) -> None:
    """Process what is landed and not yet seen; the keyed state in ``state`` goes on
    from run to run.  Every batch writes the digests it changed to ``log`` under
    its batch number (a repeated batch overwrites its own folder)."""
    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        seen = (spark.readStream.schema(LANDED).option("maxFilesPerTrigger", files_per_trigger).parquet(landing)
                .groupBy("digest")
                .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"),
                     F.max_by("locator", "doc_id").alias("locator")))

        def publish(batch: DataFrame, number: int) -> None:
            batch.write.mode("overwrite").parquet(f"{log}/batch={number}")

        (seen.writeStream.outputMode("update").foreachBatch(publish)
         .option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def seen_digests(spark: SparkSession, log: str) -> DataFrame:
    """The latest state of every digest: counts and identifiers only grow, so the
    largest of a digest's log rows is the last one."""
    schema = "digest binary, keep_id bigint, group_size bigint, locator string, batch int"
    return (spark.read.schema(schema).parquet(log).groupBy("digest")
            .agg(F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size")))


def exact_dedup(docs: DataFrame, id_col="doc_id", text_col="text", digest=sha256,
                files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, digest."""
    spark = docs.sparkSession
    base = work_uri(spark, "exact-dedup")
    land(docs, f"{base}/landing", id_col, text_col, digest)
    dedup_stream(spark, f"{base}/landing", f"{base}/state", f"{base}/log", files_per_trigger)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text")) \
        .withColumn("digest", digest(F.col("text")))
    hits = cut(seen_digests(spark, f"{base}/log").where("group_size > 1").select("digest", "keep_id", "group_size"))
    differing = broadcast_if_bounded(_differing(rows, broadcast_if_bounded(hits, BROADCAST_ROWS)), BROADCAST_ROWS)
    ids = spark.read.schema(LANDED).parquet(f"{base}/landing").select("digest", "doc_id")
    plain = ids.join(hits.join(differing, "digest", "left_anti"), "digest", "left") \
        .join(differing, "digest", "left_anti") \
        .select("doc_id", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"), "digest")
    collided = rows.join(differing, "digest", "left_semi")
    by_text = collided.groupBy("digest", "text").agg(F.max("doc_id").alias("keep_id"),
                                                     F.count(F.lit(1)).alias("group_size"))
    resolved = collided.join(by_text, ["digest", "text"]).select("doc_id", "keep_id", "group_size", "digest")
    return plain.unionByName(resolved).select(
        "doc_id", "keep_id", "group_size",
        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.lit(False)).alias("kept"), "digest")


def _differing(rows: DataFrame, hits: DataFrame) -> DataFrame:
    """Digests with a row whose bytes differ from the retained content.  Only rows
    of digests that occurred more than once are compared (their digests are
    broadcast up to a checked number, so that other texts stay where they are);
    the retained side has one row per digest and is a table of its own, so that the
    join can split a hot digest by its rows."""
    again = rows.join(hits, "digest")
    retained = written(again.where(F.col("doc_id").eqNullSafe(F.col("keep_id"))).groupBy("digest")
                       .agg(F.min("text").alias("retained")), "retained")
    unequal = again.select("digest", "text").join(retained, "digest").where(F.col("text") != F.col("retained"))
    return cut(unequal.select("digest")).distinct()


def keep_rows(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """One input row per text, with all its columns: that with the largest identifier, one without only
    where no copy has one.  Rows that repeat identifier and text are one."""
    names = docs.columns
    print_ = sha256(F.coalesce(docs[text_col].cast("string"), F.lit("")))
    groups = cut(exact_dedup(docs, id_col, text_col).where("group_size > 1")
                 .select(F.col("digest").alias("__digest"), F.col("keep_id").alias("__keep")).distinct())
    groups = broadcast_if_bounded(groups, BROADCAST_ROWS)
    # Digests that two texts share have several rows here; each row meets that of its own identifier.
    single = docs.join(groups, print_ == F.col("__digest"), "left_anti")
    staying = docs.join(groups, (print_ == F.col("__digest")) & docs[id_col].cast("bigint").eqNullSafe(F.col("__keep")))
    same = staying.groupBy(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    return single.unionByName(same.agg(*[F.first(c).alias(c) for c in names]).select(*names))
