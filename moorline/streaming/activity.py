"""ST2: incremental activity counts over sliding windows.

Sessions (``view`` events) are counted per customer and day; the 30-day windows
that slide by one day are sums of day counts, added up when the result is read.  The
state holds one row per customer and day instead of one per customer and window.  A
day stays open as long as one of its windows does: the watermark lies the
window's length plus the allowed lateness behind the newest event; older days are
final, their state is dropped and rows for them are ignored.

A run takes everything that is there when it starts as one micro-batch, whatever
the number and order of its files, so the watermark only ever applies to rows that
arrive after a later event was processed.  Output mode ``update`` emits changed
days; ``foreachBatch`` writes them to a folder per batch number (a repeated batch
replaces its own), and the read side keeps the latest version per (customer, day).
With no late rows the result equals the batch aggregate over the same events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WINDOW_DAYS = 30
LATE_DAYS = 2
LOG = "customer_id long, day date, sessions long, batch int"


def session_events(events: DataFrame, event_type: str = "view") -> DataFrame:
    # ts is TIMESTAMP_NTZ in the source; event-time operators need TIMESTAMP.
    return events.where(F.col("event_type") == event_type).select(
        F.col("user_id").alias("customer_id"), F.col("ts").cast("timestamp").alias("ts"))


def daily_counts(sessions: DataFrame) -> DataFrame:
    return sessions.groupBy("customer_id", F.window("ts", "1 day").alias("w")).agg(
        F.count(F.lit(1)).alias("sessions")).select("customer_id", F.to_date("w.start").alias("day"), "sessions")


def windowed(days: DataFrame, window_days: int = WINDOW_DAYS) -> DataFrame:
    """Sliding windows from day counts: a day counts in the ``window_days`` windows that contain it."""
    start = F.explode(F.sequence(F.date_sub("day", window_days - 1), F.col("day")))
    return days.select("customer_id", start.alias("window_start"), "sessions") \
        .groupBy("customer_id", "window_start").agg(F.sum("sessions").alias("sessions")) \
        .select("customer_id", "window_start", F.date_add("window_start", window_days).alias("window_end"), "sessions")


def batch_activity(events: DataFrame) -> DataFrame:
    """Batch twin of the stream (the oracle for ST2)."""
    return windowed(daily_counts(session_events(events)))


def start_activity_stream(spark: SparkSession, source_dir: str, log_dir: str, checkpoint_dir: str,
                          schema, late_days: int = LATE_DAYS, window_days: int = WINDOW_DAYS,
                          file_glob: str | None = None):
    reader = spark.readStream.schema(schema)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    sessions = session_events(reader.parquet(source_dir)).withWatermark("ts", f"{window_days + late_days} days")

    def sink(batch_df: DataFrame, batch_id: int):
        batch_df.write.mode("overwrite").parquet(f"{log_dir}/batch={batch_id}")

    return (daily_counts(sessions).writeStream.outputMode("update").foreachBatch(sink)
            .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start())


def read_latest(spark: SparkSession, log_dir: str, window_days: int = WINDOW_DAYS) -> DataFrame:
    """Windows from the latest emitted count per (customer, day)."""
    log = spark.read.schema(LOG).parquet(log_dir)
    return windowed(log.groupBy("customer_id", "day").agg(F.max_by("sessions", "batch").alias("sessions")), window_days)


def run_activity_stream(spark: SparkSession, source_dir: str, log_dir: str, checkpoint_dir: str,
                        schema, late_days: int = LATE_DAYS, file_glob: str | None = None) -> DataFrame:
    q = start_activity_stream(spark, source_dir, log_dir, checkpoint_dir, schema, late_days, file_glob=file_glob)
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return read_latest(spark, log_dir)
