"""Sources and sinks (IO1-IO20, ML18, ML19).

Everything is a DataFrame reader/writer call with an explicit schema or
partition layout; nothing passes through the driver.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, FloatType, StructType, TimestampNTZType, TimestampType


# -- feature table (IO5, PF4, ML18, ML19) ------------------------------------------
def write_feature_table(features: DataFrame, path: str, dataset_version: str) -> None:
    """Partitioned by dataset_version / snapshot_date; with dynamic partition
    overwrite only the partitions present in ``features`` are replaced."""
    (features.withColumn("dataset_version", F.lit(dataset_version))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("dataset_version", "snapshot_date").parquet(path))


def read_feature_table(spark: SparkSession, path: str, start=None, end=None,
                       dataset_version: str | None = None) -> DataFrame:
    """PF4: the window filter is on partition columns, so only the matching
    folders are listed and read."""
    df = spark.read.parquet(path)
    if dataset_version is not None:
        df = df.where(F.col("dataset_version") == dataset_version)
    if start is not None:
        df = df.where(F.col("snapshot_date") >= F.lit(start))
    if end is not None:
        df = df.where(F.col("snapshot_date") <= F.lit(end))
    return df


def feature_manifest(spark: SparkSession, path: str) -> DataFrame:
    """ML18: what a feature table holds: rows per dataset version and snapshot date, and
    the feature columns in order."""
    df = spark.read.parquet(path)
    keys = ["dataset_version", "snapshot_date"]
    names = ",".join(c for c in df.columns if c not in keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).withColumn("columns", F.lit(names))


def backfill(snapshots: DataFrame, path: str, dataset_version: str) -> None:
    """ML19: write the feature rows of many snapshot dates with one job; each date replaces
    its own partition only (idempotent reruns)."""
    write_feature_table(snapshots.hint("rebalance", "snapshot_date"), path, dataset_version)


def load_parts(spark: SparkSession, path: str) -> DataFrame:
    """IO2: scan a folder of parquet parts; an empty folder is an error."""
    df = spark.read.parquet(path)
    if df.limit(1).count() == 0:
        raise ValueError(f"no feature rows under {path}")
    return df


# -- CSV batch (IO3, IO7, IO17) ---------------------------------------------------------
# Blanks at the ends of values, quotes and line breaks inside them survive a round trip.
CSV = {"header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**CSV).csv(path)


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).options(**CSV, multiLine="true").csv(path)


def export_existing_columns(df: DataFrame, wanted: list[str], path: str) -> None:
    """IO17: CSV export of the wanted columns that exist."""
    write_csv(df.select(*[c for c in wanted if c in df.columns]), path)


# -- metrics JSON (IO18) -------------------------------------------------------------------
def write_metrics(metrics: DataFrame, path: str) -> None:
    metrics.coalesce(1).write.mode("overwrite").json(path)


def read_metrics(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


# -- warehouse load (IO6, IO8, IO9) ----------------------------------------------------------
def clean_for_load(df: DataFrame, date_columns: list[str] = ()) -> DataFrame:
    """IO9: NaN -> NULL for floating columns; listed timestamp columns -> DATE."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (DoubleType, FloatType)):
            c = F.when(F.isnan(c), None).otherwise(c)
        if f.name in date_columns and isinstance(f.dataType, (TimestampType, TimestampNTZType, DateType)):
            c = c.cast("date")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def load_population(tables: dict[str, DataFrame], base: str, population: str) -> None:
    """IO6 / IO8: population 'a' is a full reload and empties every table first (all
    populations go); later populations replace only their own partition, so that a
    repeated load adds nothing."""
    mode = "static" if population == "a" else "dynamic"
    for name, df in tables.items():
        (df.withColumn("population", F.lit(population)).write.mode("overwrite")
         .option("partitionOverwriteMode", mode).partitionBy("population").parquet(f"{base}/{name}"))


# -- dashboard marts (IO4, IO16) -------------------------------------------------------------
def refresh_marts(marts: dict[str, DataFrame], base: str) -> None:
    for name, df in marts.items():
        df.write.mode("overwrite").parquet(f"{base}/{name}")


def read_mart(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base}/{name}")


# -- existence ------------------------------------------------------------------------------------
def exists(spark: SparkSession, path: str) -> bool:
    """Whether a Parquet table is there.  Only a missing or empty path counts as
    absent; any other failure (permissions, damaged files) is raised."""
    try:
        spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
    return True


# -- outreach tables (IO10-IO12, SEM17) ---------------------------------------------------------
def append_idempotent(spark: SparkSession, rows: DataFrame, path: str,
                      keys=("batch_date", "customer_id")) -> DataFrame:
    """Append rows whose key is not stored yet (reruns add nothing; of incoming rows
    with one key the smallest counts).  The surrogate id is a hash of the key, not a
    global counter."""
    keys = list(keys)
    rest = [c for c in rows.columns if c not in keys]
    one = rows.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("r")).select(*keys, "r.*").select(*rows.columns)
    new = one.withColumn("id", F.xxhash64(*keys))
    if exists(spark, path):
        stored = spark.read.parquet(path).select(*keys)
        # A batch has few dates; row groups of other dates are skipped by their statistics.
        dates = [r[0] for r in one.select(keys[0]).distinct().limit(1001).collect()]
        if len(dates) <= 1000 and None not in dates:
            stored = stored.where(F.col(keys[0]).isin(dates))
        new = new.join(stored, keys, "left_anti")
    new.write.mode("append").parquet(path)
    return new


# -- profile store (IO13, IO14) ------------------------------------------------------------------
class VersionedStore:
    """Keyed table kept as immutable version folders and a log of them.

    ``upsert`` writes ``old anti-join new  UNION  new`` into a fresh version folder and
    then appends its name to the log.  An append becomes visible as a whole file, so
    readers see the version before or the version after, never none; a log that
    cannot be read is an error, not an empty store.  One writer at a time.
    """

    LOG = "seq long, path string"

    def __init__(self, spark: SparkSession, base: str, key: str = "customer_id"):
        self.spark, self.base, self.key = spark, base, key

    def _last(self):
        if not exists(self.spark, f"{self.base}/_versions"):
            return None
        return self.spark.read.schema(self.LOG).parquet(f"{self.base}/_versions") \
            .agg(F.max(F.struct("seq", "path")).alias("v")).first().v

    def current_path(self) -> str | None:
        last = self._last()
        return last.path if last else None

    def read(self) -> DataFrame | None:
        p = self.current_path()
        return self.spark.read.parquet(p) if p else None

    def _publish(self, df: DataFrame) -> str:
        last = self._last()
        path = f"{self.base}/v-{dt.datetime.now(dt.timezone.utc):%Y%m%d%H%M%S}-{uuid.uuid4().hex[:8]}"
        df.write.mode("errorifexists").parquet(path)
        self.spark.createDataFrame([((last.seq if last else 0) + 1, path)], self.LOG).coalesce(1) \
            .write.mode("append").parquet(f"{self.base}/_versions")
        return path

    def upsert(self, incoming: DataFrame) -> str:
        old = self.read()
        merged = incoming if old is None else \
            old.join(incoming.select(self.key), self.key, "left_anti").unionByName(incoming)
        return self._publish(merged)

    def retain(self, active_ids: DataFrame) -> str:
        """IO14: keep only rows whose key is active."""
        old = self.read()
        return self._publish(old.join(active_ids.select(self.key), self.key, "left_semi"))
