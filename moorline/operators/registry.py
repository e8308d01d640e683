"""Run log and model registry as tables (ML11-ML14, ML18, AG20, AG21, WN3, PV4, SO4).

The registry is a DataFrame with one row per model version (string version
ordered numerically, status in staging/production/retired).  Every operation
is a projection or a small aggregate over it; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from . import metrics as MT

METRIC_COLS = ["precision", "recall", "f1", "auc", "false_positive_rate"]


def runs_by_day(scored: DataFrame, snapshot, date_col: str = "scored_date",
                threshold: float = K.HIGH_RISK_THRESHOLD) -> DataFrame:
    """ML11: one evaluation run per scoring day with its parameters and metrics.
    ``version`` is the day number since the snapshot (1-based) as a string."""
    m = MT.grouped_metrics(scored, [date_col], threshold)
    return m.select(
        F.concat(F.lit("run-"), F.date_format(date_col, "yyyyMMdd")).alias("run_id"),
        F.col(date_col).alias("run_date"),
        (F.datediff(F.col(date_col), F.lit(snapshot)) + 1).cast("string").alias("version"),
        F.lit(threshold).alias("churn_threshold"),
        "n_rows", *METRIC_COLS,
    )


def gate(runs: DataFrame, precision_gate: float = K.PRECISION_GATE,
         dataset_version: str = "v1") -> DataFrame:
    """ML12 + ML18: runs whose precision passes the gate become ``staging``
    registry versions tagged with dataset version and metrics."""
    return runs.where(F.col("precision") >= F.lit(precision_gate)).select(
        "version", F.lit("staging").alias("status"), F.lit(dataset_version).alias("dataset_version"),
        F.col("run_date").alias("snapshot_date"), *METRIC_COLS[:4])


def _vnum():
    return F.col("version").cast("int")


def _one_row(df: DataFrame, *aggs) -> DataFrame:
    """A registry-wide aggregate (one row, computed with partial aggregation)
    keyed for an equi-join back onto every registry row."""
    return df.agg(*aggs).withColumn("_k", F.lit(0))


def promote(registry: DataFrame, version: str | None = None) -> DataFrame:
    """ML14: target -> production, any other production -> retired.  Default
    target: the newest staging version (numeric order).  Without a target the
    registry is returned unchanged; ``require_target`` is the check for jobs."""
    if version is not None:
        tgt = _one_row(registry, F.max(F.when(F.col("version") == str(version), _vnum())).alias("_t"))
    else:
        tgt = _one_row(registry, F.max(F.when(F.col("status") == "staging", _vnum())).alias("_t"))
    j = registry.withColumn("_k", F.lit(0)).join(F.broadcast(tgt), "_k")
    is_target = F.coalesce(_vnum() == F.col("_t"), F.lit(False))
    new_status = (F.when(is_target, F.lit("production"))
                  .when((F.col("status") == "production") & F.col("_t").isNotNull(), F.lit("retired"))
                  .otherwise(F.col("status")))
    return j.withColumn("status", new_status).drop("_k", "_t")


def require_target(registry: DataFrame, version: str | None = None) -> None:
    """Raise when there is nothing to promote."""
    wanted = F.col("status") == "staging" if version is None else F.col("version") == str(version)
    if registry.where(wanted).isEmpty():
        raise LookupError("no staging version to promote" if version is None else f"no version {version}")


def next_version(registry: DataFrame | None) -> str:
    """One above the highest version number (numeric order), "1" for a new registry."""
    last = registry.agg(F.max(_vnum())).first()[0] if registry is not None else None
    return str((last or 0) + 1)


def resolve(registry: DataFrame) -> DataFrame:
    """ML13: the highest production version, else the highest staging version.
    Empty result = no usable model (the caller raises)."""
    rank = F.when(F.col("status") == "production", 0).when(F.col("status") == "staging", 1)
    usable = registry.where(rank.isNotNull())
    best = usable.agg(F.min_by(F.struct(*usable.columns),
                               F.struct(rank.alias("r"), (-_vnum()).alias("v"))).alias("m"))
    return best.where(F.col("m").isNotNull()).select("m.*")


def listing(registry: DataFrame) -> DataFrame:
    """AG20: registry rows with production/staging/total counts."""
    stats = _one_row(
        registry,
        F.max(F.when(F.col("status") == "production", _vnum())).cast("string").alias("production_version"),
        F.count(F.when(F.col("status") == "staging", 1)).alias("staging_count"),
        F.count(F.lit(1)).alias("total_versions"))
    return registry.withColumn("_k", F.lit(0)).join(F.broadcast(stats), "_k").drop("_k")


def metric_trend(runs: DataFrame, n: int = 20) -> DataFrame:
    """AG21 / WN3 / PV4: the ``n`` newest runs indexed from 0 (newest first),
    melted to (run_index, run_id, metric, value)."""
    top = runs.orderBy(F.desc("run_date"), F.desc("run_id")).limit(n)
    idx = top.withColumn("run_index", F.row_number().over(
        Window.orderBy(F.desc("run_date"), F.desc("run_id"))) - 1)
    return idx.unpivot(["run_index", "run_id"], METRIC_COLS[:4], "metric", "value")
