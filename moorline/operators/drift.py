"""Feature drift between a reference and a production window (ML15, ML17, SEM14).

Input is long format ``(feature, value, period)``.  Two metrics per feature:

* normalised Wasserstein-1: the area between the two empirical CDFs divided
  by the population standard deviation of the reference values.  Rows are
  first reduced to one per (feature, distinct value); the CDFs come from a
  distributed prefix sum partitioned by feature.
* Jensen-Shannon divergence (base 2, in [0, 1]) on ``bins`` shared
  equal-width bins spanning both windows.

Per-feature totals and bin edges are one row per feature, joined back with a
broadcast below a checked number of features.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.joins import broadcast_if_bounded
from ..functions.ordered import prefix_sums
from ..session import materialize


def event_drift_input(events: DataFrame, split: dt.datetime,
                      window_days: int = K.DRIFT_WINDOW_DAYS) -> DataFrame:
    """Reference = before ``split``; production = the ``window_days`` after it.
    Compared as zone-free timestamps, independent of the session time zone."""
    ts = F.col("ts").cast("timestamp_ntz")

    def ntz(t):
        return F.lit(t.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    start, end = ntz(split), ntz(split + dt.timedelta(days=window_days))
    return events.select(
        F.col("event_type").alias("feature"), F.col("value"),
        F.when(ts < start, F.lit("reference")).when(ts < end, F.lit("production")).alias("period"),
    ).where(F.col("period").isNotNull() & F.col("value").isNotNull())


def feature_drift_input(ref_features: DataFrame, prod_features: DataFrame,
                        features=K.DRIFT_FEATURES) -> DataFrame:
    """Long format from two feature tables (the ten monitored model inputs)."""
    def melt(df, tag):
        return df.select(*[F.col(c).cast("double").alias(c) for c in features]).unpivot(
            [], list(features), "feature", "value").withColumn("period", F.lit(tag))
    return melt(ref_features, "reference").unionByName(melt(prod_features, "production")) \
        .where(F.col("value").isNotNull())


def counts(long: DataFrame) -> DataFrame:
    """One row per (feature, value) with its count in both windows.  All metrics are
    computed from this table, which is materialised: the input is read once."""
    return materialize(long.groupBy("feature", "value").agg(
        F.count(F.when(F.col("period") == "reference", 1)).alias("ref_n"),
        F.count(F.when(F.col("period") == "production", 1)).alias("prod_n")))


def _totals(c: DataFrame) -> DataFrame:
    """Per feature: window sizes, value range and population deviation of the reference
    (sum of squares about the mean, in a second pass over the counts)."""
    t = c.groupBy("feature").agg(
        F.sum("ref_n").alias("n_reference"), F.sum("prod_n").alias("n_production"),
        (F.sum(F.col("value") * F.col("ref_n")) / F.nullif(F.sum("ref_n"), F.lit(0))).alias("ref_mean"),
        F.min("value").alias("lo"), F.max("value").alias("hi"))
    d = c.join(broadcast_if_bounded(t.select("feature", "ref_mean")), "feature").groupBy("feature").agg(
        F.sum(F.col("ref_n") * F.pow(F.col("value") - F.col("ref_mean"), 2)).alias("squares"))
    return t.join(d, "feature").withColumn(
        "ref_stddev", F.sqrt(F.col("squares") / F.nullif(F.col("n_reference"), F.lit(0)))).drop("squares", "ref_mean")


def wasserstein(long: DataFrame, places: int = 6, counted: DataFrame | None = None,
                totals: DataFrame | None = None) -> DataFrame:
    """Normalised Wasserstein-1 per feature (``counted`` and ``totals`` where already computed)."""
    c = counted if counted is not None else counts(long)
    totals = totals if totals is not None else materialize(_totals(c))
    cum = prefix_sums(c, "value", ["ref_n", "prod_n"], partition_cols=["feature"], inclusive=False,
                      with_prev=True)
    j = cum.join(broadcast_if_bounded(totals), "feature")
    gap = F.col("value") - F.col("prev_value")
    diff = F.abs(F.col("cum_ref_n") / F.nullif(F.col("n_reference"), F.lit(0))
                 - F.col("cum_prod_n") / F.nullif(F.col("n_production"), F.lit(0)))
    w = j.groupBy("feature", "n_reference", "n_production", "ref_stddev").agg(
        F.sum(F.when(F.col("prev_value").isNotNull(), diff * gap)).alias("w1"))
    norm = F.col("w1") / F.nullif(F.col("ref_stddev"), F.lit(0.0))
    return w.select(
        "feature", "n_reference", "n_production",
        F.round("w1", places).alias("wasserstein"),
        F.round("ref_stddev", places).alias("ref_stddev"),
        F.round(norm, places).alias("wasserstein_norm"),
    )


def jensen_shannon(long: DataFrame, bins: int = 20, places: int = 6, counted: DataFrame | None = None,
                   totals: DataFrame | None = None) -> DataFrame:
    """Jensen-Shannon divergence per feature (``counted`` and ``totals`` where already computed)."""
    c = counted if counted is not None else counts(long)
    totals = totals if totals is not None else materialize(_totals(c))
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    b = F.when(F.col("hi") == F.col("lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col("value") - F.col("lo")) / width), F.lit(bins - 1))).cast("int")
    h = (c.join(broadcast_if_bounded(totals), "feature").withColumn("bin", b)
         .groupBy("feature", "bin", "n_reference", "n_production").agg(
             F.sum("ref_n").alias("rc"), F.sum("prod_n").alias("pc")))
    p = F.col("rc") / F.nullif(F.col("n_reference"), F.lit(0))
    q = F.col("pc") / F.nullif(F.col("n_production"), F.lit(0))
    m = (p + q) / 2

    def kl_term(x):
        return F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))
    return h.groupBy("feature").agg(
        F.round(F.sum(0.5 * kl_term(p) + 0.5 * kl_term(q)), places).alias("js_divergence"))


def drift_report(long: DataFrame, threshold: float = K.DRIFT_THRESHOLD, bins: int = 20) -> DataFrame:
    """ML15: both metrics per feature and the drift flag (normalised W1 > threshold)."""
    return report_of_counts(counts(long), threshold, bins)


def report_of_counts(c: DataFrame, threshold: float = K.DRIFT_THRESHOLD, bins: int = 20) -> DataFrame:
    """ML15 from (feature, value, ref_n, prod_n), however they were counted."""
    totals = materialize(_totals(c))
    w = wasserstein(c, counted=c, totals=totals)
    js = jensen_shannon(c, bins, counted=c, totals=totals)
    return w.join(js, "feature", "left").withColumn(
        "drifted", F.coalesce(F.col("wasserstein_norm") > F.lit(threshold), F.lit(False)))


def drift_alerts(report: DataFrame, threshold: float = K.DRIFT_THRESHOLD) -> DataFrame:
    """ML17: one alert row per (feature, metric) above the threshold."""
    long = report.select("feature", F.lit("wasserstein_norm").alias("metric"),
                         F.col("wasserstein_norm").alias("value")).unionByName(
        report.select("feature", F.lit("js_divergence").alias("metric"), F.col("js_divergence").alias("value")))
    return long.where(F.col("value") > F.lit(threshold)).withColumn("threshold", F.lit(threshold))


# -- stored baseline ----------------------------------------------------------------------------------
STORED = "feature string, value double, n long, snapshot_date date"


def store_counts(features: DataFrame, path: str, columns=K.DRIFT_FEATURES) -> None:
    """Write how often every value of every feature occurs at each snapshot date.  The counts of a date are
    written once and replace only their own partition; they add up, so any window is a sum of them."""
    long = features.select("snapshot_date", *[F.col(c).cast("double").alias(c) for c in columns]) \
        .unpivot(["snapshot_date"], list(columns), "feature", "value").where(F.col("value").isNotNull())
    (long.groupBy("feature", "value", "snapshot_date").agg(F.count(F.lit(1)).alias("n"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("snapshot_date").parquet(path))


def stored_counts(spark, path: str, reference: tuple[dt.date, dt.date], production: tuple[dt.date, dt.date]) -> DataFrame:
    """Both windows (closed ranges of snapshot dates) from the stored counts; no feature is read or
    computed again, and only the partitions of the two windows are opened."""
    day = F.col("snapshot_date")
    stored = spark.read.schema(STORED).parquet(path)
    in_ref, in_prod = day.between(*[F.lit(d) for d in reference]), day.between(*[F.lit(d) for d in production])
    return materialize(stored.where(in_ref | in_prod).groupBy("feature", "value").agg(
        F.sum(F.when(in_ref, F.col("n")).otherwise(0)).alias("ref_n"),
        F.sum(F.when(in_prod, F.col("n")).otherwise(0)).alias("prod_n")))
