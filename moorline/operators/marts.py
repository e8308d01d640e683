"""Dashboard read models and population aggregates (AG1-AG6, AG23, SE1, SC21).

pandas ``groupby``/``value_counts`` drop NULL keys while Spark keeps them
(SEM11); grouping operators here filter NULL keys first.  Sorting is left to
the consumer unless it is part of the feature (top-k), and then has a unique
tie-break (SEM21).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ordered import row_numbers


def population_summary(labelled: DataFrame) -> DataFrame:
    """AG1 / AG23: total customers, churned, churn rate in percent."""
    return labelled.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.coalesce(F.sum(F.col("churned").cast("int")), F.lit(0)).cast("long").alias("churned"),
        F.round(F.sum(F.col("churned").cast("int")) * 100.0 / F.count(F.lit(1)), 6).alias("churn_rate_pct"),
    )


def count_by(df: DataFrame, key: str, name: str = "customers") -> DataFrame:
    """AG2 / AG3 / AG10 / AG11: row count per non-null key."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(name))


def churn_by(labelled: DataFrame, key: str = "segment") -> DataFrame:
    """AG4: per key, non-null churned count, churned sum and rate in percent."""
    return (labelled.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.count("churned").alias("total"),
        F.coalesce(F.sum(F.col("churned").cast("int")), F.lit(0)).cast("long").alias("churned"),
    ).withColumn("churn_rate_pct", F.round(F.col("churned") * 100.0 / F.nullif(F.col("total"), F.lit(0)), 6)))


def holdings_by_type(holdings: DataFrame, products: DataFrame) -> DataFrame:
    """AG5 / J3: active holdings per product type.  The holdings are reduced to
    one row per product first (partial aggregation), so the join with the
    product list is between two small inputs and AQE sizes it at runtime."""
    active = (holdings.where(F.col("status") == "active").groupBy("product_id")
              .agg(F.count(F.lit(1)).alias("k")))
    p = products.select("product_id", "product_type")
    return active.join(p, "product_id").groupBy("product_type").agg(F.sum("k").alias("holdings"))


# FIXED VALUES: histogram bins chosen by us (lower edge, width, bins).
HISTOGRAM_BINS = {
    "days_since_last_login": (0, 25, 40),
    "competitor_transfer_count": (0, 1, 20),
    "complaints_open": (0, 1, 10),
}
HISTOGRAM_CAPS = {"competitor_transfer_count": 20}


def feature_histogram(features: DataFrame, bins=None) -> DataFrame:
    """AG6 / SC21 / PF11: fixed-width bins per feature split by churned.  Values below
    the first edge fall into the open bin -1, values from the last edge on into the
    open bin ``n``; ``bin_label`` says so.

    One pass: the three features are unpivoted and binned in a projection,
    then counted with a single grouped aggregate."""
    bins = bins or HISTOGRAM_BINS
    parts = []
    for feat, (lo, width, n) in bins.items():
        v = F.col(feat)
        keep = v.isNotNull()
        if feat in HISTOGRAM_CAPS:
            keep = keep & (v <= HISTOGRAM_CAPS[feat])
        b = F.least(F.greatest(F.floor((v - F.lit(lo)) / F.lit(width)), F.lit(-1)), F.lit(n)).cast("int")
        start = F.when(b >= 0, (F.lit(lo) + b * F.lit(width)).cast("double"))
        label = F.when(b < 0, F.lit(f"< {lo}")).when(b >= n, F.lit(f">= {lo + n * width}")).otherwise(
            F.concat((F.lit(lo) + b * F.lit(width)).cast("string"), F.lit(" to < "),
                     (F.lit(lo) + (b + 1) * F.lit(width)).cast("string")))
        parts.append(features.where(keep).select(
            F.lit(feat).alias("feature"), F.col("churned"), b.alias("bin"), start.alias("bin_start"),
            label.alias("bin_label")))
    u = reduce(DataFrame.unionByName, parts)
    return u.groupBy("feature", "churned", "bin", "bin_start", "bin_label").agg(F.count(F.lit(1)).alias("n"))


def ranked(df: DataFrame, key: str, *order, groups_bounded: bool = True) -> DataFrame:
    """SO2 / SO3: the rows of a small read model in display order, as (rank, key).  The
    order is by ``order`` and then the key; the input has one row per group.  Where nothing
    bounds the number of groups (free texts), they are numbered by ranges instead of in one task."""
    order = [*order, F.col(key).asc()]
    if groups_bounded:
        return df.select(F.row_number().over(Window.orderBy(*order)).alias("rank"), F.col(key).cast("string").alias("key"))
    return row_numbers(df, *order, name="rank").select(F.col("rank").cast("int").alias("rank"), F.col(key).cast("string").alias("key"))


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """AG23 / SE1: tagged UNION ALL of per-table row counts."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def top_n(df: DataFrame, n: int, *order) -> DataFrame:
    """SO5 / SO6 / PF12: ordered limit (TakeOrderedAndProject, no global sort)."""
    return df.orderBy(*order).limit(n)
