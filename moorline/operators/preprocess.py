"""Model-ready features (ML1, FT11, PF1, PF4, IO9).

Null fill with fixed defaults and type casts, then label-encode segment and
region against the sorted category lists (unknown or NULL falls back to
``standard`` / ``Flanders``; matching is exact, like the reference).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K


def encode(col: Column, categories: list[str], fallback: str) -> Column:
    """Sorted-category index; values outside the list map to the fallback's index."""
    idx = {c: i for i, c in enumerate(sorted(categories))}
    expr = F.lit(idx[fallback])
    for c in sorted(categories, reverse=True):
        expr = F.when(col == F.lit(c), F.lit(idx[c])).otherwise(expr)
    return F.when(col.isNull(), F.lit(idx[fallback])).otherwise(expr).cast("int")


def fill_features(df: DataFrame) -> DataFrame:
    """ML1: fixed null fill + cast for the ten numeric features."""
    cols = []
    for c in df.columns:
        if c in K.FEATURE_DEFAULTS:
            default, typ = K.FEATURE_DEFAULTS[c]
            val = F.col(c)
            if typ == "double":
                val = F.when(F.isnan(val.cast("double")), None).otherwise(val.cast("double"))
            cols.append(F.coalesce(val, F.lit(default)).cast(typ).alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


def model_ready(features: DataFrame) -> DataFrame:
    """Filled features plus ``segment_enc`` / ``region_enc``."""
    filled = fill_features(features)
    return filled.withColumn(
        "segment_enc", encode(F.col("segment"), K.SEGMENT_CATEGORIES, K.SEGMENT_FALLBACK)
    ).withColumn(
        "region_enc", encode(F.col("region"), K.REGION_CATEGORIES, K.REGION_FALLBACK)
    )


def feature_vector_columns(df: DataFrame) -> DataFrame:
    """PF1/PF2: ordered model columns, tolerant of missing optional columns."""
    keep = ["customer_id", "snapshot_date", "segment", "region", "churned"] + K.FEATURE_COLUMNS
    return df.select(*[c for c in keep if c in df.columns])


def window_filter(df: DataFrame, start, end) -> DataFrame:
    """PF4: materialisation window on snapshot_date (closed) - a partition
    filter when the feature table is partitioned by snapshot_date."""
    return df.where(F.col("snapshot_date").between(F.lit(start), F.lit(end)))
