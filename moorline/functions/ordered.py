"""Distributed ordered prefix sums and row numbers.

AUC and Wasserstein distances need running totals in value order.  A window
without ``partitionBy`` would pull every row into one task, so the prefix sum
is computed in two passes:

1. rows are range partitioned by group and value (Spark samples the bounds) and written once with the
   number of their range, so each row is placed by one lookup whatever the number of ranges;
2. totals per group and range, of which there are at most ranges + groups, get a running total of their own
   and give each range's offset; inside a range a window finishes the job.

Ranges follow the values, so they stay balanced where values concentrate.
Input should already be reduced to one row per distinct value,
so a value repeated a billion times is one row here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .joins import bounded

# The number of value ranges follows the number of rows (one per distinct value).
ROWS_PER_BUCKET, LEAST_BUCKETS = 1_000_000, 16
MAX_BROADCAST_GROUPS = 1_000


def prefix_sums(df: DataFrame, order_col: str, value_cols: list[str], partition_cols=(),
                buckets: int | None = None, inclusive: bool = True,
                with_prev: bool = False) -> DataFrame:
    """Add ``cum_<v>`` = running sum of ``v`` in ``order_col`` order (per
    ``partition_cols`` group), inclusive or exclusive of the current row.
    ``with_prev`` also adds ``prev_<order_col>``, the previous value in the
    group's global order (NULL for the first).  ``order_col`` must be unique
    within a group."""
    parts = list(partition_cols)
    if buckets is None:
        buckets = max(LEAST_BUCKETS, -(-df.count() // ROWS_PER_BUCKET))
    dummy = not parts
    if dummy:
        df, parts = df.withColumn("_g", F.lit(0)), ["_g"]
    # Written, because a range's number must not change between the two passes.
    withb = materialize(df.repartitionByRange(buckets, *parts, order_col).withColumn("_bucket", F.spark_partition_id()))

    totals = withb.groupBy(*parts, "_bucket").agg(*[F.sum(v).alias(f"_t_{v}") for v in value_cols],
                                                  F.max(order_col).alias("_bmax"))
    wt = Window.partitionBy(*parts).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    wl = Window.partitionBy(*parts).orderBy("_bucket")
    offsets = materialize(totals.select(*parts, "_bucket", *[
        F.coalesce(F.sum(f"_t_{v}").over(wt), F.lit(0)).alias(f"_o_{v}") for v in value_cols],
        F.lag("_bmax").over(wl).alias("_prev_bmax")))
    small = bounded(offsets, buckets + MAX_BROADCAST_GROUPS)

    frame_end = Window.currentRow if inclusive else -1
    wr = Window.partitionBy(*parts, "_bucket").orderBy(order_col).rowsBetween(Window.unboundedPreceding, frame_end)
    wp = Window.partitionBy(*parts, "_bucket").orderBy(order_col)
    running = withb.select("*", *[F.coalesce(F.sum(v).over(wr), F.lit(0)).alias(f"_r_{v}") for v in value_cols],
                           F.lag(order_col).over(wp).alias("_prev_in"))
    out = running.join(F.broadcast(offsets) if small else offsets, [*parts, "_bucket"])
    for v in value_cols:
        out = out.withColumn(f"cum_{v}", F.col(f"_o_{v}") + F.col(f"_r_{v}"))
    if with_prev:
        out = out.withColumn(f"prev_{order_col}", F.coalesce(F.col("_prev_in"), F.col("_prev_bmax")))
    out = out.drop("_bucket", "_prev_in", "_prev_bmax", *[f"_o_{v}" for v in value_cols],
                   *[f"_r_{v}" for v in value_cols])
    return out.drop("_g") if dummy else out


def row_numbers(df: DataFrame, *order, name: str = "row_number") -> DataFrame:
    """Add ``name``: the row's number from 1 in a global order (which must be total), without a
    single-task window.  Rows are range partitioned and written once with their position inside
    their partition; the partitions' sizes (one row each) give the offsets."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = materialize(df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                         .withColumn("_at", F.monotonically_increasing_id()))
    part, first, offsets = F.shiftright("_at", 33), 0, []
    for r in sorted(placed.groupBy(part.alias("part")).count().collect()):
        offsets.append((r["part"], first))
        first += r["count"]
    table = df.sparkSession.createDataFrame(offsets, "_part bigint, _offset bigint")
    return placed.withColumn("_part", part).join(F.broadcast(table), "_part") \
        .withColumn(name, F.col("_offset") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1).drop("_part", "_offset", "_at")
