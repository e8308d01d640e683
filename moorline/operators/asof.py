"""Feature snapshots of many dates in one pass (ML19, FT1-FT9).

``features.feature_snapshot`` answers one date; asking it once per date reads every child as often as there are
dates.  Here the (customer, day) rollups are read once.  Every customer's days are put in order together
with probes, one per snapshot date and window edge; running sums over that order give, at a
probe, everything up to its day, and a window's value is the difference between its two edges.
Days and probes share one exchange by customer, and regrouping the probes needs none.

What does not depend on the date (open complaints, NPS, active products) is joined once per customer;
months to the next rate reset are the difference of two month numbers, of which only one depends on it.

A window partition holds one customer's days within the dates asked for, and three probes a date.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.numeric import mean_cents
from .features import complaint_aggregate, nps_aggregate

SUMS = ["sessions", "session_ids", "competitor_n", "credit_cents", "credit_n"]


def _month_number(d):
    return F.year(d) * 12 + F.month(d)


def holding_base(holdings: DataFrame) -> DataFrame:
    """Per customer: distinct active products and the month number of the nearest rate reset."""
    per = holdings.groupBy("customer_id", "product_id").agg(
        F.max((F.col("status") == "active").cast("int")).alias("is_active"),
        F.min(_month_number(F.col("fixed_rate_end_date"))).alias("reset_month"))
    return per.groupBy("customer_id").agg(F.sum("is_active").cast("long").alias("product_n"), F.min("reset_month").alias("reset_month"))


def window_values(customers: DataFrame, dates: list[dt.date], daily_s: DataFrame, daily_t: DataFrame,
                  lookback: int = K.FEATURE_LOOKBACK_DAYS, recent: int = K.RECENT_LOGIN_DAYS) -> DataFrame:
    """One row per customer and date: last_session_date in the window, logins_recent, logins_window,
    competitor_n, credit_cents, credit_n."""
    first, last = min(dates) - dt.timedelta(days=lookback), max(dates)
    zero = F.lit(0).cast("long")

    def days(daily, columns, seen):
        values = [F.coalesce(F.col(columns[c]).cast("long"), zero).alias(c) if c in columns else zero.alias(c) for c in SUMS]
        return daily.where(F.col("d").between(F.lit(first), F.lit(last))).select(
            "customer_id", "d", F.lit(0).alias("edge"), F.lit(None).cast("date").alias("snapshot_date"), *values, seen.alias("seen"))

    sessions = days(daily_s, {"sessions": "n", "session_ids": "id_n"}, F.col("d"))
    transactions = days(daily_t, {c: c for c in SUMS[2:]}, F.lit(None).cast("date"))
    # Edge 1 is the snapshot itself, 2 the day before the recent window, 3 the day before the whole window.
    edges = F.array(*[F.struct(F.lit(s).alias("snapshot_date"), F.lit(k).alias("edge"), F.lit(s - dt.timedelta(days=back)).alias("d"))
                      for s in sorted(set(dates)) for k, back in ((1, 0), (2, recent + 1), (3, lookback + 1))])
    probes = customers.select("customer_id", F.explode(edges).alias("p")).select(
        "customer_id", "p.d", "p.edge", "p.snapshot_date", *[zero.alias(c) for c in SUMS], F.lit(None).cast("date").alias("seen"))
    up_to = Window.partitionBy("customer_id").orderBy("d", "edge").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = sessions.unionByName(transactions).unionByName(probes) \
        .withColumns({c: F.sum(c).over(up_to) for c in SUMS} | {"seen": F.max("seen").over(up_to)}).where("edge > 0")

    def at(edge, column):
        return F.max(F.when(F.col("edge") == edge, F.col(column)))

    def between(edge, column):
        return at(1, column) - at(edge, column)
    out = running.groupBy("customer_id", "snapshot_date").agg(
        at(1, "seen").alias("seen"), between(2, "sessions").alias("logins_recent"), between(3, "session_ids").alias("logins_window"),
        *[between(3, c).alias(c) for c in SUMS[2:]])
    return out.withColumn("last_session_date", F.when(F.col("seen") >= F.date_sub("snapshot_date", lookback), F.col("seen"))).drop("seen")


def snapshots(customers: DataFrame, dates: list[dt.date], daily_s: DataFrame, daily_t: DataFrame, holdings: DataFrame,
              complaints: DataFrame, nps: DataFrame, lookback: int = K.FEATURE_LOOKBACK_DAYS,
              recent: int = K.RECENT_LOGIN_DAYS) -> DataFrame:
    """The canonical feature snapshot of every date, one row per customer and date
    (``churned`` is null: labels belong to a snapshot of their own)."""
    base = customers.select("customer_id", "salary_account_flag", "segment", "region") \
        .join(holding_base(holdings), "customer_id", "left").join(complaint_aggregate(complaints), "customer_id", "left") \
        .join(nps_aggregate(nps), "customer_id", "left")
    j = base.join(window_values(customers, dates, daily_s, daily_t, lookback, recent), "customer_id")
    snap = F.col("snapshot_date")
    return j.select(
        "customer_id", "snapshot_date", F.lit(None).cast("int").alias("churned"),
        F.col("salary_account_flag").cast("int").alias("salary_account_flag"), "segment", "region",
        F.coalesce(F.datediff(snap, F.col("last_session_date")), F.lit(999)).alias("days_since_last_login"),
        F.col("logins_recent").alias("app_logins_last_30d"), F.col("logins_window").alias("app_logins_last_90d"),
        F.col("competitor_n").alias("competitor_transfer_count"),
        F.coalesce(mean_cents("credit_cents", "credit_n"), F.lit(0.0)).alias("avg_monthly_inflow_eur"),
        F.coalesce(F.col("complaints_open_n"), F.lit(0)).cast("long").alias("complaints_open"),
        F.col("nps_score").alias("nps_score_last"),
        F.coalesce(F.col("product_n"), F.lit(0)).cast("long").alias("product_count"),
        (F.col("reset_month") - _month_number(snap)).cast("int").alias("months_to_rate_reset"))
