"""Customer feature aggregate (FT1-FT12, J1, J2, PF3, PF13).

Canonical plan: each child table is filtered to its window, reduced to one
row per customer with a partial (map-side) aggregate, and the five reduced
tables are left-joined to the customers.  All reduced tables are hash
partitioned on ``customer_id``, so the joins between them need no further
exchange - only the customer table is shuffled once more.  A customer with a
third of all rows costs nothing extra here: partial aggregation collapses it
to one row per map task before the shuffle.

``compat="fanout"`` reproduces the literal five-way LEFT JOIN + GROUP BY, in
which every count/sum is multiplied by the row counts of the *other* joined
children (SEM1).  It is computed in closed form from per-child counts; the
cross product is never built.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.dates import as_date_col, in_closed, month_boundaries
from ..functions.numeric import mean_cents


def daily_sessions(sessions: DataFrame) -> DataFrame:
    """One row per (customer, session day): count, non-null ids, total duration.
    Shared by features, labels and profiles; a hot customer becomes at most
    one row per day after map-side partial aggregation."""
    cols = set(sessions.columns)
    dur = F.col("session_duration_seconds") if "session_duration_seconds" in cols else F.lit(None).cast("int")
    return sessions.groupBy("customer_id", F.col("session_date").alias("d")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count("id").alias("id_n"),
        F.sum(dur).cast("long").alias("duration_sum"),
        F.count(dur).alias("duration_n"))


def daily_transactions(transactions: DataFrame, bics=None) -> DataFrame:
    """One row per (customer, transaction day) with every count/sum the labels,
    features and profiles need."""
    bics = bics or K.COMPETITOR_BICS
    credit = F.col("direction") == "credit"
    return transactions.groupBy("customer_id", F.col("transaction_date").alias("d")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(credit & (F.col("merchant_category") == "salary"), 1)).alias("salary_credit_n"),
        F.count(F.when((F.col("direction") == "debit") & F.col("counterparty_bank_bic").isin(*bics), 1))
        .alias("competitor_debit_n"),
        F.count(F.when(F.col("is_competitor_transfer"), 1)).alias("competitor_n"),
        F.sum(F.when(credit, (F.col("amount_eur") * 100).cast("long"))).alias("credit_cents"),
        F.count(F.when(credit, F.col("amount_eur"))).alias("credit_n"))


def session_aggregate(sessions: DataFrame | None, snapshot, lookback: int = K.FEATURE_LOOKBACK_DAYS,
                      recent: int = K.RECENT_LOGIN_DAYS, daily: DataFrame | None = None) -> DataFrame:
    snap = as_date_col(snapshot)
    daily = daily if daily is not None else daily_sessions(sessions)
    s = daily.where(in_closed(F.col("d"), F.date_sub(snap, lookback), snap))
    return s.groupBy("customer_id").agg(
        F.max("d").alias("last_session_date"),
        F.sum(F.when(F.col("d") >= F.date_sub(snap, recent), F.col("n")).otherwise(0)).alias("logins_recent"),
        F.sum("id_n").alias("logins_window"),
        F.sum("n").alias("n_sessions"),
    )


def transaction_aggregate(transactions: DataFrame | None, snapshot,
                          lookback: int = K.FEATURE_LOOKBACK_DAYS, daily: DataFrame | None = None) -> DataFrame:
    snap = as_date_col(snapshot)
    daily = daily if daily is not None else daily_transactions(transactions)
    t = daily.where(in_closed(F.col("d"), F.date_sub(snap, lookback), snap))
    return t.groupBy("customer_id").agg(
        F.sum("competitor_n").alias("competitor_n"),
        F.sum("credit_cents").alias("credit_cents"),
        F.sum("credit_n").alias("credit_n"),
        F.sum("n").alias("n_transactions"),
    )


def complaint_aggregate(complaints: DataFrame) -> DataFrame:
    # complaint_id is the key of the complaints table, so a conditional count
    # equals COUNT(DISTINCT ...) without a distinct-aggregate Expand.
    return complaints.groupBy("customer_id").agg(
        F.count(F.when(F.col("status") == "open", F.col("complaint_id"))).alias("complaints_open_n"),
        F.count(F.lit(1)).alias("n_complaints"),
    )


def nps_aggregate(nps: DataFrame, snapshot=None, mode: str = "max") -> DataFrame:
    """``mode="max"``: literal MAX(score).  ``mode="latest_180d"``: the most
    recent score within 180 days of the snapshot (spec meaning, SEM4)."""
    if mode == "latest_180d":
        snap = as_date_col(snapshot)
        n = nps.where(in_closed(F.col("response_date"), F.date_sub(snap, 180), snap))
        return n.groupBy("customer_id").agg(
            F.max_by("score", F.struct("response_date", "id")).alias("nps_score"),
            F.count(F.lit(1)).alias("n_nps"),
        )
    return nps.groupBy("customer_id").agg(
        F.max("score").alias("nps_score"),
        F.count(F.lit(1)).alias("n_nps"),
    )


def holding_stats(holdings: DataFrame, snapshot, window_days: int = K.CHURN_WINDOW_DAYS,
                  as_of: bool = False) -> DataFrame:
    """Per customer, in one pass over the holdings: the label counts (holdings
    closing inside the forward window, holdings active at the snapshot) and
    the feature values (distinct active products, months to the nearest
    fixed-rate reset, raw row count for fan-out mode).

    ``as_of=False`` counts products by the current ``status`` (literal, SEM2);
    ``as_of=True`` by activity on the snapshot date.  Rows are first reduced
    per (customer, product): that set is bounded by the catalogue size."""
    snap = as_date_col(snapshot)
    end = F.col("end_date")
    active_at_snap = (F.col("start_date") <= snap) & (end.isNull() | (end > snap))
    active = active_at_snap if as_of else (F.col("status") == "active")
    per_product = holdings.groupBy("customer_id", "product_id").agg(
        F.max(active.cast("int")).alias("is_active"),
        F.min(month_boundaries(snap, F.col("fixed_rate_end_date"))).alias("mrr"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count(F.when(end.isNotNull() & in_closed(end, snap, F.date_add(snap, window_days)), 1)).alias("closed_n"),
        F.count(F.when(active_at_snap, 1)).alias("active_n"),
    )
    return per_product.groupBy("customer_id").agg(
        F.sum("is_active").cast("long").alias("product_n"),
        F.min("mrr").alias("months_to_rate_reset"),
        F.sum("n_rows").alias("n_holdings"),
        F.sum("closed_n").alias("closed_n"),
        F.sum("active_n").alias("active_n"),
    )


def holding_aggregate(holdings: DataFrame, snapshot, as_of: bool = False) -> DataFrame:
    """Feature view of ``holding_stats``."""
    return holding_stats(holdings, snapshot, as_of=as_of).select(
        "customer_id", "product_n", "months_to_rate_reset", "n_holdings")


def feature_snapshot(customers: DataFrame | None, labels: DataFrame | None, sessions: DataFrame | None,
                     transactions: DataFrame | None, complaints: DataFrame, nps: DataFrame,
                     holdings: DataFrame | None, snapshot: dt.date, compat: str = "canonical",
                     lookback: int = K.FEATURE_LOOKBACK_DAYS, recent: int = K.RECENT_LOGIN_DAYS,
                     nps_mode: str = "max", as_of: bool = False,
                     daily_s: DataFrame | None = None, daily_t: DataFrame | None = None,
                     holding: DataFrame | None = None, labelled: DataFrame | None = None) -> DataFrame:
    """One row per customer: keys, churned, the 10 raw features, segment, region.

    ``daily_s`` / ``daily_t`` / ``holding`` are optional shared rollups of the
    children; ``labelled`` (customers already carrying ``churned``) replaces
    the customers + labels join so the customer table is scanned once, and if it
    carries the label joins' statistics (``keep_stats``) no child is joined again."""
    snap = as_date_col(snapshot)
    c = complaint_aggregate(complaints)
    n = nps_aggregate(nps, snapshot, nps_mode)
    cols = ["customer_id", "snapshot_date", "salary_account_flag", "segment", "region"]
    stats = ["last_session_date", "logins_recent", "logins_window", "n_sessions", "competitor_n", "credit_cents", "credit_n",
             "n_transactions", "product_n", "months_to_rate_reset", "n_holdings"]
    joined = labelled is not None and set(stats) <= set(labelled.columns)
    if joined:
        base = labelled.select(*cols, "churned", *stats)
    elif labelled is not None:
        base = labelled.select(*cols, "churned")
    elif labels is not None:
        base = customers.select(*cols).join(labels.select("customer_id", "churned"), "customer_id", "left")
    else:
        base = customers.select(*cols).withColumn("churned", F.lit(None).cast("boolean"))
    if not joined:
        s = session_aggregate(sessions, snapshot, lookback, recent, daily=daily_s)
        t = transaction_aggregate(transactions, snapshot, lookback, daily=daily_t)
        h = (holding if holding is not None else holding_stats(holdings, snapshot, as_of=as_of)).select(
            "customer_id", "product_n", "months_to_rate_reset", "n_holdings")
        base = base.join(s, "customer_id", "left").join(t, "customer_id", "left").join(h, "customer_id", "left")
    j = base.join(c, "customer_id", "left").join(n, "customer_id", "left")

    def m(col):  # max(1, rows of a child in the literal join)
        return F.greatest(F.coalesce(F.col(col), F.lit(0)), F.lit(1))

    if compat == "fanout":
        others_s = m("n_transactions") * m("n_complaints") * m("n_nps") * m("n_holdings")
        others_t = m("n_sessions") * m("n_complaints") * m("n_nps") * m("n_holdings")
        logins_recent = F.coalesce(F.col("logins_recent"), F.lit(0)) * others_s
        logins_window = F.coalesce(F.col("logins_window"), F.lit(0)) * others_s
        competitor = F.coalesce(F.col("competitor_n"), F.lit(0)) * others_t
    elif compat == "canonical":
        logins_recent = F.coalesce(F.col("logins_recent"), F.lit(0))
        logins_window = F.coalesce(F.col("logins_window"), F.lit(0))
        competitor = F.coalesce(F.col("competitor_n"), F.lit(0))
    else:
        raise ValueError(f"unknown compat mode {compat!r}")

    inflow = F.coalesce(mean_cents("credit_cents", "credit_n"), F.lit(0.0))
    return j.select(
        "customer_id",
        "snapshot_date",
        F.col("churned").cast("int").alias("churned"),
        F.col("salary_account_flag").cast("int").alias("salary_account_flag"),
        "segment",
        "region",
        F.coalesce(F.datediff(snap, F.col("last_session_date")), F.lit(999)).alias("days_since_last_login"),
        logins_recent.cast("long").alias("app_logins_last_30d"),
        logins_window.cast("long").alias("app_logins_last_90d"),
        competitor.cast("long").alias("competitor_transfer_count"),
        inflow.alias("avg_monthly_inflow_eur"),
        F.coalesce(F.col("complaints_open_n"), F.lit(0)).cast("long").alias("complaints_open"),
        F.col("nps_score").alias("nps_score_last"),
        F.coalesce(F.col("product_n"), F.lit(0)).cast("long").alias("product_count"),
        F.col("months_to_rate_reset").cast("int").alias("months_to_rate_reset"),
    )


def feature_mart(customers: DataFrame, labels: DataFrame, sessions: DataFrame | None,
                 transactions: DataFrame | None, complaints: DataFrame, snapshot,
                 daily_s: DataFrame | None = None, daily_t: DataFrame | None = None) -> DataFrame:
    """Dashboard ``customer_features`` mart (FT12, J2, SEM5): no session window
    (forward sessions give negative days), transactions bounded below only,
    NULL instead of 999; fan-out removed by pre-aggregation."""
    snap = as_date_col(snapshot)
    daily_s = daily_s if daily_s is not None else daily_sessions(sessions)
    daily_t = daily_t if daily_t is not None else daily_transactions(transactions)
    s = daily_s.groupBy("customer_id").agg(F.max("d").alias("last_session_date"))
    t = (daily_t.where(F.col("d") >= F.date_sub(snap, 90))
         .groupBy("customer_id").agg(F.sum("competitor_n").alias("competitor_n")))
    c = complaint_aggregate(complaints)
    base = customers.select("customer_id").join(labels.select("customer_id", "churned"), "customer_id", "left")
    j = base.join(s, "customer_id", "left").join(t, "customer_id", "left").join(c, "customer_id", "left")
    return j.select(
        "customer_id",
        F.col("churned").cast("int").alias("churned"),
        F.datediff(snap, F.col("last_session_date")).alias("days_since_last_login"),
        F.coalesce(F.col("competitor_n"), F.lit(0)).cast("long").alias("competitor_transfer_count"),
        F.coalesce(F.col("complaints_open_n"), F.lit(0)).cast("long").alias("complaints_open"),
    )
