"""Churn labels from forward-window behaviour (LB1-LB7, WN1, WN2, J6).

Window ``[snap, snap+60]`` (closed).  Every signal is a per-customer
aggregate; the two sequence signals (inactivity gap, rolling transfers) first
reduce rows to one per (customer, day) and keep the days that labels and features look at
(90 before the snapshot to 60 after it), which bounds each window partition to
151 rows no matter how long a history or how many events a hot customer has, then use a
``lag`` / ``rangeBetween`` window over that bounded set.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.dates import as_date_col, in_closed
from .features import daily_sessions, daily_transactions, holding_stats


def _in_window(daily: DataFrame, snapshot, window_days: int) -> DataFrame:
    snap = as_date_col(snapshot)
    return daily.where(in_closed(F.col("d"), snap, F.date_add(snap, window_days)))


def _salary_agg(daily: DataFrame, snapshot, window_days: int, baseline_days: int) -> DataFrame:
    snap = as_date_col(snapshot)
    d = F.col("d")
    return daily.where(F.col("salary_credit_n") > 0).groupBy("customer_id").agg(
        F.sum(F.when((d >= F.date_sub(snap, baseline_days)) & (d < snap), F.col("salary_credit_n"))
              .otherwise(0)).alias("pre_n"),
        F.sum(F.when(in_closed(d, snap, F.date_add(snap, window_days)), F.col("salary_credit_n"))
              .otherwise(0)).alias("post_n"))


def _gap_agg(daily: DataFrame, snapshot, window_days: int) -> DataFrame:
    days = _in_window(daily, snapshot, window_days).select("customer_id", "d")
    w = Window.partitionBy("customer_id").orderBy("d")
    return days.withColumn("gap", F.datediff(F.col("d"), F.lag("d").over(w))).groupBy("customer_id").agg(
        F.min("d").alias("first_d"), F.max("d").alias("last_d"), F.max("gap").alias("max_gap"))


def _rolling_agg(daily: DataFrame, snapshot, window_days: int, span_days: int) -> DataFrame:
    days = _in_window(daily.where(F.col("competitor_debit_n") > 0), snapshot, window_days)
    dn = days.select("customer_id", F.col("competitor_debit_n").alias("n"),
                     F.datediff(F.col("d"), F.lit("1970-01-01").cast("date")).alias("dn"))
    w = Window.partitionBy("customer_id").orderBy("dn").rangeBetween(0, span_days)
    return dn.withColumn("in_span", F.sum("n").over(w)).groupBy("customer_id").agg(
        F.max("in_span").alias("max_in_span"))


def salary_stop(customers: DataFrame, transactions: DataFrame | None, snapshot,
                window_days: int = K.CHURN_WINDOW_DAYS,
                baseline_days: int = K.SALARY_BASELINE_DAYS, daily: DataFrame | None = None) -> DataFrame:
    """LB1: salary flag set, >=1 salary credit in [snap-90, snap), none in [snap, snap+60]."""
    daily = daily if daily is not None else daily_transactions(transactions)
    agg = _salary_agg(daily, snapshot, window_days, baseline_days)
    j = customers.select("customer_id", "salary_account_flag").join(agg, "customer_id", "left")
    fired = (F.coalesce(F.col("salary_account_flag"), F.lit(False))
             & (F.coalesce(F.col("pre_n"), F.lit(0)) > 0)
             & (F.coalesce(F.col("post_n"), F.lit(0)) == 0))
    return j.select("customer_id", fired.alias("signal_salary_stop"))


def app_inactive(customers: DataFrame, sessions: DataFrame | None, snapshot,
                 window_days: int = K.CHURN_WINDOW_DAYS, gap_days: int = K.INACTIVITY_GAP_DAYS,
                 daily: DataFrame | None = None) -> DataFrame:
    """LB2: no session in the window, or a gap >= 30 days at the start, between
    consecutive sessions, or at the end.  Customers without sessions fire."""
    snap = as_date_col(snapshot)
    daily = daily if daily is not None else daily_sessions(sessions)
    per = _gap_agg(daily, snapshot, window_days)
    fired_seen = ((F.datediff(F.col("first_d"), snap) >= gap_days)
                  | (F.coalesce(F.col("max_gap"), F.lit(0)) >= gap_days)
                  | (F.datediff(F.date_add(snap, window_days), F.col("last_d")) >= gap_days))
    j = customers.select("customer_id").join(per, "customer_id", "left")
    return j.select("customer_id",
                    F.when(F.col("first_d").isNull(), F.lit(True)).otherwise(fired_seen)
                    .alias("signal_app_inactive"))


def product_reduction(customers: DataFrame, holdings: DataFrame, snapshot,
                      window_days: int = K.CHURN_WINDOW_DAYS) -> DataFrame:
    """LB3: >=1 holding ends within [snap, snap+60] and >1 holding is active at snap."""
    snap = as_date_col(snapshot)
    end = F.col("end_date")
    agg = holdings.groupBy("customer_id").agg(
        F.count(F.when(end.isNotNull() & in_closed(end, snap, F.date_add(snap, window_days)), 1))
        .alias("closed_n"),
        F.count(F.when((F.col("start_date") <= snap) & (end.isNull() | (end > snap)), 1)).alias("active_n"),
    )
    j = customers.select("customer_id").join(agg, "customer_id", "left")
    fired = (F.coalesce(F.col("closed_n"), F.lit(0)) >= 1) & (F.coalesce(F.col("active_n"), F.lit(0)) > 1)
    return j.select("customer_id", fired.alias("signal_product_reduction"))


def competitor_debits(transactions: DataFrame, bics=None) -> DataFrame:
    """LB6: debits whose counterparty BIC is a competitor (broadcast-size literal set)."""
    bics = bics or K.COMPETITOR_BICS
    return transactions.where((F.col("direction") == "debit") & F.col("counterparty_bank_bic").isin(*bics))


def competitor_rolling(customers: DataFrame, transactions: DataFrame | None, snapshot,
                       window_days: int = K.CHURN_WINDOW_DAYS, span_days: int = K.TRANSFER_SPAN_DAYS,
                       limit: int = K.TRANSFER_COUNT_LIMIT, bics=None, daily: DataFrame | None = None) -> DataFrame:
    """LB4: more than 3 competitor debits in some closed span [d, d+30] that
    starts at a transfer date inside the window."""
    daily = daily if daily is not None else daily_transactions(transactions, bics)
    per = _rolling_agg(daily, snapshot, window_days, span_days)
    j = customers.select("customer_id").join(per, "customer_id", "left")
    return j.select("customer_id",
                    (F.coalesce(F.col("max_in_span"), F.lit(0)) > limit).alias("signal_competitor_transfers"))


LABEL_COLUMNS = ["churned", "churn_signal_count", "signal_salary_stop", "signal_app_inactive",
                 "signal_product_reduction", "signal_competitor_transfers"]


def transaction_stats(daily: DataFrame, snapshot, window_days: int, baseline_days: int, span_days: int,
                      lookback: int) -> DataFrame:
    """Per customer everything labels and features need from the (customer, day)
    transaction rollup.  The rolling count is a window over the customer's days, so
    window and grouping share one exchange."""
    snap = as_date_col(snapshot)
    d = F.col("d")
    daily = daily.where(in_closed(d, F.date_sub(snap, max(baseline_days, lookback)), F.date_add(snap, window_days)))
    ahead = in_closed(d, snap, F.date_add(snap, window_days))
    back = in_closed(d, F.date_sub(snap, lookback), snap)
    debits = F.when(ahead, F.col("competitor_debit_n")).otherwise(0)
    w = Window.partitionBy("customer_id").orderBy(F.datediff(d, F.lit("1970-01-01").cast("date"))).rangeBetween(0, span_days)
    rows = daily.withColumn("_debits", debits).withColumn("_in_span", F.sum("_debits").over(w))
    return rows.groupBy("customer_id").agg(
        F.sum(F.when((d >= F.date_sub(snap, baseline_days)) & (d < snap), F.col("salary_credit_n")).otherwise(0)).alias("pre_n"),
        F.sum(F.when(ahead, F.col("salary_credit_n")).otherwise(0)).alias("post_n"),
        F.max(F.when(F.col("_debits") > 0, F.col("_in_span"))).alias("max_in_span"),
        *[F.sum(F.when(back, F.col(c))).alias(n) for c, n in (
            ("competitor_n", "competitor_n"), ("credit_cents", "credit_cents"), ("credit_n", "credit_n"),
            ("n", "n_transactions"))])


def session_stats(daily: DataFrame, snapshot, window_days: int, lookback: int, recent: int) -> DataFrame:
    """Per customer everything labels and features need from the (customer, day) session rollup."""
    snap = as_date_col(snapshot)
    d = F.col("d")
    daily = daily.where(in_closed(d, F.date_sub(snap, lookback), F.date_add(snap, window_days)))
    ahead = in_closed(d, snap, F.date_add(snap, window_days))
    back = in_closed(d, F.date_sub(snap, lookback), snap)
    before = F.lag("d").over(Window.partitionBy("customer_id").orderBy("d"))
    rows = daily.withColumn("_gap", F.when(ahead & (before >= snap), F.datediff(d, before)))
    return rows.groupBy("customer_id").agg(
        F.min(F.when(ahead, d)).alias("first_d"), F.max(F.when(ahead, d)).alias("last_d"), F.max("_gap").alias("max_gap"),
        F.max(F.when(back, d)).alias("last_session_date"),
        F.sum(F.when(back & (d >= F.date_sub(snap, recent)), F.col("n")).otherwise(0)).alias("logins_recent"),
        F.sum(F.when(back, F.col("id_n"))).alias("logins_window"), F.sum(F.when(back, F.col("n"))).alias("n_sessions"))


STATS = ["last_session_date", "logins_recent", "logins_window", "n_sessions", "competitor_n", "credit_cents", "credit_n",
         "n_transactions", "product_n", "months_to_rate_reset", "n_holdings"]


def labelled(customers: DataFrame, snapshot, daily_t: DataFrame, daily_s: DataFrame, holding: DataFrame,
             window_days: int = K.CHURN_WINDOW_DAYS, baseline_days: int = K.SALARY_BASELINE_DAYS,
             gap_days: int = K.INACTIVITY_GAP_DAYS, span_days: int = K.TRANSFER_SPAN_DAYS,
             limit: int = K.TRANSFER_COUNT_LIMIT, threshold: int = K.CHURN_SIGNAL_THRESHOLD,
             lookback: int = K.FEATURE_LOOKBACK_DAYS, recent: int = K.RECENT_LOGIN_DAYS,
             keep_stats: bool = False) -> DataFrame:
    """Customers with all label columns, built as one join chain: the customer table is
    scanned once and each child rollup is shuffled by customer_id once.  ``holding``
    is ``features.holding_stats``.  ``keep_stats`` also keeps the columns that the
    features of the same snapshot are computed from, so they need no joins of their own."""
    snap = as_date_col(snapshot)
    j = (customers.join(transaction_stats(daily_t, snapshot, window_days, baseline_days, span_days, lookback),
                        "customer_id", "left")
         .join(session_stats(daily_s, snapshot, window_days, lookback, recent), "customer_id", "left")
         .join(holding, "customer_id", "left"))
    s1 = (F.coalesce(F.col("salary_account_flag"), F.lit(False)) & (F.coalesce(F.col("pre_n"), F.lit(0)) > 0)
          & (F.coalesce(F.col("post_n"), F.lit(0)) == 0))
    s2 = F.when(F.col("first_d").isNull(), F.lit(True)).otherwise(
        (F.datediff(F.col("first_d"), snap) >= gap_days)
        | (F.coalesce(F.col("max_gap"), F.lit(0)) >= gap_days)
        | (F.datediff(F.date_add(snap, window_days), F.col("last_d")) >= gap_days))
    s3 = (F.coalesce(F.col("closed_n"), F.lit(0)) >= 1) & (F.coalesce(F.col("active_n"), F.lit(0)) > 1)
    s4 = F.coalesce(F.col("max_in_span"), F.lit(0)) > limit
    stats = STATS if keep_stats else []
    sig = j.select(*customers.columns, s1.alias("signal_salary_stop"), s2.alias("signal_app_inactive"),
                   s3.alias("signal_product_reduction"), s4.alias("signal_competitor_transfers"), *stats)
    count = sum(F.col(c).cast("int") for c in LABEL_COLUMNS[2:])
    return sig.select(*customers.columns, (count >= threshold).alias("churned"),
                      count.alias("churn_signal_count"), *LABEL_COLUMNS[2:], *stats)


def churn_labels(customers: DataFrame, transactions: DataFrame | None, sessions: DataFrame | None,
                 holdings: DataFrame | None, snapshot, window_days: int = K.CHURN_WINDOW_DAYS,
                 threshold: int = K.CHURN_SIGNAL_THRESHOLD, daily_t: DataFrame | None = None,
                 daily_s: DataFrame | None = None, holding: DataFrame | None = None) -> DataFrame:
    """LB5: four signals, their count and churned = count >= 2.  Pass shared
    rollups (``daily_t``/``daily_s``/``holding``) to read each child table once."""
    daily_t = daily_t if daily_t is not None else daily_transactions(transactions)
    daily_s = daily_s if daily_s is not None else daily_sessions(sessions)
    holding = holding if holding is not None else holding_stats(holdings, snapshot, window_days)
    lab = labelled(customers.select("customer_id", "salary_account_flag"), snapshot, daily_t, daily_s, holding,
                   window_days=window_days, threshold=threshold)
    return lab.select("customer_id", *LABEL_COLUMNS)


def labelled_customers(customers: DataFrame, labels: DataFrame) -> DataFrame:
    """J6: customers with their label columns (left merge)."""
    return customers.join(labels, "customer_id", "left")


def churn_rate(labelled: DataFrame) -> DataFrame:
    """LB7: share of churned customers."""
    return labelled.agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum(F.col("churned").cast("int")).cast("long").alias("churned"),
        F.round(F.avg(F.col("churned").cast("double")), 6).alias("churn_rate"),
    )
