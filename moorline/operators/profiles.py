"""Customer profile documents for the high-risk batch (EN1-EN8, J3-J5, J9,
IO13-IO15, IO19, SE2).

The batch id set restricts every child table with a ``left_semi`` join (the
set-based replacement for chunked ``IN (...)`` lists); it is broadcast only
after a row-count check.  Each summary is one grouped aggregate keyed by
customer; texts are rendered with built-in string functions, no UDFs.

Product lists are pre-reduced to (customer, item text, multiplicity) before
they are gathered per customer, so the gathered array is bounded by the
number of distinct products a customer holds; only the sentence that names
each holding grows with raw row counts.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.joins import broadcast_if_bounded
from ..functions.numeric import round_half_even_binary
from ..functions.text import render


def _ids(batch: DataFrame) -> DataFrame:
    return broadcast_if_bounded(batch.select("customer_id").distinct())


def _day(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def product_summary(batch: DataFrame, holdings: DataFrame, products: DataFrame,
                    ids: DataFrame | None = None, list_each: bool = True) -> DataFrame:
    """EN4 / J3: "Active products (n): a; b (fixed rate ends YYYY-MM-DD)." in
    item-text order (explicit order, SEM21).  The sentence names every holding, so it
    is as long as the customer's holdings; ``list_each=False`` names every product
    once with its multiplicity ("a x3") and stays within the catalogue's size.  The
    product list join is left to AQE, which broadcasts it when its measured size is small."""
    ids = ids if ids is not None else _ids(batch)
    act = holdings.where(F.col("status") == "active").join(ids, "customer_id", "left_semi")
    p = products.select("product_id", "product_name", "product_type")
    txt = F.concat(
        F.coalesce(F.col("product_name"), F.col("product_type"), F.lit("Unknown")),
        F.when(F.col("fixed_rate_end_date").isNotNull(),
               render(K.RATE_END_NOTE, date=_day(F.col("fixed_rate_end_date"))))
        .otherwise(F.lit("")))
    items = act.join(p, "product_id").groupBy("customer_id", txt.alias("txt")).agg(F.count(F.lit(1)).alias("k"))
    per = items.groupBy("customer_id").agg(
        F.sort_array(F.collect_list(F.struct("txt", "k"))).alias("items"),
        F.sum("k").alias("n"))
    if list_each:
        names = F.flatten(F.transform("items", lambda x: F.array_repeat(x["txt"], x["k"].cast("int"))))
    else:
        names = F.transform("items", lambda x: F.when(x["k"] > 1, F.concat(x["txt"], F.lit(" x"), x["k"].cast("string")))
                            .otherwise(x["txt"]))
    joined = F.array_join(names, "; ")
    return per.select("customer_id", "n",
                      render(K.PRODUCTS_TEXT, n=F.col("n"), items=joined).alias("product_summary"))


def engagement(batch: DataFrame, sessions: DataFrame | None, as_of, days: int = K.ENGAGEMENT_DAYS,
               daily: DataFrame | None = None, ids: DataFrame | None = None) -> DataFrame:
    """EN1 + EN5: sessions since ``as_of - days``: count, last date, integer
    (truncated) average duration; minutes shown with one decimal, rounded as binary
    floating point rounds (9 s are 0.1 min, 15 s are 0.2 min).
    Reads the (customer, day) session rollup when given."""
    if daily is None:
        from .features import daily_sessions
        daily = daily_sessions(sessions)
    ids = ids if ids is not None else _ids(batch)
    s = daily.where(F.col("d") >= F.date_sub(F.lit(as_of), days)).join(ids, "customer_id", "left_semi")
    agg = s.groupBy("customer_id").agg(
        F.sum("n").alias("sessions_60d"),
        F.max("d").alias("last_session"),
        F.floor(F.sum("duration_sum") / F.nullif(F.sum("duration_n"), F.lit(0))).cast("long")
        .alias("avg_duration_sec"))
    text = render(K.ENGAGEMENT_TEXT, n=F.col("sessions_60d"),
                  avg_min=F.format_string("%.1f", F.coalesce(
                      round_half_even_binary(F.col("avg_duration_sec"), 60), F.lit(0.0))),
                  last=F.coalesce(_day(F.col("last_session")), F.lit("unknown")))
    return agg.withColumn("engagement_summary", text)


def open_complaints(batch: DataFrame, complaints: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """EN2 + EN6: open complaints: count, oldest opened, max category (lexicographic)."""
    ids = ids if ids is not None else _ids(batch)
    c = complaints.where(F.col("status") == "open").join(ids, "customer_id", "left_semi")
    agg = c.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("open_count"),
        F.min("opened_date").alias("oldest_open"),
        F.max("category").alias("last_category"))
    text = render(K.COMPLAINT_TEXT, n=F.col("open_count"),
                  oldest=F.coalesce(_day(F.col("oldest_open")), F.lit("unknown")),
                  category=F.coalesce(F.nullif(F.col("last_category"), F.lit("")), F.lit("unspecified")))
    return agg.withColumn("complaint_summary", text)


def recent_transactions(batch: DataFrame, transactions: DataFrame | None, as_of,
                        days: int = K.PROFILE_TX_DAYS, daily: DataFrame | None = None,
                        ids: DataFrame | None = None) -> DataFrame:
    """EN3 + EN7: transactions since ``as_of - days``: count, credit sum,
    competitor count, last date; inflow with thousands separators.  Reads the
    (customer, day) transaction rollup when given (credit sums kept in cents)."""
    if daily is None:
        from .features import daily_transactions
        daily = daily_transactions(transactions)
    ids = ids if ids is not None else _ids(batch)
    t = daily.where(F.col("d") >= F.date_sub(F.lit(as_of), days)).join(ids, "customer_id", "left_semi")
    agg = t.groupBy("customer_id").agg(
        F.sum("n").alias("tx_count_90d"),
        (F.coalesce(F.sum("credit_cents"), F.lit(0)).cast("decimal(20,0)") / 100).cast("decimal(20,2)")
        .alias("total_inflow_eur"),
        F.sum("competitor_n").alias("competitor_transfers"),
        F.max("d").alias("last_tx_date"))
    text = render(K.TRANSACTION_TEXT, n=F.col("tx_count_90d"),
                  inflow=F.format_number(F.col("total_inflow_eur").cast("double"), 0),
                  competitor=F.col("competitor_transfers"),
                  last=F.coalesce(_day(F.col("last_tx_date")), F.lit("unknown")))
    return agg.withColumn("transaction_summary", text)


def profile_documents(batch: DataFrame, holdings: DataFrame, products: DataFrame, sessions: DataFrame | None,
                      complaints: DataFrame, transactions: DataFrame | None, as_of: dt.date,
                      daily_s: DataFrame | None = None, daily_t: DataFrame | None = None) -> DataFrame:
    """J9 + EN8: one document per batch row, typed attributes with defaults and
    four summaries (default sentences when a customer has no child rows)."""
    ids = _ids(batch)   # one size check for all four semi joins
    p = product_summary(batch, holdings, products, ids=ids).select("customer_id", "product_summary")
    e = engagement(batch, sessions, as_of, daily=daily_s, ids=ids).select("customer_id", "engagement_summary")
    c = open_complaints(batch, complaints, ids=ids).select("customer_id", "complaint_summary")
    t = recent_transactions(batch, transactions, as_of, daily=daily_t, ids=ids).select(
        "customer_id", "transaction_summary")
    cols = set(batch.columns)

    def num(name, typ, default):
        return F.coalesce(F.col(name).cast(typ), F.lit(default).cast(typ)) if name in cols \
            else F.lit(default).cast(typ)

    def txt(name):
        return F.coalesce(F.col(name).cast("string"), F.lit("")) if name in cols else F.lit("")

    j = batch.join(p, "customer_id", "left").join(e, "customer_id", "left") \
        .join(c, "customer_id", "left").join(t, "customer_id", "left")
    return j.select(
        "customer_id",
        F.substring(txt("scored_at"), 1, 10).alias("snapshot_date"),
        num("churn_score", "double", 0.0).alias("churn_score"),
        num("days_since_last_login", "int", 0).alias("days_since_last_login"),
        num("complaints_open", "int", 0).alias("complaints_open"),
        num("competitor_transfer_count", "int", 0).alias("competitor_transfer_cnt"),
        num("months_to_rate_reset", "double", 0.0).alias("months_to_rate_reset"),
        txt("segment").alias("segment"),
        txt("region").alias("region"),
        F.coalesce("product_summary", F.lit(K.NO_PRODUCTS_TEXT)).alias("product_summary"),
        F.coalesce("engagement_summary", F.lit(K.NO_SESSIONS_TEXT)).alias("engagement_summary"),
        F.coalesce("complaint_summary", F.lit(K.NO_COMPLAINTS_TEXT)).alias("complaint_summary"),
        F.coalesce("transaction_summary", F.lit(K.NO_TRANSACTIONS_TEXT)).alias("transaction_summary"),
    )


def upsert(existing: DataFrame, incoming: DataFrame, key: str = "customer_id") -> DataFrame:
    """IO13: keyed upsert - existing rows without a new version, plus all new rows."""
    return existing.join(incoming.select(key), key, "left_anti").unionByName(incoming)


def stale(existing: DataFrame, active: DataFrame, key: str = "customer_id") -> DataFrame:
    """IO14 / J5 / SE2: ids present before but not in the active batch (to delete)."""
    return existing.select(key).join(active.select(key), key, "left_anti")


def keep_active(existing: DataFrame, active: DataFrame, key: str = "customer_id") -> DataFrame:
    """IO14: the store after deletion = rows whose key is in the active batch."""
    return existing.join(active.select(key), key, "left_semi")


def lookup(requests: DataFrame, profiles: DataFrame, key: str = "customer_id") -> DataFrame:
    """IO15: point lookups; absent ids give a ``not_found`` record."""
    j = requests.select(key).join(profiles, key, "left")
    return j.withColumn("lookup_status", F.when(F.col("product_summary").isNull(), F.lit("not_found"))
                        .otherwise(F.lit("found")))
