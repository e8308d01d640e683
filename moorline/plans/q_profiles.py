"""Queries: profile enrichment for the high-risk batch (EN1-EN8, J3-J5, J9, IO13-IO15, IO19)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from .. import constants as K
from ..operators import model as MD
from ..operators import preprocess as PP
from ..operators import profiles as PR
from ..session import materialize
from . import common as C
from .oracle_frag import MODEL_READY, sql_with
from .oracle_views import SNAP
from .q_model import _linear_sql, scored_at_col
from .registry import query

PREV_AS_OF = K.TEST_SNAPSHOT - dt.timedelta(days=7)
PREV_THRESHOLD = 0.6
_V = ("customers_v", "transactions_v", "app_sessions_v", "customer_products_v", "complaints_v",
      "nps_responses_v", "products_v")


def scored_batch(w, threshold=K.HIGH_RISK_THRESHOLD):
    """High-risk rows (linear scorer) with the raw NPS / rate-reset values kept
    beside the filled model inputs; checkpointed so downstream plans start
    from a small materialised table instead of re-deriving features."""
    f = C.features(w).withColumn("nps_raw", F.col("nps_score_last")) \
        .withColumn("mrr_raw", F.col("months_to_rate_reset"))
    mr = PP.model_ready(f)
    sc = mr.select("*", MD.linear_score_col().alias("churn_score"))
    hr = sc.where(F.col("churn_score") >= F.lit(threshold)).withColumn("scored_at", scored_at_col())
    return materialize(hr)


def batch(w, threshold=K.HIGH_RISK_THRESHOLD):
    return MD.high_risk(scored_batch(w, threshold), threshold)


def documents(w, as_of=None, threshold=K.HIGH_RISK_THRESHOLD):
    return PR.profile_documents(batch(w, threshold), w.customer_products(), w.products(), None,
                                w.complaints(), None, as_of or w.snapshot,
                                daily_s=C.daily_sessions(w), daily_t=C.daily_transactions(w))


def _docs_sql(name: str, as_of: str, threshold: float) -> str:
    """DuckDB text of the profile documents CTE for one batch."""
    return f"""
{name}_b AS (SELECT *, {_linear_sql()} AS churn_score, TIMESTAMP '2024-01-16 06:00:00' AS scored_at
             FROM model_o WHERE {_linear_sql()} >= {threshold}),
{name}_p AS (
  SELECT cp.customer_id,
         'Active products (' || CAST(count(*) AS VARCHAR) || '): '
         || string_agg(COALESCE(p.product_name, p.product_type, 'Unknown')
                       || CASE WHEN cp.fixed_rate_end_date IS NOT NULL
                               THEN ' (fixed rate ends ' || strftime(cp.fixed_rate_end_date, '%Y-%m-%d') || ')'
                               ELSE '' END, '; '
                       ORDER BY COALESCE(p.product_name, p.product_type, 'Unknown')
                                || CASE WHEN cp.fixed_rate_end_date IS NOT NULL
                                        THEN ' (fixed rate ends ' || strftime(cp.fixed_rate_end_date, '%Y-%m-%d') || ')'
                                        ELSE '' END) || '.' AS product_summary
  FROM customer_products_v cp JOIN products_v p ON cp.product_id = p.product_id
  WHERE cp.status = 'active' AND cp.customer_id IN (SELECT customer_id FROM {name}_b)
  GROUP BY cp.customer_id),
{name}_e AS (
  SELECT customer_id,
         CAST(count(*) AS VARCHAR) || ' app session(s) in the last 60 days (avg '
         || format('{{:.1f}}', CAST(floor(avg(session_duration_seconds)) AS BIGINT) / 60.0::DOUBLE)
         || ' min). Last login: ' || strftime(max(session_date), '%Y-%m-%d') || '.' AS engagement_summary
  FROM app_sessions_v
  WHERE session_date >= {as_of} - 60 AND customer_id IN (SELECT customer_id FROM {name}_b)
  GROUP BY customer_id),
{name}_c AS (
  SELECT customer_id,
         CAST(count(*) AS VARCHAR) || ' open complaint(s). Oldest opened: ' || strftime(min(opened_date), '%Y-%m-%d')
         || '. Category: ' || COALESCE(nullif(max(category), ''), 'unspecified') || '.' AS complaint_summary
  FROM complaints_v WHERE status = 'open' AND customer_id IN (SELECT customer_id FROM {name}_b)
  GROUP BY customer_id),
{name}_t AS (
  SELECT customer_id,
         CAST(count(*) AS VARCHAR) || ' transaction(s) in last 90 days. Total inflow: €'
         || format('{{:,.0f}}', CAST(COALESCE(sum(CASE WHEN direction = 'credit' THEN amount_eur END), 0) AS DOUBLE))
         || '. Competitor transfers: ' || CAST(count(*) FILTER (WHERE is_competitor_transfer) AS VARCHAR)
         || '. Last transaction: ' || strftime(max(transaction_date), '%Y-%m-%d') || '.' AS transaction_summary
  FROM transactions_v
  WHERE transaction_date >= {as_of} - 90 AND customer_id IN (SELECT customer_id FROM {name}_b)
  GROUP BY customer_id),
{name} AS (
  SELECT b.customer_id, substr(CAST(b.scored_at AS VARCHAR), 1, 10) AS snapshot_date,
         CAST(b.churn_score AS DOUBLE) AS churn_score,
         CAST(b.days_since_last_login AS INTEGER) AS days_since_last_login,
         CAST(b.complaints_open AS INTEGER) AS complaints_open,
         CAST(b.competitor_transfer_count AS INTEGER) AS competitor_transfer_cnt,
         CAST(b.months_to_rate_reset AS DOUBLE) AS months_to_rate_reset,
         COALESCE(b.segment, '') AS segment, COALESCE(b.region, '') AS region,
         COALESCE(p.product_summary, '{K.NO_PRODUCTS_TEXT}') AS product_summary,
         COALESCE(e.engagement_summary, '{K.NO_SESSIONS_TEXT}') AS engagement_summary,
         COALESCE(c.complaint_summary, '{K.NO_COMPLAINTS_TEXT}') AS complaint_summary,
         COALESCE(t.transaction_summary, '{K.NO_TRANSACTIONS_TEXT}') AS transaction_summary
  FROM {name}_b b
  LEFT JOIN {name}_p p ON b.customer_id = p.customer_id
  LEFT JOIN {name}_e e ON b.customer_id = e.customer_id
  LEFT JOIN {name}_c c ON b.customer_id = c.customer_id
  LEFT JOIN {name}_t t ON b.customer_id = t.customer_id)
"""


_CUR = MODEL_READY + "," + _docs_sql("docs", SNAP, 0.7)
_BOTH = _CUR + "," + _docs_sql("prev", f"DATE '{PREV_AS_OF.isoformat()}'", PREV_THRESHOLD)


@query("profile_products", sql_with(_CUR, "SELECT customer_id, product_summary FROM docs_p", _V))
def profile_products(spark, sf_dir):
    """EN4 / J3: product summary per batch customer."""
    w = C.warehouse(spark, sf_dir)
    return PR.product_summary(batch(w), w.customer_products(), w.products()).select(
        "customer_id", "product_summary")


@query("profile_engagement", sql_with(_CUR, "SELECT customer_id, engagement_summary FROM docs_e", _V))
def profile_engagement(spark, sf_dir):
    """EN1 / EN5: engagement summary."""
    w = C.warehouse(spark, sf_dir)
    return PR.engagement(batch(w), None, w.snapshot, daily=C.daily_sessions(w)).select(
        "customer_id", "engagement_summary")


@query("profile_complaints", sql_with(_CUR, "SELECT customer_id, complaint_summary FROM docs_c", _V))
def profile_complaints(spark, sf_dir):
    """EN2 / EN6: open-complaint summary."""
    w = C.warehouse(spark, sf_dir)
    return PR.open_complaints(batch(w), w.complaints()).select("customer_id", "complaint_summary")


@query("profile_transactions", sql_with(_CUR, "SELECT customer_id, transaction_summary FROM docs_t", _V))
def profile_transactions(spark, sf_dir):
    """EN3 / EN7: 90-day transaction summary."""
    w = C.warehouse(spark, sf_dir)
    return PR.recent_transactions(batch(w), None, w.snapshot, daily=C.daily_transactions(w)).select(
        "customer_id", "transaction_summary")


@query("profile_documents", sql_with(_CUR, "SELECT * FROM docs", _V))
def profile_documents(spark, sf_dir):
    """J9 / EN8: profile documents for the high-risk batch."""
    return documents(C.warehouse(spark, sf_dir))


@query("profile_upsert", sql_with(_BOTH, """
SELECT * FROM prev WHERE customer_id NOT IN (SELECT customer_id FROM docs)
UNION ALL SELECT * FROM docs""", _V))
def profile_upsert(spark, sf_dir):
    """IO13: keyed upsert of profile documents."""
    w = C.warehouse(spark, sf_dir)
    prev = documents(w, PREV_AS_OF, PREV_THRESHOLD)
    return PR.upsert(prev, documents(w))


@query("profile_stale", sql_with(_BOTH, """
SELECT customer_id FROM prev WHERE customer_id NOT IN (SELECT customer_id FROM docs)""", _V))
def profile_stale(spark, sf_dir):
    """IO14 / J5 / SE2: profile ids to delete."""
    w = C.warehouse(spark, sf_dir)
    return PR.stale(documents(w, PREV_AS_OF, PREV_THRESHOLD), batch(w))


@query("profile_lookup", sql_with(_CUR, """
SELECT c.customer_id, d.* EXCLUDE (customer_id),
       CASE WHEN d.product_summary IS NULL THEN 'not_found' ELSE 'found' END AS lookup_status
FROM customers_v c LEFT JOIN docs d ON c.customer_id = d.customer_id""", _V))
def profile_lookup(spark, sf_dir):
    """IO15 / IO19: point lookups with not_found records."""
    w = C.warehouse(spark, sf_dir)
    return PR.lookup(w.customers(), documents(w))
