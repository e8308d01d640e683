"""Queries: population overview aggregates (AG1-AG6, AG23)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features as FT
from ..operators import marts as M
from . import common as C
from .oracle_frag import LABELS, sql_with
from .oracle_views import SNAP
from .registry import query

_LV = ("customers_v", "transactions_v", "app_sessions_v", "customer_products_v")
_LABELLED = LABELS + """,
lab AS (SELECT c.*, l.churned, l.churn_signal_count FROM customers_v c
        LEFT JOIN labels_o l ON c.customer_id = l.customer_id)
"""


@query("population_summary", sql_with(_LABELLED, """
SELECT count(*) AS total_customers,
       CAST(COALESCE(sum(CAST(churned AS INTEGER)), 0) AS BIGINT) AS churned,
       round(sum(CAST(churned AS INTEGER)) * 100.0 / count(*), 6) AS churn_rate_pct
FROM lab""", _LV))
def population_summary(spark, sf_dir):
    """AG1 / AG23: totals, churned, churn rate."""
    return M.population_summary(C.labelled_customers(C.warehouse(spark, sf_dir)))


@query("by_segment", sql_with(_LABELLED, """
SELECT segment, count(*) AS customers FROM lab WHERE segment IS NOT NULL GROUP BY segment""", _LV))
def by_segment(spark, sf_dir):
    """AG2: customers per segment."""
    return M.count_by(C.warehouse(spark, sf_dir).customers(), "segment")


@query("by_region", sql_with(_LABELLED, """
SELECT region, count(*) AS customers FROM lab WHERE region IS NOT NULL GROUP BY region""", _LV))
def by_region(spark, sf_dir):
    """AG3: customers per region."""
    return M.count_by(C.warehouse(spark, sf_dir).customers(), "region")


@query("churn_by_segment", sql_with(_LABELLED, """
SELECT segment, count(churned) AS total,
       CAST(COALESCE(sum(CAST(churned AS INTEGER)), 0) AS BIGINT) AS churned,
       round(COALESCE(sum(CAST(churned AS INTEGER)), 0) * 100.0 / nullif(count(churned), 0), 6) AS churn_rate_pct
FROM lab WHERE segment IS NOT NULL GROUP BY segment""", _LV))
def churn_by_segment(spark, sf_dir):
    """AG4: churn rate per segment."""
    return M.churn_by(C.labelled_customers(C.warehouse(spark, sf_dir)), "segment")


@query("holdings_by_type", sql_with("x AS (SELECT 1)", """
SELECT p.product_type, count(*) AS holdings
FROM customer_products_v cp JOIN products_v p ON cp.product_id = p.product_id
WHERE cp.status = 'active' GROUP BY p.product_type""", ("customer_products_v", "products_v")))
def holdings_by_type(spark, sf_dir):
    """AG5 / J3: active holdings per product type."""
    w = C.warehouse(spark, sf_dir)
    return M.holdings_by_type(w.customer_products(), w.products())


_HIST_SQL = sql_with(LABELS + f""",
mart AS (
  SELECT c.customer_id, CAST(l.churned AS INTEGER) AS churned,
         date_diff('day', s.last_d, {SNAP}) AS days_since_last_login,
         COALESCE(t.n, 0) AS competitor_transfer_count, COALESCE(k.co, 0) AS complaints_open
  FROM customers_v c
  LEFT JOIN labels_o l ON c.customer_id = l.customer_id
  LEFT JOIN (SELECT customer_id, max(session_date) AS last_d FROM app_sessions_v GROUP BY 1) s
         ON c.customer_id = s.customer_id
  LEFT JOIN (SELECT customer_id, count(*) AS n FROM transactions_v
             WHERE is_competitor_transfer AND transaction_date >= {SNAP} - 90 GROUP BY 1) t
         ON c.customer_id = t.customer_id
  LEFT JOIN (SELECT customer_id, count(*) FILTER (WHERE status = 'open') AS co
             FROM complaints_v GROUP BY 1) k ON c.customer_id = k.customer_id),
vals AS (
  SELECT 'days_since_last_login' AS feature, churned, days_since_last_login AS v, 25 AS w, 40 AS bins FROM mart
  UNION ALL SELECT 'competitor_transfer_count', churned, competitor_transfer_count, 1, 20 FROM mart
  WHERE competitor_transfer_count <= 20
  UNION ALL SELECT 'complaints_open', churned, complaints_open, 1, 10 FROM mart),
long AS (
  SELECT feature, churned, w, bins,
         CASE WHEN v < 0 THEN -1 WHEN v >= w * bins THEN bins ELSE CAST(floor(v / CAST(w AS DOUBLE)) AS INTEGER) END AS bin
  FROM vals WHERE v IS NOT NULL)
""", """
SELECT feature, churned, CAST(bin AS INTEGER) AS bin, CAST(CASE WHEN bin >= 0 THEN bin * w END AS DOUBLE) AS bin_start,
       CASE WHEN bin < 0 THEN '< 0' WHEN bin >= bins THEN '>= ' || CAST(w * bins AS VARCHAR)
            ELSE CAST(bin * w AS VARCHAR) || ' to < ' || CAST((bin + 1) * w AS VARCHAR) END AS bin_label, count(*) AS n
FROM long GROUP BY ALL""",
    ("customers_v", "transactions_v", "app_sessions_v", "customer_products_v", "complaints_v"))


@query("feature_histogram", _HIST_SQL)
def feature_histogram(spark, sf_dir):
    """AG6 / SC21 / PF11: binned feature histograms by churned."""
    w = C.warehouse(spark, sf_dir)
    mart = FT.feature_mart(w.customers(), C.labels(w), None, None, w.complaints(), w.snapshot,
                           daily_s=C.daily_sessions(w), daily_t=C.daily_transactions(w))
    return M.feature_histogram(mart)


_COUNT_TABLES = ["customers_v", "products_v", "customer_products_v", "transactions_v",
                 "complaints_v", "nps_responses_v", "app_sessions_v", "branch_visits_v"]


@query("table_row_counts", sql_with("x AS (SELECT 1)", "\nUNION ALL\n".join(
    f"SELECT '{t[:-2]}' AS table_name, count(*) AS row_count FROM {t}" for t in _COUNT_TABLES),
    tuple(_COUNT_TABLES)))
def table_row_counts(spark, sf_dir):
    """AG23 / SE1: staged table row counts."""
    w = C.warehouse(spark, sf_dir)
    tables = {
        "customers": w.customers(), "products": w.products(), "customer_products": w.customer_products(),
        "transactions": w.transactions(), "complaints": w.complaints(), "nps_responses": w.nps_responses(),
        "app_sessions": w.app_sessions(), "branch_visits": w.branch_visits(),
    }
    return M.table_row_counts(tables)


@query("load_sample_top5", sql_with(_LABELLED, """
SELECT customer_id, segment, region, churned, churn_signal_count FROM lab
ORDER BY customer_id LIMIT 5""", _LV))
def load_sample_top5(spark, sf_dir):
    """AG23 / SO6: TOP 5 load-verification sample."""
    lab = C.labelled_customers(C.warehouse(spark, sf_dir))
    return M.top_n(lab.select("customer_id", "segment", "region", "churned", "churn_signal_count"),
                   5, F.col("customer_id"))
