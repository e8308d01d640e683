"""Queries: features, labels, population aggregates."""

from __future__ import annotations

from ..operators import features as FT
from ..operators import labels as LB
from . import common as C
from .oracle_frag import FEATURES, LABELS, MODEL_READY, sql_with
from .oracle_views import SNAP
from .registry import query


@query("features_snapshot", sql_with(FEATURES, "SELECT * FROM features_o"))
def features_snapshot(spark, sf_dir):
    """FT1-FT11 / J1 / PF3 / PF13: the feature snapshot (canonical, pre-aggregated)."""
    return C.features(C.warehouse(spark, sf_dir))


# SEM1: the five child tables joined at once multiply each other's rows.  The oracle counts the
# rows of each child per customer and multiplies; a child without rows leaves one NULL row.
_FANOUT_SQL = sql_with(FEATURES + f""",
n_of AS (
  SELECT customer_id, kind, count(*) AS n FROM (
    SELECT customer_id, 's' AS kind FROM app_sessions_v WHERE session_date BETWEEN {SNAP} - 90 AND {SNAP}
    UNION ALL SELECT customer_id, 't' FROM transactions_v WHERE transaction_date BETWEEN {SNAP} - 90 AND {SNAP}
    UNION ALL SELECT customer_id, 'c' FROM complaints_v
    UNION ALL SELECT customer_id, 'n' FROM nps_responses_v
    UNION ALL SELECT customer_id, 'h' FROM customer_products_v) u
  GROUP BY customer_id, kind),
times AS (
  SELECT k.customer_id,
         CAST(product(CASE WHEN kind <> 's' THEN n ELSE 1 END) AS HUGEINT) AS for_sessions,
         CAST(product(CASE WHEN kind <> 't' THEN n ELSE 1 END) AS HUGEINT) AS for_transfers
  FROM n_of k GROUP BY k.customer_id)
""", """
SELECT f.* REPLACE (
         CAST(f.app_logins_last_30d * COALESCE(x.for_sessions, 1) AS BIGINT) AS app_logins_last_30d,
         CAST(f.app_logins_last_90d * COALESCE(x.for_sessions, 1) AS BIGINT) AS app_logins_last_90d,
         CAST(f.competitor_transfer_count * COALESCE(x.for_transfers, 1) AS BIGINT) AS competitor_transfer_count)
FROM features_o f LEFT JOIN times x ON f.customer_id = x.customer_id""")


@query("features_fanout_compat", _FANOUT_SQL)
def features_fanout_compat(spark, sf_dir):
    """SEM1: the literal five-way join fan-out, in closed form."""
    return C.features(C.warehouse(spark, sf_dir), compat="fanout")


@query("features_model_ready", sql_with(MODEL_READY, "SELECT * FROM model_o"))
def features_model_ready(spark, sf_dir):
    """ML1 / FT11: filled and encoded model inputs."""
    return C.model_features(C.warehouse(spark, sf_dir))


_MART_SQL = sql_with(LABELS, f"""
SELECT c.customer_id, CAST(l.churned AS INTEGER) AS churned,
       CAST(date_diff('day', s.last_d, {SNAP}) AS INTEGER) AS days_since_last_login,
       CAST(COALESCE(t.n, 0) AS BIGINT) AS competitor_transfer_count,
       CAST(COALESCE(k.co, 0) AS BIGINT) AS complaints_open
FROM customers_v c
LEFT JOIN labels_o l ON c.customer_id = l.customer_id
LEFT JOIN (SELECT customer_id, max(session_date) AS last_d FROM app_sessions_v GROUP BY 1) s
       ON c.customer_id = s.customer_id
LEFT JOIN (SELECT customer_id, count(*) AS n FROM transactions_v
           WHERE is_competitor_transfer AND transaction_date >= {SNAP} - 90 GROUP BY 1) t
       ON c.customer_id = t.customer_id
LEFT JOIN (SELECT customer_id, count(DISTINCT CASE WHEN status = 'open' THEN complaint_id END) AS co
           FROM complaints_v GROUP BY 1) k ON c.customer_id = k.customer_id
""", views=("customers_v", "transactions_v", "app_sessions_v", "customer_products_v", "complaints_v"))


@query("features_mart", _MART_SQL)
def features_mart(spark, sf_dir):
    """FT12 / J2 / SEM5: dashboard customer_features mart."""
    w = C.warehouse(spark, sf_dir)
    return FT.feature_mart(w.customers(), C.labels(w), None, None, w.complaints(), w.snapshot,
                           daily_s=C.daily_sessions(w), daily_t=C.daily_transactions(w))



# -- labels ---------------------------------------------------------------------
_LV = ("customers_v", "transactions_v", "app_sessions_v", "customer_products_v")


@query("label_salary_stop", sql_with(LABELS, "SELECT customer_id, signal_salary_stop FROM sig", _LV))
def label_salary_stop(spark, sf_dir):
    """LB1: salary domiciliation stop."""
    w = C.warehouse(spark, sf_dir)
    return LB.salary_stop(w.customers(), None, w.snapshot, daily=C.daily_transactions(w))


@query("label_app_inactive", sql_with(LABELS, "SELECT customer_id, signal_app_inactive FROM sig", _LV))
def label_app_inactive(spark, sf_dir):
    """LB2 / WN1: 30-day app inactivity gap."""
    w = C.warehouse(spark, sf_dir)
    return LB.app_inactive(w.customers(), None, w.snapshot, daily=C.daily_sessions(w))


@query("label_product_reduction",
       sql_with(LABELS, "SELECT customer_id, signal_product_reduction FROM sig", _LV))
def label_product_reduction(spark, sf_dir):
    """LB3: product reduction."""
    w = C.warehouse(spark, sf_dir)
    return LB.product_reduction(w.customers(), w.customer_products(), w.snapshot)


@query("label_competitor_rolling",
       sql_with(LABELS, "SELECT customer_id, signal_competitor_transfers FROM sig", _LV))
def label_competitor_rolling(spark, sf_dir):
    """LB4 / LB6 / WN2: >3 competitor debits in a 30-day span."""
    w = C.warehouse(spark, sf_dir)
    return LB.competitor_rolling(w.customers(), None, w.snapshot, daily=C.daily_transactions(w))


@query("churn_labels", sql_with(LABELS, "SELECT * FROM labels_o", _LV))
def churn_labels(spark, sf_dir):
    """LB5: signals, count and churned."""
    return C.labels(C.warehouse(spark, sf_dir))


@query("churn_rate", sql_with(LABELS, """
SELECT count(*) AS customers, CAST(sum(CAST(churned AS INTEGER)) AS BIGINT) AS churned,
       round(avg(CAST(churned AS DOUBLE)), 6) AS churn_rate FROM labels_o""", _LV))
def churn_rate(spark, sf_dir):
    """LB7: churn rate of the population."""
    w = C.warehouse(spark, sf_dir)
    return LB.churn_rate(C.labelled_customers(w))


_ASOF_HOLD = FEATURES.replace(
    "count(DISTINCT CASE WHEN status = 'active' THEN product_id END) AS pc",
    f"count(DISTINCT CASE WHEN start_date <= {SNAP} AND (end_date IS NULL OR end_date > {SNAP}) "
    "THEN product_id END) AS pc")


@query("features_as_of_holdings", sql_with(_ASOF_HOLD, "SELECT * FROM features_o"))
def features_as_of_holdings(spark, sf_dir):
    """SEM2: product_count from holdings active on the snapshot date."""
    return C.features_variant(C.warehouse(spark, sf_dir), as_of_holdings=True)


_NPS_LATEST = FEATURES.replace(
    "fn AS (SELECT customer_id, max(score) AS nps, count(*) AS n_n FROM nps_responses_v GROUP BY customer_id)",
    f"fn AS (SELECT customer_id, arg_max(score, (response_date, id)) AS nps, count(*) AS n_n FROM nps_responses_v "
    f"WHERE response_date BETWEEN {SNAP} - 180 AND {SNAP} GROUP BY customer_id)")


@query("features_nps_latest", sql_with(_NPS_LATEST, "SELECT * FROM features_o"))
def features_nps_latest(spark, sf_dir):
    """SEM4: nps_score_last = most recent score within 180 days."""
    return C.features_variant(C.warehouse(spark, sf_dir), nps_mode="latest_180d")
