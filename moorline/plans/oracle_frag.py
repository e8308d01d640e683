"""Reusable DuckDB CTE fragments (labels, features) for oracle queries.

These are written independently of the Spark operators: the rolling transfer
rule is a self-join here (a range window in Spark), the inactivity rule uses
DuckDB's own window over distinct days.
"""

from __future__ import annotations

from .oracle_views import SNAP, with_views

BASE_VIEWS = ("customers_v", "transactions_v", "app_sessions_v", "customer_products_v",
              "complaints_v", "nps_responses_v")

LABELS = f"""
sal AS (
  SELECT customer_id,
         count(*) FILTER (WHERE transaction_date >= {SNAP} - 90 AND transaction_date < {SNAP}) AS pre_n,
         count(*) FILTER (WHERE transaction_date BETWEEN {SNAP} AND {SNAP} + 60) AS post_n
  FROM transactions_v WHERE merchant_category = 'salary' AND direction = 'credit' GROUP BY customer_id),
sdays AS (
  SELECT DISTINCT customer_id, session_date AS d FROM app_sessions_v
  WHERE session_date BETWEEN {SNAP} AND {SNAP} + 60),
sgap AS (
  SELECT customer_id, min(d) AS first_d, max(d) AS last_d, max(gap) AS max_gap
  FROM (SELECT customer_id, d,
               date_diff('day', lag(d) OVER (PARTITION BY customer_id ORDER BY d), d) AS gap
        FROM sdays) g
  GROUP BY customer_id),
hold AS (
  SELECT customer_id,
         count(*) FILTER (WHERE end_date IS NOT NULL AND end_date BETWEEN {SNAP} AND {SNAP} + 60) AS closed_n,
         count(*) FILTER (WHERE start_date <= {SNAP} AND (end_date IS NULL OR end_date > {SNAP})) AS active_n
  FROM customer_products_v GROUP BY customer_id),
cdeb AS (
  SELECT customer_id, transaction_date AS d FROM transactions_v
  WHERE direction = 'debit' AND counterparty_bank_bic IN ('KREDBEBB', 'BBRUBEBB', 'GKCCBEBB', 'GEBABEBB')
    AND transaction_date BETWEEN {SNAP} AND {SNAP} + 60),
croll AS (
  SELECT a.customer_id, max(cnt) AS mx FROM (
    SELECT a.customer_id, a.d, count(*) AS cnt
    FROM (SELECT DISTINCT customer_id, d FROM cdeb) a
    JOIN cdeb b ON a.customer_id = b.customer_id AND b.d BETWEEN a.d AND a.d + 30
    GROUP BY a.customer_id, a.d) a
  GROUP BY a.customer_id),
sig AS (
  SELECT c.customer_id,
         COALESCE(c.salary_account_flag AND sal.pre_n > 0 AND sal.post_n = 0, false) AS signal_salary_stop,
         CASE WHEN sgap.first_d IS NULL THEN true
              ELSE date_diff('day', {SNAP}, sgap.first_d) >= 30
                   OR COALESCE(sgap.max_gap, 0) >= 30
                   OR date_diff('day', sgap.last_d, {SNAP} + 60) >= 30 END AS signal_app_inactive,
         COALESCE(hold.closed_n, 0) >= 1 AND COALESCE(hold.active_n, 0) > 1 AS signal_product_reduction,
         COALESCE(croll.mx, 0) > 3 AS signal_competitor_transfers
  FROM customers_v c
  LEFT JOIN sal ON c.customer_id = sal.customer_id
  LEFT JOIN sgap ON c.customer_id = sgap.customer_id
  LEFT JOIN hold ON c.customer_id = hold.customer_id
  LEFT JOIN croll ON c.customer_id = croll.customer_id),
labels_o AS (
  SELECT customer_id,
         CAST(signal_salary_stop AS INTEGER) + CAST(signal_app_inactive AS INTEGER)
           + CAST(signal_product_reduction AS INTEGER) + CAST(signal_competitor_transfers AS INTEGER)
           >= 2 AS churned,
         CAST(signal_salary_stop AS INTEGER) + CAST(signal_app_inactive AS INTEGER)
           + CAST(signal_product_reduction AS INTEGER) + CAST(signal_competitor_transfers AS INTEGER)
           AS churn_signal_count,
         signal_salary_stop, signal_app_inactive, signal_product_reduction, signal_competitor_transfers
  FROM sig)
"""

_FEATURE_AGGS = f"""
fs AS (
  SELECT customer_id, max(session_date) AS last_d,
         count(*) FILTER (WHERE session_date >= {SNAP} - 30) AS l30, count(id) AS l90
  FROM app_sessions_v WHERE session_date BETWEEN {SNAP} - 90 AND {SNAP} GROUP BY customer_id),
ft AS (
  SELECT customer_id, count(*) FILTER (WHERE is_competitor_transfer) AS comp,
         CAST(sum(CAST(amount_eur * 100 AS BIGINT)) FILTER (WHERE direction = 'credit') AS DOUBLE)
              / (nullif(count(*) FILTER (WHERE direction = 'credit'), 0) * 100.0::DOUBLE) AS inflow,
         count(*) AS n_t
  FROM transactions_v WHERE transaction_date BETWEEN {SNAP} - 90 AND {SNAP} GROUP BY customer_id),
fc AS (
  SELECT customer_id, count(DISTINCT CASE WHEN status = 'open' THEN complaint_id END) AS co, count(*) AS n_c
  FROM complaints_v GROUP BY customer_id),
fn AS (SELECT customer_id, max(score) AS nps, count(*) AS n_n FROM nps_responses_v GROUP BY customer_id),
fh AS (
  SELECT customer_id, count(DISTINCT CASE WHEN status = 'active' THEN product_id END) AS pc,
         min(CASE WHEN fixed_rate_end_date IS NOT NULL THEN
               (year(fixed_rate_end_date) - year({SNAP})) * 12 + month(fixed_rate_end_date) - month({SNAP}) END)
           AS mrr,
         count(*) AS n_h
  FROM customer_products_v GROUP BY customer_id)
"""

FEATURES = LABELS + "," + _FEATURE_AGGS + f""",
features_o AS (
  SELECT c.customer_id, c.snapshot_date, CAST(l.churned AS INTEGER) AS churned,
         CAST(c.salary_account_flag AS INTEGER) AS salary_account_flag, c.segment, c.region,
         CAST(COALESCE(date_diff('day', fs.last_d, {SNAP}), 999) AS INTEGER) AS days_since_last_login,
         CAST(COALESCE(fs.l30, 0) AS BIGINT) AS app_logins_last_30d,
         CAST(COALESCE(fs.l90, 0) AS BIGINT) AS app_logins_last_90d,
         CAST(COALESCE(ft.comp, 0) AS BIGINT) AS competitor_transfer_count,
         COALESCE(ft.inflow, 0.0) AS avg_monthly_inflow_eur,
         CAST(COALESCE(fc.co, 0) AS BIGINT) AS complaints_open,
         fn.nps AS nps_score_last,
         CAST(COALESCE(fh.pc, 0) AS BIGINT) AS product_count,
         CAST(fh.mrr AS INTEGER) AS months_to_rate_reset
  FROM customers_v c
  LEFT JOIN labels_o l ON c.customer_id = l.customer_id
  LEFT JOIN fs ON c.customer_id = fs.customer_id
  LEFT JOIN ft ON c.customer_id = ft.customer_id
  LEFT JOIN fc ON c.customer_id = fc.customer_id
  LEFT JOIN fn ON c.customer_id = fn.customer_id
  LEFT JOIN fh ON c.customer_id = fh.customer_id)
"""

MODEL_READY = FEATURES + """,
model_o AS (
  SELECT customer_id, snapshot_date, churned, salary_account_flag, segment, region,
         days_since_last_login, CAST(app_logins_last_30d AS INTEGER) AS app_logins_last_30d,
         CAST(app_logins_last_90d AS INTEGER) AS app_logins_last_90d,
         CAST(competitor_transfer_count AS INTEGER) AS competitor_transfer_count,
         CAST(avg_monthly_inflow_eur AS DOUBLE) AS avg_monthly_inflow_eur,
         CAST(complaints_open AS INTEGER) AS complaints_open,
         CAST(COALESCE(nps_score_last, 5.0) AS DOUBLE) AS nps_score_last,
         CAST(product_count AS INTEGER) AS product_count,
         CAST(COALESCE(months_to_rate_reset, 99.0) AS DOUBLE) AS months_to_rate_reset,
         CASE segment WHEN 'private_banking' THEN 0 WHEN 'standard' THEN 1 WHEN 'starter' THEN 2
                      WHEN 'student' THEN 3 ELSE 1 END AS segment_enc,
         CASE region WHEN 'Brussels' THEN 0 WHEN 'Flanders' THEN 1 WHEN 'Wallonia' THEN 2 ELSE 1 END AS region_enc
  FROM features_o)
"""


def sql_with(cte_text: str, select: str, views=BASE_VIEWS) -> str:
    """``WITH <views>, <cte_text> <select>``."""
    return with_views(f"WITH {cte_text.strip()}\n{select}", *views)


def features_at_sql(snap_sql: str, tag: str) -> str:
    """CTEs ``*_{tag}`` computing the feature snapshot as of ``snap_sql`` over
    the staged views (churned NULL: labels belong to the staged snapshot)."""
    aggs = _FEATURE_AGGS.replace(SNAP, snap_sql)
    for name in ("fs", "ft", "fc", "fn", "fh"):
        aggs = aggs.replace(f"{name} AS (", f"{name}_{tag} AS (")
    return aggs + f""",
feat_{tag} AS (
  SELECT c.customer_id, {snap_sql} AS snapshot_date, CAST(NULL AS INTEGER) AS churned,
         CAST(c.salary_account_flag AS INTEGER) AS salary_account_flag, c.segment, c.region,
         CAST(COALESCE(date_diff('day', fs.last_d, {snap_sql}), 999) AS INTEGER) AS days_since_last_login,
         CAST(COALESCE(fs.l30, 0) AS BIGINT) AS app_logins_last_30d,
         CAST(COALESCE(fs.l90, 0) AS BIGINT) AS app_logins_last_90d,
         CAST(COALESCE(ft.comp, 0) AS BIGINT) AS competitor_transfer_count,
         COALESCE(ft.inflow, 0.0) AS avg_monthly_inflow_eur,
         CAST(COALESCE(fc.co, 0) AS BIGINT) AS complaints_open,
         fn.nps AS nps_score_last,
         CAST(COALESCE(fh.pc, 0) AS BIGINT) AS product_count,
         CAST(fh.mrr AS INTEGER) AS months_to_rate_reset
  FROM customers_v c
  LEFT JOIN fs_{tag} fs ON c.customer_id = fs.customer_id
  LEFT JOIN ft_{tag} ft ON c.customer_id = ft.customer_id
  LEFT JOIN fc_{tag} fc ON c.customer_id = fc.customer_id
  LEFT JOIN fn_{tag} fn ON c.customer_id = fn.customer_id
  LEFT JOIN fh_{tag} fh ON c.customer_id = fh.customer_id)
"""
