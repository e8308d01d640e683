"""DuckDB text of the staged views (twins of ``moorline.sources.staging``).

Oracle queries are built as ``WITH <views> SELECT ...`` over the raw tables
the checker registers.  Conventions (FIXTURES.md): ``date_add(d, n)`` is
``d + CAST(n AS INTEGER)``, ``datediff(a, b)`` is ``date_diff('day', b, a)``,
Spark's truncating double->int cast is written with ``floor``.
"""

from __future__ import annotations

SNAP = "DATE '2024-01-16'"
FOLD = "DATE '2023-10-18'"      # snap - 90
NPS0 = "DATE '2023-07-20'"      # snap - 180

VIEWS: dict[str, str] = {}

VIEWS["customers_v"] = f"""
SELECT c.c_custkey AS customer_id,
       {SNAP} AS snapshot_date,
       CAST(18 + c.c_custkey % 57 AS INTEGER) AS age,
       CASE n.n_regionkey WHEN 0 THEN 'Brussels' WHEN 1 THEN 'Flanders'
                          WHEN 2 THEN 'Wallonia' WHEN 3 THEN 'Other' END AS region,
       CASE c.c_mktsegment WHEN 'MACHINERY' THEN 'private_banking' WHEN 'BUILDING' THEN 'standard'
                           WHEN 'FURNITURE' THEN 'starter' WHEN 'HOUSEHOLD' THEN 'student' END AS segment,
       {SNAP} - CAST(30 + (c.c_custkey * 37) % 9095 AS INTEGER) AS customer_since_date,
       CASE n.n_regionkey WHEN 1 THEN 'nl' WHEN 2 THEN 'fr' WHEN 0 THEN 'fr' ELSE 'en' END AS preferred_language,
       c.c_acctbal > 0 AS salary_account_flag,
       CASE WHEN c.c_mktsegment = 'MACHINERY'
            THEN 'RM' || lpad(CAST(c.c_custkey % 40 AS VARCHAR), 3, '0') END AS relationship_manager_id
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
"""

VIEWS["products_v"] = """
SELECT p_type AS product_id, lower(p_type) AS product_type, p_type || ' product' AS product_name,
       CASE split_part(p_type, ' ', 1)
            WHEN 'ECONOMY' THEN 'current_account' WHEN 'LARGE' THEN 'savings_account'
            WHEN 'PROMO' THEN 'mortgage' WHEN 'MEDIUM' THEN 'consumer_credit'
            WHEN 'SMALL' THEN 'investment' WHEN 'STANDARD' THEN 'insurance'
            ELSE 'current_account' END AS product_kind
FROM (SELECT DISTINCT p_type FROM part) t
"""

VIEWS["customer_products_v"] = f"""
SELECT l.l_orderkey * 10 + l.l_linenumber AS id, o.o_custkey AS customer_id, p.p_type AS product_id,
       {FOLD} + CAST(date_diff('day', DATE '1995-01-01', CAST(l.l_shipdate AS DATE)) % 150 - 200 AS INTEGER)
           AS start_date,
       CASE WHEN l.l_suppkey % 4 = 0 THEN {SNAP} + CAST(l.l_partkey % 60 AS INTEGER) END AS end_date,
       CASE WHEN l.l_suppkey % 4 = 0 THEN 'closed' ELSE 'active' END AS status,
       CASE WHEN p.p_type = 'PROMO' THEN {SNAP} + CAST((l.l_partkey % 120) * 30 AS INTEGER) END
           AS fixed_rate_end_date
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
                JOIN part p ON l.l_partkey = p.p_partkey
"""

VIEWS["transactions_v"] = f"""
SELECT l.l_orderkey * 10 + l.l_linenumber AS transaction_id,
       o.o_custkey AS customer_id,
       {FOLD} + CAST(date_diff('day', DATE '1995-01-01', CAST(l.l_shipdate AS DATE)) % 150 AS INTEGER)
           AS transaction_date,
       CAST(l.l_extendedprice AS DECIMAL(12,2)) AS amount_eur,
       CASE WHEN l.l_returnflag = 'R' THEN 'credit' ELSE 'debit' END AS direction,
       CASE WHEN o.o_orderpriority = '1-URGENT' THEN 'salary' ELSE 'transfer' END AS merchant_category,
       CASE WHEN l.l_suppkey % 10 = 0 THEN
            CASE (l.l_suppkey // 10) % 4 WHEN 0 THEN 'KREDBEBB' WHEN 1 THEN 'BBRUBEBB'
                                         WHEN 2 THEN 'GKCCBEBB' WHEN 3 THEN 'GEBABEBB' END END
           AS counterparty_bank_bic,
       CASE l.l_linenumber % 5 WHEN 0 THEN 'app' WHEN 1 THEN 'web' WHEN 2 THEN 'atm'
                               WHEN 3 THEN 'branch' WHEN 4 THEN 'standing_order' END AS channel,
       l.l_suppkey % 10 = 0 AS is_competitor_transfer
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
"""

_EVDAY = "date_diff('day', DATE '2024-01-01', CAST(ts AS DATE))"

VIEWS["app_sessions_v"] = f"""
SELECT event_id AS id, user_id AS customer_id,
       {FOLD} + CAST(5 * {_EVDAY} AS INTEGER) AS session_date,
       CAST(floor(value * 10) AS INTEGER) AS session_duration_seconds
FROM events WHERE event_type = 'view'
"""

VIEWS["complaints_v"] = f"""
SELECT event_id AS complaint_id, user_id AS customer_id,
       {FOLD} + CAST(2 * {_EVDAY} AS INTEGER) AS opened_date,
       CASE WHEN NOT (value > 10) THEN {FOLD} + CAST(2 * {_EVDAY} AS INTEGER)
                                     + CAST(2 + event_id % 12 AS INTEGER) END AS closed_date,
       CASE event_id % 5 WHEN 0 THEN 'card_dispute' WHEN 1 THEN 'fee_query' WHEN 2 THEN 'transfer_error'
                         WHEN 3 THEN 'product_query' WHEN 4 THEN 'service_quality' END AS category,
       CASE WHEN value > 10 THEN 'open' ELSE 'resolved' END AS status,
       CASE WHEN NOT (value > 10) THEN CAST(2 + event_id % 12 AS INTEGER) END AS resolution_days
FROM events WHERE event_type = 'error'
"""

VIEWS["nps_responses_v"] = f"""
SELECT event_id AS id, user_id AS customer_id,
       {NPS0} + CAST(6 * {_EVDAY} AS INTEGER) AS response_date,
       CAST(floor(value) % 11 AS INTEGER) AS score
FROM events WHERE event_type = 'signup'
"""

VIEWS["branch_visits_v"] = f"""
SELECT event_id AS id, user_id AS customer_id,
       {FOLD} + CAST(5 * {_EVDAY} AS INTEGER) AS visit_date,
       'BR' || CAST(event_id % 30 AS VARCHAR) AS branch_id,
       'advice' AS purpose
FROM events WHERE event_type = 'click'
"""

_OUTREACH_COLS = """
       o.o_orderkey AS id, o.o_custkey AS customer_id,
       CAST(date_trunc('month', o.o_orderdate) AS DATE) AS batch_date,
       'PR-' || lpad(CAST(1 + o.o_orderkey % 25 AS VARCHAR), 3, '0') AS offer_id,
       CASE WHEN o.o_orderkey % 3 = 0 THEN 'call' ELSE 'email' END AS channel,
       CASE o.o_orderpriority WHEN '1-URGENT' THEN 'Price_Sensitivity'
                              WHEN '2-HIGH' THEN ' competitor fee concerns'
                              WHEN '3-MEDIUM' THEN 'mortgage rate reset soon'
                              WHEN '5-LOW' THEN 'disengaged / dormant' END AS churn_reason,
"""

VIEWS["approved_v"] = f"""
SELECT {_OUTREACH_COLS}
       CASE WHEN o.o_orderkey % 5 = 0 THEN NULL
            ELSE CASE o.o_orderkey % 3 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' WHEN 2 THEN 'low' END
       END AS confidence,
       d.text AS message_draft,
       CAST(100 + o.o_orderkey % 700 AS INTEGER) AS agent1_tokens,
       CAST(200 + o.o_orderkey % 900 AS INTEGER) AS agent2_tokens,
       CAST(300 + o.o_orderkey % 500 AS INTEGER) AS agent3_tokens,
       CAST(o.o_orderdate AS TIMESTAMP) AS approved_at
FROM orders o LEFT JOIN documents d ON o.o_orderkey = d.doc_id
WHERE o.o_orderstatus <> 'F'
"""

VIEWS["queue_v"] = f"""
SELECT {_OUTREACH_COLS}
       d.text AS message_draft,
       CASE o.o_orderkey % 4
            WHEN 0 THEN '[]'
            WHEN 1 THEN '[{{"rule_id": "BT-001", "severity": "hard_block", "finding": "urgency phrase"}}]'
            WHEN 2 THEN '[{{"rule_id": "CH-001", "severity": "hard_block", "finding": "no unsubscribe line"}}, "BT-005", "XX-999"]'
            WHEN 3 THEN '[bad json' END AS violated_rules,
       CAST(NULL AS VARCHAR) AS review_notes,
       CASE o.o_orderkey % 5 WHEN 0 THEN 'approved' WHEN 1 THEN 'rejected' ELSE 'pending' END AS status,
       CASE WHEN o.o_orderkey % 5 IN (0, 1) THEN 'reviewer_' || CAST(o.o_orderkey % 3 AS VARCHAR) END
           AS reviewed_by,
       CASE WHEN o.o_orderkey % 5 IN (0, 1) THEN CAST(o.o_orderdate AS TIMESTAMP) + INTERVAL 1 DAY END
           AS reviewed_at,
       CAST(o.o_orderdate AS TIMESTAMP) AS created_at
FROM orders o LEFT JOIN documents d ON o.o_orderkey = d.doc_id
WHERE o.o_orderstatus = 'F'
"""

VIEWS["scored_v"] = f"""
SELECT l.doc_id AS customer_id, CAST(l.quality AS INTEGER) AS label,
       (d.n_chars % 97) / 97.0 AS score,
       {SNAP} + CAST(d.doc_id % 14 AS INTEGER) AS scored_date
FROM labels l JOIN documents d ON l.doc_id = d.doc_id
"""


def with_views(sql: str, *names: str) -> str:
    """Prefix ``sql`` with CTEs for the named views (in the given order)."""
    body = sql.strip()
    if not names:
        return body
    ctes = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in names)
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
