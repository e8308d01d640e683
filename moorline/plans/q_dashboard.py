"""Queries: campaign read models and review workflow (AG7-AG19, AG25, DC15, J7, J8, J12,
PV1-PV3, PF7, SO1, SO5, WN4)."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as TX
from ..operators import dashboard as DB
from ..operators import marts as M
from ..operators import registry as RG
from ..operators import review as RV
from . import common as C
from .oracle_frag import LABELS, sql_with
from .q_registry import RUNS
from .registry import query

_O = ("approved_v", "queue_v")
_TAGGED = """
u AS (SELECT batch_date, churn_reason, channel, customer_id, 'approved' AS src FROM approved_v
      UNION ALL SELECT batch_date, churn_reason, channel, customer_id, 'queued' FROM queue_v)
"""


def _w(spark, sf_dir):
    return C.warehouse(spark, sf_dir)


@query("home_kpis", sql_with("x AS (SELECT 1)", """
SELECT (SELECT count(*) FROM approved_v) + (SELECT count(*) FROM queue_v) AS processed,
       COALESCE((SELECT count(*) FROM approved_v) /
                nullif((SELECT count(*) FROM approved_v) + (SELECT count(*) FROM queue_v), 0), 0.0) AS pass_rate,
       (SELECT count(*) FROM approved_v) AS approved, (SELECT count(*) FROM queue_v) AS queued,
       CAST(COALESCE((SELECT sum(agent1_tokens + agent2_tokens + agent3_tokens) FROM approved_v), 0) AS BIGINT)
           AS tokens""", _O))
def home_kpis(spark, sf_dir):
    """AG7: processed, pass rate, approved, queued, tokens."""
    w = _w(spark, sf_dir)
    return DB.home_kpis(w.approved(), w.queue())


@query("batch_summary", sql_with(_TAGGED, """
SELECT batch_date, count(*) FILTER (WHERE src = 'approved') AS approved_count,
       count(*) FILTER (WHERE src = 'queued') AS review_count,
       count(*) FILTER (WHERE src = 'approved') / nullif(count(*), 0) AS pass_rate
FROM u GROUP BY batch_date""", _O))
def batch_summary(spark, sf_dir):
    """AG8 / J7: approved and review counts per batch with pass rate."""
    w = _w(spark, sf_dir)
    return DB.batch_summary(w.approved(), w.queue())


@query("pass_rate_trend", sql_with(_TAGGED, """
SELECT batch_date, count(*) FILTER (WHERE src = 'approved') AS approved_count,
       count(*) FILTER (WHERE src = 'queued') AS review_count, count(*) AS total,
       round_even(count(*) FILTER (WHERE src = 'approved') / nullif(count(*), 0) * 100, 1) AS pass_pct
FROM u GROUP BY batch_date""", _O))
def pass_rate_trend(spark, sf_dir):
    """AG15: per-batch totals and pass percentage."""
    w = _w(spark, sf_dir)
    return DB.pass_rate_trend(w.approved(), w.queue())


@query("outreach_kpis", sql_with("x AS (SELECT 1)", """
SELECT count(*) AS total, count(*) FILTER (WHERE channel = 'email') AS email,
       count(*) FILTER (WHERE channel = 'call') AS call,
       CAST(floor(avg(agent1_tokens + agent2_tokens + agent3_tokens)) AS BIGINT) AS avg_tokens
FROM approved_v""", _O))
def outreach_kpis(spark, sf_dir):
    """AG9: total, email, call, average tokens."""
    return DB.outreach_kpis(_w(spark, sf_dir).approved())


@query("count_by_reason", sql_with("x AS (SELECT 1)", """
SELECT churn_reason, count(*) AS n FROM approved_v WHERE churn_reason IS NOT NULL GROUP BY churn_reason""", _O))
def count_by_reason(spark, sf_dir):
    """AG10: approved rows per churn reason."""
    from ..operators.marts import count_by
    return count_by(_w(spark, sf_dir).approved(), "churn_reason", "n")


@query("count_by_confidence", sql_with("x AS (SELECT 1)", """
SELECT confidence, count(*) AS n FROM approved_v WHERE confidence IS NOT NULL GROUP BY confidence""", _O))
def count_by_confidence(spark, sf_dir):
    """AG11: approved rows per confidence."""
    from ..operators.marts import count_by
    return count_by(_w(spark, sf_dir).approved(), "confidence", "n")


@query("queue_kpis", sql_with("x AS (SELECT 1)", """
SELECT count(*) AS total, count(*) FILTER (WHERE status = 'pending') AS pending,
       count(*) FILTER (WHERE status = 'approved') AS approved,
       count(*) FILTER (WHERE status = 'rejected') AS rejected FROM queue_v""", _O))
def queue_kpis(spark, sf_dir):
    """AG12: queue totals by status."""
    return DB.queue_kpis(_w(spark, sf_dir).queue())


_VIOL = """
parsed AS (SELECT id, churn_reason, violated_rules,
                  CASE WHEN json_valid(violated_rules) THEN CAST(violated_rules AS JSON) END AS j FROM queue_v),
el AS (SELECT id, churn_reason, violated_rules, unnest(from_json(j, '["JSON"]')) AS e FROM parsed WHERE j IS NOT NULL),
ids AS (SELECT id, churn_reason, violated_rules,
               CASE WHEN json_type(e) = 'OBJECT' THEN e ->> 'rule_id' ELSE e ->> '$' END AS rule_id,
               json_type(e) = 'OBJECT' AS is_obj FROM el)
"""


@query("rule_top10", sql_with(_VIOL, """
SELECT COALESCE(rule_id, 'unknown') AS rule_id, count(*) AS violations FROM ids
GROUP BY COALESCE(rule_id, 'unknown') ORDER BY violations DESC, rule_id LIMIT 10""", ("queue_v",)))
def rule_top10(spark, sf_dir):
    """AG13 / SO5: ten most violated rules."""
    return DB.rule_top10(_w(spark, sf_dir).queue())


@query("pass_rate_by_reason", sql_with(_TAGGED, """
SELECT churn_reason, count(*) AS total, count(*) FILTER (WHERE src = 'approved') AS approved,
       count(*) FILTER (WHERE src = 'approved') / count(*) AS pass_rate,
       round_even(count(*) FILTER (WHERE src = 'approved') / count(*) * 100, 1) AS pass_pct
FROM u WHERE churn_reason IS NOT NULL GROUP BY churn_reason""", _O))
def pass_rate_by_reason(spark, sf_dir):
    """AG14 / SE1: pass rate per churn reason."""
    w = _w(spark, sf_dir)
    return DB.pass_rate_by_reason(w.approved(), w.queue())


_LV = ("customers_v", "transactions_v", "app_sessions_v", "customer_products_v", "approved_v", "queue_v")


@query("signals_vs_outcome", sql_with(LABELS + """,
o AS (SELECT customer_id, 'Pass' AS outcome FROM approved_v UNION ALL SELECT customer_id, 'Fail' FROM queue_v),
j AS (SELECT l.churn_signal_count, o.outcome FROM o LEFT JOIN labels_o l ON o.customer_id = l.customer_id
      WHERE l.churn_signal_count IS NOT NULL)
""", """
SELECT churn_signal_count, count(*) FILTER (WHERE outcome = 'Pass') AS "Pass",
       count(*) FILTER (WHERE outcome = 'Fail') AS "Fail", count(*) AS total,
       round_even(count(*) FILTER (WHERE outcome = 'Pass') / count(*) * 100, 1) AS pass_pct
FROM j GROUP BY churn_signal_count""", _LV))
def signals_vs_outcome(spark, sf_dir):
    """AG16 / J8 / PV1: outcomes per churn-signal count."""
    w = _w(spark, sf_dir)
    return DB.signals_vs_outcome(w.approved(), w.queue(), C.labels(w))


_HEAT_WHERE = """
FROM ids WHERE violated_rules IS NOT NULL AND violated_rules <> '[]' AND churn_reason IS NOT NULL AND rule_id IS NOT NULL
GROUP BY churn_reason"""


def _heat_sql():
    known = ", ".join(f"'{r}'" for r in DB.RULE_IDS)
    cols = ", ".join(f"count(*) FILTER (WHERE rule_id = '{r}') AS \"{r}\"" for r in DB.RULE_IDS)
    return f"SELECT churn_reason, {cols}, count(*) FILTER (WHERE rule_id NOT IN ({known})) AS \"other\"" + _HEAT_WHERE


@query("rule_heatmap", sql_with(_VIOL, _heat_sql(), ("queue_v",)))
def rule_heatmap(spark, sf_dir):
    """AG17 / PV2: reason x rule violation counts, ids outside the catalogue in a column of their own."""
    return DB.rule_heatmap(_w(spark, sf_dir).queue())


@query("rule_counts", sql_with(_VIOL, "SELECT churn_reason, rule_id, count(*) AS n" + _HEAT_WHERE + ", rule_id",
                               ("queue_v",)))
def rule_counts(spark, sf_dir):
    """AG17 in long form: every rule id that occurs."""
    return DB.rule_counts(_w(spark, sf_dir).queue())


@query("tokens_by_reason", sql_with("x AS (SELECT 1)", """
SELECT churn_reason, count(agent1_tokens + agent2_tokens + agent3_tokens) AS customers,
       CAST(round_even(avg(agent1_tokens + agent2_tokens + agent3_tokens), 0) AS BIGINT) AS avg_tokens,
       CAST(sum(agent1_tokens + agent2_tokens + agent3_tokens) AS BIGINT) AS total_tokens
FROM approved_v WHERE churn_reason IS NOT NULL GROUP BY churn_reason""", _O))
def tokens_by_reason(spark, sf_dir):
    """AG18: token count, mean and sum per reason."""
    return DB.tokens_by_reason(_w(spark, sf_dir).approved())


@query("channel_by_reason", sql_with(_TAGGED, """
SELECT churn_reason, count(*) FILTER (WHERE channel = 'email') AS email,
       count(*) FILTER (WHERE channel = 'call') AS call
FROM u WHERE churn_reason IS NOT NULL AND channel IS NOT NULL GROUP BY churn_reason""", _O))
def channel_by_reason(spark, sf_dir):
    """AG19 / PV3: reason x channel counts."""
    w = _w(spark, sf_dir)
    return DB.channel_by_reason(w.approved(), w.queue())


# Dashboard filter selection used by the filtered views (PF7).
FILTER_BATCH = dt.date(1998, 3, 1)


@query("approved_filtered", sql_with("x AS (SELECT 1)", f"""
SELECT id, customer_id, batch_date, offer_id, channel, churn_reason, confidence, message_draft,
       agent1_tokens, agent2_tokens, agent3_tokens, approved_at, substr(message_draft, 1, 500) AS message_preview,
       agent1_tokens + agent2_tokens + agent3_tokens AS total_tokens
FROM approved_v WHERE batch_date = DATE '{FILTER_BATCH}' AND channel = 'email'""", _O))
def approved_filtered(spark, sf_dir):
    """PF2 / PF7 / SC16 / SC17 / SO1: filtered approved view with preview and tokens."""
    return DB.approved_view(_w(spark, sf_dir).approved(drafts=True), batch_date=FILTER_BATCH, channel="email")


@query("queue_filtered", sql_with("x AS (SELECT 1)", """
SELECT id, customer_id, batch_date, offer_id, channel, churn_reason, message_draft, violated_rules,
       review_notes, status, reviewed_by, reviewed_at, created_at, substr(message_draft, 1, 500) AS message_preview
FROM queue_v WHERE status = 'pending'""", _O))
def queue_filtered(spark, sf_dir):
    """PF7 / SC16 / SO1: pending review queue with preview."""
    return DB.queue_view(_w(spark, sf_dir).queue(drafts=True), status="pending")


@query("queue_item", sql_with(_VIOL + """,
agg AS (SELECT id, string_agg(COALESCE(rule_id, 'unknown'), ',' ORDER BY ord) AS rule_ids
        FROM (SELECT *, row_number() OVER () AS ord FROM ids) t GROUP BY id)
""", """
SELECT q.id, q.customer_id, q.status, q.churn_reason, COALESCE(agg.rule_ids, '') AS rule_ids
FROM queue_v q LEFT JOIN agg ON q.id = agg.id""", ("queue_v",)))
def queue_item(spark, sf_dir):
    """AG25 / SC14: queue items with parsed violation ids."""
    return DB.queue_items(_w(spark, sf_dir).queue())


@query("message_lookup", sql_with("x AS (SELECT 1)", """
SELECT customer_id, batch_date, message_draft FROM (
  SELECT customer_id, batch_date, message_draft,
         row_number() OVER (PARTITION BY customer_id, batch_date ORDER BY approved_at DESC, id) AS rn
  FROM approved_v) t WHERE rn = 1""", _O))
def message_lookup(spark, sf_dir):
    """WN4: first message per (customer, batch)."""
    return DB.first_message(_w(spark, sf_dir).approved(drafts=True))


# -- display order (SO2, SO3) ----------------------------------------------------------------
def _order_sql(view, key, order, source):
    return (f"SELECT '{view}' AS view, row_number() OVER (ORDER BY {order}, {key}) AS rank, "
            f"CAST({key} AS VARCHAR) AS key FROM ({source})")


_ORDERED = [
    _order_sql("segments", "segment", "n DESC", "SELECT segment, count(*) AS n FROM customers_v WHERE segment IS NOT NULL GROUP BY 1"),
    _order_sql("regions", "region", "n DESC", "SELECT region, count(*) AS n FROM customers_v WHERE region IS NOT NULL GROUP BY 1"),
    _order_sql("churn_rate", "segment", "r DESC", "SELECT c.segment, round(avg(CAST(l.churned AS INTEGER)) * 100.0, 6) AS r "
               "FROM customers_v c JOIN labels_o l ON c.customer_id = l.customer_id WHERE c.segment IS NOT NULL GROUP BY 1"),
    _order_sql("holdings", "product_type", "n DESC", "SELECT p.product_type, count(*) AS n FROM customer_products_v cp "
               "JOIN products_v p ON cp.product_id = p.product_id WHERE cp.status = 'active' GROUP BY 1"),
    _order_sql("pass_rate", "churn_reason", "r DESC", "SELECT churn_reason, count(*) FILTER (WHERE src = 'approved') / count(*) AS r "
               "FROM u WHERE churn_reason IS NOT NULL GROUP BY 1"),
    _order_sql("trend", "batch_date", "batch_date", "SELECT DISTINCT batch_date FROM u"),
    _order_sql("tokens", "churn_reason", "m DESC", "SELECT churn_reason, "
               "round_even(avg(agent1_tokens + agent2_tokens + agent3_tokens), 0) AS m FROM approved_v "
               "WHERE churn_reason IS NOT NULL GROUP BY 1"),
    _order_sql("reasons_to_clean", "tbl || ': ' || churn_reason", "tbl, cnt DESC", "SELECT tbl, churn_reason, count(*) AS cnt FROM ("
               "SELECT 'approved_outreach' AS tbl, churn_reason FROM approved_v "
               "UNION ALL SELECT 'compliance_review_queue', churn_reason FROM queue_v) "
               "WHERE lower(churn_reason) NOT IN ('price_sensitivity', 'service_dissatisfaction', 'product_lifecycle', "
               "'inactivity', 'unknown') GROUP BY 1, 2"),
]


@query("display_order", sql_with(LABELS + "," + _TAGGED, "\nUNION ALL ".join(_ORDERED),
                                 ("customers_v", "transactions_v", "app_sessions_v", "customer_products_v", "products_v",
                                  "approved_v", "queue_v")))
def display_order(spark, sf_dir):
    """SO2 + SO3: the rank of every row in the sorted read models (count, rate, mean, date; table and count)."""
    w = _w(spark, sf_dir)
    a, q = w.approved(), w.queue()
    dirty = a.select(F.lit("approved_outreach").alias("tbl"), "churn_reason").unionByName(
        q.select(F.lit("compliance_review_queue").alias("tbl"), "churn_reason")) \
        .where(~TX.is_canonical_reason(F.col("churn_reason"))).groupBy("tbl", "churn_reason").agg(F.count(F.lit(1)).alias("cnt")) \
        .withColumn("name", F.concat_ws(": ", "tbl", "churn_reason"))
    views = {
        "segments": M.ranked(M.count_by(w.customers(), "segment"), "segment", F.desc("customers")),
        "regions": M.ranked(M.count_by(w.customers(), "region"), "region", F.desc("customers")),
        "churn_rate": M.ranked(M.churn_by(C.labelled_customers(w), "segment"), "segment", F.desc("churn_rate_pct")),
        "holdings": M.ranked(M.holdings_by_type(w.customer_products(), w.products()), "product_type", F.desc("holdings")),
        "pass_rate": M.ranked(DB.pass_rate_by_reason(a, q), "churn_reason", F.desc("pass_rate")),
        "trend": M.ranked(DB.pass_rate_trend(a, q), "batch_date", F.asc("batch_date")),
        "tokens": M.ranked(DB.tokens_by_reason(a), "churn_reason", F.desc("avg_tokens")),
        "reasons_to_clean": M.ranked(dirty, "name", F.asc("tbl"), F.desc("cnt"), groups_bounded=False),
    }
    return reduce(DataFrame.unionByName, [v.select(F.lit(k).alias("view"), "rank", "key") for k, v in views.items()])


# -- batch history (AG24) ------------------------------------------------------------------------
@query("batch_history", sql_with(RUNS + "," + _TAGGED + """,
b AS (SELECT batch_date AS month, count(*) FILTER (WHERE src = 'approved') AS approved_count,
             count(*) FILTER (WHERE src = 'queued') AS review_count FROM u GROUP BY 1),
r AS (SELECT CAST(DATE '1996-01-01' + to_months(CAST(version AS INTEGER) - 1) AS DATE) AS month,
             precision AS model_precision FROM runs),
j AS (SELECT month, approved_count, review_count, approved_count / (approved_count + review_count) AS pass_rate,
             model_precision FROM b JOIN r USING (month))
""", """
SELECT *, round((SELECT corr(model_precision, pass_rate) FROM j), 6) AS precision_pass_rate_corr FROM j""",
    ("scored_v", "approved_v", "queue_v")))
def batch_history(spark, sf_dir):
    """AG24: pass rate of each batch month beside the precision of that month's run.  The
    staged runs are folded onto consecutive batch months."""
    w = _w(spark, sf_dir)
    runs = RG.runs_by_day(w.scored(), w.snapshot).withColumn(
        "run_date", F.add_months(F.lit(dt.date(1996, 1, 1)), F.col("version").cast("int") - 1))
    h = DB.batch_history(DB.batch_summary(w.approved(), w.queue()), runs)
    return h.withColumn("precision_pass_rate_corr", F.round("precision_pass_rate_corr", 6))


@query("batch_history_weekly", sql_with(RUNS + """,
w AS (SELECT CAST(date_trunc('week', approved_at) AS DATE) AS batch_date, 1 AS passed FROM approved_v
      UNION ALL SELECT CAST(date_trunc('week', created_at) AS DATE), 0 FROM queue_v),
b AS (SELECT batch_date, sum(passed) AS approved_count, sum(1 - passed) AS review_count FROM w GROUP BY 1),
r AS (SELECT CAST(DATE '1995-06-01' + to_days(182 * (CAST(version AS INTEGER) - 1)) AS DATE) AS run_date, version, precision FROM runs)
""", """
SELECT batch_date, version AS model_version, precision AS model_precision,
       round(approved_count / (approved_count + review_count), 6) AS pass_rate,
       round(1 - approved_count / (approved_count + review_count), 6) AS failure_rate,
       CAST(approved_count AS BIGINT) AS approved_count, CAST(review_count AS BIGINT) AS review_count
FROM b ASOF LEFT JOIN r ON b.batch_date >= r.run_date""", ("scored_v", "approved_v", "queue_v")))
def batch_history_weekly(spark, sf_dir):
    """AG24: weekly rows with the model version in use, its precision, pass and failure rate.  The staged
    runs are folded onto half years."""
    w = _w(spark, sf_dir)
    runs = RG.runs_by_day(w.scored(), w.snapshot).withColumn(
        "run_date", F.date_add(F.lit(dt.date(1995, 6, 1)), (182 * (F.col("version").cast("int") - 1)).cast("int")))
    return DB.weekly_history(w.approved(), w.queue(), runs)


# -- review workflow ---------------------------------------------------------------
def _decisions(w):
    """Reviewer decisions derived from the pending queue: approve unedited,
    approve with an edited draft, reject; some ids decided twice (the later
    wins) and some decisions for ids that are not in the queue."""
    q = w.queue(drafts=True).where(F.col("status") == "pending")
    k = F.col("id") % 3
    base = q.select(
        F.col("id").alias("queue_id"),
        F.when(k == 2, F.lit("rejected")).otherwise(F.lit("approved")).alias("decision"),
        F.concat(F.lit("reviewer_"), (F.col("id") % 4).cast("string")).alias("reviewer"),
        F.when(k == 1, F.concat(F.lit("Hello, "), F.coalesce(F.col("message_draft"), F.lit("")))).alias("edited_draft"),
        (F.col("created_at") + F.expr("INTERVAL 2 DAYS")).alias("decided_at"))
    earlier = q.where(F.col("id") % 7 == 0).select(
        F.col("id").alias("queue_id"), F.lit("rejected").alias("decision"), F.lit("reviewer_x").alias("reviewer"),
        F.lit(None).cast("string").alias("edited_draft"),
        (F.col("created_at") + F.expr("INTERVAL 1 DAYS")).alias("decided_at"))
    unknown = q.where(F.col("id") % 11 == 0).select(
        (F.col("id") + F.lit(10**12)).alias("queue_id"), F.lit("approved").alias("decision"),
        F.lit("reviewer_y").alias("reviewer"), F.lit(None).cast("string").alias("edited_draft"),
        F.col("created_at").alias("decided_at"))
    return base.unionByName(earlier).unionByName(unknown)


_DEC_SQL = """
pend AS (SELECT * FROM queue_v WHERE status = 'pending'),
dec AS (
  SELECT id AS queue_id, CASE WHEN id % 3 = 2 THEN 'rejected' ELSE 'approved' END AS decision,
         'reviewer_' || CAST(id % 4 AS VARCHAR) AS reviewer,
         CASE WHEN id % 3 = 1 THEN 'Hello, ' || COALESCE(message_draft, '') END AS edited_draft,
         created_at + INTERVAL 2 DAY AS decided_at FROM pend
  UNION ALL
  SELECT id, 'rejected', 'reviewer_x', NULL, created_at + INTERVAL 1 DAY FROM pend WHERE id % 7 = 0
  UNION ALL
  SELECT id + 1000000000000, 'approved', 'reviewer_y', NULL, created_at FROM pend WHERE id % 11 = 0),
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY queue_id ORDER BY decided_at DESC,
                                                        reviewer DESC) AS rn FROM dec) t WHERE rn = 1),
rev AS (
  SELECT q.id, q.customer_id, q.batch_date, q.offer_id, q.channel, q.churn_reason, q.violated_rules,
         q.review_notes, q.created_at,
         CASE WHEN l.decision IS NOT NULL AND length(l.edited_draft) > 0
                   AND trim(COALESCE(l.edited_draft, '')) <> trim(COALESCE(q.message_draft, ''))
              THEN l.edited_draft ELSE q.message_draft END AS message_draft,
         CASE WHEN l.decision IS NULL THEN q.status WHEN l.decision = 'approved' THEN 'approved'
              ELSE 'rejected' END AS status,
         CASE WHEN l.decision IS NOT NULL THEN l.reviewer ELSE q.reviewed_by END AS reviewed_by,
         CASE WHEN l.decision IS NOT NULL THEN l.decided_at ELSE q.reviewed_at END AS reviewed_at,
         l.decision IS NOT NULL AND COALESCE(length(l.edited_draft) > 0, false)
           AND trim(COALESCE(l.edited_draft, '')) <> trim(COALESCE(q.message_draft, '')) AS draft_edited,
         l.decision IS NOT NULL AS decided_now
  FROM queue_v q LEFT JOIN latest l ON q.id = l.queue_id)
"""


def _reviewed(w):
    return RV.apply_decisions(w.queue(drafts=True), _decisions(w))


@query("review_apply", sql_with(_DEC_SQL, "SELECT * FROM rev", ("queue_v",)))
def review_apply(spark, sf_dir):
    """DC15 / SC19: queue after reviewer decisions."""
    return _reviewed(_w(spark, sf_dir))


@query("review_mirrored", sql_with(_DEC_SQL, """
SELECT customer_id, batch_date, offer_id, channel, churn_reason, message_draft,
       0 AS agent1_tokens, 0 AS agent2_tokens, 0 AS agent3_tokens
FROM rev WHERE status = 'approved' AND decided_now AND draft_edited""", ("queue_v",)))
def review_mirrored(spark, sf_dir):
    """DC15 / J12: edited approvals appended to the approved table."""
    return RV.mirrored_approvals(_reviewed(_w(spark, sf_dir)))
