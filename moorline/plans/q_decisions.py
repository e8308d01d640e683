"""Queries: decisioning (DC1-DC14, J10, J11, SC18) and text functions
(SC9-SC16, PF9, PF10, AG22)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as TX
from ..functions.joins import broadcast_if_bounded
from ..operators import catalogue as CT
from ..operators import decisions as DC
from ..operators import profiles as PR
from . import common as C
from .oracle_frag import sql_with
from .oracle_views import with_views
from ..operators import model as MD
from ..session import materialize
from .oracle_decisions import CONTRACT_SQL, DECISION_VIEWS, decision_ctes, golden_sql, staged_compliance_sql
from .q_model import scored_at_col
from .q_profiles import scored_batch
from .registry import query


def context(w):
    """Decision inputs for the high-risk batch.  The batch and its holdings are read
    several times and materialised; the context itself is read once by each query.
    The profile store lags behind the batch: every ninth customer has no profile yet."""
    b = scored_batch(w)
    # Holdings of the batch customers only (a small set), read by the product
    # summary, the holding kinds and the rate-reset dates.
    hold = materialize(w.customer_products().join(broadcast_if_bounded(b.select("customer_id")), "customer_id",
                                                  "left_semi"))
    docs = PR.profile_documents(MD.high_risk(b).where(F.col("customer_id") % 9 != 4), hold, w.products(), None,
                                w.complaints(), None, w.snapshot,
                                daily_s=C.daily_sessions(w), daily_t=C.daily_transactions(w))
    return DC.decision_context(b, w.customers(), hold, w.products(), w.complaints(), None, docs, w.snapshot,
                               daily_t=C.daily_transactions(w))


def decided(w):
    """All decisions for the batch, materialised: filters on the outcome would else be
    pushed through the whole projection chain and repeat it.  For every fifth customer
    the later stage returns a draft of its own, with a phrase that the rules block."""
    later = F.when(F.col("customer_id") % 5 == 2, F.concat(F.lit("Act now: "), F.col("message_draft")))
    return materialize(DC.decide(context(w), later_draft=later))


_D = decision_ctes()


def _dsql(select: str) -> str:
    return sql_with(_D, select, DECISION_VIEWS)


@query("reason_classify", _dsql("""
SELECT customer_id, churn_reason, confidence, array_to_string(supporting_signals, ',') AS supporting_signals,
       error FROM cls2"""))
def reason_classify(spark, sf_dir):
    """DC1-DC4: reason, confidence, supporting signals per batch customer."""
    c = DC.classify(context(C.warehouse(spark, sf_dir)))
    return c.select("customer_id", "churn_reason", "confidence",
                    F.array_join("supporting_signals", ",").alias("supporting_signals"), "error")


@query("offer_eligibility", _dsql("""
SELECT customer_id, e.offer_id, e.triggered FROM (SELECT customer_id, unnest(eligible) AS e FROM elig) t"""))
def offer_eligibility(spark, sf_dir):
    """DC5 / J10: every eligible (customer, offer) with its triggered-predicate count.
    Materialised before it is exploded: the filter on empty lists that Spark infers would else
    be pushed below the context's last exchange, with the whole chain of projections in it."""
    e = materialize(DC.eligible_offers(DC.classify(context(C.warehouse(spark, sf_dir)))).select("customer_id", "eligible"))
    return e.select("customer_id", F.explode("eligible").alias("o")).select(
        "customer_id", "o.offer_id", "o.triggered")


@query("offer_catalogue", _dsql("""
SELECT customer_id, e.offer_id, e.triggered FROM (SELECT customer_id, unnest(eligible) AS e FROM elig) t"""))
def offer_catalogue(spark, sf_dir):
    """J10 + DC5: the same from the catalogue as a table, by relational division."""
    return CT.eligible_offers(DC.classify(context(C.warehouse(spark, sf_dir))), DC.offers_frame(spark)) \
        .select("customer_id", F.explode("eligible").alias("o")).select("customer_id", "o.offer_id", "o.triggered")


@query("offer_best", _dsql("""
SELECT customer_id, churn_reason, offer_id, offer_triggered, channel FROM off"""))
def offer_best(spark, sf_dir):
    """DC6 + DC7: best offer (NULL when none) and channel."""
    c = DC.choose_offer(DC.eligible_offers(DC.classify(context(C.warehouse(spark, sf_dir)))))
    return c.select("customer_id", "churn_reason", "offer_id", "offer_triggered", "channel")


@query("message_render", _dsql("SELECT customer_id, channel, offer_id, message_draft FROM msg0"))
def message_render(spark, sf_dir):
    """DC8: the deterministic draft per customer."""
    d = DC.render_message(DC.choose_offer(DC.eligible_offers(DC.classify(context(C.warehouse(spark, sf_dir))))))
    return d.select("customer_id", "channel", "offer_id", "message_draft")


@query("compliance_hits", _dsql("""
SELECT customer_id, v.rule_id, v.severity, v.finding
FROM (SELECT customer_id, unnest(violated_rules) AS v FROM dec) t"""))
def compliance_hits(spark, sf_dir):
    """DC9 / J11: one row per rule hit on the rendered drafts."""
    d = decided(C.warehouse(spark, sf_dir))
    return d.select("customer_id", F.explode("violated_rules").alias("v")).select(
        "customer_id", "v.rule_id", "v.severity", "v.finding")


@query("compliance_status", _dsql("""
SELECT customer_id, status, CAST(len(violated_rules) AS INTEGER) AS n_violations FROM dec"""))
def compliance_status(spark, sf_dir):
    """DC10: pass/fail per draft."""
    d = decided(C.warehouse(spark, sf_dir))
    return d.select("customer_id", "status", F.size("violated_rules").alias("n_violations"))


@query("campaign_route", _dsql("""
SELECT customer_id, outcome, churn_reason, confidence, offer_id, channel,
       CAST(to_json(violated_rules) AS VARCHAR) AS violated_rules FROM outc"""))
def campaign_route(spark, sf_dir):
    """DC11 + DC12: outcome per customer (approved / queued / error)."""
    d = decided(C.warehouse(spark, sf_dir))
    return d.select("customer_id", "outcome", "churn_reason", "confidence", "offer_id", "channel",
                    F.to_json("violated_rules").alias("violated_rules"))


@query("batch_counters", _dsql("SELECT outcome, count(*) AS n FROM outc GROUP BY outcome"))
def batch_counters(spark, sf_dir):
    """DC13: counts per outcome."""
    return DC.batch_counters(decided(C.warehouse(spark, sf_dir)))


def _stage_outputs(d):
    """Outputs of the three stages as JSON texts; every eighth customer breaks one
    contract each (score out of range, unknown confidence, channel, short draft,
    unknown severity, missing rationale, extra key)."""
    k = F.col("customer_id") % 8
    rules = F.when(k == 4, F.array(F.struct(F.lit("BT-001").alias("rule_id"), F.lit("warn").alias("severity"),
                                            F.lit("?").alias("finding")))).otherwise(F.col("violated_rules"))
    draft = F.when(k == 3, F.lit("Too short.")).otherwise(F.col("message_draft"))
    keep = {"ignoreNullFields": "false"}
    s1 = F.to_json(F.struct("customer_id", F.when(k == 0, F.lit(1.5)).otherwise(F.col("churn_score")).alias("churn_score"),
                            "churn_reason", F.when(k == 1, F.lit("certain")).otherwise(F.col("confidence")).alias("confidence"),
                            "supporting_signals"), keep)
    common = ["customer_id", "offer_id", F.when(k == 2, F.lit("sms")).otherwise(F.col("channel")).alias("channel"),
              draft.alias("message_draft")]
    s2 = F.when(k == 5, F.to_json(F.struct(*common), keep)).otherwise(
        F.to_json(F.struct(*common, F.lit("most triggered conditions").alias("rationale")), keep))
    checked = [F.col("status"), rules.alias("violated_rules"), F.col("message_draft"), F.lit("").alias("review_notes")]
    s3 = F.when(k == 6, F.to_json(F.struct(*checked, F.lit(1).alias("debug")), keep)).otherwise(
        F.to_json(F.struct(*checked), keep))
    return d.select("customer_id", s1.alias("stage1"), s2.alias("stage2"), s3.alias("stage3"))


@query("contract_validation", _dsql(CONTRACT_SQL))
def contract_validation(spark, sf_dir):
    """SC18: contract violations of staged stage outputs, valid and broken ones."""
    d = DC.contract_violations(_stage_outputs(decided(C.warehouse(spark, sf_dir))))
    return d.select("customer_id", F.array_join("contract_violations", ",").alias("contract_violations"))


# -- compliance on the staged outreach drafts (free text from documents) --------
def _own_values(w):
    """Per customer what PERS-001 may find in a message: product names, next rate end."""
    h = w.customer_products().join(w.products().select("product_id", "product_name"), "product_id")
    return h.groupBy("customer_id").agg(
        F.collect_set(F.when(F.col("status") == "active", F.col("product_name"))).alias("product_names"),
        F.min(F.when(F.col("fixed_rate_end_date") >= w.snap, F.col("fixed_rate_end_date"))).alias("next_rate_end"))


def _staged_checked(w):
    a = w.approved(drafts=True).join(w.customers().select("customer_id", "segment", "age", "region"), "customer_id", "left") \
        .join(_own_values(w), "customer_id", "left")
    return DC.compliance(a)


@query("compliance_staged", with_views(staged_compliance_sql(), "approved_v", "customers_v", "customer_products_v",
                                       "products_v"))
def compliance_staged(spark, sf_dir):
    """DC9 + DC10 on every staged approved row; one without a draft fails the signal,
    unsubscribe and opt-out rules."""
    d = _staged_checked(C.warehouse(spark, sf_dir))
    return d.select("id", "status", F.array_join(F.transform("violated_rules", lambda v: v["rule_id"]), ",")
                    .alias("rule_ids"))


@query("golden_agreement", with_views(golden_sql(), "approved_v", "queue_v", "customers_v", "customer_products_v",
                                      "products_v"))
def golden_agreement(spark, sf_dir):
    """DC16: agreement of the rule checks with the recorded outcomes of the staged rows
    (approved: pass without a hit; queued: fail with the recorded rule ids)."""
    w = C.warehouse(spark, sf_dir)
    cols = ["id", "customer_id", "churn_reason", "channel", "offer_id", "message_draft"]
    a = w.approved(drafts=True).select(*cols, F.lit("pass").alias("expected_status"),
                                       F.array().cast("array<string>").alias("expected_rules"))
    q = w.queue(drafts=True).select(*cols, F.lit("fail").alias("expected_status"),
                                    TX.violation_ids(F.col("violated_rules")).alias("expected_rules"))
    g = a.unionByName(q).join(w.customers().select("customer_id", "segment", "age", "region"), "customer_id", "left") \
        .join(_own_values(w), "customer_id", "left")
    return DC.golden_agreement(g.withColumnRenamed("id", "example_id").withColumnRenamed("message_draft", "body"))


@query("draft_override", with_views("""
SELECT id, CASE WHEN id % 3 = 0 AND message_draft IS NOT NULL THEN 'Reviewed: ' || message_draft
                ELSE message_draft END AS message_draft FROM approved_v""", "approved_v"))
def draft_override(spark, sf_dir):
    """DC12: the later stage's draft replaces the earlier one unless it is empty or missing."""
    a = C.warehouse(spark, sf_dir).approved(drafts=True)
    k = F.col("id") % 3
    later = F.when(k == 0, F.concat(F.lit("Reviewed: "), F.col("message_draft"))).when(k == 1, F.lit(""))
    return DC.merge_drafts(a.withColumn("later", later), "later").select("id", "message_draft")


# -- text functions ------------------------------------------------------------------
_OUT = ("approved_v", "queue_v")
_BOTH_REASONS = """
reasons AS (SELECT 'approved_outreach' AS tbl, id, churn_reason FROM approved_v
            UNION ALL SELECT 'compliance_review_queue', id, churn_reason FROM queue_v)
"""


def _reasons(w):
    a = w.approved().select(F.lit("approved_outreach").alias("tbl"), "id", "churn_reason")
    q = w.queue().select(F.lit("compliance_review_queue").alias("tbl"), "id", "churn_reason")
    return a.unionByName(q)


def _kw_case(col: str) -> str:
    from .. import constants as K
    parts = []
    for reason, words in K.REASON_KEYWORDS:
        cond = " OR ".join(f"contains(lower(trim({col})), '{wd}')" for wd in words)
        parts.append(f"WHEN {cond} THEN '{reason}'")
    canon = ", ".join(f"'{r}'" for r in K.CHURN_REASONS)
    return (f"CASE WHEN {col} IS NULL OR trim({col}) = '' THEN 'unknown' "
            f"WHEN lower(trim({col})) IN ({canon}) THEN lower(trim({col})) {' '.join(parts)} ELSE 'unknown' END")


@query("normalize_reason_runtime", sql_with(_BOTH_REASONS, f"""
SELECT tbl, id, churn_reason, {_kw_case('churn_reason')} AS normalized FROM reasons""", _OUT))
def normalize_reason_runtime(spark, sf_dir):
    """SC11: runtime churn-reason normaliser over both outreach tables."""
    r = _reasons(C.warehouse(spark, sf_dir))
    return r.select("tbl", "id", "churn_reason", TX.normalize_reason(F.col("churn_reason")).alias("normalized"))


def _like_case(col: str) -> str:
    from .. import constants as K
    parts = []
    for reason, pats in K.REASON_LIKE_PATTERNS:
        cond = " OR ".join(f"lower({col}) LIKE '{p}'" for p in pats)
        parts.append(f"WHEN {cond} THEN '{reason}'")
    canon = ", ".join(f"'{r}'" for r in K.CHURN_REASONS)
    return (f"CASE WHEN {col} IS NULL OR lower({col}) IN ({canon}) THEN {col} "
            f"{' '.join(parts)} ELSE 'unknown' END")


@query("normalize_reason_migration", sql_with(_BOTH_REASONS, f"""
SELECT tbl, id, {_like_case('churn_reason')} AS churn_reason FROM reasons""", _OUT))
def normalize_reason_migration(spark, sf_dir):
    """SC12 / PF9 / PF10: one-time migration normaliser."""
    r = _reasons(C.warehouse(spark, sf_dir))
    return r.select("tbl", "id", TX.normalize_reason_migration(F.col("churn_reason")).alias("churn_reason"))


@query("reason_preview", sql_with(_BOTH_REASONS, """
SELECT tbl, churn_reason, count(*) AS cnt FROM reasons
WHERE NOT (lower(churn_reason) IN ('price_sensitivity', 'service_dissatisfaction', 'product_lifecycle',
                                   'inactivity', 'unknown'))
GROUP BY tbl, churn_reason""", _OUT))
def reason_preview(spark, sf_dir):
    """AG22 / PF9: values the migration would change (NULL never matches)."""
    r = _reasons(C.warehouse(spark, sf_dir))
    return r.where(~TX.is_canonical_reason(F.col("churn_reason"))).groupBy("tbl", "churn_reason").agg(
        F.count(F.lit(1)).alias("cnt"))


@query("reason_residual", sql_with(_BOTH_REASONS + f""",
migrated AS (SELECT tbl, {_like_case('churn_reason')} AS churn_reason FROM reasons)
""", """
SELECT tbl, count(*) AS n_rows, count(*) FILTER (NOT (lower(churn_reason) IN (
         'price_sensitivity', 'service_dissatisfaction', 'product_lifecycle', 'inactivity', 'unknown'))) AS residual,
       count(DISTINCT churn_reason) AS n_reasons
FROM migrated GROUP BY tbl""", _OUT))
def reason_residual(spark, sf_dir):
    """AG22: per table the rows whose reason the migration has left outside the canonical ones (none), beside
    all rows and the number of reasons."""
    r = _reasons(C.warehouse(spark, sf_dir))
    m = r.select("tbl", TX.normalize_reason_migration(F.col("churn_reason")).alias("churn_reason"))
    return m.groupBy("tbl").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(F.when(~TX.is_canonical_reason(F.col("churn_reason")), 1)).alias("residual"),
        F.count_distinct("churn_reason").alias("n_reasons"))


def _translate_sql(col: str) -> str:
    from .. import constants as K
    pairs = [p for p in K.SANITIZE_MAP if p[1]] + [p for p in K.SANITIZE_MAP if not p[1]]
    src = "".join(a for a, _ in pairs)
    dst = "".join(b for _, b in pairs if b)
    esc = lambda s: s.replace("'", "''")
    return f"translate({col}, '{esc(src)}', '{esc(dst)}')"


@query("sanitize_text", sql_with("x AS (SELECT 1)",
                                 f"SELECT doc_id, {_translate_sql('text')} AS text FROM documents", ()))
def sanitize_text(spark, sf_dir):
    """SC10 over whole document texts."""
    d = C.warehouse(spark, sf_dir).raw("documents", ["doc_id", "text"])
    return d.select("doc_id", TX.sanitize(F.col("text")).alias("text"))


def _jstr(c):
    return F.coalesce(F.concat(F.lit('"'), c, F.lit('"')), F.lit("null"))


def _model_outputs(w):
    """Stage outputs as a model would return them, derived from the staged
    approved rows: fenced JSON, JSON inside prose, alternative key names,
    and broken JSON."""
    a = w.approved()
    cid = F.col("customer_id").cast("string")

    def obj(conf_key):
        return F.concat(F.lit('{"customer_id": '), cid, F.lit(', "churn_reason": '), _jstr(F.col("churn_reason")),
                        F.lit(f', "{conf_key}": '), _jstr(F.col("confidence")), F.lit("}"))
    k = F.col("id") % 4
    out = (F.when(k == 0, F.concat(F.lit("```json\n"), obj("confidence"), F.lit("\n```")))
           .when(k == 1, F.concat(F.lit("Here is the result: "), obj("confidence"), F.lit(" Hope this helps.")))
           .when(k == 2, obj("confidence_level"))
           .otherwise(F.concat(F.lit('{"customer_id": '), cid, F.lit(", oops"))))
    return a.select("id", out.alias("raw_output"))


_MODEL_OUT_SQL = """
raw AS (
  SELECT id, CASE id % 4
    WHEN 0 THEN '```json' || chr(10) || '{"customer_id": ' || CAST(customer_id AS VARCHAR) || ', "churn_reason": '
                || COALESCE('"' || churn_reason || '"', 'null') || ', "confidence": '
                || COALESCE('"' || confidence || '"', 'null') || '}' || chr(10) || '```'
    WHEN 1 THEN 'Here is the result: {"customer_id": ' || CAST(customer_id AS VARCHAR) || ', "churn_reason": '
                || COALESCE('"' || churn_reason || '"', 'null') || ', "confidence": '
                || COALESCE('"' || confidence || '"', 'null') || '} Hope this helps.'
    WHEN 2 THEN '{"customer_id": ' || CAST(customer_id AS VARCHAR) || ', "churn_reason": '
                || COALESCE('"' || churn_reason || '"', 'null') || ', "confidence_level": '
                || COALESCE('"' || confidence || '"', 'null') || '}'
    ELSE '{"customer_id": ' || CAST(customer_id AS VARCHAR) || ', oops' END AS raw_output
  FROM approved_v),
st AS (SELECT id, regexp_replace(regexp_replace(raw_output, '```(?:json)?', '', 'g'), '^\\s+|\\s+$', '', 'g') AS s
       FROM raw),
sp AS (SELECT id, s, regexp_extract(s, '(?s)\\{.*\\}', 0) AS span FROM st),
ex AS (SELECT id, CASE WHEN json_valid(s) THEN s WHEN span <> '' AND json_valid(span) THEN span END AS j FROM sp)
"""


@query("extract_json", sql_with(_MODEL_OUT_SQL, f"""
SELECT id, j AS json_text,
       CASE WHEN j IS NOT NULL THEN {_kw_case("json_extract_string(j, '$.churn_reason')")} END AS churn_reason,
       CASE WHEN j IS NOT NULL THEN COALESCE(nullif(json_extract_string(j, '$.confidence'), ''),
                                             nullif(json_extract_string(j, '$.confidence_level'), ''),
                                             nullif(json_extract_string(j, '$.confidence_score'), ''),
                                             'medium') END AS confidence
FROM ex""", ("approved_v",)))
def extract_json(spark, sf_dir):
    """SC13 + SC15 + SC11: parse stage output, confidence key chain, reason normalised."""
    m = _model_outputs(C.warehouse(spark, sf_dir))
    j = TX.extract_json_text(F.col("raw_output"))
    return m.select(
        "id", j.alias("json_text"),
        F.when(j.isNotNull(), TX.normalize_reason(F.get_json_object(j, "$.churn_reason"))).alias("churn_reason"),
        F.when(j.isNotNull(), F.coalesce(TX.json_field(j, "confidence", "confidence_level", "confidence_score"),
                                         F.lit("medium"))).alias("confidence"))


@query("violation_rules", sql_with("""
parsed AS (SELECT id, CASE WHEN json_valid(violated_rules) THEN CAST(violated_rules AS JSON) END AS j FROM queue_v),
el AS (SELECT id, unnest(from_json(j, '["JSON"]')) AS e FROM parsed WHERE j IS NOT NULL)
""", """
SELECT id, CASE WHEN json_type(e) = 'OBJECT' THEN COALESCE(e ->> 'rule_id', 'unknown') ELSE e ->> '$' END AS rule_id
FROM el""", ("queue_v",)))
def violation_rules(spark, sf_dir):
    """SC14: rule ids from JSON violation lists (objects or bare strings; bad JSON skipped)."""
    q = C.warehouse(spark, sf_dir).queue()
    return q.select("id", F.explode(TX.violation_ids(F.col("violated_rules"))).alias("rule_id"))


# -- routed rows as written to the outreach tables (IO10-IO12, DC11) ---------------------
@query("outreach_approved_rows", _dsql(f"""
SELECT customer_id, DATE '2024-01-16' AS batch_date, offer_id, channel, churn_reason, confidence,
       {_translate_sql('message_draft')} AS message_draft,
       0 AS agent1_tokens, 0 AS agent2_tokens, 0 AS agent3_tokens, TIMESTAMP '2024-01-16 06:00:00' AS approved_at
FROM outc WHERE outcome = 'approved'"""))
def outreach_approved_rows(spark, sf_dir):
    """DC11 / IO10 / IO11: approved rows as written to the outreach table (sanitised, with audit columns)."""
    w = C.warehouse(spark, sf_dir)
    return DC.approved_rows(decided(w), w.snapshot, scored_at_col())


@query("outreach_queued_rows", _dsql(f"""
SELECT customer_id, DATE '2024-01-16' AS batch_date, offer_id, channel, churn_reason,
       {_translate_sql('message_draft')} AS message_draft,
       CAST(to_json(violated_rules) AS VARCHAR) AS violated_rules, '' AS review_notes, 'pending' AS status,
       CAST(NULL AS VARCHAR) AS reviewed_by, CAST(NULL AS TIMESTAMP) AS reviewed_at,
       TIMESTAMP '2024-01-16 06:00:00' AS created_at
FROM outc WHERE outcome = 'queued'"""))
def outreach_queued_rows(spark, sf_dir):
    """DC11 / IO10 / IO12: queued rows with JSON-encoded violations (sanitised, with audit columns)."""
    w = C.warehouse(spark, sf_dir)
    return DC.queued_rows(decided(w), w.snapshot, scored_at_col())
