"""DuckDB text for the decision-layer oracle.

The offer catalogue is written down here a second time, as SQL conditions, so that
a wrong transcription in the operator shows; message statements and rule patterns
are shared texts.  A different engine evaluates them (RE2 regexes, DuckDB list
lambdas, its own NULL logic).
"""

from __future__ import annotations

from ..operators import decisions as DC
from .oracle_frag import MODEL_READY
from .oracle_views import SNAP
from .q_model import _linear_sql

# FIXED VALUES: offers as (id, use case, segments, channels, kind, new product?, amount text,
# required conditions, alternative conditions).
_TEN, _COMP, _DSL = "tenure_months", "competitor_transfer_count", "days_since_last_login"
_S, _P, _ST, _STU = "standard", "private_banking", "starter", "student"
OFFERS = [
    ("PR-001", "price_sensitivity", [_S, _ST], ["email", "call"], "fee_waiver", False, "up to €96",
     [f"{_TEN} >= 12"], [f"{_COMP} >= 1", "nps_raw <= 5"]),
    ("PR-002", "price_sensitivity", [_S, _P], ["email", "call"], "bonus_rate", False, "€200",
     ["has_savings = 1"], [f"{_COMP} >= 1", f"{_DSL} > 60"]),
    ("PR-003", "price_sensitivity", [_S, _STU], ["email"], "cashback", True, "up to €90", ["age <= 45"], []),
    ("PR-004", "price_sensitivity", [_S, _P], ["call"], "rate_discount", False, "about €750",
     ["mrr_raw >= 0 AND mrr_raw <= 6", f"{_COMP} >= 1"], []),
    ("PR-005", "price_sensitivity", [_P], ["call"], "fee_refund", False, "up to €150",
     [f"{_TEN} >= 60", "product_count >= 3", "nps_raw <= 6"], []),
    ("PR-006", "price_sensitivity", [_S, _P], ["email", "call"], "bundle_discount", True, "up to €72",
     ["has_current = 1", "product_count >= 2", f"{_COMP} >= 1"], []),
    ("PR-007", "price_sensitivity", [_S, _STU], ["email"], "referral_bonus", False, "up to €150",
     ["app_logins_last_30d >= 1"], []),
    ("PR-008", "price_sensitivity", [_S, _ST, _STU], ["email", "call"], "interest_waiver", False, "typically €30 to €90",
     ["complaints_open = 0", f"{_COMP} >= 1"], []),
    ("PR-009", "service_dissatisfaction", [_S, _P], ["call"], "priority_service", False, "",
     [f"{_TEN} >= 6"], ["complaints_open >= 1", "nps_raw <= 5"]),
    ("PR-010", "service_dissatisfaction", [_P, _S], ["call"], "relationship_manager", False, "",
     ["avg_monthly_inflow_eur >= 3000", "relationship_manager_id IS NULL"], ["nps_raw <= 4", "complaints_open >= 2"]),
    ("PR-011", "service_dissatisfaction", [_S, _ST, _STU], ["call"], "goodwill_credit", False, "€25",
     ["complaints_open >= 1", "oldest_open_days > 14"], []),
    ("PR-012", "service_dissatisfaction", [_S, _ST], ["email", "call"], "onboarding_session", False, "",
     [f"{_DSL} > 45", "app_logins_last_90d < 3", f"{_TEN} < 24"], []),
    ("PR-013", "service_dissatisfaction", [_P, _S], ["call"], "service_guarantee", False, "€30",
     ["nps_raw <= 5", f"{_TEN} >= 12", "complaints_open = 0"], []),
    ("PR-014", "service_dissatisfaction", [_S, _ST, _STU], ["call"], "fee_compensation", False, "€4 to €15",
     ["complaints_open >= 1", "open_service"], []),
    ("PR-015", "product_lifecycle", [_S, _P], ["call", "email"], "rate_lock", False, "",
     ["mrr_raw >= 1 AND mrr_raw <= 6"], []),
    ("PR-016", "product_lifecycle", [_S, _P], ["call"], "refinance_review", False, "",
     ["mrr_raw <= 3", f"{_COMP} >= 1"], []),
    ("PR-017", "product_lifecycle", [_S], ["call"], "product_upgrade", True, "",
     ["avg_monthly_inflow_eur >= 5000", "product_count <= 2", f"{_TEN} >= 24", "has_investment = 0"], []),
    ("PR-018", "product_lifecycle", [_S, _P], ["email", "call"], "consolidation", False, "€75",
     ["product_count >= 3", "salary_account_flag = 0"], []),
    ("PR-019", "product_lifecycle", [_S], ["email"], "pension_starter", True, "€100",
     ["age >= 30 AND age <= 55", "product_count <= 2"], []),
    ("PR-020", "product_lifecycle", [_S, _ST], ["email", "call"], "salary_switch_bonus", False, "€100 plus up to €96",
     ["salary_account_flag = 0", "avg_monthly_inflow_eur >= 1500", f"{_TEN} >= 3"], []),
    ("PR-021", "inactivity", [_S, _ST, _STU], ["email"], "reengagement_cashback", False, "€20",
     [f"{_DSL} > 60", "app_logins_last_90d < 5"], []),
    ("PR-022", "inactivity", [_S, _STU, _ST], ["email"], "feature_discovery", False, "€10",
     [f"{_DSL} > 30", "app_logins_last_30d < 2", f"{_TEN} >= 6"], []),
    ("PR-023", "inactivity", [_S, _ST], ["email", "call"], "reactivation_offer", False, "€15",
     [f"{_DSL} > 90", "days_since_last_tx > 60"], []),
    ("PR-024", "inactivity", [_S, _STU, _ST], ["email"], "savings_goal_incentive", True, "up to €15",
     ["app_logins_last_90d < 10", "has_savings = 1"], []),
    ("PR-025", "inactivity", [_S, _P], ["email"], "loyalty_milestone", False, "€10 to €100",
     [f"{_DSL} > 30", f"{_TEN} // 12 IN (1, 3, 5, 10)"], []),
]
INVESTMENT = ["PR-017", "PR-019"]
SAVINGS_OR_INVESTMENT = ["PR-002", "PR-017", "PR-019", "PR-024"]


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _lst(xs) -> str:
    return "[" + ", ".join(_q(x) for x in xs) + "]"


def _attr(col: str, idx: int) -> str:
    parts = []
    for o in OFFERS:
        v = o[idx]
        lit = _lst(v) if isinstance(v, list) else ("true" if v is True else "false" if v is False else _q(v))
        parts.append(f"WHEN {_q(o[0])} THEN {lit}")
    return f"(CASE {col} {' '.join(parts)} END)"


def _sig(cond: str, name: str, value: str) -> str:
    return f"CASE WHEN {cond} THEN '{name}=' || CAST({value} AS VARCHAR) END"


SIGNALS = {
    "price_sensitivity": [
        _sig("competitor_transfer_count >= 1", "competitor_transfer_cnt", "competitor_transfer_count"),
        _sig("nps_raw <= 5", "nps_score_last", "nps_raw"),
        _sig("salary_account_flag = 0", "salary_account_flag", "salary_account_flag")],
    "service_dissatisfaction": [
        _sig("complaints_open >= 1", "complaints_open", "complaints_open"),
        _sig("nps_raw <= 5 AND complaints_open >= 1", "nps_score_last", "nps_raw"),
        _sig("oldest_open_days > 14", "oldest_open_complaint_days", "oldest_open_days")],
    "product_lifecycle": [
        _sig("mrr_raw BETWEEN 0 AND 6", "months_to_rate_reset", "mrr_raw"),
        _sig("product_count <= 1", "product_count", "product_count"),
        _sig("competitor_transfer_count >= 1 AND (has_mortgage = 1 OR has_savings = 1)",
             "competitor_transfer_cnt", "competitor_transfer_count")],
    "inactivity": [
        _sig("days_since_last_login > 45", "days_since_last_login", "days_since_last_login"),
        _sig("app_logins_last_90d < 3", "app_logins_last_90d", "app_logins_last_90d"),
        _sig("days_since_last_tx > 60", "days_since_last_tx", "days_since_last_tx")],
}
_SHORT = {"price_sensitivity": "p", "service_dissatisfaction": "s", "product_lifecycle": "l", "inactivity": "i"}


def _offer_struct(o) -> str:
    oid, use, segs, chans, kind, new, value, req, anyof = o
    req_ok = " AND ".join(f"COALESCE({r}, false)" for r in req) or "true"
    any_ok = "(" + " OR ".join(f"COALESCE({a}, false)" for a in anyof) + ")" if anyof else "true"
    trig = " + ".join(f"CAST(COALESCE({c}, false) AS INTEGER)" for c in req + anyof) or "0"
    ok = f"churn_reason = {_q(use)} AND COALESCE(segment IN ({', '.join(_q(s) for s in segs)}), false) " \
         f"AND {req_ok} AND {any_ok}"
    return (f"CASE WHEN {ok} THEN {{'neg_triggered': -({trig}), 'offer_id': {_q(oid)}, "
            f"'triggered': ({trig})}} END")


_PAT = DC.PATTERNS


def _rx(name: str, col: str = "msg") -> str:
    return f"COALESCE(regexp_matches({col}, {_q(_PAT[name])}), false)"


def _rules_sql(mode: str = "strict") -> list[tuple[str, str, str, str]]:
    inv = f"COALESCE(offer_id IN ({', '.join(_q(x) for x in INVESTMENT)}), false)"
    sav = f"COALESCE(offer_id IN ({', '.join(_q(x) for x in SAVINGS_OR_INVESTMENT)}), false)"
    new = f"COALESCE({_attr('offer_id', 5)}, false)"
    segs, chans = _attr("offer_id", 2), _attr("offer_id", 3)
    disc = f"contains(msg, {_q(DC.RISK_DISCLOSURE)})" if mode == "strict" else _rx("disclosure_equiv")
    opening = f"regexp_extract(msg, {_q(DC.opening_pattern())}, 0)"
    own = ("(length(region) > 0 AND contains(lower(msg), lower(region)))",
           "contains(msg, strftime(next_rate_end, '%Y-%m-%d'))",
           "len(list_filter(product_names, lambda n: contains(lower(msg), lower(n)))) > 0")
    personal = " OR ".join([_rx("tenure"), _rx("recent_contact"), *[f"COALESCE({o}, false)" for o in own]])
    email, call = "COALESCE(channel = 'email', false)", "COALESCE(channel = 'call', false)"
    lo, hi = DC.TARGET_MARKET_AGE
    checks = {
        "BT-001": _rx("urgency"), "BT-002": _rx("impersonal"), "BT-003": _rx("fear"),
        "BT-004": _rx("surveillance"), "BT-005": _rx("jargon"),
        "BT-006": f"{_rx('superlative')} AND NOT {_rx('substantiated')}",
        "FSMA-001": f"{sav} AND {_rx('guarantee')}",
        "FSMA-002": f"{inv} AND NOT COALESCE({disc}, false)",
        "FSMA-003": f"{inv} AND {_rx('advice')}",
        "FSMA-004": f"{new} AND NOT {_rx('cooling_off')}",
        "FSMA-005": f"{_rx('fee_or_rate')} AND NOT {_rx('terms')}",
        "MIFID-001": f"{inv} AND {_rx('percent')} AND NOT {_rx('caveat_period')}",
        "MIFID-002": f"COALESCE(offer_id IN ('PR-017', 'PR-019'), false) "
                     f"AND NOT COALESCE(age BETWEEN {lo} AND {hi}, false)",
        "MIFID-003": f"{_rx('comparison')} AND NOT {_rx('sourced')}",
        "PERS-001": f"NOT ({personal})",
        "PERS-002": f"offer_id IS NOT NULL AND NOT COALESCE(list_contains({segs}, segment), false)",
        "PERS-003": f"offer_id IS NOT NULL AND NOT COALESCE(list_contains({chans}, channel), false)",
        "CH-001": f"{email} AND NOT {_rx('unsubscribe')}",
        "CH-002": f"{call} AND NOT {_rx('opt_out', opening)}",
        "CH-003": f"{call} AND ({_rx('alert_open', opening)} OR NOT {_rx('loyalty_call', opening)})",
        "CH-004": f"{email} AND {_rx('bad_subject')}",
    }
    return [(rid, sev, checks[rid]) for rid, sev in DC.RULES]


FINDINGS = {
    "BT-001": "urgency or pressure phrase", "BT-002": "impersonal salutation", "BT-003": "fear-based phrase",
    "BT-004": "reference to monitoring or scoring", "BT-005": "jargon term without explanation",
    "BT-006": "unsubstantiated superlative", "FSMA-001": "guaranteed-return language",
    "FSMA-002": "risk disclosure missing", "FSMA-003": "personal advice phrase",
    "FSMA-004": "cooling-off period not referenced", "FSMA-005": "fee or rate without terms reference",
    "MIFID-001": "performance figure without caveat and period", "MIFID-002": "outside target market",
    "MIFID-003": "comparison without source and date", "PERS-001": "no personal signal",
    "PERS-002": "segment not targeted by offer", "PERS-003": "channel not in offer channel fit",
    "CH-001": "no unsubscribe line", "CH-002": "no opt-out in opening", "CH-003": "alert-style opening or not named a loyalty call",
    "CH-004": "misleading subject line",
}


def decision_ctes() -> str:
    """CTEs: ctx (inputs), cls (reason), off (offer, channel), msg (draft), dec (compliance, outcome)."""
    sig_cols = ",\n".join(
        f"list_filter([{', '.join(v)}], lambda x: x IS NOT NULL) AS sig_{_SHORT[r]}" for r, v in SIGNALS.items())
    n = {r: f"len(sig_{_SHORT[r]})" for r in SIGNALS}
    best = f"greatest({', '.join(n.values())})"
    pick = "CASE " + " ".join(f"WHEN {n[r]} = {best} THEN {_q(r)}" for r in DC.REASON_TIE_ORDER) + " END"
    pick0 = f"CASE WHEN {best} < 2 THEN 'unknown' ELSE {pick} END"
    pick = (f"CASE WHEN pick0 = 'price_sensitivity' AND mrr_raw BETWEEN 0 AND 6 "
            f"AND {n['product_lifecycle']} >= 2 THEN 'product_lifecycle' "
            f"WHEN pick0 = 'inactivity' AND complaints_open >= 1 AND {n['service_dissatisfaction']} >= 2 "
            f"THEN 'service_dissatisfaction' ELSE pick0 END")
    chosen = ("CASE churn_reason " + " ".join(f"WHEN {_q(r)} THEN sig_{_SHORT[r]}" for r in SIGNALS)
              + " ELSE list_filter(flatten([sig_p, sig_s, sig_l, sig_i]), lambda x: x IS NOT NULL) END")
    offers = ",\n      ".join(_offer_struct(o) for o in OFFERS)
    chans, kind, value, new = _attr("offer_id", 3), _attr("offer_id", 4), _attr("offer_id", 6), _attr("offer_id", 5)
    call_only = f"COALESCE(len({chans}) = 1, false) AND COALESCE(list_contains({chans}, 'call'), false)"
    email_only = f"COALESCE(len({chans}) = 1, false) AND COALESCE(list_contains({chans}, 'email'), false)"
    prefers = (f"(segment = 'private_banking' OR complaints_open >= 2 "
               f"OR {kind} IN ('rate_discount', 'rate_lock', 'refinance_review') OR avg_monthly_inflow_eur >= 5000)")
    years = "CAST(floor(tenure_months / 12) AS BIGINT)"
    thanks = ", we wanted to thank you for your loyalty."
    opening = (f"CASE WHEN {years} >= 1 THEN 'As you have been with us for ' || CAST({years} AS VARCHAR) "
               f"|| ' years' || {_q(thanks)} "
               f"WHEN next_rate_end IS NOT NULL THEN 'Your fixed rate ends on ' || strftime(next_rate_end, '%Y-%m-%d') "
               f"|| ', so we wanted to share the options available to you.' "
               f"WHEN region IS NOT NULL THEN 'As a valued client in ' || region || {_q(thanks)} "
               f"ELSE 'We wanted to thank you for your loyalty.' END")
    offer_line = (f"CASE WHEN offer_id IS NULL THEN 'We would welcome the chance to review your accounts with you.' "
                  f"ELSE 'We would like to tell you about our ' || replace(offer_kind, '_', ' ') || ' offer (' "
                  f"|| offer_id || ')' || CASE WHEN {value} <> '' THEN ', worth ' || {value} ELSE '' END || '.' END")
    extras = (f"concat_ws(' ', CASE WHEN offer_id IN ({', '.join(_q(x) for x in INVESTMENT)}) "
              f"THEN {_q(DC.RISK_DISCLOSURE)} END, CASE WHEN {new} THEN {_q(DC.COOLING_OFF_LINE)} END, "
              f"CASE WHEN offer_id IS NOT NULL THEN {_q(DC.TERMS_LINE)} END)")
    email = (f"concat_ws(chr(10) || chr(10), 'Subject: A loyalty offer for you', 'Hello,', "
             f"concat_ws(' ', {opening}, {offer_line}, {extras}), {_q(DC.UNSUBSCRIBE_LINE)})")
    call = (f"concat_ws(' ', {_q(DC.OPT_OUT_STATEMENT)}, 'This is a loyalty call about our customer programme.', "
            f"{opening}, {offer_line}, {extras})")
    hits = ",\n      ".join(
        f"CASE WHEN {cond} THEN {{'rule_id': {_q(rid)}, 'severity': {_q(sev)}, 'finding': {_q(FINDINGS[rid])}}} END"
        for rid, sev, cond in _rules_sql())
    return MODEL_READY + f""",
bat0 AS (SELECT *, {_linear_sql()} AS churn_score FROM model_o),
bat AS (SELECT b.*, f.nps_score_last AS nps_raw, f.months_to_rate_reset AS mrr_raw
        FROM bat0 b JOIN features_o f ON b.customer_id = f.customer_id),
hb AS (SELECT * FROM bat WHERE churn_score >= 0.7),
kinds AS (SELECT cp.customer_id, list_sort(list(DISTINCT p.product_name)) AS product_names,
                 max(CAST(p.product_kind = 'savings_account' AS INTEGER)) AS has_savings,
                 max(CAST(p.product_kind = 'mortgage' AS INTEGER)) AS has_mortgage,
                 max(CAST(p.product_kind = 'investment' AS INTEGER)) AS has_investment,
                 max(CAST(p.product_kind = 'current_account' AS INTEGER)) AS has_current
          FROM customer_products_v cp JOIN products_v p ON cp.product_id = p.product_id
          WHERE cp.status = 'active' GROUP BY cp.customer_id),
rate AS (SELECT customer_id, min(fixed_rate_end_date) AS next_rate_end FROM customer_products_v
         WHERE fixed_rate_end_date >= {SNAP} GROUP BY customer_id),
oc AS (SELECT customer_id, date_diff('day', min(opened_date), {SNAP}) AS oldest_open_days,
              bool_or(category = 'service_quality') AS open_service FROM complaints_v WHERE status = 'open' GROUP BY customer_id),
ltx AS (SELECT customer_id, date_diff('day', max(transaction_date), {SNAP}) AS days_since_last_tx
        FROM transactions_v WHERE transaction_date <= {SNAP} GROUP BY customer_id),
ctx AS MATERIALIZED (
  SELECT hb.customer_id, hb.segment, hb.region, hb.churn_score, hb.nps_raw, hb.mrr_raw,
         hb.days_since_last_login, hb.app_logins_last_30d, hb.app_logins_last_90d,
         hb.competitor_transfer_count, hb.avg_monthly_inflow_eur, hb.complaints_open, hb.product_count,
         hb.salary_account_flag, c.age, c.relationship_manager_id,
         CAST((year({SNAP}) - year(c.customer_since_date)) * 12 + month({SNAP}) - month(c.customer_since_date)
              - CASE WHEN day({SNAP}) < day(c.customer_since_date) THEN 1 ELSE 0 END AS INTEGER) AS tenure_months,
         COALESCE(k.has_savings, 0) AS has_savings, COALESCE(k.has_mortgage, 0) AS has_mortgage,
         COALESCE(k.has_investment, 0) AS has_investment, COALESCE(k.has_current, 0) AS has_current,
         k.product_names, rate.next_rate_end, oc.oldest_open_days, oc.open_service, ltx.days_since_last_tx,
         CASE WHEN hb.customer_id % 9 = 4 THEN 'profile_not_found' END AS error
  FROM hb JOIN customers_v c ON hb.customer_id = c.customer_id
  LEFT JOIN kinds k ON hb.customer_id = k.customer_id
  LEFT JOIN rate ON hb.customer_id = rate.customer_id
  LEFT JOIN oc ON hb.customer_id = oc.customer_id
  LEFT JOIN ltx ON hb.customer_id = ltx.customer_id),
sigs AS MATERIALIZED (SELECT *, {sig_cols} FROM ctx),
pk AS (SELECT *, {pick0} AS pick0 FROM sigs),
cls0 AS (SELECT *, {pick} AS churn_reason FROM pk),
cls AS (SELECT *, {chosen} AS supporting_signals FROM cls0),
cls2 AS MATERIALIZED (SELECT *, CASE WHEN churn_reason = 'unknown' THEN 'low' WHEN len(supporting_signals) >= 3 THEN 'high'
                        WHEN len(supporting_signals) = 2 THEN 'medium' ELSE 'low' END AS confidence FROM cls),
elig AS (SELECT *, list_sort(list_filter([
      {offers}], lambda x: x IS NOT NULL)) AS eligible FROM cls2),
off0 AS (SELECT *, CASE WHEN len(eligible) > 0 THEN eligible[1].offer_id END AS offer_id,
                COALESCE(CASE WHEN len(eligible) > 0 THEN eligible[1].triggered END, 0) AS offer_triggered FROM elig),
off AS MATERIALIZED (SELECT *, {kind} AS offer_kind,
               CASE WHEN {call_only} THEN 'call' WHEN {email_only} THEN 'email'
                    WHEN COALESCE({prefers}, false) THEN 'call' ELSE 'email' END AS channel FROM off0),
msg0 AS MATERIALIZED (SELECT *, CASE WHEN channel = 'call' THEN {call} ELSE {email} END AS message_draft FROM off),
msg1 AS (SELECT *, COALESCE(message_draft, '') AS msg FROM (
  SELECT * EXCLUDE (message_draft),
         CASE WHEN customer_id % 5 = 2 THEN 'Act now: ' || message_draft ELSE message_draft END AS message_draft
  FROM msg0)),
dec0 AS MATERIALIZED (SELECT *, list_filter([
      {hits}], lambda x: x IS NOT NULL) AS violated_rules FROM msg1),
dec AS (SELECT *, CASE WHEN len(list_filter(violated_rules, lambda v: v.severity = 'hard_block')) > 0
                       THEN 'fail' ELSE 'pass' END AS status FROM dec0),
outc AS (SELECT *, CASE WHEN error IS NOT NULL THEN 'error' WHEN status = 'pass' THEN 'approved' ELSE 'queued' END AS outcome FROM dec)
"""


DECISION_VIEWS = ("customers_v", "transactions_v", "app_sessions_v", "customer_products_v", "complaints_v",
                  "nps_responses_v", "products_v")


def hits_list_sql() -> str:
    """The rule-hit list expression over columns msg, channel, offer_id, segment, age."""
    return "list_filter([" + ",\n      ".join(
        f"CASE WHEN {cond} THEN {{'rule_id': {_q(rid)}, 'severity': {_q(sev)}, 'finding': {_q(FINDINGS[rid])}}} END"
        for rid, sev, cond in _rules_sql()) + "], lambda x: x IS NOT NULL)"


def staged_compliance_sql() -> str:
    return f"""
WITH own AS (
  SELECT cp.customer_id, list(DISTINCT p.product_name) FILTER (WHERE cp.status = 'active') AS product_names,
         min(CASE WHEN cp.fixed_rate_end_date >= {SNAP} THEN cp.fixed_rate_end_date END) AS next_rate_end
  FROM customer_products_v cp JOIN products_v p ON cp.product_id = p.product_id GROUP BY cp.customer_id),
st AS (
  SELECT a.id, a.channel, a.offer_id, c.segment, c.age, c.region, own.product_names, own.next_rate_end,
         COALESCE(a.message_draft, '') AS msg
  FROM approved_v a LEFT JOIN customers_v c ON a.customer_id = c.customer_id
                    LEFT JOIN own ON a.customer_id = own.customer_id),
h AS (SELECT id, {hits_list_sql()} AS hits FROM st)
SELECT id, CASE WHEN len(list_filter(hits, lambda v: v.severity = 'hard_block')) > 0 THEN 'fail' ELSE 'pass' END
           AS status,
       array_to_string(list_transform(hits, lambda v: v.rule_id), ',') AS rule_ids
FROM h"""


def golden_sql() -> str:
    return f"""
WITH own AS (
  SELECT cp.customer_id, list(DISTINCT p.product_name) FILTER (WHERE cp.status = 'active') AS product_names,
         min(CASE WHEN cp.fixed_rate_end_date >= {SNAP} THEN cp.fixed_rate_end_date END) AS next_rate_end
  FROM customer_products_v cp JOIN products_v p ON cp.product_id = p.product_id GROUP BY cp.customer_id),
el AS (SELECT id, unnest(from_json(CASE WHEN json_valid(violated_rules) THEN CAST(violated_rules AS JSON) END,
                                   '["JSON"]')) AS e FROM queue_v),
ids AS (SELECT id, list(CASE WHEN json_type(e) = 'OBJECT' THEN COALESCE(e ->> 'rule_id', 'unknown') ELSE e ->> '$' END) AS x
        FROM el GROUP BY id),
gold AS (
  SELECT id, customer_id, churn_reason, channel, offer_id, message_draft, 'pass' AS st, CAST([] AS VARCHAR[]) AS want
  FROM approved_v
  UNION ALL
  SELECT q.id, customer_id, churn_reason, channel, offer_id, message_draft, 'fail', COALESCE(ids.x, CAST([] AS VARCHAR[]))
  FROM queue_v q LEFT JOIN ids ON q.id = ids.id),
st AS (
  SELECT g.*, c.segment, c.age, c.region, own.product_names, own.next_rate_end, COALESCE(g.message_draft, '') AS msg
  FROM gold g LEFT JOIN customers_v c ON g.customer_id = c.customer_id LEFT JOIN own ON g.customer_id = own.customer_id),
h AS (SELECT churn_reason, channel, st, want, {hits_list_sql()} AS hits FROM st)
SELECT churn_reason, channel, count(*) AS examples,
       count(*) FILTER (WHERE (len(list_filter(hits, lambda v: v.severity = 'hard_block')) > 0) = (st = 'fail')) AS status_agreement,
       count(*) FILTER (WHERE list_sort(list_transform(hits, lambda v: v.rule_id)) = list_sort(want)) AS rules_agreement
FROM h GROUP BY churn_reason, channel"""


# The staged stage outputs break one contract each, by customer number.
CONTRACT_SQL = """
SELECT customer_id, array_to_string(list_filter([
  CASE WHEN k = 5 THEN '2.rationale:required' END,
  CASE WHEN k = 0 THEN '1.churn_score:range' END,
  CASE WHEN k = 1 THEN '1.confidence:enum' END,
  CASE WHEN k = 2 THEN '2.channel:enum' END,
  CASE WHEN k = 3 OR length(message_draft) < 50 THEN '2.message_draft:minLength' END,
  CASE WHEN k = 4 THEN '3.violated_rules:severity' END,
  CASE WHEN k = 6 THEN '3:additionalProperties' END], lambda x: x IS NOT NULL), ',') AS contract_violations
FROM (SELECT customer_id, customer_id % 8 AS k, message_draft FROM outc)"""
