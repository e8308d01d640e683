"""Retention decisioning as set-based Spark (DC1-DC14, J10, J11, SC18).

The rules the reference hands to language models are deterministic here:

* reason classification (DC1-DC4) - signal booleans, counts, a CASE chain;
* offer eligibility and choice (DC5-DC7, J10) - the 25 offers are a fixed
  array of predicate structs evaluated in one projection: no join, no
  shuffle, the work per customer is constant;
* message drafting (DC8) - a fixed template;
* compliance (DC9-DC10, J11) - 21 rule checks produce an
  ``array<struct<rule_id, severity, finding>>`` of hits in one projection.

Rules needing human judgement (tone, brand voice, advice) are pattern
approximations; see ``RULES``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.dates import full_months
from ..functions.joins import broadcast_if_bounded
from ..functions.text import normalize_reason, sanitize

# ---------------------------------------------------------------------------
# Context: one row per batch customer with every input a rule can read.
# ---------------------------------------------------------------------------


def decision_context(batch: DataFrame, customers: DataFrame, holdings: DataFrame, products: DataFrame,
                     complaints: DataFrame, transactions: DataFrame | None, profiles: DataFrame,
                     as_of: dt.date, daily_t: DataFrame | None = None) -> DataFrame:
    """Batch rows (model features + score) joined with customer attributes,
    holding kinds, complaint and transaction recency, and profile presence
    (SEM19: the feature row and segment are always joined)."""
    snap = F.lit(as_of)
    # The batch is small (the high-risk share): broadcast its ids after a size
    # check so the large inputs are filtered in place instead of shuffled.
    ids = broadcast_if_bounded(batch.select("customer_id"))
    cust = customers.join(ids, "customer_id", "left_semi").select(
        "customer_id", "age", "relationship_manager_id",
        full_months(F.col("customer_since_date"), snap).alias("tenure_months"))
    # Product names are a set per customer, so at most the catalogue's size.
    kinds = (holdings.where(F.col("status") == "active").join(ids, "customer_id", "left_semi")
             .join(products.select("product_id", "product_kind", "product_name"), "product_id")
             .groupBy("customer_id").agg(
                 F.array_sort(F.collect_set("product_name")).alias("product_names"),
                 F.max((F.col("product_kind") == "savings_account").cast("int")).alias("has_savings"),
                 F.max((F.col("product_kind") == "mortgage").cast("int")).alias("has_mortgage"),
                 F.max((F.col("product_kind") == "investment").cast("int")).alias("has_investment"),
                 F.max((F.col("product_kind") == "current_account").cast("int")).alias("has_current")))
    rate = (holdings.join(ids, "customer_id", "left_semi").where(F.col("fixed_rate_end_date") >= snap)
            .groupBy("customer_id").agg(F.min("fixed_rate_end_date").alias("next_rate_end")))
    comp = (complaints.where(F.col("status") == "open").join(ids, "customer_id", "left_semi")
            .groupBy("customer_id").agg(F.datediff(snap, F.min("opened_date")).alias("oldest_open_days"),
                                        F.max("category").alias("open_category"),
                                        F.max(F.col("category") == "service_quality").alias("open_service_quality")))
    days = daily_t if daily_t is not None else \
        transactions.select("customer_id", F.col("transaction_date").alias("d"))
    tx = (days.where(F.col("d") <= snap).join(ids, "customer_id", "left_semi")
          .groupBy("customer_id").agg(F.datediff(snap, F.max("d")).alias("days_since_last_tx")))
    prof = profiles.select("customer_id", F.lit(True).alias("has_profile"))
    j = (batch.join(cust, "customer_id", "left").join(kinds, "customer_id", "left")
         .join(rate, "customer_id", "left").join(comp, "customer_id", "left")
         .join(tx, "customer_id", "left").join(prof, "customer_id", "left"))
    defaults = {"has_savings": 0, "has_mortgage": 0, "has_investment": 0, "has_current": 0, "has_profile": False}
    # Few bytes, much work a row: the partitions that AQE has made of so little are dealt out again, by a fixed
    # number, or the rules of the whole batch run in one task.
    parts = int(batch.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return j.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()}).repartition(parts, "customer_id")


# ---------------------------------------------------------------------------
# DC1-DC4: signals, reason, confidence
# ---------------------------------------------------------------------------
def _c(name):
    return F.col(name)


def _sig(cond: Column, name: str, value: Column) -> Column:
    return F.when(cond, F.concat(F.lit(name + "="), value.cast("string")))


# Raw (unfilled) inputs: NULL means unknown and never satisfies a condition.
NPS = "nps_raw"
MRR = "mrr_raw"


def reason_signals() -> dict[str, list[Column]]:
    """DC1: supporting-signal strings per reason (NULL when not firing)."""
    comp, nps, mrr = _c("competitor_transfer_count"), _c(NPS), _c(MRR)
    dsl, l90, co = _c("days_since_last_login"), _c("app_logins_last_90d"), _c("complaints_open")
    return {
        "price_sensitivity": [
            _sig(comp >= 1, "competitor_transfer_cnt", comp),
            _sig(nps <= 5, "nps_score_last", nps),
            _sig(_c("salary_account_flag") == 0, "salary_account_flag", _c("salary_account_flag")),
        ],
        "service_dissatisfaction": [
            _sig(co >= 1, "complaints_open", co),
            _sig((nps <= 5) & (co >= 1), "nps_score_last", nps),
            _sig(_c("oldest_open_days") > 14, "oldest_open_complaint_days", _c("oldest_open_days")),
        ],
        "product_lifecycle": [
            _sig(mrr.between(0, 6), "months_to_rate_reset", mrr),
            _sig(_c("product_count") <= 1, "product_count", _c("product_count")),
            _sig((comp >= 1) & ((_c("has_mortgage") == 1) | (_c("has_savings") == 1)),
                 "competitor_transfer_cnt", comp),
        ],
        "inactivity": [
            _sig(dsl > 45, "days_since_last_login", dsl),
            _sig(l90 < 3, "app_logins_last_90d", l90),
            _sig(_c("days_since_last_tx") > 60, "days_since_last_tx", _c("days_since_last_tx")),
        ],
    }


# Tie order when two reasons have the same number of signals.
REASON_TIE_ORDER = ["service_dissatisfaction", "product_lifecycle", "price_sensitivity", "inactivity"]


def classify(ctx: DataFrame) -> DataFrame:
    """DC1-DC4: churn_reason, confidence, supporting_signals, error."""
    sigs = reason_signals()
    cols = {r: F.filter(F.array(*s), lambda x: x.isNotNull()) for r, s in sigs.items()}
    df = ctx.select("*", *[v.alias(f"sig_{r}") for r, v in cols.items()])
    n = {r: F.size(F.col(f"sig_{r}")) for r in sigs}
    best = F.greatest(*n.values())
    pick = None
    for r in REASON_TIE_ORDER:
        pick = F.when(n[r] == best, F.lit(r)) if pick is None else pick.when(n[r] == best, F.lit(r))
    pick = F.when(best < 2, F.lit("unknown")).otherwise(pick)
    # Precedence rules: lifecycle over price when a reset is within 6 months,
    # service over inactivity when a complaint is open (the other reason must
    # itself have >= 2 signals).
    pick = (F.when((pick == "price_sensitivity") & _c(MRR).between(0, 6) & (n["product_lifecycle"] >= 2),
                   F.lit("product_lifecycle"))
            .when((pick == "inactivity") & (_c("complaints_open") >= 1) & (n["service_dissatisfaction"] >= 2),
                  F.lit("service_dissatisfaction"))
            .otherwise(pick))
    df = df.withColumn("churn_reason", pick)
    chosen = F.coalesce(*[F.when(F.col("churn_reason") == r, F.col(f"sig_{r}")) for r in sigs],
                        F.filter(F.flatten(F.array(*[F.col(f"sig_{r}") for r in sigs])), lambda x: x.isNotNull()))
    k = F.size(chosen)
    conf = F.when(F.col("churn_reason") == "unknown", F.lit("low")).when(k >= 3, F.lit("high")) \
        .when(k == 2, F.lit("medium")).otherwise(F.lit("low"))
    return df.select(
        *ctx.columns, "churn_reason", conf.alias("confidence"), chosen.alias("supporting_signals"),
        F.when(~F.col("has_profile"), F.lit("profile_not_found")).alias("error"))


# ---------------------------------------------------------------------------
# DC5-DC7: offers
# ---------------------------------------------------------------------------
# FIXED VALUES: offer catalogue encoded as (offer_id, use case, segments,
# channels, kind, new product?, required, any_of).  Conditions
# name functions in OFFER_CONDITIONS; inputs absent from the data model are
# treated as satisfied and are not listed.
OFFERS = [
    ("PR-001", "price_sensitivity", ["standard", "starter"], ["email", "call"], "fee_waiver", False, ["ten>=12"], ["comp>=1", "nps<=5"]),
    ("PR-002", "price_sensitivity", ["standard", "private_banking"], ["email", "call"], "bonus_rate", False, ["savings"], ["comp>=1", "dsl>60"]),
    ("PR-003", "price_sensitivity", ["standard", "student"], ["email"], "cashback", True, ["age<=45"], []),
    ("PR-004", "price_sensitivity", ["standard", "private_banking"], ["call"], "rate_discount", False, ["mrr0-6", "comp>=1"], []),
    ("PR-005", "price_sensitivity", ["private_banking"], ["call"], "fee_refund", False, ["ten>=60", "pc>=3", "nps<=6"], []),
    ("PR-006", "price_sensitivity", ["standard", "private_banking"], ["email", "call"], "bundle_discount", True, ["current", "pc>=2", "comp>=1"], []),
    ("PR-007", "price_sensitivity", ["standard", "student"], ["email"], "referral_bonus", False, ["l30>=1"], []),
    ("PR-008", "price_sensitivity", ["standard", "starter", "student"], ["email", "call"], "interest_waiver", False, ["co=0", "comp>=1"], []),
    ("PR-009", "service_dissatisfaction", ["standard", "private_banking"], ["call"], "priority_service", False, ["ten>=6"], ["co>=1", "nps<=5"]),
    ("PR-010", "service_dissatisfaction", ["private_banking", "standard"], ["call"], "relationship_manager", False, ["inflow>=3000", "no_rm"], ["nps<=4", "co>=2"]),
    ("PR-011", "service_dissatisfaction", ["standard", "starter", "student"], ["call"], "goodwill_credit", False, ["co>=1", "oldest>14"], []),
    ("PR-012", "service_dissatisfaction", ["standard", "starter"], ["email", "call"], "onboarding_session", False, ["dsl>45", "l90<3", "ten<24"], []),
    ("PR-013", "service_dissatisfaction", ["private_banking", "standard"], ["call"], "service_guarantee", False, ["nps<=5", "ten>=12", "co=0"], []),
    ("PR-014", "service_dissatisfaction", ["standard", "starter", "student"], ["call"], "fee_compensation", False, ["co>=1", "service_cat"], []),
    ("PR-015", "product_lifecycle", ["standard", "private_banking"], ["call", "email"], "rate_lock", False, ["mrr1-6"], []),
    ("PR-016", "product_lifecycle", ["standard", "private_banking"], ["call"], "refinance_review", False, ["mrr<=3", "comp>=1"], []),
    ("PR-017", "product_lifecycle", ["standard"], ["call"], "product_upgrade", True, ["inflow>=5000", "pc<=2", "ten>=24", "no_investment"], []),
    ("PR-018", "product_lifecycle", ["standard", "private_banking"], ["email", "call"], "consolidation", False, ["pc>=3", "no_salary"], []),
    ("PR-019", "product_lifecycle", ["standard"], ["email"], "pension_starter", True, ["age30-55", "pc<=2"], []),
    ("PR-020", "product_lifecycle", ["standard", "starter"], ["email", "call"], "salary_switch_bonus", False, ["no_salary", "inflow>=1500", "ten>=3"], []),
    ("PR-021", "inactivity", ["standard", "starter", "student"], ["email"], "reengagement_cashback", False, ["dsl>60", "l90<5"], []),
    ("PR-022", "inactivity", ["standard", "student", "starter"], ["email"], "feature_discovery", False, ["dsl>30", "l30<2", "ten>=6"], []),
    ("PR-023", "inactivity", ["standard", "starter"], ["email", "call"], "reactivation_offer", False, ["dsl>90", "lasttx>60"], []),
    ("PR-024", "inactivity", ["standard", "student", "starter"], ["email"], "savings_goal_incentive", True, ["l90<10", "savings"], []),
    ("PR-025", "inactivity", ["standard", "private_banking"], ["email"], "loyalty_milestone", False, ["dsl>30", "milestone"], []),
]
# FIXED VALUES: amounts of the offers that state one, in euros, each as
# (qualifier, lowest, highest).
OFFER_AMOUNTS = {
    "PR-001": [("up to", 96, 96)], "PR-002": [("", 200, 200)], "PR-003": [("up to", 90, 90)],
    "PR-004": [("about", 750, 750)], "PR-005": [("up to", 150, 150)], "PR-006": [("up to", 72, 72)],
    "PR-007": [("up to", 150, 150)], "PR-008": [("typically", 30, 90)], "PR-011": [("", 25, 25)],
    "PR-013": [("", 30, 30)], "PR-014": [("", 4, 15)], "PR-018": [("", 75, 75)], "PR-019": [("", 100, 100)],
    "PR-020": [("", 100, 100), ("up to", 96, 96)], "PR-021": [("", 20, 20)], "PR-022": [("", 10, 10)],
    "PR-023": [("", 15, 15)], "PR-024": [("up to", 15, 15)], "PR-025": [("", 10, 100)],
}


def offer_value(offer_id: str) -> str:
    """The amounts as a message states them: ceilings and ranges stay what they are."""
    parts = [f"{q} €{lo}".strip() if lo == hi else f"{q} €{lo} to €{hi}".strip()
             for q, lo, hi in OFFER_AMOUNTS.get(offer_id, [])]
    return " plus ".join(parts)


INVESTMENT_OFFERS = ["PR-017", "PR-019"]
SAVINGS_OR_INVESTMENT_OFFERS = ["PR-002", "PR-017", "PR-019", "PR-024"]
TARGET_MARKET_AGE = (18, 67)


def offer_conditions() -> dict[str, Column]:
    comp, nps, mrr = _c("competitor_transfer_count"), _c(NPS), _c(MRR)
    dsl, ten = _c("days_since_last_login"), _c("tenure_months")
    return {
        "ten>=12": ten >= 12, "ten>=60": ten >= 60, "ten>=6": ten >= 6, "ten<24": ten < 24,
        "ten>=24": ten >= 24, "ten>=3": ten >= 3,
        "comp>=1": comp >= 1, "nps<=5": nps <= 5, "nps<=6": nps <= 6, "nps<=4": nps <= 4,
        "dsl>60": dsl > 60, "dsl>45": dsl > 45, "dsl>30": dsl > 30, "dsl>90": dsl > 90,
        "savings": _c("has_savings") == 1, "current": _c("has_current") == 1,
        "no_investment": _c("has_investment") == 0,
        "age<=45": _c("age") <= 45, "age30-55": _c("age").between(30, 55),
        "mrr0-6": mrr.between(0, 6), "mrr1-6": mrr.between(1, 6), "mrr<=3": mrr <= 3,
        "pc>=3": _c("product_count") >= 3, "pc>=2": _c("product_count") >= 2, "pc<=2": _c("product_count") <= 2,
        "l30>=1": _c("app_logins_last_30d") >= 1, "l30<2": _c("app_logins_last_30d") < 2,
        "l90<3": _c("app_logins_last_90d") < 3, "l90<5": _c("app_logins_last_90d") < 5,
        "l90<10": _c("app_logins_last_90d") < 10,
        "co=0": _c("complaints_open") == 0, "co>=1": _c("complaints_open") >= 1, "co>=2": _c("complaints_open") >= 2,
        "oldest>14": _c("oldest_open_days") > 14, "service_cat": _c("open_service_quality"),
        "inflow>=3000": _c("avg_monthly_inflow_eur") >= 3000, "inflow>=5000": _c("avg_monthly_inflow_eur") >= 5000,
        "inflow>=1500": _c("avg_monthly_inflow_eur") >= 1500,
        "no_rm": _c("relationship_manager_id").isNull(), "no_salary": _c("salary_account_flag") == 0,
        "lasttx>60": _c("days_since_last_tx") > 60,
        "milestone": (F.floor(ten / 12)).isin(1, 3, 5, 10),
    }


def _cond_col(key: str) -> str:
    """Column name of a predicate: its key with the comparison spelled out."""
    for sign, word in ((">=", "_min_"), ("<=", "_max_"), (">", "_above_"), ("<", "_below_"), ("=", "_is_"), ("-", "_to_")):
        key = key.replace(sign, word)
    return "cond_" + key


def _offer_struct(o) -> Column:
    oid, use, segs, chans, kind, new, req, anyof = o
    c = {k: F.col(_cond_col(k)) for k in req + anyof}
    req_ok = F.lit(True)
    for r in req:
        req_ok = req_ok & c[r]
    any_ok = F.lit(True)
    if anyof:
        any_ok = F.lit(False)
        for a in anyof:
            any_ok = any_ok | c[a]
    triggered = sum(c[k].cast("int") for k in req + anyof) if (req + anyof) else F.lit(0)
    ok = (_c("churn_reason") == use) & F.coalesce(_c("segment").isin(*segs), F.lit(False)) & req_ok & any_ok
    return F.when(ok, F.struct((-triggered).alias("neg_triggered"), F.lit(oid).alias("offer_id"),
                               triggered.alias("triggered")))


def eligible_offers(classified: DataFrame) -> DataFrame:
    """DC5 / J10: ``eligible`` = array of (neg_triggered, offer_id, triggered)
    sorted best first (most triggered predicates, then offer_id).  The ~40
    atomic predicates are projected once as boolean columns (NULL -> false) so
    the 25 offer structs only reference columns."""
    conds = offer_conditions()
    with_c = classified.select("*", *[F.coalesce(v, F.lit(False)).alias(_cond_col(k)) for k, v in conds.items()])
    arr = F.filter(F.array(*[_offer_struct(o) for o in OFFERS]), lambda x: x.isNotNull())
    return with_c.withColumn("eligible", F.array_sort(arr)).drop(*[_cond_col(k) for k in conds])


_ATTR_FIELDS = {2: "segments", 3: "channels", 4: "kind", 5: "new_product", 6: "value"}


def _offer_map() -> Column:
    """offer_id -> struct of catalogue attributes, as one literal map (constant
    folded, so each lookup is a hash probe, not a 25-branch CASE)."""
    kv = []
    for o in OFFERS:
        kv += [F.lit(o[0]), F.struct(F.array(*[F.lit(x) for x in o[2]]).alias("segments"),
                                     F.array(*[F.lit(x) for x in o[3]]).alias("channels"),
                                     F.lit(o[4]).alias("kind"), F.lit(o[5]).alias("new_product"),
                                     F.lit(offer_value(o[0])).alias("value"))]
    return F.create_map(*kv)


def _offer_attr(col: Column, idx: int) -> Column:
    return F.element_at(_offer_map(), col)[_ATTR_FIELDS[idx]]


def choose_offer(eligible: DataFrame) -> DataFrame:
    """DC6 + DC7: best offer (NULL if none) and channel."""
    best = F.when(F.size("eligible") > 0, F.col("eligible").getItem(0))
    df = eligible.withColumn("offer_id", best["offer_id"]).withColumn(
        "offer_triggered", F.coalesce(best["triggered"], F.lit(0)))
    chans = _offer_attr(F.col("offer_id"), 3)
    kind = _offer_attr(F.col("offer_id"), 4)
    call_only = F.coalesce(F.size(chans) == 1, F.lit(False)) & F.coalesce(F.array_contains(chans, "call"), F.lit(False))
    email_only = F.coalesce(F.size(chans) == 1, F.lit(False)) & F.coalesce(F.array_contains(chans, "email"), F.lit(False))
    prefers_call = ((_c("segment") == "private_banking") | (_c("complaints_open") >= 2)
                    | kind.isin("rate_discount", "rate_lock", "refinance_review")
                    | (_c("avg_monthly_inflow_eur") >= 5000))
    channel = (F.when(call_only, F.lit("call")).when(email_only, F.lit("email"))
               .when(F.coalesce(prefers_call, F.lit(False)), F.lit("call")).otherwise(F.lit("email")))
    return df.withColumn("channel", channel).withColumn("offer_kind", kind)


# ---------------------------------------------------------------------------
# DC8: message template
# ---------------------------------------------------------------------------
# FIXED VALUES: mandatory statements required by the rules.
OPT_OUT_STATEMENT = ("Before I continue, I want to let you know that you can ask us at any time to stop "
                     "contacting you about offers — just let me know and I'll update your preferences immediately.")
UNSUBSCRIBE_LINE = "To manage your communication preferences or unsubscribe, [click here]."
RISK_DISCLOSURE = ("The value of investments can go down as well as up. Past performance is not a reliable "
                   "indicator of future results. You may get back less than you invest.")
COOLING_OFF_LINE = "You have a 14-day cooling-off period after signing up."
TERMS_LINE = "Full terms and conditions apply and are available on request."


def render_message(chosen: DataFrame) -> DataFrame:
    """DC8: deterministic draft.  Personal signal = tenure (years), else the
    fixed-rate end date, else the region.  Offer value copied verbatim."""
    years = F.floor(_c("tenure_months") / 12)
    thanks = ", we wanted to thank you for your loyalty."
    opening = (F.when(years >= 1, F.concat(F.lit("As you have been with us for "), years.cast("string"),
                                           F.lit(" years"), F.lit(thanks)))
               .when(_c("next_rate_end").isNotNull(),
                     F.concat(F.lit("Your fixed rate ends on "), F.date_format("next_rate_end", "yyyy-MM-dd"),
                              F.lit(", so we wanted to share the options available to you.")))
               .when(_c("region").isNotNull(), F.concat(F.lit("As a valued client in "), _c("region"), F.lit(thanks)))
               .otherwise(F.lit("We wanted to thank you for your loyalty.")))
    value = _offer_attr(F.col("offer_id"), 6)
    offer_line = F.when(F.col("offer_id").isNull(), F.lit("We would welcome the chance to review your accounts with you."))\
        .otherwise(F.concat(F.lit("We would like to tell you about our "), F.regexp_replace(_c("offer_kind"), "_", " "),
                            F.lit(" offer ("), _c("offer_id"), F.lit(")"),
                            F.when(value != "", F.concat(F.lit(", worth "), value)).otherwise(F.lit("")), F.lit(".")))
    extras = F.concat_ws(" ",
                         F.when(_c("offer_id").isin(*INVESTMENT_OFFERS), F.lit(RISK_DISCLOSURE)),
                         F.when(_offer_attr(F.col("offer_id"), 5), F.lit(COOLING_OFF_LINE)),
                         F.when(_c("offer_id").isNotNull(), F.lit(TERMS_LINE)))
    email = F.concat_ws("\n\n", F.lit("Subject: A loyalty offer for you"), F.lit("Hello,"),
                        F.concat_ws(" ", opening, offer_line, extras), F.lit(UNSUBSCRIBE_LINE))
    call = F.concat_ws(" ", F.lit(OPT_OUT_STATEMENT), F.lit("This is a loyalty call about our customer programme."),
                       opening, offer_line, extras)
    return chosen.withColumn("message_draft", F.when(_c("channel") == "call", call).otherwise(email))


# ---------------------------------------------------------------------------
# DC9-DC10: compliance checks
# ---------------------------------------------------------------------------
HARD, FLAG = "hard_block", "flag_for_review"
_I = "(?i)"
PATTERNS = {
    "urgency": _I + r"\b(act now|limited time|offer expires|expires (tonight|today)|last chance|don'?t miss out|"
               r"you must respond|will not be repeated|hurry)\b",
    "impersonal": _I + r"\b(dear (valued )?customer|dear sir|dear madam|to whom it may concern)\b",
    "fear": _I + r"(account may be at risk|could lose|failure to act|will be closed|account closure)",
    "surveillance": _I + r"(identified as|flagged|selected by (our|the) system|our (model|algorithm)|risk score|"
                    r"churn|haven'?t logged in for \d+|no transactions (in|for|since) \d+|\d+ days since your last)",
    "jargon": r"\b(AER|LTV|MiFID|APR|ISIN|UCITS)\b\s*([^\s(]|$)",
    "superlative": _I + r"(best rate|market-leading|unbeatable|lowest fees?)",
    "substantiated": _I + r"(as of|compared to|source)",
    "guarantee": _I + r"(guaranteed (growth|returns?)|risk-free|you will earn \d|guaranteed to grow)",
    "disclosure_equiv": r"(?is)can go down as well as up.*past performance",
    "advice": _I + r"(you should invest|we recommend you|right product for you|you should switch)",
    "cooling_off": _I + r"(14-day|cooling-off)",
    "fee_or_rate": _I + r"(\d+(\.\d+)?\s?%|\bfees?\b|\brates?\b)",
    "terms": _I + r"(terms|conditions)",
    "percent": r"\d+(\.\d+)?\s?%",
    "caveat_period": r"(?is)past performance.*(last year|per year|\b(19|20)\d\d\b|Q[1-4])",
    "comparison": _I + r"(compared to|market average|than other banks|than competitors)",
    "sourced": _I + r"\([^)]*(data|source|NBB)[^)]*\d{4}[^)]*\)",
    "tenure": _I + r"(with us for \d+|since you joined|customer for \d+)",
    "recent_contact": _I + r"(following|after) (our|your) recent (conversation|visit|call|meeting)",
    "loyalty_call": _I + r"\b(loyalty|marketing) (call|conversation)\b",
    "unsubscribe": _I + r"(unsubscribe|communication preferences)",
    "opt_out": _I + r"stop contacting you",
    "alert_open": _I + r"(security alert|account issue|suspicious activity|problem with your account|urgent notice)",
    "bad_subject": _I + r"^subject:[^\n]*(action required|important update about your account|security|alert|suspended)",
}
# What a text must hold, in lower case, for a pattern to match anywhere in it: one of these at least.  A search for
# plain strings is far cheaper than the pattern, which is only tried on texts that pass.
LITERALS = {
    "urgency": ["act now", "limited time", "expires", "last chance", "miss out", "you must respond", "will not be repeated", "hurry"],
    "impersonal": ["dear", "to whom it may concern"],
    "fear": ["account may be at risk", "could lose", "failure to act", "will be closed", "account closure"],
    "surveillance": ["identified as", "flagged", "selected by", "our model", "our algorithm", "risk score", "churn",
                     "logged in for", "no transactions", "days since your last"],
    "jargon": ["aer", "ltv", "mifid", "apr", "isin", "ucits"],
    "superlative": ["best rate", "market-leading", "unbeatable", "lowest fee"],
    "substantiated": ["as of", "compared to", "source"],
    "guarantee": ["guaranteed", "risk-free", "you will earn"],
    "disclosure_equiv": ["can go down as well as up"],
    "advice": ["you should invest", "we recommend you", "right product for you", "you should switch"],
    "cooling_off": ["14-day", "cooling-off"],
    "fee_or_rate": ["%", "fee", "rate"],
    "terms": ["terms", "conditions"],
    "percent": ["%"],
    "caveat_period": ["past performance"],
    "comparison": ["compared to", "market average", "than other banks", "than competitors"],
    "sourced": ["data", "source", "nbb"],
    "tenure": ["with us for", "since you joined", "customer for"],
    "recent_contact": ["our recent"],
    "loyalty_call": ["loyalty c", "marketing c"],
    "unsubscribe": ["unsubscribe", "communication preferences"],
    "opt_out": ["stop contacting you"],
    "alert_open": ["security alert", "account issue", "suspicious activity", "problem with your account", "urgent notice"],
    "bad_subject": ["subject:"],
}
# The opening of a call (CH-002, CH-003): the rules speak of its start and its first
# 30 seconds; at 150 spoken words a minute that is the first 75 words.
OPENING_WORDS = 75


def opening_pattern(words: int = OPENING_WORDS) -> str:
    return r"^[ \t\r\n]*([^ \t\r\n]+[ \t\r\n]+){0,%d}[^ \t\r\n]*" % (words - 1)


# FIXED VALUES: rule ids, severities and where they apply.
RULES = [
    ("BT-001", HARD), ("BT-002", HARD), ("BT-003", HARD), ("BT-004", HARD), ("BT-005", FLAG), ("BT-006", FLAG),
    ("FSMA-001", HARD), ("FSMA-002", HARD), ("FSMA-003", HARD), ("FSMA-004", FLAG), ("FSMA-005", FLAG),
    ("MIFID-001", HARD), ("MIFID-002", HARD), ("MIFID-003", FLAG),
    ("PERS-001", HARD), ("PERS-002", FLAG), ("PERS-003", FLAG),
    ("CH-001", HARD), ("CH-002", HARD), ("CH-003", HARD), ("CH-004", FLAG),
]


def rule_checks(msg: Column, channel: Column, offer_id: Column, segment: Column, age: Column,
                disclosure_mode: str = "strict", region: Column | None = None, rate_end: Column | None = None,
               product_names: Column | None = None, opening_words: int = OPENING_WORDS,
               low: Column | None = None) -> dict[str, tuple[Column, str]]:
    """rule_id -> (violation condition, finding).  ``disclosure_mode``
    'strict' wants the verbatim FSMA-002 statement, 'equivalent' accepts a
    paraphrase (SEM12).  PERS-001 accepts a tenure or recent-contact phrase or the
    row's own region, fixed-rate end date or product name (where given).  ``low`` is
    the message in lower case, where the caller has it as a column."""
    low = F.lower(msg) if low is None else low

    def rx(name, col=msg):
        held = None
        for literal in LITERALS[name]:
            held = low.contains(literal) if held is None else held | low.contains(literal)
        return F.coalesce(held & col.rlike(PATTERNS[name]), F.lit(False))
    inv = F.coalesce(offer_id.isin(*INVESTMENT_OFFERS), F.lit(False))
    sav_inv = F.coalesce(offer_id.isin(*SAVINGS_OR_INVESTMENT_OFFERS), F.lit(False))
    new_prod = F.coalesce(_offer_attr(offer_id, 5), F.lit(False))
    segs = _offer_attr(offer_id, 2)
    chans = _offer_attr(offer_id, 3)
    has_disclosure = msg.contains(RISK_DISCLOSURE) if disclosure_mode == "strict" else rx("disclosure_equiv")
    opening = F.regexp_extract(msg, opening_pattern(opening_words), 0)
    personal = rx("tenure") | rx("recent_contact")
    for own in (region, None if rate_end is None else F.date_format(rate_end, "yyyy-MM-dd")):
        if own is not None:
            personal = personal | F.coalesce((F.length(own) > 0) & low.contains(F.lower(own)), F.lit(False))
    if product_names is not None:
        personal = personal | F.coalesce(F.exists(product_names, lambda n: low.contains(F.lower(n))), F.lit(False))
    is_email, is_call = channel == "email", channel == "call"
    return {
        "BT-001": (rx("urgency"), "urgency or pressure phrase"),
        "BT-002": (rx("impersonal"), "impersonal salutation"),
        "BT-003": (rx("fear"), "fear-based phrase"),
        "BT-004": (rx("surveillance"), "reference to monitoring or scoring"),
        "BT-005": (rx("jargon"), "jargon term without explanation"),
        "BT-006": (rx("superlative") & ~rx("substantiated"), "unsubstantiated superlative"),
        "FSMA-001": (sav_inv & rx("guarantee"), "guaranteed-return language"),
        "FSMA-002": (inv & ~F.coalesce(has_disclosure, F.lit(False)), "risk disclosure missing"),
        "FSMA-003": (inv & rx("advice"), "personal advice phrase"),
        "FSMA-004": (new_prod & ~rx("cooling_off"), "cooling-off period not referenced"),
        "FSMA-005": (rx("fee_or_rate") & ~rx("terms"), "fee or rate without terms reference"),
        "MIFID-001": (inv & rx("percent") & ~rx("caveat_period"), "performance figure without caveat and period"),
        "MIFID-002": (F.coalesce(offer_id.isin("PR-017", "PR-019"), F.lit(False))
                      & ~F.coalesce(age.between(*TARGET_MARKET_AGE), F.lit(False)), "outside target market"),
        "MIFID-003": (rx("comparison") & ~rx("sourced"), "comparison without source and date"),
        "PERS-001": (~personal, "no personal signal"),
        "PERS-002": (offer_id.isNotNull() & ~F.coalesce(F.array_contains(segs, segment), F.lit(False)),
                     "segment not targeted by offer"),
        "PERS-003": (offer_id.isNotNull() & ~F.coalesce(F.array_contains(chans, channel), F.lit(False)),
                     "channel not in offer channel fit"),
        "CH-001": (F.coalesce(is_email, F.lit(False)) & ~rx("unsubscribe"), "no unsubscribe line"),
        "CH-002": (F.coalesce(is_call, F.lit(False)) & ~rx("opt_out", opening), "no opt-out in opening"),
        "CH-003": (F.coalesce(is_call, F.lit(False)) & (rx("alert_open", opening) | ~rx("loyalty_call", opening)),
                   "alert-style opening or not named a loyalty call"),
        "CH-004": (F.coalesce(is_email, F.lit(False)) & rx("bad_subject"), "misleading subject line"),
    }


def compliance(df: DataFrame, msg: str = "message_draft", channel: str = "channel", offer_id: str = "offer_id",
               segment: str = "segment", age: str = "age", disclosure_mode: str = "strict") -> DataFrame:
    """DC9 + DC10: ``violated_rules`` array of hits and ``status`` pass/fail
    (fail iff any hard_block hit; flags are recorded but pass, SEM15)."""
    own = {k: F.col(c) if c in df.columns else None
           for k, c in (("region", "region"), ("rate_end", "next_rate_end"), ("product_names", "product_names"))}
    names, df = df.columns, df.withColumn("__low", F.lower(F.coalesce(F.col(msg), F.lit(""))))
    checks = rule_checks(F.coalesce(F.col(msg), F.lit("")), F.col(channel), F.col(offer_id),
                         F.col(segment), F.col(age), disclosure_mode, low=F.col("__low"), **own)
    hits = F.filter(F.array(*[
        F.when(checks[rid][0], F.struct(F.lit(rid).alias("rule_id"), F.lit(sev).alias("severity"),
                                        F.lit(checks[rid][1]).alias("finding")))
        for rid, sev in RULES]), lambda x: x.isNotNull())
    out = df.select(*[F.col(c) for c in names if c != "violated_rules"], hits.alias("violated_rules"))
    return out.withColumn("status", F.when(F.exists("violated_rules", lambda v: v["severity"] == HARD),
                                           F.lit("fail")).otherwise(F.lit("pass")))


# ---------------------------------------------------------------------------
# DC11-DC14: routing and counters
# ---------------------------------------------------------------------------
def decide(ctx: DataFrame, disclosure_mode: str = "strict", later_draft: Column | None = None) -> DataFrame:
    """DC1-DC12 in one chain of projections over the context.  ``later_draft`` is a later
    stage's draft (it may refer to ``message_draft``), checked in place of the earlier one."""
    c = classify(ctx)
    d = render_message(choose_offer(eligible_offers(c)))
    if later_draft is not None:
        d = merge_drafts(d.withColumn("later_draft", later_draft), "later_draft").drop("later_draft")
    d = compliance(d, disclosure_mode=disclosure_mode)
    return d.withColumn("churn_reason", normalize_reason(F.col("churn_reason"))) \
        .withColumn("outcome", F.when(F.col("error").isNotNull(), F.lit("error"))
                    .when(F.col("status") == "pass", F.lit("approved")).otherwise(F.lit("queued")))


def merge_drafts(df: DataFrame, later: str, msg: str = "message_draft") -> DataFrame:
    """DC12: the later stage's draft replaces the earlier one unless it is empty."""
    return df.withColumn(msg, F.coalesce(F.nullif(F.col(later), F.lit("")), F.col(msg)))


def _or_zero(df: DataFrame, name: str) -> Column:
    return F.coalesce(F.col(name).cast("int"), F.lit(0)) if name in df.columns else F.lit(0)


def approved_rows(decided: DataFrame, batch_date: dt.date, written_at: Column | None = None) -> DataFrame:
    """DC11 / DC14 / IO11: rows routed to the approved table, drafts sanitised, tokens
    of the stages (0 where a stage reports none), ``approved_at`` the time of writing."""
    return decided.where(F.col("outcome") == "approved").select(
        "customer_id", F.lit(batch_date).alias("batch_date"), "offer_id", "channel", "churn_reason",
        "confidence", sanitize(F.col("message_draft")).alias("message_draft"),
        *[_or_zero(decided, f"agent{i}_tokens").alias(f"agent{i}_tokens") for i in (1, 2, 3)],
        (F.current_timestamp() if written_at is None else written_at).alias("approved_at"))


def queued_rows(decided: DataFrame, batch_date: dt.date, written_at: Column | None = None) -> DataFrame:
    """DC11 / IO12: everything not passed and not an error -> review queue, drafts and
    notes sanitised, violations JSON-encoded, status pending, not yet reviewed."""
    notes = F.col("review_notes") if "review_notes" in decided.columns else F.lit("")
    return decided.where(F.col("outcome") == "queued").select(
        "customer_id", F.lit(batch_date).alias("batch_date"), "offer_id", "channel", "churn_reason",
        sanitize(F.col("message_draft")).alias("message_draft"), F.to_json("violated_rules").alias("violated_rules"),
        sanitize(F.coalesce(notes, F.lit(""))).alias("review_notes"), F.lit("pending").alias("status"),
        F.lit(None).cast("string").alias("reviewed_by"), F.lit(None).cast("timestamp_ntz").alias("reviewed_at"),
        (F.current_timestamp() if written_at is None else written_at).alias("created_at"))


def batch_counters(decided: DataFrame) -> DataFrame:
    """DC13: approved / queued / error counts (one grouped aggregate)."""
    return decided.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


# FIXED VALUES: keys that the three stage outputs may have.
STAGE_KEYS = {
    1: ["customer_id", "churn_score", "churn_reason", "confidence", "supporting_signals", "error"],
    2: ["customer_id", "offer_id", "channel", "message_draft", "rationale"],
    3: ["status", "violated_rules", "message_draft", "review_notes"],
}


def contract_violations(outputs: DataFrame) -> DataFrame:
    """SC18: the three stage contracts on JSON texts ``stage1`` .. ``stage3`` per
    customer, as an array of violation codes (required, enum, range, length, extra keys)."""
    def get(stage, key):
        return F.get_json_object(F.col(f"stage{stage}"), f"$.{key}")

    def has(stage, key):
        return F.coalesce(F.array_contains(F.json_object_keys(F.col(f"stage{stage}")), key), F.lit(False))

    score = get(1, "churn_score").cast("double")
    rules = F.from_json(get(3, "violated_rules"), "array<struct<rule_id:string,severity:string,finding:string>>")
    optional = {(1, "error")}
    checks = [(~has(n, k), f"{n}.{k}:required") for n, keys in STAGE_KEYS.items() for k in keys if (n, k) not in optional]
    checks += [
        (F.coalesce(~score.between(0, 1), has(1, "churn_score")), "1.churn_score:range"),
        (has(1, "churn_reason") & ~F.coalesce(get(1, "churn_reason").isin(*K.CHURN_REASONS), F.lit(False)), "1.churn_reason:enum"),
        (has(1, "confidence") & ~F.coalesce(get(1, "confidence").isin("high", "medium", "low"), F.lit(False)), "1.confidence:enum"),
        (has(2, "channel") & ~F.coalesce(get(2, "channel").isin("email", "call"), F.lit(False)), "2.channel:enum"),
        (has(2, "message_draft") & (F.length(F.coalesce(get(2, "message_draft"), F.lit(""))) < 50), "2.message_draft:minLength"),
        (has(3, "status") & ~F.coalesce(get(3, "status").isin("pass", "fail"), F.lit(False)), "3.status:enum"),
        (F.coalesce(F.exists(rules, lambda v: ~F.coalesce(v["severity"].isin(HARD, FLAG), F.lit(False))), F.lit(False)),
         "3.violated_rules:severity"),
    ]
    checks += [(F.size(F.array_except(F.json_object_keys(F.col(f"stage{n}")), F.array(*[F.lit(k) for k in keys]))) > 0,
                f"{n}:additionalProperties") for n, keys in STAGE_KEYS.items()]
    arr = F.filter(F.array(*[F.when(F.coalesce(c, F.lit(True)), F.lit(code)) for c, code in checks]),
                   lambda x: x.isNotNull())
    return outputs.select("customer_id", arr.alias("contract_violations"))


def golden_agreement(golden: DataFrame, disclosure_mode: str = "strict") -> DataFrame:
    """DC16: run the rule checks on golden examples and compare with their
    expected status and violated rule ids; agreement per (reason, channel).

    ``golden`` columns: example_id, churn_reason, channel, offer_id, segment,
    age, expected_status, expected_rules (array<string>), body."""
    checked = compliance(golden.withColumnRenamed("body", "message_draft"), disclosure_mode=disclosure_mode)
    got_ids = F.array_sort(F.transform("violated_rules", lambda v: v["rule_id"]))
    exp_ids = F.array_sort(F.coalesce(F.col("expected_rules"), F.array().cast("array<string>")))
    per = checked.select(
        "example_id", "churn_reason", "channel",
        (F.col("status") == F.col("expected_status")).alias("status_agrees"),
        (got_ids == exp_ids).alias("rules_agree"))
    return per.groupBy("churn_reason", "channel").agg(
        F.count(F.lit(1)).alias("examples"),
        F.sum(F.col("status_agrees").cast("int")).alias("status_agreement"),
        F.sum(F.col("rules_agree").cast("int")).alias("rules_agreement"))


def golden_differences(golden: DataFrame, disclosure_mode: str = "strict") -> DataFrame:
    """DC16: one row per example and rule on which the checks and the expectation differ: example_id, rule_id,
    expected, found.  ``golden`` as in ``golden_agreement``."""
    checked = compliance(golden.withColumnRenamed("body", "message_draft"), disclosure_mode=disclosure_mode)
    found = F.transform("violated_rules", lambda v: v["rule_id"])
    both = checked.select("example_id", F.coalesce("expected_rules", F.array().cast("array<string>")).alias("want"), found.alias("have"))
    return both.select("example_id", "want", "have", F.explode(F.array_union("want", "have")).alias("rule_id")).select(
        "example_id", "rule_id", F.array_contains("want", F.col("rule_id")).alias("expected"),
        F.array_contains("have", F.col("rule_id")).alias("found")).where("expected != found")


def offers_frame(spark) -> DataFrame:
    """IO20 (re-aimed): the offer catalogue as a table (25 rows, fixed)."""
    rows = [(*o, offer_value(o[0]), OFFER_AMOUNTS.get(o[0], [])) for o in OFFERS]
    return spark.createDataFrame(rows, "offer_id string, retention_use_case string, target_segments array<string>, "
                                       "channel_fit array<string>, product_type string, new_product boolean, "
                                       "required array<string>, any_of array<string>, offer_value string, "
                                       "amounts array<struct<qualifier:string,low:int,high:int>>")


def rules_frame(spark) -> DataFrame:
    """IO20 (re-aimed): the compliance rule table (21 rows, fixed)."""
    return spark.createDataFrame([(rid, rid.split("-")[0], sev) for rid, sev in RULES],
                                 "rule_id string, category string, severity string")
