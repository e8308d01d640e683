"""Eligibility by relational division against a loop over customers and offers."""

import random

from moorline.operators import catalogue as CT
from moorline.operators import decisions as DC

NUMBERS = ["tenure_months", "competitor_transfer_count", DC.NPS, DC.MRR, "days_since_last_login", "age", "product_count",
           "app_logins_last_30d", "app_logins_last_90d", "complaints_open", "oldest_open_days", "avg_monthly_inflow_eur",
           "days_since_last_tx", "has_savings", "has_current", "has_investment", "salary_account_flag"]
NAMES = dict(zip(["ten", "comp", "nps", "mrr", "dsl", "age", "pc", "l30", "l90", "co", "oldest", "inflow", "lasttx"], NUMBERS))
REASONS, SEGMENTS = ["price_sensitivity", "inactivity"], ["standard", "student", "starter"]


def _customers(spark, n, rng):
    rows = []
    for i in range(n):
        values = [rng.choice([None, 0, 1, 2, 3, 5, 6, 12, 40, 61]) for _ in NUMBERS]
        rows.append((i, rng.choice(REASONS + ["unknown"]), rng.choice(SEGMENTS + [None]), rng.choice([None, "RM1"]),
                     rng.choice([None, True, False]), *values))
    schema = "customer_id long, churn_reason string, segment string, relationship_manager_id string, open_service_quality boolean, " \
             + ", ".join(f"{c} double" for c in NUMBERS)
    return spark.createDataFrame([(*r[:5], *[None if v is None else float(v) for v in r[5:]]) for r in rows], schema)


def _entry(rng):
    return rng.choice([f"{rng.choice(list(NAMES))}{rng.choice(['>=', '<=', '>', '<', '='])}{rng.choice([0, 1, 2, 3, 6, 12])}",
                       f"{rng.choice(['age', 'mrr', 'ten'])}{rng.choice([0, 1])}-{rng.choice([5, 40])}",
                       rng.choice(["savings", "current", "no_investment", "no_rm", "no_salary", "service_cat", "milestone", "unheard_of"])])


def _holds(text, r):
    flags = {"savings": r.has_savings == 1, "current": r.has_current == 1, "no_investment": r.has_investment == 0,
             "no_rm": r.relationship_manager_id is None, "no_salary": r.salary_account_flag == 0,
             "service_cat": r.open_service_quality is True,
             "milestone": r.tenure_months is not None and r.tenure_months // 12 in (1, 3, 5, 10), "unheard_of": False}
    if text in flags:
        return flags[text]
    for sign, f in ((">=", float.__ge__), ("<=", float.__le__), (">", float.__gt__), ("<", float.__lt__), ("=", float.__eq__)):
        if sign in text:
            name, bound = text.split(sign)
            v = r[NAMES[name]]
            return v is not None and f(v, float(bound))
    name = text.rstrip("0123456789-")
    low, high = text[len(name):].split("-")
    v = r[NAMES[name]]
    return v is not None and float(low) <= v <= float(high)


def test_equals_a_loop_over_thousands_of_offers(spark):
    rng = random.Random(4)
    customers = _customers(spark, 60, rng)
    offers = [(f"O{i:05d}", rng.choice(REASONS), rng.sample(SEGMENTS, rng.randint(1, 3)), [_entry(rng) for _ in range(rng.randint(0, 3))],
               [_entry(rng) for _ in range(rng.choice([0, 0, 2, 3]))]) for i in range(3000)]
    table = spark.createDataFrame(offers, "offer_id string, retention_use_case string, target_segments array<string>, "
                                          "required array<string>, any_of array<string>")
    want = set()
    for r in customers.collect():
        for oid, use, segments, required, any_of in offers:
            if r.churn_reason == use and r.segment in segments and all(_holds(t, r) for t in required) \
                    and (not any_of or any(_holds(t, r) for t in any_of)):
                count = sum(_holds(t, r) for t in set(required)) + sum(_holds(t, r) for t in set(any_of))
                want.add((r.customer_id, oid, count))
    got = {tuple(r) for r in CT.eligible_pairs(customers, table, CT.conditions(table)).collect()}
    assert got == want and len(want) > 500


def test_fixed_catalogue_gives_the_same_offers(spark):
    customers = _customers(spark, 400, random.Random(5))
    fixed = {r.customer_id: [tuple(o) for o in r.eligible] for r in DC.eligible_offers(customers).collect()}
    table = {r.customer_id: [tuple(o) for o in r.eligible] for r in CT.eligible_offers(customers, DC.offers_frame(spark)).collect()}
    assert fixed == table and any(fixed.values())
