"""The plain strings in front of the rule patterns."""

import random

from pyspark.sql import functions as F

from moorline.operators import decisions as DC

TEXTS = [
    "Act now", "limited time", "offer expires", "expires tonight", "EXPIRES today", "last chance", "don't miss out", "dont miss out",
    "you must respond", "will not be repeated", "Hurry", "Dear customer", "dear valued customer", "DEAR SIR", "dear madam",
    "To whom it may concern", "account may be at risk", "could lose", "failure to act", "will be closed", "account closure",
    "identified as", "flagged", "selected by our system", "selected by the system", "our model", "our algorithm", "risk score",
    "churn", "haven't logged in for 9", "havent logged in for 12", "no transactions in 3", "no transactions for 4",
    "no transactions since 5", "12 days since your last", "AER today", "LTV", "MiFID  x", "APR", "ISIN.", "UCITS", "best rate", "market-leading",
    "unbeatable", "lowest fee", "lowest fees", "as of", "compared to", "source", "guaranteed growth", "guaranteed return",
    "guaranteed returns", "risk-free", "you will earn 5", "guaranteed to grow", DC.RISK_DISCLOSURE, "you should invest",
    "we recommend you", "right product for you", "you should switch", "14-day", "cooling-off", "3 %", "2.5%", "a fee", "fees", "the rate",
    "rates", "terms", "conditions", "past performance last year", "Past performance\nin 2019", "past performance Q3",
    "market average", "than other banks", "than competitors", "(NBB data, 2023)", "(source 2020)", "with us for 7", "since you joined",
    "customer for 3", "following our recent visit", "after your recent call", "loyalty call", "marketing conversation", "unsubscribe",
    "communication preferences", "stop contacting you", "security alert", "account issue", "suspicious activity",
    "problem with your account", "urgent notice", "subject: action required", "Subject: suspended", "İ Act now K"]


def test_a_text_that_matches_holds_one_of_the_plain_strings(spark):
    texts = TEXTS + [t.upper() for t in TEXTS] + [t.lower() for t in TEXTS] + [f"é {t} ß" for t in TEXTS]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert set(DC.LITERALS) == set(DC.PATTERNS)
    for name, pattern in DC.PATTERNS.items():
        held = F.exists(F.array(*[F.lit(x) for x in DC.LITERALS[name]]), lambda x: F.lower("t").contains(x))
        assert df.where(F.col("t").rlike(pattern)).where(~held).count() == 0, name
        assert df.where(F.col("t").rlike(pattern)).count() > 0, name


def test_hits_are_those_of_the_patterns_alone(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.sample(TEXTS, rng.randint(0, 4))) if i % 9 else None, rng.choice(["email", "call", None]),
             rng.choice(["PR-002", "PR-017", "PR-019", "PR-003", None]), "standard", rng.choice([17, 40, None]), "Flanders", ["Gold card", None])
            for i in range(300)]
    df = spark.createDataFrame(rows, "id int, message_draft string, channel string, offer_id string, segment string, age int, "
                                     "region string, product_names array<string>")

    def hits():
        out = DC.compliance(df)
        assert out.columns == [*df.columns, "violated_rules", "status"]
        return [(r.id, r.status, [v.rule_id for v in r.violated_rules]) for r in out.orderBy("id").collect()]
    got = hits()
    monkeypatch.setattr(DC, "LITERALS", {k: [""] for k in DC.PATTERNS})
    assert got == hits() and len({x for *_, ids in got for x in ids}) > 12
