"""Compliance rules: a violating and a clean message per rule; routing; review."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from moorline.operators import decisions as DC
from moorline.operators import review as RV

OK_EMAIL = ("Subject: A loyalty offer for you\n\nHello,\n\nAs you have been with us for 4 years, thank you. "
            "Full terms and conditions apply.\n\n" + DC.UNSUBSCRIBE_LINE)
OK_CALL = DC.OPT_OUT_STATEMENT + " This is a loyalty call. As you have been with us for 4 years, thank you."

# rule -> (bad message, channel, offer, segment, age), the clean variant uses OK_* with the same context
CASES = {
    "BT-001": (OK_EMAIL.replace("thank you", "act now"), "email", None, "standard", 40),
    "BT-002": ("Dear valued customer, " + OK_EMAIL, "email", None, "standard", 40),
    "BT-003": (OK_EMAIL.replace("thank you", "your account may be at risk"), "email", None, "standard", 40),
    "BT-004": (OK_EMAIL.replace("thank you", "you were flagged for outreach"), "email", None, "standard", 40),
    "BT-005": (OK_EMAIL.replace("thank you", "our AER is good"), "email", None, "standard", 40),
    "BT-006": (OK_EMAIL.replace("thank you", "the best rate"), "email", None, "standard", 40),
    "FSMA-001": (OK_EMAIL.replace("thank you", "guaranteed growth") + " " + DC.RISK_DISCLOSURE + " 14-day",
                 "email", "PR-019", "standard", 40),
    "FSMA-002": (OK_EMAIL + " 14-day", "email", "PR-019", "standard", 40),
    "FSMA-003": (OK_EMAIL.replace("thank you", "you should invest") + " " + DC.RISK_DISCLOSURE + " 14-day",
                 "email", "PR-019", "standard", 40),
    "FSMA-004": (OK_EMAIL, "email", "PR-003", "standard", 40),
    "FSMA-005": (OK_EMAIL.replace("Full terms and conditions apply.", "No fee."), "email", None, "standard", 40),
    "MIFID-001": (OK_EMAIL.replace("thank you", "returns of 7%") + " " + DC.RISK_DISCLOSURE + " 14-day",
                  "email", "PR-019", "standard", 40),
    "MIFID-002": (OK_EMAIL + " " + DC.RISK_DISCLOSURE + " 14-day", "email", "PR-019", "standard", 70),
    "MIFID-003": (OK_EMAIL.replace("thank you", "compared to the market average"), "email", None, "standard", 40),
    "PERS-001": (OK_EMAIL.replace("As you have been with us for 4 years", "Your fixed rate ends"), "email", None, "standard", 40),
    "PERS-002": (OK_EMAIL, "email", "PR-005", "student", 40),
    "PERS-003": (OK_EMAIL, "email", "PR-004", "standard", 40),
    "CH-001": (OK_EMAIL.replace(DC.UNSUBSCRIBE_LINE, ""), "email", None, "standard", 40),
    "CH-002": (OK_CALL.replace(DC.OPT_OUT_STATEMENT, "Hello."), "call", None, "standard", 40),
    "CH-003": ("Security alert! " + OK_CALL, "call", None, "standard", 40),
    "CH-004": (OK_EMAIL.replace("A loyalty offer for you", "Action required on your account"), "email", None,
               "standard", 40),
}


@pytest.fixture(scope="module")
def checked(spark):
    rows = []
    for rid, (bad, ch, offer, seg, age) in CASES.items():
        rows.append((rid, "bad", bad, ch, offer, seg, age))
        clean = OK_CALL if ch == "call" else OK_EMAIL
        if offer in DC.INVESTMENT_OFFERS and rid != "MIFID-002":
            clean = clean + " " + DC.RISK_DISCLOSURE + " 14-day"
        if rid == "MIFID-002":
            clean, age = clean + " " + DC.RISK_DISCLOSURE + " 14-day", 40
        if rid in ("PERS-002", "PERS-003", "FSMA-004"):
            offer = "PR-001"
        rows.append((rid, "clean", clean, ch, offer, "standard", age))
    df = spark.createDataFrame(rows, "rule string, kind string, message_draft string, channel string, "
                                     "offer_id string, segment string, age int")
    out = DC.compliance(df).select("rule", "kind", F.transform("violated_rules", lambda v: v["rule_id"]).alias("ids"),
                                   "status")
    return {(r.rule, r.kind): (r.ids, r.status) for r in out.collect()}


@pytest.mark.parametrize("rule", list(CASES))
def test_rule_pair(checked, rule):
    bad_ids, bad_status = checked[(rule, "bad")]
    clean_ids, _ = checked[(rule, "clean")]
    assert rule in bad_ids
    assert rule not in clean_ids
    sev = dict(DC.RULES)[rule]
    if sev == DC.HARD:
        assert bad_status == "fail"


def test_review_decisions(spark):
    q = spark.createDataFrame([
        (1, 10, "draft one", "pending", None, None),
        (2, 20, "draft two", "pending", None, None),
        (3, 30, "draft three", "pending", None, None),
        (4, 40, "draft four", "pending", None, None),
        (5, 50, "draft five", "pending", None, None),
    ], "id long, customer_id long, message_draft string, status string, reviewed_by string, reviewed_at timestamp")
    q = q.withColumn("batch_date", F.lit(dt.date(2024, 1, 1))).withColumn("offer_id", F.lit("PR-001")) \
        .withColumn("channel", F.lit("email")).withColumn("churn_reason", F.lit("inactivity"))
    t = dt.datetime(2024, 1, 2)
    dec = spark.createDataFrame([
        (1, "approved", "r1", None, t),                        # approve unedited
        (2, "approved", "r1", "new text", t),                  # approve edited
        (3, "rejected", "r2", None, t),                        # reject
        (99, "approved", "r3", None, t),                       # unknown id: ignored
        (4, "approved", "r1", None, t), (4, "rejected", "r2", None, t + dt.timedelta(hours=1)),  # twice
        (5, "approved", "r1", "  draft five ", t),            # "edit" equal after trimming: not an edit
    ], "queue_id long, decision string, reviewer string, edited_draft string, decided_at timestamp")
    rev = {r.id: r for r in RV.apply_decisions(q, dec).collect()}
    assert [rev[i].status for i in (1, 2, 3, 4)] == ["approved", "approved", "rejected", "rejected"]
    assert rev[2].message_draft == "new text" and rev[1].message_draft == "draft one"
    assert len(rev) == 5 and rev[5].message_draft == "draft five" and not rev[5].draft_edited
    mirrored = RV.mirrored_approvals(RV.apply_decisions(q, dec)).collect()
    assert [m.customer_id for m in mirrored] == [20] and mirrored[0].agent1_tokens == 0
    all_m = RV.mirrored_approvals(RV.apply_decisions(q, dec), mirror_all=True).collect()
    assert sorted(m.customer_id for m in all_m) == [10, 20, 50]


def test_golden_agreement(spark):
    rows = [
        ("g1", "inactivity", "email", None, "standard", 40, "pass", [], OK_EMAIL),
        ("g2", "inactivity", "email", None, "standard", 40, "fail", ["CH-001"],
         OK_EMAIL.replace(DC.UNSUBSCRIBE_LINE, "")),
        ("g3", "service_dissatisfaction", "call", None, "standard", 40, "pass", [], OK_CALL),
        ("g4", "service_dissatisfaction", "call", None, "standard", 40, "pass", [],   # expected wrongly
         "Security alert! " + OK_CALL),
    ]
    g = spark.createDataFrame(rows, "example_id string, churn_reason string, channel string, offer_id string, "
                                    "segment string, age int, expected_status string, expected_rules array<string>, "
                                    "body string")
    out = {(r.churn_reason, r.channel): (r.examples, r.status_agreement, r.rules_agreement)
           for r in DC.golden_agreement(g).collect()}
    assert out[("inactivity", "email")] == (2, 2, 2)
    assert out[("service_dissatisfaction", "call")] == (2, 1, 1)


def test_batch_history(spark):
    from moorline.operators.dashboard import batch_history
    b = spark.createDataFrame([(dt.date(2024, 1, 1), 8, 2), (dt.date(2024, 2, 1), 5, 5), (dt.date(2024, 3, 1), 9, 1)],
                              "batch_date date, approved_count long, review_count long")
    runs = spark.createDataFrame([(dt.date(2024, 1, 10), 0.8), (dt.date(2024, 1, 20), 0.9),
                                  (dt.date(2024, 2, 5), 0.6), (dt.date(2024, 3, 9), 0.95)],
                                 "run_date date, precision double")
    h = {r.month: r for r in batch_history(b, runs).collect()}
    assert h[dt.date(2024, 1, 1)].model_precision == 0.9 and h[dt.date(2024, 1, 1)].pass_rate == 0.8
    assert h[dt.date(2024, 2, 1)].precision_pass_rate_corr > 0.9


def test_catalogue_frames(spark):
    offers = DC.offers_frame(spark)
    rules = DC.rules_frame(spark)
    assert offers.count() == 25 and rules.count() == 21
    assert rules.where("severity = 'hard_block'").count() == 13
    assert offers.where("retention_use_case = 'inactivity'").count() == 5


def test_disclosure_modes(spark):
    para = (OK_EMAIL + " Please note the value of investments can go down as well as up, and past performance "
            "does not guarantee future results. 14-day cooling-off applies.")
    df = spark.createDataFrame([(para, "email", "PR-019", "standard", 40)],
                               "message_draft string, channel string, offer_id string, segment string, age int")

    def ids(mode):
        r = DC.compliance(df, disclosure_mode=mode).first()
        return [v.rule_id for v in r.violated_rules], r.status
    strict_ids, strict_status = ids("strict")
    equiv_ids, equiv_status = ids("equivalent")
    assert "FSMA-002" in strict_ids and strict_status == "fail"
    assert "FSMA-002" not in equiv_ids


def _ids(spark, rows, **columns):
    schema = "message_draft string, channel string, offer_id string, segment string, age int, region string, " \
             "next_rate_end date, product_names array<string>"
    out = DC.compliance(spark.createDataFrame(rows, schema))
    return [[v.rule_id for v in r.violated_rules] for r in out.collect()]


def test_own_values_are_personal_signals(spark):
    plain = OK_EMAIL.replace("As you have been with us for 4 years", "Hi")
    end = dt.date(2024, 5, 1)
    row = lambda text: (text, "email", None, "standard", 40, "Flanders", end, ["Promo product"])
    got = _ids(spark, [row(plain), row(plain + " in flanders"), row(plain + " until 2024-05-01"),
                       row(plain + " your PROMO product"), row(plain + " in Wallonia until 2024-06-01")])
    assert ["PERS-001" in g for g in got] == [True, False, False, False, True]


def test_opening_of_a_call_is_counted_in_words(spark):
    filler = lambda n: " ".join(["word"] * n)
    opt = "stop contacting you"
    row = lambda text: (text, "call", None, "standard", 40, None, None, None)
    w = DC.OPENING_WORDS
    got = _ids(spark, [row(f"loyalty call {filler(w - 5)} {opt} since you joined"),
                       row(f"loyalty call {filler(w - 4)} {opt} since you joined"),
                       row(f"{opt} {filler(w - 5)} loyalty call since you joined"),
                       row(f"{opt} {filler(w - 4)} loyalty call since you joined")])
    assert ["CH-002" in g for g in got] == [False, True, False, False]
    assert ["CH-003" in g for g in got] == [False, False, False, True]


def test_line_breaks_do_not_hide_a_disclosure(spark):
    text = OK_EMAIL + " value can go down as well as up.\nPast performance is no guide. 14-day"
    df = spark.createDataFrame([(text, "email", "PR-019", "standard", 40)],
                               "message_draft string, channel string, offer_id string, segment string, age int")
    assert "FSMA-002" not in [v.rule_id for v in DC.compliance(df, disclosure_mode="equivalent").first().violated_rules]


def test_amounts_keep_ranges_and_ceilings():
    assert DC.offer_value("PR-001") == "up to €96" and DC.offer_value("PR-008") == "typically €30 to €90"
    assert DC.offer_value("PR-014") == "€4 to €15" and DC.offer_value("PR-020") == "€100 plus up to €96"
    assert DC.offer_value("PR-009") == ""


def test_written_rows_are_sanitised_and_have_audit_columns(spark):
    df = spark.createDataFrame([(1, "PR-001", "call", "inactivity", "low", "a — “b”", "approved", [], 7),
                                (2, None, "call", "inactivity", "low", "c — d", "queued", [], None)],
                               "customer_id long, offer_id string, channel string, churn_reason string, confidence string, "
                               "message_draft string, outcome string, violated_rules array<string>, agent1_tokens int")
    a = DC.approved_rows(df, dt.date(2024, 1, 1)).first()
    assert "—" not in a.message_draft and "“" not in a.message_draft
    assert (a.agent1_tokens, a.agent2_tokens) == (7, 0) and a.approved_at is not None
    q = DC.queued_rows(df, dt.date(2024, 1, 1)).first()
    assert "—" not in q.message_draft and q.created_at is not None and q.reviewed_by is None and q.reviewed_at is None


def test_later_draft_wins_unless_empty(spark):
    df = spark.createDataFrame([(1, "a", "b"), (2, "a", ""), (3, "a", None)], "id int, message_draft string, later string")
    assert [r.message_draft for r in DC.merge_drafts(df, "later").orderBy("id").collect()] == ["b", "a", "a"]
