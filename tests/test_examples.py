"""Message examples from files through the rule checks, and a catalogue from sections through the offers."""

from pyspark.sql import functions as F

from moorline.operators import catalogue as CT
from moorline.operators import decisions as DC
from moorline.sources import sections

from test_catalogue import _customers
from test_decisions import OK_CALL, OK_EMAIL


def _example(path, name, channel, status, rules, body):
    (path / f"{name}.md").write_text(f"---\nexample_id: {name}\nchurn_reason: inactivity\nchannel: {channel}\nsegment: standard\n"
                                     f"customer_signal: days: 40\nstatus: {status}\nviolated_rules: {rules}\n---\n\n{body}\n")


def _golden(examples):
    f = F.col("fields")
    return examples.select(*[f[c].alias(c) for c in ("example_id", "churn_reason", "channel", "offer_id", "segment")],
                           F.lit(40).alias("age"), "expected_status", "expected_rules", "body")


def test_examples_are_read_and_a_wrong_rule_shows(spark, tmp_path):
    _example(tmp_path, "A-01", "email", "pass", "[]", OK_EMAIL)
    _example(tmp_path, "A-02", "email", "fail", "[CH-001]", OK_EMAIL.replace(DC.UNSUBSCRIBE_LINE, ""))
    _example(tmp_path, "A-03", "call", "pass", "[]", "Security alert! " + OK_CALL)
    _example(tmp_path, "A-04", "email", "fail", "[CH-001, BT-001]", OK_EMAIL)
    (tmp_path / "notes.md").write_text("no head here\n---\nnone")
    read = sections.read_examples(spark, str(tmp_path))
    by = {r.fields.get("example_id"): r for r in read.collect()}
    assert by["A-02"].expected_rules == ["CH-001"] and by["A-02"].fields["customer_signal"] == "days: 40"
    assert by["A-01"].body == OK_EMAIL.strip() and by[None].body.startswith("no head") and by[None].expected_status is None
    golden = _golden(read.where(F.col("expected_status").isNotNull()))
    agree = {(r.churn_reason, r.channel): (r.examples, r.status_agreement, r.rules_agreement) for r in DC.golden_agreement(golden).collect()}
    assert agree == {("inactivity", "email"): (3, 2, 2), ("inactivity", "call"): (1, 0, 0)}
    different = {(r.example_id, r.rule_id): (r.expected, r.found) for r in DC.golden_differences(golden).collect()}
    assert different[("A-03", "CH-003")] == (False, True) and different[("A-04", "BT-001")] == (True, False)
    assert not any(e in ("A-01", "A-02") for e, _ in different)


def test_a_catalogue_written_as_sections_decides_the_offers(spark, tmp_path):
    (tmp_path / "offers.md").write_text("""# Offers

### X-1 One

- **offer_id:** X-1
- **retention_use_case:** inactivity
- **target_segment:** standard, student
- **required:** dsl > 1, age 0-40
- **any_of:** no_rm, pc>=2

### X-2 Two

- **offer_id:** X-2
- **retention_use_case:** inactivity
- **target_segment:** starter
""")
    none = F.array().cast("array<string>")
    offers = sections.typed(sections.read_sections(spark, str(tmp_path)), {
        "offer_id": "string", "retention_use_case": "string", "target_segment": "array<string>", "required": "array<string>",
        "any_of": "array<string>"}).select("offer_id", "retention_use_case", F.col("target_segment").alias("target_segments"),
                                           F.coalesce("required", none).alias("required"), F.coalesce("any_of", none).alias("any_of"))
    import random
    customers = _customers(spark, 300, random.Random(9))
    got = {(r.customer_id, r.offer_id) for r in CT.eligible_pairs(customers, offers, CT.conditions(offers)).collect()}
    want = set()
    for r in customers.where("churn_reason = 'inactivity'").collect():
        if r.segment == "starter":
            want.add((r.customer_id, "X-2"))
        if r.segment in ("standard", "student") and (r.days_since_last_login or 0) > 1 and r.age is not None and r.age <= 40 \
                and (r.relationship_manager_id is None or (r.product_count or 0) >= 2):
            want.add((r.customer_id, "X-1"))
    assert got == want and {o for _, o in want} == {"X-1", "X-2"}
