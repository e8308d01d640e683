"""Scalar functions: month boundaries, encoding, text normalisation, JSON."""

import datetime as dt

from pyspark.sql import functions as F

from moorline.functions import text as TX
from moorline.functions.dates import full_months, month_boundaries
from moorline.operators.preprocess import encode
from moorline import constants as K


def test_month_boundaries(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 31), dt.date(2024, 2, 1)),
                                (dt.date(2024, 3, 15), dt.date(2024, 1, 20))], "a date, b date")
    out = [r[0] for r in df.select(month_boundaries(F.col("a"), F.col("b"))).collect()]
    assert out == [1, -2]
    full = [r[0] for r in df.select(full_months(F.col("a"), F.col("b"))).collect()]
    assert full == [0, -2]


def test_encoding_fallbacks(spark):
    df = spark.createDataFrame([("private_banking",), ("student",), (None,), ("Standard",), ("vip",)], "s string")
    out = [r[0] for r in df.select(encode(F.col("s"), K.SEGMENT_CATEGORIES, K.SEGMENT_FALLBACK)).collect()]
    assert out == [0, 3, 1, 1, 1]


def test_normalize_reason(spark):
    vals = ["Price_Sensitivity", " competitor fee concerns", "mortgage rate reset soon", None, "",
            "disengaged / dormant", '["service issue nps", "x"]', "something else", "NPS complaint about price"]
    df = spark.createDataFrame([(v,) for v in vals], "r string")
    out = [r[0] for r in df.select(TX.normalize_reason(F.col("r"))).collect()]
    assert out == ["price_sensitivity", "price_sensitivity", "product_lifecycle", "unknown", "unknown",
                   "inactivity", "service_dissatisfaction", "unknown", "service_dissatisfaction"]
    # idempotent
    df2 = spark.createDataFrame([(v,) for v in out], "r string")
    assert [r[0] for r in df2.select(TX.normalize_reason(F.col("r"))).collect()] == out


def test_normalize_migration_keeps_null_and_case(spark):
    df = spark.createDataFrame([("Price_Sensitivity",), (None,), ("rate  reset later",), ("x",)], "r string")
    out = [r[0] for r in df.select(TX.normalize_reason_migration(F.col("r"))).collect()]
    assert out == ["Price_Sensitivity", None, "product_lifecycle", "unknown"]


def test_sanitize(spark):
    df = spark.createDataFrame([("‘a’ “b” – c — d\xa0e\x15f",)], "t string")
    assert df.select(TX.sanitize(F.col("t"))).first()[0] == "'a' \"b\" - c - d ef"


def test_extract_json(spark):
    rows = ['```json\n{"a": 1}\n```', 'Sure! {"a": {"b": 2}} done', 'not json', '{"a": [1,}',
            '{"confidence_level": "high"}']
    df = spark.createDataFrame([(r,) for r in rows], "t string")
    out = [r[0] for r in df.select(TX.extract_json_text(F.col("t"))).collect()]
    assert out == ['{"a": 1}', '{"a": {"b": 2}}', None, None, '{"confidence_level": "high"}']
    conf = df.select(TX.json_field(TX.extract_json_text(F.col("t")), "confidence", "confidence_level")).collect()
    assert conf[4][0] == "high"


def test_violation_ids(spark):
    rows = ['[]', '[{"rule_id": "BT-001", "severity": "hard_block"}]',
            '[{"rule_id": "CH-001"}, "BT-005"]', '[bad json', '[{"severity": "flag_for_review"}]']
    df = spark.createDataFrame([(r,) for r in rows], "v string")
    out = [r[0] for r in df.select(TX.violation_ids(F.col("v"))).collect()]
    assert out == [[], ["BT-001"], ["CH-001", "BT-005"], [], ["unknown"]]
    dropped = [r[0] for r in df.select(TX.violation_ids(F.col("v"), None)).collect()]
    assert dropped[4] == []


def test_rounding_of_binary_quotients(spark):
    from moorline.functions.numeric import round_half_even_binary
    got = {r.id: r.x for r in spark.range(0, 8000).select("id", round_half_even_binary(F.col("id"), 60).alias("x")).collect()}
    assert all(got[n] == round(n / 60, 1) for n in got)
    assert got[9] == 0.1 and got[15] == 0.2


def test_text_that_only_begins_like_a_list(spark):
    from moorline.functions.text import normalize_reason
    df = spark.createDataFrame([("[bad rate reset",), ('["inactivity", "x"]',), ("[]",), (None,)], "s string")
    assert [r[0] for r in df.select(normalize_reason(F.col("s"))).collect()] == \
        ["product_lifecycle", "inactivity", "unknown", "unknown"]


def test_prefix_sums_and_row_numbers_equal_a_sort(spark):
    import random
    from moorline.functions import ordered
    rng = random.Random(6)
    rows = [(g, v, rng.randint(0, 9)) for g in ("a", "b", None, "lonely") for v in rng.sample(range(1000), 1 if g == "lonely" else 200)]
    df = spark.createDataFrame(rows, "g string, v long, n long").repartition(5)
    for inclusive in (True, False):
        got = {(r.g, r.v): (r.cum_n, r.prev_v) for r in ordered.prefix_sums(
            df.where("g is not null"), "v", ["n"], ["g"], buckets=7, inclusive=inclusive, with_prev=True).collect()}
        for g in ("a", "b", "lonely"):
            total, last = 0, None
            for _, v, n in sorted(r for r in rows if r[0] == g):
                assert got[(g, v)] == (total + (n if inclusive else 0), last)
                total, last = total + n, v
    one = {r.v: r.cum_n for r in ordered.prefix_sums(df.where("g = 'a'"), "v", ["n"]).collect()}
    assert max(one.values()) == sum(n for g, _, n in rows if g == "a")
    numbers = [(r.row_number, r.v, r.g) for r in ordered.row_numbers(df, F.desc("v"), F.asc("g")).collect()]
    want = sorted(rows, key=lambda r: (-r[1], r[0] is not None, r[0] or ""))
    assert sorted(numbers) == [(i, v, g) for i, (g, v, _) in enumerate(want, 1)]
    assert ordered.row_numbers(df.limit(0), "v").count() == 0
