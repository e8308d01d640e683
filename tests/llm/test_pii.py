import hashlib
import random
import re

from moorline.llm import pii as P

from . import helpers as H

PATTERNS = {"email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
            "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
            "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")}


def _luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _fits(kind, m):
    digits = re.sub("[^0-9]", "", m)
    return {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m.split(".")),
            "card": lambda: 13 <= len(digits) <= 19 and _luhn(digits), "phone": lambda: 9 <= len(digits) <= 15}[kind]()


def brute(text):
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in p.finditer(text or "") if _fits(k, m.group())]


def _check(rows, docs):
    got = sorted(((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in rows), key=str)
    expected = []
    for i, t in docs:
        spans = brute(t)
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        expected.append((i, *[sum(x[0] == k for x in spans) for k in PATTERNS], hashlib.sha256(joined.encode()).hexdigest()))
    assert got == sorted(expected, key=str)


def test_edges_and_documents(spark):
    short = [(i, t) for i, t in H.EDGES if t is None or not re.search("[0-9]{9000}|(a.b-c){9000}|x{9000}", t)]
    _check([r for r in P.digest_columns(P.find(H.edges(spark))).collect() if r.doc_id in {i for i, _ in short}], short)
    assert P.find(H.empty(spark)).collect() == []
    docs = [(i, t) for i, t, _ in H.documents()]
    _check(P.digest_columns(P.find(spark.createDataFrame(docs, "doc_id bigint, text string"))).collect(), docs)


def test_random_texts(spark):
    rng = random.Random(6)
    parts = ["a", "b.c", "@", ".", "-", "x-y", "1", "12", "255", "256", "0001", " ", "+", "(", ")", "4111 1111 1111 1111",
             "4111-1111-1111-1112", "+49 170 1234567", "é", "🙂", "10.0.0.1", "_", "%", "\n"]
    docs = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))) for i in range(600)]
    _check(P.digest_columns(P.find(spark.createDataFrame(docs, "doc_id bigint, text string"))).collect(), docs)


def test_terms_that_disclose_are_generalised_or_removed(spark):
    docs = [(i, f"note {w}{i} from zanzibar ann@x.org about the {w}") for i, w in enumerate(["tea", "rice", "salt", "corn"])]
    docs += [(10 + i, f"the note about tea and rice from {i}") for i in range(20)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    found = {r.doc_id: r.found for r in P.find(df).collect()}
    text = docs[0][1]
    assert [text[x.start:x.end] for x in found[0] if x.kind == "removed"] == ["zanzibar"]
    assert all(x.kind != "removed" for i in range(10, 30) for x in found[i])
    clean = {r.doc_id: r.text for r in P.sanitise(df).collect()}
    assert "zanzibar" not in clean[0] and "ann@" not in clean[0] and "[EMAIL]" in clean[0]
    assert clean[10] == docs[4][1]


def test_many_matches_of_one_text(spark):
    text = " ".join(f"a{i}@b.c é 10.0.{i % 256}.1" for i in range(3000))
    docs = [(1, text), (2, "4111 1111 1111 1111 " * 700), (3, "12 " * 5000 + "+4917012345678")]
    _check(P.digest_columns(P.find(spark.createDataFrame(docs, "doc_id bigint, text string"))).collect(), docs)


def test_luhn(spark):
    rng = random.Random(7)
    digits = ["".join(rng.choice("0123456789") for _ in range(rng.randint(1, 19))) for _ in range(300)]
    df = spark.createDataFrame([(d,) for d in digits], "d string")
    assert [r[0] for r in df.select(P.luhn(df.d)).collect()] == [_luhn(d) for d in digits]


def _terms(spark, docs):
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    texts = dict(docs)
    return {r.doc_id: {texts[r.doc_id][x.start:x.end] for x in r.found if x.kind in ("general", "removed")}
            for r in P.find(df).collect()}


def test_terms_anywhere_in_the_document_disclose(spark):
    far = [(i, f"Zanzibar project {'filler words of all ' * 50} n{i} {'y' * 200} ann@x.org {'more filler of all ' * 40} "
               f"\uae40\uc218 {'filler ' * 30} \u6771\u4eac{'\u90fd' * 200}") for i in range(4)]
    rest = [(10 + i, f"project filler words of all more {i}") for i in range(20)]
    got = _terms(spark, far + rest)
    want = {"Zanzibar", "\uae40\uc218", "y" * 200, "\u6771\u4eac" + "\u90fd" * 200}
    assert all(got[i] == want for i in range(4)) and all(not got[i] for i in range(10, 30))


def test_equal_texts_support_a_term_once(spark):
    rest = [(10 + i, f"the note about tea and rice from {i}") for i in range(20)]
    assert not any(_terms(spark, [(i, "zanzibar ann@x.org") for i in range(4)] + rest).values())


def test_input_split_anew_between_jobs(spark, monkeypatch):
    docs = [(i, f"n{i} from zanzibar ann@x.org" if i % 5 == 0 else f"n{i} from here") for i in range(100)]
    with H.moving(spark, monkeypatch, P, docs, "doc_id bigint, text string") as df:
        got = {(r.doc_id, *(dict(docs)[r.doc_id][x.start:x.end] for x in r.found)) for r in P.find(df).collect()}
        clean = {(r.doc_id, r.text) for r in P.sanitise(df).collect()}
    assert got == {(i, "ann@x.org", "zanzibar") if i % 5 == 0 else (i,) for i in range(100)}
    assert clean == {(i, f"n{i} from  [EMAIL]" if i % 5 == 0 else t) for i, t in docs}
