import hashlib
import random
import re

from moorline.llm import secrets as S
from moorline.llm.common import work_uri

from . import helpers as H


def _ci(word):
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


PATTERNS = {
    "assign": (re.compile("(?:" + "|".join(_ci(w) for w in ("password", "passwd", "secret", "token")) + "|" + _ci("api")
                          + "_?" + _ci("key") + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 1, 8),
    "access": (re.compile("AKIA[A-Z0-9]+"), 0, 16),
    "hex": (re.compile("[0-9a-f]+"), 0, 32),
}


def brute(text):
    out = []
    for order, (kind, (pattern, group, least)) in enumerate(PATTERNS.items()):
        out += [(m.start(), order, kind, m.end()) for m in pattern.finditer(text or "") if len(m.group(group)) >= least]
    return sorted(out)


def _check(rows, docs):
    got = sorted(((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in rows), key=str)
    expected = []
    for i, t in docs:
        spans = brute(t)
        joined = ",".join(f"{k}:{s}:{e}" for s, _, k, e in spans)
        expected.append((i, *[sum(x[2] == k for x in spans) for k in PATTERNS], hashlib.sha256(joined.encode()).hexdigest()))
    assert got == sorted(expected, key=str)


def test_edges_and_documents(spark):
    _check(S.digest_columns(S.scan(H.edges(spark))).collect(), H.EDGES)
    assert S.scan(H.empty(spark)).collect() == []
    docs = [(i, t) for i, t, _ in H.documents()]
    _check(S.digest_columns(S.scan(spark.createDataFrame(docs, "doc_id bigint, text string"))).collect(), docs)


def test_random_texts(spark):
    rng = random.Random(5)
    parts = ["password", "Token", "api_key", "APIKEY", "secret", "=", ":", " ", '"', "'", "abcdefgh", "1234", "AKIA", "ABCDEFGHIJKL",
             "deadbeef" * 4, "é", "/", "-----BEGIN RSA PRIVATE KEY-----", "🙂", "\n"]
    docs = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))) for i in range(400)]
    _check(S.digest_columns(S.scan(spark.createDataFrame(docs, "doc_id bigint, text string"))).collect(), docs)


def test_ledger_scans_only_unseen_pairs(spark):
    ledger = S.BlobLedger(spark, work_uri(spark, "test-ledger"))
    one = spark.createDataFrame([(1, "AKIA" + "A" * 16), (2, "nothing"), (3, "AKIA" + "A" * 16)], "doc_id bigint, text string")
    got = ledger.scan(one, S.BASE, "r1").collect()
    assert sorted((r.doc_id, len(r.found)) for r in got) == [(1, 1), (2, 0), (3, 1)]
    assert ledger.read().where("run = 'r1'").count() == 2
    two = one.union(spark.createDataFrame([(4, "a" * 40)], "doc_id bigint, text string"))
    got = ledger.scan(two, S.BASE, "r2").collect()
    assert sorted((r.doc_id, len(r.found)) for r in got) == [(1, 1), (2, 0), (3, 1), (4, 1)]
    assert ledger.read().where("run = 'r2'").count() == 1
    raised = [S.Rule("access", r"AKIA[A-Z0-9]+", "length:30", version=2), S.BASE[2]]
    got = ledger.scan(two, raised, "r3").collect()
    assert sorted((r.doc_id, len(r.found)) for r in got) == [(1, 0), (2, 0), (3, 0), (4, 1)]
    assert {tuple(r.rules) for r in ledger.read().where("run = 'r3'").collect()} == {("access@2",)}


def test_added_kinds(spark):
    text = "ghp_" + "a" * 36 + " xoxb-1234567890-abc -----BEGIN EC PRIVATE KEY----- AIza" + "b" * 35 + " https://u:pw@h/ "
    row = S.scan(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert {x.kind for x in row.found} >= {"github", "slack", "private_key", "google", "url_login"}
    assert all(text[x.start:x.end] for x in row.found)


def test_input_split_anew_between_jobs(spark, monkeypatch):
    docs = [(i, f"{i} AKIA" + "A" * 16 if i % 3 else "password = abcdefgh1234") for i in range(100)]
    with H.moving(spark, monkeypatch, S, docs, "doc_id bigint, text string") as df:
        ledger = S.BlobLedger(spark, work_uri(spark, "test-ledger"))
        assert {(r.doc_id, len(r.found)) for r in ledger.scan(df, S.BASE, "r1").collect()} == {(i, 1) for i in range(100)}
        assert ledger.read().count() == ledger.read().select("digest").distinct().count() == len({t for _, t in docs})
