"""Repeated passages against the plain search for equal strings."""

import collections
import random

import numpy as np
import pytest

from moorline.llm import suffixes as S

from . import helpers as H


def brute(docs, keep, length):
    """Spans and kept bytes of (row, doc_id, text), places ordered by identifier (null last) and row."""
    places = collections.defaultdict(list)
    order = sorted(docs, key=lambda d: (d[1] is None, d[1] or 0, d[0]))
    data = {row: (text or "").encode() for row, _, text in docs}
    for nth, (row, _, _) in enumerate(order):
        for i in range(len(data[row]) - length + 1):
            places[data[row][i:i + length]].append((nth, i, row))
    gone = {row: np.zeros(len(b), dtype=bool) for row, b in data.items()}
    for found in places.values():
        if len(found) > 1:
            for _, i, row in (sorted(found)[1:] if keep == "first" else found):
                gone[row][i:i + length] = True
    out = []
    for row, doc_id, _ in docs:
        edge = np.flatnonzero(np.diff(np.concatenate([[0], gone[row].astype(np.int8), [0]])))
        kept = bytes(b for b, g in zip(data[row], gone[row]) if not g)
        out.append((doc_id, len(data[row]), [tuple(x) for x in edge.reshape(-1, 2).tolist()], kept))
    return sorted(out, key=str)


def _got(df):
    return sorted(((r.doc_id, r.n_bytes, [tuple(x) for x in r.spans], bytes(r.kept)) for r in df.collect()), key=str)


def _mixed():
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdeéß日", k=rng.randint(2, 7)))
    passages = [" ".join(word() for _ in range(rng.choice([30, 45, 90]))) for _ in range(6)]
    docs = []
    for i in range(160):
        parts = [" ".join(word() for _ in range(rng.randint(0, 60)))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            cut = rng.randint(0, 40)
            parts += [p[cut:] if rng.random() < 0.5 else p, word()]
        docs.append((i, rng.choice([i, i, None]), " ".join(parts)))
    docs += [(200, 5, "ab" * 900), (201, 6, "ab" * 300 + "c"), (202, 7, docs[3][2]), (203, 3, docs[3][2]),
             (204, 8, passages[0][:199]), (205, 9, None), (206, 10, "")]
    return docs


@pytest.mark.parametrize("keep", ["first", "none"])
@pytest.mark.parametrize("most", [1 << 19, 300])
def test_equals_brute_force(spark, keep, most):
    docs = _mixed()
    table = spark.createDataFrame([(i, t) for _, i, t in docs], "doc_id bigint, text string").coalesce(1)
    got = _got(S.dedup(table, keep, most=most, batch=4000, table_bits=1 << 15))
    assert got == brute(docs, keep, 200)
    assert sum(len(r[2]) for r in got) > 100


def test_documents_of_the_small_table(spark):
    docs = [(n, i, t) for n, (i, t, _) in enumerate(H.documents())]
    table = spark.createDataFrame([(i, t) for _, i, t in docs], "doc_id bigint, text string").repartition(4)
    assert _got(S.dedup(table, "none")) == brute(docs, "none", 200)


def test_edges(spark, monkeypatch):
    monkeypatch.setattr(S, "SEGMENT", 5000)
    docs = [(n, i, t[:30000] if t else t) for n, (i, t) in enumerate(H.EDGES)]
    table = H.edges(spark)
    short = table.withColumn("text", table.text.substr(1, 30000)).coalesce(1)
    assert _got(S.dedup(short, "none", length=50)) == brute(docs, "none", 50)
    whole = {r.doc_id: r for r in S.dedup(table).collect()}
    assert bytes(whole[6].kept).startswith(b"password = abcdefgh1234") and bytes(whole[7].kept) == b""
    assert S.dedup(H.empty(spark)).collect() == []


def test_factors_equal_the_plain_definition():
    rng = np.random.default_rng(5)
    for _ in range(40):
        n, width = int(rng.integers(1, 60)), 6
        strings = rng.integers(97, 99, (n, width)).astype(np.uint8)
        share = [[int(np.argmin(np.append(a == b, False))) for b in strings] for a in strings]
        previous, following = S.factors(strings)
        assert previous.tolist() == [max(share[i][:i], default=0) for i in range(n)]
        assert following.tolist() == [max(share[i][i + 1:], default=0) for i in range(n)]
