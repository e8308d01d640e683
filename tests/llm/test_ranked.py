"""Ranked search against the plain score of every document for every query."""

import collections
import math

import duckdb
import numpy as np
import pyarrow as pa

from moorline.llm import ranked as R
from moorline.llm.common import ALNUM_WORDS, split_words

from . import helpers as H


def brute(docs, items, k=10):
    words = [(i, collections.Counter(H.words(t))) for i, t in docs]
    n, total = sum(bool(w) for _, w in words), sum(sum(w.values()) for _, w in words)
    df = collections.Counter(t for _, w in words for t in w)
    out = []
    for item, text in items:
        scored = []
        for i, w in words:
            m = 10 + (90 * sum(w.values()) * n) // max(total, 1)
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10 ** 9 * w[t]) // (1000 * w[t] + 8 * m))
                        for t in set(H.words(text)) if w[t])
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, rank, r[3], -r[0]) for rank, r in enumerate(sorted(scored, key=lambda r: r[:3])[:k], 1)]
    return sorted(out, key=str)


def _search(spark, docs, items, **how):
    return sorted(map(tuple, R.search(R.index(docs), items, **how).collect()), key=str)


def test_equals_brute_force_in_blocks_of_queries(spark):
    docs = [(i, t) for i, t, _ in H.documents()]
    items = duckdb.connect().execute(f"SELECT item_id, text FROM '{H.SMALL}/benchmark.parquet'").fetchall()
    items += [(900, None), (901, "!!"), (902, "nowhereinthecorpus"), (items[0][0], items[0][1])]
    table = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    want = brute(docs, items)
    assert _search(spark, table, asked) == want
    assert _search(spark, table, asked, at_once=7) == want and len(want) > 300


def test_edges(spark):
    items = [(None, "mit license"), (2, "lorem x"), (3, "日本語 CC By é"), (4, None)]
    asked = spark.createDataFrame([(i, t, "x", "y") for i, t in items], "item_id bigint, text string, rank string, score string")
    assert _search(spark, H.edges(spark), asked) == brute(H.EDGES, items)
    assert _search(spark, H.empty(spark), asked) == []
    assert _search(spark, H.edges(spark), asked.limit(0)) == []


def test_skipping_loses_no_document():
    rng = np.random.default_rng(1)
    for case in range(60):
        n, k = 300, 10
        lists = []
        for _ in range(rng.integers(1, 9)):
            docs = np.flatnonzero(rng.random(n) < rng.choice([0.02, 0.1, 0.6, 1.0])).astype(np.int32)
            if len(docs):
                lists.append((docs, rng.integers(1, rng.choice([5, 5000]), len(docs))))
        total = np.zeros(n, dtype=np.int64)
        for docs, values in lists:
            total[docs] += values
        best = R._Best(k)
        if lists:
            ids = [int(x) for x in rng.permutation(n)]
            R.score_block(lists, ids, best, window=16)
            want = sorted((-int(s), i) for s, i in zip(total, ids) if s > 0)[:k]
            assert [(r[0], r[3]) for r in best.rows] == want, case


def test_words_are_those_of_the_pattern():
    texts = ["A-b  cÉ日 x\x1cy\x0b9", None, "", "   ", "Z"]
    codes, terms, at = split_words(pa.array(["skipped"] + texts)[1:], ALNUM_WORDS)
    got = [[terms[c].as_py() for c in codes[a:b]] for a, b in zip(at, at[1:])]
    assert got == [H.words(t) for t in texts]
