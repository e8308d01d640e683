"""The pipeline against a brute-force version, and the registry."""

import collections

import corpus_pipeline
import duckdb
import numpy as np

import __spark_entry__ as E
from moorline.llm import langid
from moorline.llm.common import written
from moorline.llm.queries import ORACLE, QUERIES, byte_bpe

from . import helpers as H
from .test_decontam import brute


def test_registry():
    for n in range(1, 14):
        assert sum(q.startswith(f"op{n}_") for q in E.queries()) == 1
    assert "pipeline" in E.queries() and set(ORACLE) <= set(QUERIES) <= set(E.queries())


def test_pipeline_equals_brute_force(spark):
    docs = spark.read.parquet(f"{H.SMALL}/documents.parquet")
    judged = langid.keep_rows(docs, langid.train(langid.sample(docs))).collect()
    last = {}
    for r in judged:
        last[r.text or ""] = max(last.get(r.text or "", -1), r.doc_id)
    rows = [(r.doc_id, r.text) for r in judged if last[r.text or ""] == r.doc_id]
    root, _ = H.components(rows, 5, 4, 5)
    rows = [(i, t) for i, t in rows if root[i] == i]
    items = duckdb.connect().execute(f"SELECT item_id, text FROM '{H.SMALL}/benchmark.parquet'").fetchall()
    bad = {x[0] for x in brute(rows, items) if x[4]}
    encode = byte_bpe()()
    expected = {i: len(encode(t)) + 1 for i, t in rows if i not in bad}
    got = collections.Counter()
    for r in corpus_pipeline.run(spark, H.SMALL).collect():
        got[r.doc_id] += r.length
    assert dict(got) == expected
    assert 0 < len(expected) < len(judged) and bad


def test_a_table_ingested_twice_gives_the_same_rows(spark):
    docs = spark.read.parquet(f"{H.SMALL}/documents.parquet")

    def kept(df):
        for _, stage in corpus_pipeline.STAGES[1:4]:
            df = written(stage(spark, df, H.SMALL), "test-stage")
        return sorted((r.doc_id, r.text) for r in df.collect())
    once = kept(docs)
    assert kept(docs.unionByName(docs)) == once and 0 < len(once) < docs.count()


def test_stages_on_edges(spark):
    docs = H.edges(spark)
    for name, stage in corpus_pipeline.STAGES[1:4]:
        out = stage(spark, docs, H.SMALL)
        assert out.columns == docs.columns, name
        assert stage(spark, H.empty(spark), H.SMALL).count() == 0


def test_last_stage_yields_the_token_ids(spark):
    docs = spark.createDataFrame([(1, "one two three"), (2, None), (3, "four " * 5000)], "doc_id bigint, text string")
    encode, got = byte_bpe()(), collections.defaultdict(list)
    for r in sorted(corpus_pipeline.pack(spark, docs, H.SMALL).collect(), key=lambda r: r.start):
        got[r.doc_id] += np.frombuffer(r.ids, dtype="<u4").tolist()
    assert got == {1: encode("one two three") + [1], 2: [1], 3: encode("four " * 5000) + [1]}
