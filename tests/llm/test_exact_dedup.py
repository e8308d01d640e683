import collections
import os

from pyspark.sql import functions as F

from moorline.llm import exact_dedup as X
from moorline.llm.common import work_uri

from . import helpers as H


def _check(rows, docs):
    groups = collections.defaultdict(list)
    for i, t in docs:
        groups[t or ""].append(i)
    expected = collections.Counter()
    for t, ids in groups.items():
        named = [i for i in ids if i is not None]
        keep = max(named) if named else None
        for i in ids:
            expected[(i, keep, len(ids), i is not None and i == keep)] += 1
    assert collections.Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in rows) == expected


def test_edges(spark):
    _check(X.exact_dedup(H.edges(spark)).collect(), H.EDGES)
    assert X.exact_dedup(H.empty(spark)).collect() == []


def test_colliding_digests_are_told_apart(spark):
    docs = [(i, f"text {i % 7}") for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    _check(X.exact_dedup(df, digest=lambda t: F.substring(X.sha256(t), 1, 0)).collect(), docs)


def test_state_goes_on_between_batches_and_runs(spark):
    base = work_uri(spark, "test-stream")
    for part in ([(1, "a"), (2, "b")], [(3, "a")], [(4, "a"), (5, "c")]):
        X.land(spark.createDataFrame(part, "doc_id bigint, text string").coalesce(1), f"{base}/landing")
        X.dedup_stream(spark, f"{base}/landing", f"{base}/state", f"{base}/log", files_per_trigger=1)
    seen = sorted((r.keep_id, r.group_size) for r in X.seen_digests(spark, f"{base}/log").collect())
    assert seen == [(2, 1), (4, 3), (5, 1)]


def test_keep_rows_keeps_columns_and_one_text_each(spark):
    docs = H.edges(spark)
    kept = X.keep_rows(docs)
    assert kept.columns == docs.columns
    texts = [r.text or "" for r in kept.where("doc_id is not null").collect()]
    assert set(texts) == {t or "" for _, t in H.EDGES} - {""} | {""}
    assert collections.Counter(texts)["Mit License"] == 1  # rows repeated under the identifier that stays are one
    assert kept.where("doc_id is null").count() == 0       # its texts have copies with an identifier


def test_keep_rows_of_a_table_united_with_itself(spark):
    docs = H.edges(spark).unionByName(spark.createDataFrame([(None, "only nulls"), (None, "only nulls")], "doc_id bigint, text string"),
                                      allowMissingColumns=True)

    def kept(df):
        return collections.Counter((r.doc_id, r.text or "") for r in X.keep_rows(df).collect())
    once = kept(docs)
    assert kept(docs.unionByName(docs)) == once and set(once.values()) == {1} and once[(None, "only nulls")] == 1


def test_state_stores_are_closed_with_their_tasks(spark):
    """Every open store has native threads and buffers of its own; none stays after the stream."""
    pid = spark.sparkContext._jvm.java.lang.ProcessHandle.current().pid()
    base, parts = work_uri(spark, "test-stores"), spark.conf.get("spark.sql.shuffle.partitions")
    X.land(spark.range(2000).selectExpr("id as doc_id", "cast(id % 700 as string) as text"), f"{base}/landing")
    before = len(os.listdir(f"/proc/{pid}/task"))
    spark.conf.set("spark.sql.shuffle.partitions", "48")
    try:
        X.dedup_stream(spark, f"{base}/landing", f"{base}/state", f"{base}/log")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    assert len(os.listdir(f"/proc/{pid}/task")) - before < 96
    assert X.seen_digests(spark, f"{base}/log").count() == 700
