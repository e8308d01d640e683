"""The keyed store against a dict, and what its writes and reads touch."""

import random

import pytest
from pyspark.sql import functions as F

from moorline.sources.keyed_store import KeyedStore

SCHEMA = "customer_id long, day date, doc string"


def _df(spark, rows):
    return spark.createDataFrame([(c, None, t) for c, t in rows], SCHEMA).coalesce(1)


def _state(store):
    return {r.customer_id: r.doc for r in store.read().collect()}


def _bytes(path):
    return sum(p.stat().st_size for p in path.rglob("*.parquet") if "_log" not in str(p))


def test_random_writes_equal_a_dict(spark, tmp_path):
    rng = random.Random(2)
    store, want = KeyedStore(spark, str(tmp_path / "s"), ["customer_id"], buckets=4), {}
    store.upsert(_df(spark, [(0, "first")]))
    want[0] = "first"
    for step in range(12):
        ids = rng.sample(range(30), 6)
        kind = step % 4
        if kind == 0:
            store.upsert(_df(spark, [(i, f"u{step}") for i in ids]))
            want |= {i: f"u{step}" for i in ids}
        elif kind == 1:
            new = {r.customer_id for r in store.insert_absent(_df(spark, [(i, f"n{step}") for i in ids])).collect()}
            assert new == set(ids) - set(want)
            want |= {i: f"n{step}" for i in new}
        elif kind == 2:
            store.delete(_df(spark, [(i, None) for i in ids]))
            want = {k: v for k, v in want.items() if k not in ids}
        else:
            store.compact(0.3)
        assert _state(store) == want, step
    keep = sorted(want)[::2]
    store.retain(_df(spark, [(i, None) for i in keep]))
    assert _state(store) == {k: want[k] for k in keep}
    assert {r.customer_id for r in store.lookup(_df(spark, [(k, None) for k in [*keep[:2], 999]])).collect()} == set(keep[:2])


def test_written_bytes_follow_the_batch(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "s"), ["customer_id"], buckets=4)
    store.upsert(spark.range(20000).select(F.col("id").alias("customer_id"), F.lit(None).cast("date").alias("day"),
                                           F.sha2(F.col("id").cast("string"), 512).alias("doc")))
    base = _bytes(tmp_path / "s")
    store.upsert(_df(spark, [(i, "changed") for i in range(10)]))
    store.delete(_df(spark, [(i, None) for i in range(10, 20)]))
    assert _bytes(tmp_path / "s") - base < base / 50
    assert store.read().count() == 19990
    assert store.compact(0.5) == []                      # nearly everything is current
    store.upsert(store.read().withColumn("doc", F.lit("x")))
    assert store.compact(0.5) == [0, 1, 2, 3]


def test_reads_open_only_the_files_that_count(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "s"), ["customer_id"], buckets=8)
    for step in range(3):
        store.upsert(_df(spark, [(i, f"v{step}") for i in range(64)]))
    before = len(store.read().inputFiles())
    files = store.read()._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in files and before == 24
    one = store.lookup(_df(spark, [(5, None)]))
    assert [r.doc for r in one.collect()] == ["v2"]
    assert sorted(store.compact()) == list(range(8))
    assert _state(store) == {i: "v2" for i in range(64)}
    live = store._live(store.history())
    assert live.select("_kept_seq").distinct().count() == 1


def test_inserts_look_at_their_own_dates_only(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "s"), ["day", "customer_id"], buckets=2, partitions=("day",))

    def rows(day, ids):
        return spark.createDataFrame([(i, f"m{i}") for i in ids], "customer_id long, doc string") \
            .select("customer_id", F.lit(day).cast("date").alias("day"), "doc")
    store.insert_absent(rows("2024-01-01", range(5)))
    assert store.insert_absent(rows("2024-01-02", range(5))).count() == 5
    assert store.insert_absent(rows("2024-01-02", range(8))).count() == 3
    assert store.insert_absent(rows("2024-01-02", range(8))).count() == 0
    assert store.read().count() == 13
    assert "day" in str(store._touched(rows("2024-01-02", range(2))))


def test_faults(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "s"), ["customer_id"])
    assert store.read() is None and store.compact() == []
    store.upsert(_df(spark, [(1, "b"), (1, "a"), (None, "n")]))
    assert _state(store) == {1: "a", None: "n"}
    store.upsert(_df(spark, [(None, "m")]))
    store.upsert(_df(spark, []))
    assert _state(store) == {1: "a", None: "m"}
    with pytest.raises(ValueError):
        store.upsert(spark.createDataFrame([(1,)], "customer_id long"))
    for p in (tmp_path / "s" / "_log").glob("*.parquet"):
        p.write_bytes(b"not parquet")
    with pytest.raises(Exception):
        store.read()
