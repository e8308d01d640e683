"""Sources and sinks: partitioned feature table, versioned store, idempotent appends, CSV export."""

import datetime as dt

import pytest

from moorline import session
from moorline.sources import io as IO
from moorline.sources import sections


def test_feature_table_partition_overwrite(spark, tmp_path):
    path = str(tmp_path / "features")
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 2, 1)
    mk = lambda d, v: spark.createDataFrame([(1, d, v), (2, d, v)], "customer_id long, snapshot_date date, x int")
    IO.write_feature_table(mk(d1, 1), path, "v1")
    IO.write_feature_table(mk(d2, 2), path, "v1")
    IO.write_feature_table(mk(d1, 3), path, "v1")      # replaces only the d1 partition
    df = IO.read_feature_table(spark, path, start=d1, end=d2, dataset_version="v1")
    got = sorted((r.snapshot_date, r.x) for r in df.select("snapshot_date", "x").distinct().collect())
    assert got == [(d1, 3), (d2, 2)]
    one = IO.read_feature_table(spark, path, start=d2, end=d2)
    assert one.count() == 2


def test_versioned_store_upsert_and_retain(spark, tmp_path):
    store = IO.VersionedStore(spark, str(tmp_path / "profiles"))
    a = spark.createDataFrame([(1, "a1"), (2, "a2")], "customer_id long, doc string")
    store.upsert(a)
    store.upsert(spark.createDataFrame([(2, "b2"), (3, "b3")], "customer_id long, doc string"))
    assert sorted(tuple(r) for r in store.read().collect()) == [(1, "a1"), (2, "b2"), (3, "b3")]
    store.retain(spark.createDataFrame([(2,), (3,)], "customer_id long"))
    assert sorted(r.customer_id for r in store.read().collect()) == [2, 3]


def test_store_whose_log_is_damaged_is_an_error(spark, tmp_path):
    store = IO.VersionedStore(spark, str(tmp_path / "profiles"))
    store.upsert(spark.createDataFrame([(1, "a")], "customer_id long, doc string"))
    for p in (tmp_path / "profiles" / "_versions").glob("*.parquet"):
        p.write_bytes(b"not parquet")
    with pytest.raises(Exception, match="(?i)parquet|footer|schema"):
        store.upsert(spark.createDataFrame([(2, "b")], "customer_id long, doc string"))


def test_full_reload_empties_and_append_keeps(spark, tmp_path):
    base = str(tmp_path / "load")
    mk = lambda v: {"t": spark.createDataFrame([(v,)], "x int")}
    for population, v in (("a", 1), ("b", 2), ("b", 3)):
        IO.load_population(mk(v), base, population)
    assert sorted(tuple(r) for r in spark.read.parquet(f"{base}/t").collect()) == [(1, "a"), (3, "b")]
    IO.load_population(mk(4), base, "a")
    assert [tuple(r) for r in spark.read.parquet(f"{base}/t").collect()] == [(4, "a")]


def test_incoming_rows_with_one_key_are_one_row(spark, tmp_path):
    rows = spark.createDataFrame([(dt.date(2024, 1, 1), 1, "n"), (dt.date(2024, 1, 1), 1, "m")],
                                 "batch_date date, customer_id long, message_draft string")
    IO.append_idempotent(spark, rows, str(tmp_path / "q"))
    assert [r.message_draft for r in spark.read.parquet(str(tmp_path / "q")).collect()] == ["m"]


def test_parts_and_csv_are_read_back(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.5, ' a "b",\nc '), (2, None, None)], "customer_id long, churn_score double, note string")
    IO.write_csv(df, str(tmp_path / "batch"))
    assert IO.read_csv(spark, str(tmp_path / "batch"), df.schema).orderBy("customer_id").collect() == df.collect()
    df.write.parquet(str(tmp_path / "parts"))
    assert IO.load_parts(spark, str(tmp_path / "parts")).count() == 2
    df.limit(0).write.parquet(str(tmp_path / "none"))
    with pytest.raises(ValueError):
        IO.load_parts(spark, str(tmp_path / "none"))


def test_shared_folder_is_required_off_a_local_master(monkeypatch):
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()
    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Session())
    Conf.get = lambda self, key, default=None: "hdfs://nn/ckpt/"
    Context.getCheckpointDir = lambda self: "hdfs://nn/ckpt/"
    assert session.shared_path(Session(), "x") == "hdfs://nn/ckpt/x"


def test_idempotent_append(spark, tmp_path):
    path = str(tmp_path / "approved")
    rows = spark.createDataFrame([(dt.date(2024, 1, 1), 1, "m"), (dt.date(2024, 1, 1), 2, "n")],
                                 "batch_date date, customer_id long, message_draft string")
    IO.append_idempotent(spark, rows, path)
    IO.append_idempotent(spark, rows, path)            # rerun adds nothing
    assert spark.read.parquet(path).count() == 2


def test_export_existing_columns_and_clean(spark, tmp_path):
    df = spark.createDataFrame([(1, float("nan"), dt.datetime(2024, 1, 2, 3, 4))], "a long, b double, t timestamp")
    clean = IO.clean_for_load(df, ["t"])
    r = clean.first()
    assert r.b is None and r.t == dt.date(2024, 1, 2)
    out = str(tmp_path / "csv")
    IO.export_existing_columns(df, ["a", "missing"], out)
    back = spark.read.option("header", True).csv(out)
    assert back.columns == ["a"]


def test_metrics_json_roundtrip(spark, tmp_path):
    m = spark.createDataFrame([(0.8, 0.6, 0.69, 0.75, 0.1)],
                              "precision double, recall double, f1 double, auc double, false_positive_rate double")
    path = str(tmp_path / "metrics")
    IO.write_metrics(m, path)
    back = IO.read_metrics(spark, path, m.schema).first()
    assert back.precision == 0.8 and back.false_positive_rate == 0.1


def test_sections_become_typed_rows(spark, tmp_path):
    text = """# Catalogue

### A-1 - First thing

- **offer_id:** A-1
- **channel_fit:** email, call
- **offer_value:** Up to 5
  in two lines

---

### A-2 - Second

- **offer_id:** A-2
- **channel_fit:** call
"""
    (tmp_path / "c.md").write_text(text)
    s = sections.read_sections(spark, str(tmp_path))
    rows = sections.typed(s, {"offer_id": "string", "channel_fit": "array<string>", "offer_value": "string"}) \
        .orderBy("offer_id").collect()
    assert [tuple(r) for r in rows] == [("A-1 - First thing", "A-1", ["email", "call"], "Up to 5 in two lines"),
                                        ("A-2 - Second", "A-2", ["call"], None)]
