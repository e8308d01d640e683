"""Queries that exercise the sinks end to end: write to a fresh folder under
the shared checkpoint directory, read back (IO4, IO5, IO16, PF4, ML18, SE3)."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import dashboard as DB
from ..operators import features as FT
from ..operators import marts as M
from ..operators import metrics as MT
from ..operators import model as MD
from ..session import shared_path
from ..sources import contract as CN
from ..sources import io as IO
from ..sources.keyed_store import KeyedStore
from . import common as C
from .oracle_frag import FEATURES, LABELS, MODEL_READY, sql_with
from .oracle_views import SNAP
from .q_metrics import _BM_SELECT, _metrics_select
from .q_model import _linear_sql
from .registry import query


def _run_dir(spark, name):
    return shared_path(spark, f"moorline-io/{name}-{uuid.uuid4().hex}")


@query("feature_table_roundtrip", sql_with(FEATURES, "SELECT *, 'v1' AS dataset_version FROM features_o"))
def feature_table_roundtrip(spark, sf_dir):
    """IO5 + ML18 + PF4: write the snapshot partitioned by dataset version and
    snapshot date, read back through a partition-pruned window filter."""
    w = C.warehouse(spark, sf_dir)
    path = _run_dir(spark, "features")
    IO.write_feature_table(C.features(w), path, "v1")
    out = IO.read_feature_table(spark, path, start=w.snapshot, end=w.snapshot, dataset_version="v1")
    return out.select(*C.features(w).columns, "dataset_version")


def _print(df, mart, key, columns):
    """(mart, key, content): the md5 of a row's fields, so that contents can be compared."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns])
    return df.select(F.lit(mart).alias("mart"), F.col(key).cast("string").alias("key"), F.md5(text).alias("content"))


def _print_sql(mart, key, columns, source):
    text = ", ".join(f"COALESCE(CAST({c} AS VARCHAR), '-')" for c in columns)
    return f"SELECT '{mart}' AS mart, CAST({key} AS VARCHAR) AS key, md5(concat_ws('|', {text})) AS content FROM {source}"


_MARTS = [
    ("approved_outreach", "id", ["customer_id", "batch_date", "offer_id", "channel", "churn_reason", "confidence",
                                 "message_draft", "agent1_tokens", "agent2_tokens", "agent3_tokens"], "approved_v"),
    ("compliance_review_queue", "id", ["customer_id", "batch_date", "offer_id", "channel", "churn_reason", "message_draft",
                                       "violated_rules", "status", "reviewed_by"], "queue_v"),
    ("customers", "customer_id", ["age", "region", "segment", "customer_since_date", "salary_account_flag", "churned",
                                  "churn_signal_count"], "cust"),
    ("product_holdings", "product_type", ["holdings"], "ph"),
    ("customer_features", "customer_id", ["churned", "days_since_last_login", "competitor_transfer_count",
                                          "complaints_open"], "cf"),
]
_MART_CTES = LABELS + f""",
cust AS (SELECT c.*, l.churned, l.churn_signal_count FROM customers_v c JOIN labels_o l ON c.customer_id = l.customer_id),
ph AS (SELECT p.product_type, count(*) AS holdings FROM customer_products_v cp
       JOIN products_v p ON cp.product_id = p.product_id WHERE cp.status = 'active' GROUP BY p.product_type),
cf AS (SELECT c.customer_id, CAST(c.churned AS INTEGER) AS churned,
              (SELECT date_diff('day', max(s.session_date), {SNAP}) FROM app_sessions_v s
               WHERE s.customer_id = c.customer_id) AS days_since_last_login,
              (SELECT count(*) FROM transactions_v t WHERE t.customer_id = c.customer_id AND t.is_competitor_transfer
               AND t.transaction_date >= {SNAP} - 90) AS competitor_transfer_count,
              (SELECT count(*) FROM complaints_v k WHERE k.customer_id = c.customer_id AND k.status = 'open')
                AS complaints_open
       FROM cust c)
"""
_MART_VIEWS = ("customers_v", "transactions_v", "app_sessions_v", "customer_products_v", "products_v", "complaints_v",
               "approved_v", "queue_v")


@query("marts_refresh", sql_with(_MART_CTES, "\nUNION ALL ".join(_print_sql(*m) for m in _MARTS), _MART_VIEWS))
def marts_refresh(spark, sf_dir):
    """IO16 + IO4: publish the five dashboard marts as parquet, read each back and compare its rows."""
    w = C.warehouse(spark, sf_dir)
    base = _run_dir(spark, "marts")
    marts = {
        "approved_outreach": w.approved(drafts=True),
        "compliance_review_queue": w.queue(drafts=True),
        "customers": C.labelled_customers(w),
        "product_holdings": M.holdings_by_type(w.customer_products(), w.products()),
        "customer_features": FT.feature_mart(w.customers(), C.labels(w), None, None, w.complaints(), w.snapshot,
                                             daily_s=C.daily_sessions(w), daily_t=C.daily_transactions(w)),
    }
    IO.refresh_marts(marts, base)
    return reduce(DataFrame.unionByName, [_print(IO.read_mart(spark, base, m), m, k, cols) for m, k, cols, _ in _MARTS])


@query("batch_csv_roundtrip", sql_with(MODEL_READY + f""",
sc AS (SELECT *, {_linear_sql()} AS churn_score FROM model_o)
""", "SELECT customer_id, segment, region, churn_score FROM sc WHERE churn_score >= 0.7"))
def batch_csv_roundtrip(spark, sf_dir):
    """IO7 + IO3: the high-risk batch written as CSV with a header and read back by schema."""
    mr = C.model_features(C.warehouse(spark, sf_dir))
    batch = MD.high_risk(mr.select("*", MD.linear_score_col().alias("churn_score"))) \
        .select("customer_id", "segment", "region", "churn_score")
    path = _run_dir(spark, "batch")
    IO.write_csv(batch, path)
    return IO.read_csv(spark, path, batch.schema)


@query("metrics_json_roundtrip", sql_with(_metrics_select(), _BM_SELECT, ("scored_v",)))
def metrics_json_roundtrip(spark, sf_dir):
    """IO18: the metrics record written as JSON and read back by schema."""
    m = MT.binary_metrics(C.warehouse(spark, sf_dir).scored())
    path = _run_dir(spark, "metrics")
    IO.write_metrics(m, path)
    return IO.read_metrics(spark, path, m.schema)


@query("feature_parts", sql_with(FEATURES, "SELECT customer_id, snapshot_date, churned FROM features_o"))
def feature_parts(spark, sf_dir):
    """IO2: a folder of feature parts read as one table."""
    w = C.warehouse(spark, sf_dir)
    path = _run_dir(spark, "parts")
    C.features(w).repartition(4, "customer_id").write.parquet(path)
    return IO.load_parts(spark, path).select("customer_id", "snapshot_date", "churned")


_LOAD_SQL = "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{p}' AS population, count(*) AS n FROM {t}_v WHERE {k} % 2 = {r} GROUP BY ALL"
    for t, k in (("customers", "customer_id"), ("complaints", "complaint_id")) for p, r in (("a", 0), ("b", 1)))


@query("population_load", sql_with("x AS (SELECT 1)", _LOAD_SQL, ("customers_v", "complaints_v")))
def population_load(spark, sf_dir):
    """IO6 + IO8 + IO9: two populations loaded, then the first reloaded in full (which empties
    the tables) and the second loaded again, twice."""
    w = C.warehouse(spark, sf_dir)
    base = _run_dir(spark, "load")

    def part(r):
        return {"customers": IO.clean_for_load(w.customers().where(F.col("customer_id") % 2 == r)),
                "complaints": IO.clean_for_load(w.complaints().where(F.col("complaint_id") % 2 == r), ["opened_date"])}
    for population, r in (("b", 1), ("a", 0), ("b", 1), ("b", 1)):
        IO.load_population(part(r), base, population)
    return reduce(DataFrame.unionByName, [
        spark.read.parquet(f"{base}/{t}").groupBy("population").agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(t).alias("table_name"), "population", "n") for t in ("customers", "complaints")])


@query("load_cleaning", sql_with("x AS (SELECT 1)", """
SELECT event_id, CAST(ts AS DATE) AS ts, CASE WHEN event_id % 5 <> 0 THEN value END AS value FROM events"""))
def load_cleaning(spark, sf_dir):
    """IO9: NaN to NULL and timestamps to dates, on events of which every fifth value is NaN."""
    e = C.warehouse(spark, sf_dir).raw("events", ["event_id", "ts", "value"])
    e = e.withColumn("value", F.when(F.col("event_id") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("value")))
    return IO.clean_for_load(e, ["ts"])


@query("outreach_export", sql_with("x AS (SELECT 1)", """
SELECT id, customer_id, offer_id, channel, churn_reason FROM approved_v""", ("approved_v",)))
def outreach_export(spark, sf_dir):
    """IO17: CSV export of the wanted columns that exist, read back."""
    a = C.warehouse(spark, sf_dir).approved()
    path = _run_dir(spark, "export")
    IO.export_existing_columns(a, ["id", "customer_id", "offer_id", "channel", "churn_reason", "not_there"], path)
    return IO.read_csv(spark, path, a.select("id", "customer_id", "offer_id", "channel", "churn_reason").schema)


@query("batch_dates", sql_with("x AS (SELECT 1)", "SELECT DISTINCT batch_date FROM approved_v",
                               ("approved_v",)))
def batch_dates(spark, sf_dir):
    """SE3: distinct batch dates (the dashboard's batch selector)."""
    return DB.filter_outreach(C.warehouse(spark, sf_dir).approved()).select("batch_date").distinct()


@query("store_merge", sql_with("x AS (SELECT 1)", """
SELECT customer_id, region, CASE WHEN customer_id % 11 = 0 AND customer_id % 13 = 0 THEN 'returned'
                                 WHEN customer_id % 7 = 0 THEN 'moved' ELSE segment END AS segment
FROM customers_v WHERE customer_id % 11 <> 0 OR customer_id % 13 = 0""", ("customers_v",)))
def store_merge(spark, sf_dir):
    """IO11-IO14: customers kept in a keyed store: loaded, some changed, some deleted, some of those inserted again
    (where absent), half of the buckets' history folded, then merged on read."""
    rows = C.warehouse(spark, sf_dir).customers().select("customer_id", "region", "segment")
    key = F.col("customer_id")
    store = KeyedStore(spark, _run_dir(spark, "store"), ["customer_id"], buckets=8)
    store.upsert(rows)
    store.upsert(rows.where(key % 7 == 0).withColumn("segment", F.lit("moved")))
    store.delete(rows.where(key % 11 == 0))
    store.insert_absent(rows.where(key % 13 == 0).withColumn("segment", F.lit("returned")))
    store.compact(0.2)
    return store.read()


def _damaged(spark, sf_dir):
    """Customers without a column, with one too many, with numbers as texts, some of them no numbers, and lost keys."""
    c = C.warehouse(spark, sf_dir).raw("customer")
    key = F.col("c_custkey")
    path = _run_dir(spark, "damaged")
    c.select(F.when(key % 25 != 0, key).alias("c_custkey"), "c_name",
             F.when(key % 10 == 3, F.lit("n/a")).otherwise(F.col("c_nationkey").cast("string")).alias("c_nationkey"),
             "c_mktsegment", F.lit(1).alias("surplus")).write.parquet(path)
    return spark.read.parquet(path)


@query("schema_faults", """
SELECT * FROM (VALUES ('c_acctbal', 'missing', 'double', NULL), ('surplus', 'extra', NULL, 'int'),
                      ('c_nationkey', 'retyped', 'int', 'string')) t(column_name, fault, declared, found)""")
def schema_faults(spark, sf_dir):
    """IO1: the faults of a damaged copy of customers against its declared schema."""
    return CN.schema_faults(_damaged(spark, sf_dir), CN.TABLES["customer"])


@query("schema_quarantine", """
SELECT CASE WHEN c_custkey % 25 <> 0 THEN c_custkey END AS c_custkey, c_name,
       CASE WHEN c_custkey % 10 <> 3 THEN c_nationkey END AS c_nationkey, CAST(NULL AS DOUBLE) AS c_acctbal, c_mktsegment,
       CASE WHEN c_custkey % 25 = 0 THEN 'c_custkey' WHEN c_custkey % 10 = 3 THEN 'c_nationkey' ELSE '' END AS faults
FROM customer""")
def schema_quarantine(spark, sf_dir):
    """IO1 + IO9: every row of the damaged copy, those that fit in the declared types, the others quarantined
    under the columns that do not fit."""
    good, bad = CN.conform(_damaged(spark, sf_dir), CN.TABLES["customer"], CN.KEYS["customer"])
    raw = F.from_json("raw", "c_custkey bigint, c_name string, c_nationkey string, c_mktsegment string")
    held = bad.select(raw.alias("r"), F.array_join("faults", ",").alias("faults")).select(
        "r.c_custkey", "r.c_name", F.col("r.c_nationkey").try_cast("int").alias("c_nationkey"),
        F.lit(None).cast("double").alias("c_acctbal"), "r.c_mktsegment", "faults")
    return good.withColumn("faults", F.lit("")).unionByName(held)
