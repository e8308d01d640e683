"""Queries: Structured Streaming paths (ST1, ST2).

Each run works in a fresh folder under the shared checkpoint directory
(stream checkpoints, sinks, request files), so reruns never collide.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import constants as K
from ..operators import model as MD
from ..session import materialize, shared_path
from ..sources.tables import table_path
from ..streaming import activity as ACT
from ..streaming import feature_state as FS
from ..streaming import scoring as SCR
from . import common as C
from .oracle_frag import FEATURES, MODEL_READY, sql_with
from .q_model import ROUNDS, _request_sql, _requests, _rounds_sql, _splits
from .registry import query


def _run_dir(spark, name):
    return shared_path(spark, f"moorline-stream/{name}-{uuid.uuid4().hex}")


@query("stream_score", sql_with(MODEL_READY, _request_sql()))
def stream_score(spark, sf_dir):
    """ST1: requests written as text files, scored by a streaming query, read back."""
    base = _run_dir(spark, "score")
    w = C.warehouse(spark, sf_dir)
    _requests(w).write.mode("overwrite").text(f"{base}/requests")
    out = SCR.run_scoring_stream(spark, f"{base}/requests", f"{base}/sink", f"{base}/checkpoint")
    return out.select("customer_id", "churn_score", "high_risk")


@query("stream_activity", """
SELECT user_id AS customer_id, CAST(ws AS DATE) AS window_start, CAST(ws + INTERVAL 30 DAY AS DATE) AS window_end,
       count(*) AS sessions
FROM (SELECT user_id, date_trunc('day', ts) - to_days(CAST(k AS INTEGER)) AS ws
      FROM events, range(0, 30) r(k) WHERE event_type = 'view') t
GROUP BY ALL""")
def stream_activity(spark, sf_dir):
    """ST2: 30-day sliding session counts from a watermarked stream over the events table."""
    base = _run_dir(spark, "activity")
    src = table_path(sf_dir, "events")
    schema = spark.read.parquet(src).schema
    # A table that is one file is picked out of its folder with a glob filter; a folder
    # of parts is streamed directly.  Which it is shows in the table's own file list.
    files = spark.read.parquet(src).inputFiles()
    if len(files) == 1 and files[0].endswith("/events.parquet"):
        return ACT.run_activity_stream(spark, sf_dir, f"{base}/log", f"{base}/checkpoint", schema,
                                       file_glob="events.parquet")
    return ACT.run_activity_stream(spark, src, f"{base}/log", f"{base}/checkpoint", schema)


@query("batch_activity", """
SELECT user_id AS customer_id, CAST(ws AS DATE) AS window_start, CAST(ws + INTERVAL 30 DAY AS DATE) AS window_end,
       count(*) AS sessions
FROM (SELECT user_id, date_trunc('day', ts) - to_days(CAST(k AS INTEGER)) AS ws
      FROM events, range(0, 30) r(k) WHERE event_type = 'view') t
GROUP BY ALL""")
def batch_activity(spark, sf_dir):
    """ST2 batch twin: the same windows computed on the static table."""
    return ACT.batch_activity(C.warehouse(spark, sf_dir).raw("events", ["user_id", "ts", "event_type"]))


LATE_DAYS = 35


@query("stream_features", sql_with(FEATURES, """
SELECT customer_id, app_logins_last_30d, app_logins_last_90d, competitor_transfer_count
FROM features_o WHERE app_logins_last_90d > 0 OR competitor_transfer_count > 0"""))
def stream_features(spark, sf_dir):
    """ST2: FT2-FT4 kept as incremental state.  Sessions and competitor transfers arrive in three
    steps, an eleventh of them one step late; a heartbeat moves the watermark to the snapshot, so that
    days have left the windows by event time.  Equal to the batch features."""
    base = _run_dir(spark, "features")
    w = C.warehouse(spark, sf_dir)
    rows = FS.activity(w.app_sessions(), w.transactions()).where(F.col("ts") <= F.lit(w.snapshot))
    third = F.floor(F.datediff("ts", F.lit(w.fold_start)) / 31)
    step = F.least(third + F.when(F.pmod(F.xxhash64("customer_id", "ts"), F.lit(11)) == 0, 1).otherwise(0), F.lit(2))
    rows = materialize(rows.withColumn("step", step))
    groups = max(1, rows.select("customer_id").distinct().count() // FS.CUSTOMERS_PER_GROUP)
    for k in range(3):
        part = rows.where(F.col("step") == k).drop("step")
        if k == 2:
            part = part.unionByName(FS.heartbeat(spark, w.snapshot, LATE_DAYS))
        part.write.mode("append").parquet(f"{base}/in")
        FS.run(spark, f"{base}/in", f"{base}/log", f"{base}/checkpoint", late_days=LATE_DAYS, groups=groups)
    out = FS.latest(spark, f"{base}/log")
    return out.where("app_logins_last_90d > 0 or competitor_transfer_count > 0").drop("as_of")


@query("stream_registry_score", sql_with(MODEL_READY + "," + _splits("model_o") + "," + _rounds_sql(ROUNDS), f"""
SELECT customer_id, round(1 / (1 + exp(-margin)), 4) AS churn_score, 1 / (1 + exp(-margin)) >= {K.HIGH_RISK_THRESHOLD} AS high_risk,
       '2' AS model_version FROM m{ROUNDS.trees}"""))
def stream_registry_score(spark, sf_dir):
    """ST1 + ML13: requests scored by the model that the registry names, resolved per micro-batch."""
    base = _run_dir(spark, "registry")
    mr = materialize(MD.with_splits(C.model_features(C.warehouse(spark, sf_dir))))
    model = MD.fit_gbt(mr.withColumn("split", F.when(F.col("split") == "train", F.lit("train"))), params=ROUNDS)
    model.save(spark, f"{base}/models/2")
    registry = spark.createDataFrame([("1", "retired"), ("2", "production"), ("3", "staging")], "version string, status string")
    mr.select(F.to_json(F.struct("customer_id", *K.FEATURE_COLUMNS)).alias("payload")).write.text(f"{base}/requests")
    return SCR.run_model_stream(spark, f"{base}/requests", f"{base}/sink", f"{base}/checkpoint",
                                SCR.RegistryModel(lambda: registry, f"{base}/models")).drop("batch")
