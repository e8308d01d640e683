"""End-to-end jobs as Spark applications.

    python -m moorline.plans.jobs train  --sf-dir DIR --out DIR
    python -m moorline.plans.jobs weekly --sf-dir DIR --out DIR [--model DIR | --scorer linear]

Each step reads what the previous one wrote (feature table, model, CSV batch,
profile store, outreach tables, marts), so a failed run can be resumed and a
rerun is idempotent.  Only one-row metric records reach the driver.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..operators import boosting as B
from ..operators import decisions as DC
from ..operators import features as FT
from ..operators import marts as M
from ..operators import metrics as MT
from ..operators import model as MD
from ..operators import preprocess as PP
from ..operators import profiles as PR
from ..operators import registry as RG
from ..session import build_session, materialize
from ..sources import io as IO
from ..sources.keyed_store import KeyedStore
from . import common as C


def train(spark: SparkSession, sf_dir: str, out: str, params: B.Params = B.Params(),
          dataset_version: str = "v1") -> dict:
    """Path A: feature table -> GBT fit -> test metrics -> gate -> registry + model."""
    w = C.warehouse(spark, sf_dir)
    IO.write_feature_table(C.features(w), f"{out}/features", dataset_version)
    feats = IO.read_feature_table(spark, f"{out}/features", w.snapshot, w.snapshot, dataset_version)
    mr = materialize(MD.with_splits(PP.model_ready(feats)))
    model = MD.fit_gbt(mr, params=params)
    scored = MD.score(model, mr.where(F.col("split") == "test"), "candidate")
    metrics = MT.binary_metrics(scored.select(F.col("churned").alias("label"), F.col("churn_score").alias("score")))
    IO.write_metrics(metrics, f"{out}/metrics")
    m = metrics.first().asDict()
    passed = m["precision"] >= K.PRECISION_GATE
    version = None
    if passed:
        path = f"{out}/registry"
        version = RG.next_version(spark.read.parquet(path) if IO.exists(spark, path) else None)
        model.save(spark, f"{out}/models/{version}")
        reg = spark.createDataFrame([(version, "staging", dataset_version, str(w.snapshot), m["precision"],
                                      m["recall"], m["f1"], m["auc"])],
                                    "version string, status string, dataset_version string, snapshot_date string, "
                                    "precision double, recall double, f1 double, auc double")
        reg.write.mode("append").parquet(path)
    return {"passed_gate": passed, "version": version, **m}


def resolve_model(spark: SparkSession, out: str) -> str:
    """Folder of the production model, else of the newest staging one, else an error."""
    path = f"{out}/registry"
    best = RG.resolve(spark.read.parquet(path)).first() if IO.exists(spark, path) else None
    if best is None:
        raise LookupError(f"no production or staging model in {path}; train one or name a scorer")
    return f"{out}/models/{best.version}"


def weekly(spark: SparkSession, sf_dir: str, out: str, model_path: str | None = None,
           scorer: str = "model") -> dict:
    """Path B: score -> high-risk CSV -> profile store -> decisions -> outreach
    tables -> dashboard marts.  The model is the one given or else the registry's;
    ``scorer="linear"`` asks for the fixed coefficients instead."""
    w = C.warehouse(spark, sf_dir)
    feats = C.features(w)
    raw = feats.select("customer_id", F.col("nps_score_last").alias("nps_raw"),
                       F.col("months_to_rate_reset").alias("mrr_raw"))
    mr = PP.model_ready(feats).join(raw, "customer_id")
    if scorer == "model":
        model_path = model_path or resolve_model(spark, out)
        scored = MD.score(B.load(spark, model_path), mr, os.path.basename(model_path.rstrip("/")))
    else:
        scored = mr.select("*", MD.linear_score_col().alias("churn_score"),
                           F.lit("linear").alias("model_version"), F.current_timestamp().alias("scored_at"))
    batch = materialize(scored.where(F.col("churn_score") >= K.HIGH_RISK_THRESHOLD))
    IO.write_csv(MD.high_risk(batch), f"{out}/high_risk_batch")

    store = KeyedStore(spark, f"{out}/profiles", ["customer_id"])
    docs = PR.profile_documents(MD.high_risk(batch), w.customer_products(), w.products(), None, w.complaints(),
                                None, w.snapshot, daily_s=C.daily_sessions(w), daily_t=C.daily_transactions(w))
    store.upsert(docs)
    store.retain(batch.select("customer_id"))

    ctx = materialize(DC.decision_context(batch, w.customers(), w.customer_products(), w.products(),
                                          w.complaints(), None, store.read(), w.snapshot,
                                          daily_t=C.daily_transactions(w)))
    decided = materialize(DC.decide(ctx))
    IO.append_idempotent(spark, DC.approved_rows(decided, w.snapshot), f"{out}/approved_outreach")
    IO.append_idempotent(spark, DC.queued_rows(decided, w.snapshot), f"{out}/compliance_review_queue")

    IO.refresh_marts({
        "approved_outreach": spark.read.parquet(f"{out}/approved_outreach"),
        "compliance_review_queue": spark.read.parquet(f"{out}/compliance_review_queue"),
        "customers": C.labelled_customers(w),
        "product_holdings": M.holdings_by_type(w.customer_products(), w.products()),
        "customer_features": FT.feature_mart(w.customers(), C.labels(w), None, None, w.complaints(), w.snapshot,
                                             daily_s=C.daily_sessions(w), daily_t=C.daily_transactions(w)),
    }, f"{out}/marts")
    counts = {r.outcome: r.n for r in DC.batch_counters(decided).collect()}   # at most three rows
    return {"approved": counts.get("approved", 0), "queued": counts.get("queued", 0),
            "errors": counts.get("error", 0)}


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="moorline-jobs")
    ap.add_argument("job", choices=["train", "weekly"])
    ap.add_argument("--sf-dir", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--model")
    ap.add_argument("--scorer", choices=["model", "linear"], default="model")
    ap.add_argument("--master")
    a = ap.parse_args(argv)
    spark = build_session(a.master, app_name=f"moorline-{a.job}")
    result = train(spark, a.sf_dir, a.out) if a.job == "train" else weekly(
        spark, a.sf_dir, a.out, a.model, a.scorer)
    print(result)


if __name__ == "__main__":
    main()
