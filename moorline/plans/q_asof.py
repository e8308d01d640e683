"""Queries over several as-of dates: feature backfill (ML19, PF4) and drift of
the ten model features between two snapshots (ML15)."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from .. import constants as K
from ..operators import drift as DR
from ..operators import preprocess as PP
from ..session import materialize, shared_path
from ..sources import io as IO
from . import common as C
from .oracle_frag import features_at_sql
from .oracle_views import with_views
from .q_drift import DRIFT_BODY
from .registry import query

BACKFILL_DATES = [K.TEST_SNAPSHOT - dt.timedelta(days=14), K.TEST_SNAPSHOT - dt.timedelta(days=7), K.TEST_SNAPSHOT]
WINDOW = (BACKFILL_DATES[0], BACKFILL_DATES[1])
DRIFT_REFERENCE = K.TEST_SNAPSHOT - dt.timedelta(days=K.DRIFT_WINDOW_DAYS)
_FV = ("customers_v", "transactions_v", "app_sessions_v", "customer_products_v", "complaints_v", "nps_responses_v")


def _d(x: dt.date) -> str:
    return f"DATE '{x.isoformat()}'"


@query("feature_backfill", with_views(
    "WITH " + features_at_sql(_d(BACKFILL_DATES[0]), "a") + "," + features_at_sql(_d(BACKFILL_DATES[1]), "b")
    + "SELECT *, 'v1' AS dataset_version FROM feat_a UNION ALL SELECT *, 'v1' FROM feat_b", *_FV))
def feature_backfill(spark, sf_dir):
    """ML19 + PF4: three weekly snapshots computed in one pass into one partitioned
    table, then a two-week window read back (partition-pruned)."""
    w = C.warehouse(spark, sf_dir)
    path = shared_path(spark, f"moorline-io/backfill-{uuid.uuid4().hex}")
    rows = C.features_many(w, BACKFILL_DATES)
    IO.backfill(rows, path, "v1")
    out = IO.read_feature_table(spark, path, start=WINDOW[0], end=WINDOW[1], dataset_version="v1")
    return out.select(*rows.columns, "dataset_version")


@query("feature_manifest", with_views("""
SELECT 'v1' AS dataset_version, d AS snapshot_date, (SELECT count(*) FROM customers_v) AS n_rows,
       'customer_id,churned,salary_account_flag,segment,region,days_since_last_login,app_logins_last_30d,'
       || 'app_logins_last_90d,competitor_transfer_count,avg_monthly_inflow_eur,complaints_open,nps_score_last,'
       || 'product_count,months_to_rate_reset' AS columns
FROM (SELECT unnest([""" + ", ".join(_d(x) for x in BACKFILL_DATES) + "]) AS d)", "customers_v"))
def feature_manifest(spark, sf_dir):
    """ML18: the manifest of a feature table of three snapshots."""
    w = C.warehouse(spark, sf_dir)
    path = shared_path(spark, f"moorline-io/manifest-{uuid.uuid4().hex}")
    IO.backfill(C.features_many(w, BACKFILL_DATES), path, "v1")
    return IO.feature_manifest(spark, path)


def _fill(col: str) -> str:
    default = K.FEATURE_DEFAULTS[col][0]
    return f"CAST(COALESCE({col}, {default!r}) AS DOUBLE)"


def _long_sql() -> str:
    parts = []
    for tag, period in (("r", "reference"), ("p", "production")):
        for f in K.DRIFT_FEATURES:
            parts.append(f"SELECT '{f}' AS feature, {_fill(f)} AS value, '{period}' AS period FROM feat_{tag}")
    return "long AS (" + "\nUNION ALL ".join(parts) + ")"


def _feature_report(spark, sf_dir, reference):
    w = C.warehouse(spark, sf_dir)
    both = materialize(PP.model_ready(C.features_many(w, [reference, K.TEST_SNAPSHOT])))
    ref, prod = (both.where(F.col("snapshot_date") == F.lit(d)) for d in (reference, K.TEST_SNAPSHOT))
    return DR.drift_report(DR.feature_drift_input(ref, prod))


@query("feature_drift", with_views(
    "WITH " + features_at_sql(_d(DRIFT_REFERENCE), "r") + "," + features_at_sql(_d(K.TEST_SNAPSHOT), "p")
    + ",\n" + _long_sql() + "," + DRIFT_BODY + "SELECT * FROM rep", *_FV))
def feature_drift(spark, sf_dir):
    """ML15: drift of the ten model inputs between the snapshot one week
    earlier (reference) and the current snapshot (production)."""
    return _feature_report(spark, sf_dir, DRIFT_REFERENCE)


# Over eight weeks some inputs do drift, so that the alerts have rows.
ALERT_REFERENCE = K.TEST_SNAPSHOT - dt.timedelta(days=56)


@query("feature_drift_alerts", with_views(
    "WITH " + features_at_sql(_d(ALERT_REFERENCE), "r") + "," + features_at_sql(_d(K.TEST_SNAPSHOT), "p")
    + ",\n" + _long_sql() + "," + DRIFT_BODY + """
SELECT feature, metric, value, CAST(0.15 AS DOUBLE) AS threshold FROM (
  SELECT feature, 'wasserstein_norm' AS metric, wasserstein_norm AS value FROM rep
  UNION ALL SELECT feature, 'js_divergence', js_divergence FROM rep) u
WHERE value > 0.15""", *_FV))
def feature_drift_alerts(spark, sf_dir):
    """ML17: alert rows of the model-feature drift over eight weeks."""
    return DR.drift_alerts(_feature_report(spark, sf_dir, ALERT_REFERENCE))


@query("feature_drift_stored", with_views(
    "WITH " + features_at_sql(_d(DRIFT_REFERENCE), "r") + "," + features_at_sql(_d(K.TEST_SNAPSHOT), "p")
    + ",\n" + _long_sql() + "," + DRIFT_BODY + "SELECT * FROM rep", *_FV))
def feature_drift_stored(spark, sf_dir):
    """ML15: the same drift from stored counts: each snapshot is counted when it is taken, the reference
    window is never computed again."""
    path = shared_path(spark, f"moorline-io/drift-{uuid.uuid4().hex}")
    w = C.warehouse(spark, sf_dir)
    for d in (DRIFT_REFERENCE, K.TEST_SNAPSHOT):
        DR.store_counts(PP.model_ready(C.features_many(w, [d])), path)
    return DR.report_of_counts(DR.stored_counts(spark, path, (DRIFT_REFERENCE,) * 2, (K.TEST_SNAPSHOT,) * 2))
