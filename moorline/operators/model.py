"""Churn model: fit, score, threshold (ML3-ML5, ML10, PF1, PF6, PF12).

The classifier is the histogram booster of ``boosting`` with the reference's
hyper-parameters (trees, depth, leaves, learning rate, row and column sampling, min rows per
leaf, L1/L2, patience).  Early stopping uses rows carved out of the *training*
split (SEM8), never the test split.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from . import boosting as B
from .metrics import stratified_split


def with_splits(df: DataFrame, key: str = "customer_id", test_fraction: float = 0.2,
                val_fraction: float = 0.1, seed: int = 42, label: str = "churned") -> DataFrame:
    """Stratified train/validation/test assignment by key hash (stable under recomputation)."""
    return stratified_split(df, key, label, test_fraction, val_fraction, seed)


def fit_gbt(model_ready: DataFrame, label: str = "churned", params: B.Params = B.Params(),
            key: str = "customer_id") -> B.Booster:
    """ML3: boosted trees on the train rows; the validation rows decide how many are kept."""
    fold = F.when(F.col("split") == "train", 0).when(F.col("split") == "validation", 1)
    return B.fit(model_ready, list(K.FEATURE_COLUMNS), label, key, fold, params)


def score(model: B.Booster, model_ready: DataFrame, model_version: str,
          scored_at: dt.datetime | None = None) -> DataFrame:
    """ML4 / SEM7: probability of class 1 as ``churn_score`` plus version and time."""
    if scored_at is None:
        ts = F.current_timestamp()
    elif isinstance(scored_at, dt.datetime):
        ts = F.lit(scored_at.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    else:
        ts = scored_at
    return model_ready.select(
        *[c for c in model_ready.columns],
        model.score_column().alias("churn_score"),
        F.lit(str(model_version)).alias("model_version"),
        ts.alias("scored_at"),
    )


def high_risk(scored: DataFrame, threshold: float = K.HIGH_RISK_THRESHOLD) -> DataFrame:
    """PF6 + PF2: rows at or above the threshold with the output column list."""
    cols = ["customer_id", "segment", "region", "churn_score", "model_version", "scored_at"] + K.FEATURE_COLUMNS
    hr = scored.where(F.col("churn_score") >= F.lit(threshold))
    return hr.select(*[c for c in cols if c in scored.columns])


def first_n(batch: DataFrame, n: int) -> DataFrame:
    """PF12: ``--batch-size`` (0 = all), made deterministic: highest score first."""
    if not n:
        return batch
    return batch.orderBy(F.desc("churn_score"), F.asc("customer_id")).limit(n)


def feature_importance(model: B.Booster, spark) -> DataFrame:
    """ML10: share of the gain and number of splits per feature, highest first (12 rows,
    read from the model object)."""
    return spark.createDataFrame(model.importance(), "feature string, importance double, splits int").orderBy(
        F.desc("importance"), "feature")


# FIXED VALUES: our transparent logistic scorer (SQL-expressible baseline).
LINEAR_INTERCEPT = -2.0
LINEAR_WEIGHTS = {
    "days_since_last_login": 0.004,
    "competitor_transfer_count": 0.35,
    "complaints_open": 0.45,
    "months_to_rate_reset": -0.01,
    "avg_monthly_inflow_eur": -0.00002,
    "app_logins_last_30d": -0.05,
    "app_logins_last_90d": -0.01,
    "salary_account_flag": -0.6,
    "product_count": -0.3,
    "nps_score_last": -0.12,
    "segment_enc": 0.05,
    "region_enc": 0.02,
}


def linear_score_col(weights: dict | None = None, intercept: float = LINEAR_INTERCEPT,
                     places: int | None = 6):
    """The logistic score as a column expression over the model inputs."""
    w = weights or LINEAR_WEIGHTS
    z = F.lit(intercept)
    for c, coef in w.items():
        z = z + F.col(c).cast("double") * F.lit(coef)
    p = 1.0 / (1.0 + F.exp(-z))
    return F.round(p, places) if places is not None else p


def score_linear(model_ready: DataFrame, weights: dict | None = None,
                 intercept: float = LINEAR_INTERCEPT, places: int | None = 6) -> DataFrame:
    """Logistic score with fixed coefficients: a pure projection, fully codegen'd."""
    return model_ready.select("customer_id", "segment", "region",
                              linear_score_col(weights, intercept, places).alias("churn_score"))


def request_schema():
    from pyspark.sql.types import DoubleType, LongType, StructField, StructType
    fields = [StructField("customer_id", LongType())]
    fields += [StructField(c, DoubleType()) for c in K.FEATURE_COLUMNS]
    return StructType(fields)


def parse_requests(requests: DataFrame, payload: str = "payload") -> DataFrame:
    """ML5 input: each payload is one JSON object or a JSON list of objects;
    list payloads are exploded.  Unknown keys are ignored, malformed payloads
    give no rows."""
    sch = request_schema()
    from pyspark.sql.types import ArrayType
    p = F.trim(F.col(payload))
    as_list = F.when(p.startswith("["), F.from_json(p, ArrayType(sch))).otherwise(
        F.array(F.from_json(p, sch)))
    return requests.select(F.explode(as_list).alias("r")).where(F.col("r").isNotNull()).select("r.*")


def fill_request_defaults(req: DataFrame) -> DataFrame:
    """Per-request defaults for every missing feature (encoded columns default
    to the sorted index of the fallback category, SEM6)."""
    cols = [F.col("customer_id")]
    for c in K.FEATURE_COLUMNS:
        default = K.FEATURE_DEFAULTS[c][0] if c in K.FEATURE_DEFAULTS else K.ENCODED_DEFAULTS[c]
        cols.append(F.coalesce(F.col(c), F.lit(float(default))).alias(c))
    return req.select(*cols)


def score_requests(requests: DataFrame, scorer=None, threshold: float = K.HIGH_RISK_THRESHOLD,
                   payload: str = "payload") -> DataFrame:
    """ML5: JSON requests -> defaults -> score (rounded to 4) -> high_risk flag.
    ``scorer`` maps a filled DataFrame to one with ``churn_score`` (default:
    the linear scorer; pass ``lambda df: score(model, df, v)`` for the GBT)."""
    filled = fill_request_defaults(parse_requests(requests, payload))
    if scorer is None:
        scored = score_linear(filled.withColumn("segment", F.lit(None).cast("string"))
                              .withColumn("region", F.lit(None).cast("string")), places=None)
    else:
        scored = scorer(filled)
    return scored.select("customer_id", F.round(F.col("churn_score"), 4).alias("churn_score"),
                         (F.col("churn_score") >= F.lit(threshold)).alias("high_risk"))
