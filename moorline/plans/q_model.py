"""Queries: scoring, high-risk batch, GBT fit (ML3-ML5, ML10, PF1, PF6, PF12)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from .. import constants as K
from ..operators import boosting as B
from ..operators import metrics as MT
from ..operators import model as MD
from ..session import materialize
from . import common as C
from .oracle_frag import MODEL_READY, sql_with
from .registry import query

SCORED_AT = dt.datetime(2024, 1, 16, 6, 0, 0)


def scored_at_col():
    """The batch scoring time as a zone-free timestamp literal."""
    return F.lit(SCORED_AT.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def _linear_sql(src: str = "model_o") -> str:
    z = " + ".join(f"CAST({c} AS DOUBLE) * {w!r}" for c, w in MD.LINEAR_WEIGHTS.items())
    return f"round(1.0 / (1.0 + exp(-({MD.LINEAR_INTERCEPT!r} + {z}))), 6)"


@query("score_linear", sql_with(MODEL_READY, f"""
SELECT customer_id, segment, region, {_linear_sql()} AS churn_score FROM model_o"""))
def score_linear(spark, sf_dir):
    """ML4 / PF1: fixed-coefficient logistic score."""
    return MD.score_linear(C.model_features(C.warehouse(spark, sf_dir)))


_HR_COLS = ["customer_id", "segment", "region", "churn_score"] + K.FEATURE_COLUMNS


@query("high_risk_batch", sql_with(MODEL_READY + f""",
sc AS (SELECT *, {_linear_sql()} AS churn_score FROM model_o)
""", f"SELECT {', '.join(_HR_COLS)} FROM sc WHERE churn_score >= 0.7"))
def high_risk_batch(spark, sf_dir):
    """PF6 / PF2: rows at or above the high-risk threshold."""
    mr = C.model_features(C.warehouse(spark, sf_dir))
    return MD.high_risk(mr.select("*", MD.linear_score_col().alias("churn_score"))).select(*_HR_COLS)


@query("high_risk_first_n", sql_with(MODEL_READY + f""",
sc AS (SELECT *, {_linear_sql()} AS churn_score FROM model_o)
""", """SELECT customer_id, churn_score FROM sc WHERE churn_score >= 0.7
ORDER BY churn_score DESC, customer_id LIMIT 20"""))
def high_risk_first_n(spark, sf_dir):
    """PF12: first N of the batch, highest score first."""
    mr = C.model_features(C.warehouse(spark, sf_dir))
    return MD.first_n(MD.high_risk(MD.score_linear(mr)), 20).select("customer_id", "churn_score")


def _requests(w):
    """Scoring requests derived from the feature table: some omit keys (defaults
    apply), some arrive as JSON lists."""
    mr = C.model_features(w)
    drop = F.col("customer_id") % 3 == 0
    vals = [F.col("customer_id")] + [
        (F.when(~drop, F.col(c)) if c in ("nps_score_last", "months_to_rate_reset") else F.col(c)).alias(c)
        for c in K.FEATURE_COLUMNS]
    obj = F.to_json(F.struct(*vals))
    payload = F.when(F.col("customer_id") % 5 == 0, F.concat(F.lit("["), obj, F.lit("]"))).otherwise(obj)
    return mr.select(payload.alias("payload"))


def _request_sql():
    z = " + ".join(
        f"CAST(CASE WHEN customer_id % 3 = 0 THEN {K.FEATURE_DEFAULTS[c][0]!r} ELSE {c} END AS DOUBLE) * {w!r}"
        if c in ("nps_score_last", "months_to_rate_reset") else f"CAST({c} AS DOUBLE) * {w!r}"
        for c, w in MD.LINEAR_WEIGHTS.items())
    s = f"(1.0 / (1.0 + exp(-({MD.LINEAR_INTERCEPT!r} + {z}))))"
    return f"SELECT customer_id, round({s}, 4) AS churn_score, {s} >= 0.7 AS high_risk FROM model_o"


@query("score_requests", sql_with(MODEL_READY, _request_sql()))
def score_requests(spark, sf_dir):
    """ML5: per-request JSON scoring with defaults."""
    return MD.score_requests(_requests(C.warehouse(spark, sf_dir)))


# One fit per application and data set: the queries on the full model read the same one.
_FITTED: dict = {}


def fitted(spark, sf_dir):
    """The boosted trees (500 at most, patience 50) and the rows they were fitted on."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _FITTED:
        mr = materialize(MD.with_splits(C.model_features(C.warehouse(spark, sf_dir))))
        _FITTED[key] = (MD.fit_gbt(mr), mr)
    return _FITTED[key]


@query("score_gbt")
def score_gbt(spark, sf_dir):
    """ML3 + ML4: the boosted trees fitted on the train split, every customer scored.  No SQL
    engine can refit hundreds of sampled trees; ``gbt_rounds`` lets one refit the first rounds."""
    model, mr = fitted(spark, sf_dir)
    return MD.score(model, mr, "1", SCORED_AT).select(
        "customer_id", "split", "churned", "churn_score",
        (F.col("churn_score") >= K.HIGH_RISK_THRESHOLD).alias("high_risk"))


@query("feature_importance")
def feature_importance(spark, sf_dir):
    """ML10: importances of the same fit, highest first."""
    return MD.feature_importance(fitted(spark, sf_dir)[0], spark)


# Three rounds that SQL can follow: no sampling, two levels, and a leaf limit that leaves one of them unsplit.
ROUNDS = B.Params(trees=3, depth=2, leaves=3, rate=0.5, bins=16, row_fraction=1.0, column_fraction=1.0)


def _splits(u: str) -> str:
    return f"""
hs AS (SELECT *, CAST(('0x' || substr(md5('42:' || CAST(customer_id AS VARCHAR)), 1, 8)) AS BIGINT) AS u FROM {u}),
rs AS (SELECT *, count(*) OVER (PARTITION BY churned ORDER BY u) AS rk, count(*) OVER (PARTITION BY churned) AS n FROM hs),
sp AS (SELECT *, CASE WHEN rk <= floor(n * 0.2::DOUBLE + 0.5) THEN 'test'
                      WHEN rk <= floor(n * (0.2::DOUBLE + 0.1::DOUBLE) + 0.5) THEN 'validation' ELSE 'train' END AS split
       FROM rs)"""


def _leaf_sql(g: str, h: str, p: B.Params) -> str:
    return f"(-{p.rate!r} * sign({g}) * greatest(abs({g}) - {p.l1!r}, 0) / ({h} + {p.l2!r}))"


def _rounds_sql(p: B.Params) -> str:
    """CTEs that boost ``p.trees`` trees of two levels and three leaves; the last one is ``scored``."""
    def worth(g, h):
        return f"(greatest(abs({g}) - {p.l1!r}, 0) ** 2 / ({h} + {p.l2!r}))"
    values = ", ".join(f"CAST({c} AS DOUBLE)" for c in K.FEATURE_COLUMNS)
    at = ", ".join(repr(i / p.bins) for i in range(1, p.bins))
    out = [f"""
long AS (SELECT customer_id, split, unnest(range({len(K.FEATURE_COLUMNS)})) AS f, unnest([{values}]) AS v FROM sp),
edges AS (SELECT f, list_sort(list_distinct(list_filter(qs, lambda x: x < m))) AS es
          FROM (SELECT f, max(v) AS m, quantile_disc(v, [{at}]) AS qs FROM long WHERE split = 'train' GROUP BY f)),
binned AS (SELECT customer_id, split, f, CAST(len(list_filter(es, lambda x: x < v)) AS INT) AS bin FROM long JOIN edges USING (f)),
m0 AS (SELECT customer_id, split, CAST(churned AS DOUBLE) AS y, ln(p / (1 - p)) AS margin
       FROM sp, (SELECT avg(churned) AS p FROM sp WHERE split = 'train'))"""]
    for r in range(p.trees):
        def best(name, rows, part):
            over = f"PARTITION BY {part}f"
            gain = f"{worth('gl', 'hl')} + {worth('gt - gl', 'ht - hl')} - {worth('gt', 'ht')}"
            lead = part.replace(", ", "")
            return f"""
{name}h{r} AS (SELECT {part}f, bin, sum(g) AS g, sum(h) AS h, count(*) AS n FROM {rows} GROUP BY ALL),
{name}c{r} AS (SELECT {part}f, bin, sum(g) OVER (w ORDER BY bin) AS gl, sum(h) OVER (w ORDER BY bin) AS hl, sum(n) OVER (w ORDER BY bin) AS nl,
                      sum(g) OVER w AS gt, sum(h) OVER w AS ht, sum(n) OVER w AS nt FROM {name}h{r} WINDOW w AS ({over})),
{name}{r} AS (SELECT * FROM (
    SELECT *, row_number() OVER ({'PARTITION BY ' + lead if lead else ''} ORDER BY gain DESC, f, bin) AS nth FROM (
      SELECT *, round({gain}, {B.GAIN_PLACES}) AS gain FROM {name}c{r}
      WHERE nl >= {p.min_rows} AND nt - nl >= {p.min_rows} AND hl >= {p.min_hessian!r} AND ht - hl >= {p.min_hessian!r}))
  WHERE nth = 1 AND gain > 0)"""
        out.append(f"""
d{r} AS (SELECT *, q - y AS g, q * (1 - q) AS h FROM (SELECT *, 1 / (1 + exp(-margin)) AS q FROM m{r})),""" + best(
            "root", f"(SELECT f, bin, g, h FROM d{r} JOIN binned USING (customer_id) WHERE d{r}.split = 'train')", "") + f""",
side{r} AS (SELECT customer_id, b.bin > s.bin AS side FROM binned b JOIN root{r} s USING (f)),""" + best(
            "kid", f"(SELECT side, f, bin, g, h FROM d{r} JOIN side{r} USING (customer_id) JOIN binned USING (customer_id) "
                   f"WHERE d{r}.split = 'train')", "side, ") + f""",
pick{r} AS (SELECT * FROM kid{r} ORDER BY gain DESC, side LIMIT 1),
m{r + 1} AS (
  SELECT customer_id, d.split, y, margin + CASE
      WHEN k.side IS NOT NULL AND b.bin > k.bin THEN {_leaf_sql('(k.gt - k.gl)', '(k.ht - k.hl)', p)}
      WHEN k.side IS NOT NULL THEN {_leaf_sql('k.gl', 'k.hl', p)}
      WHEN i.side THEN {_leaf_sql('(s.gt - s.gl)', '(s.ht - s.hl)', p)}
      ELSE {_leaf_sql('s.gl', 's.hl', p)} END AS margin
  FROM d{r} d JOIN side{r} i USING (customer_id) CROSS JOIN root{r} s
  LEFT JOIN pick{r} k ON k.side = i.side LEFT JOIN binned b ON b.customer_id = d.customer_id AND b.f = k.f)""")
    out.append(f"""
scored AS (SELECT customer_id, split, CAST(y AS INT) AS churned, round(1 / (1 + exp(-margin)), 6) AS churn_score FROM m{p.trees})""")
    return ",".join(out)


def _first_rounds(spark, sf_dir):
    mr = materialize(MD.with_splits(C.model_features(C.warehouse(spark, sf_dir))))
    model = MD.fit_gbt(mr.withColumn("split", F.when(F.col("split") == "train", F.lit("train"))), params=ROUNDS)
    return mr.select("customer_id", "split", F.col("churned").cast("int").alias("churned"),
                     F.round(model.score_column(), 6).alias("churn_score"))


@query("gbt_rounds", sql_with(MODEL_READY + "," + _splits("model_o") + "," + _rounds_sql(ROUNDS), "SELECT * FROM scored"))
def gbt_rounds(spark, sf_dir):
    """ML3 + ML4: every customer's score after three rounds of boosting, refitted by the oracle
    (bin edges, gradients, best splits, leaf limit, L1/L2 leaf weights)."""
    return _first_rounds(spark, sf_dir)


QUALITY_THRESHOLD = 0.5


@query("gbt_quality", sql_with(MODEL_READY + "," + _splits("model_o") + "," + _rounds_sql(ROUNDS) + f""",
cm AS (SELECT split, count(*) AS n_rows, count(*) FILTER (churn_score >= {QUALITY_THRESHOLD} AND churned = 1) AS tp,
              count(*) FILTER (churn_score >= {QUALITY_THRESHOLD} AND churned = 0) AS fp,
              count(*) FILTER (churn_score < {QUALITY_THRESHOLD} AND churned = 0) AS tn,
              count(*) FILTER (churn_score < {QUALITY_THRESHOLD} AND churned = 1) AS fn FROM scored GROUP BY split),
rk AS (SELECT split, churned, rank() OVER (PARTITION BY split ORDER BY churn_score)
              + (count(*) OVER (PARTITION BY split, churn_score) - 1) / 2.0 AS r FROM scored),
au AS (SELECT split, (sum(r) FILTER (churned = 1) - p * (p + 1) / 2.0) / (p * (n - p)) AS auc
       FROM rk JOIN (SELECT split, sum(churned) AS p, count(*) AS n FROM scored GROUP BY split) USING (split) GROUP BY split, p, n)
""", """
SELECT split, round_even(coalesce(tp / nullif(tp + fp, 0), 0), 4) AS precision, round_even(coalesce(tp / nullif(tp + fn, 0), 0), 4) AS recall,
       round_even(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 4) AS f1, round_even(auc, 4) AS auc,
       round_even(coalesce(fp / nullif(fp + tn, 0), 0), 4) AS false_positive_rate, n_rows
FROM cm JOIN au USING (split)"""))
def gbt_quality(spark, sf_dir):
    """ML6-ML8 on the booster: precision, recall, f1, AUC and false positive rate of each
    stratified split, from scores that the oracle computes for itself."""
    scored = materialize(_first_rounds(spark, sf_dir))
    return MT.grouped_metrics(scored, ["split"], QUALITY_THRESHOLD, label="churned", score="churn_score")
