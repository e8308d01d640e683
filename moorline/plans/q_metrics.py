"""Queries: classification metrics on scored rows (ML2, ML6-ML9, ML16, ML17)."""

from __future__ import annotations

import datetime as dt

from .. import constants as K
from ..operators import metrics as MT
from . import common as C
from .oracle_frag import sql_with
from .registry import query

_SV = ("scored_v",)
_AS_OF = K.TEST_SNAPSHOT + dt.timedelta(days=13)
_CM = """
cm AS (SELECT count(*) FILTER (WHERE score >= 0.7 AND label = 1) AS tp,
              count(*) FILTER (WHERE score >= 0.7 AND label <> 1) AS fp,
              count(*) FILTER (WHERE score < 0.7 AND label <> 1) AS tn,
              count(*) FILTER (WHERE score < 0.7 AND label = 1) AS fn
       FROM src),
rk AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r FROM src),
au AS (SELECT (sum(r) FILTER (WHERE label = 1)
               - count(*) FILTER (WHERE label = 1) * (count(*) FILTER (WHERE label = 1) + 1) / 2.0)
              / (count(*) FILTER (WHERE label = 1) * count(*) FILTER (WHERE label <> 1)) AS auc FROM rk)
"""


def _metrics_select(src_where: str = "") -> str:
    return f"""src AS (SELECT * FROM scored_v {src_where}),""" + _CM


_BM_SELECT = """
SELECT round_even(COALESCE(tp / nullif(tp + fp, 0), 0.0), 4) AS precision,
       round_even(COALESCE(tp / nullif(tp + fn, 0), 0.0), 4) AS recall,
       round_even(COALESCE(2 * tp / nullif(2 * tp + fp + fn, 0), 0.0), 4) AS f1,
       round_even(au.auc, 4) AS auc,
       round_even(COALESCE(fp / nullif(fp + tn, 0), 0.0), 4) AS false_positive_rate,
       tp, fp, tn, fn
FROM cm, au"""


@query("confusion", sql_with(_metrics_select(), "SELECT tp, fp, tn, fn FROM cm", _SV))
def confusion(spark, sf_dir):
    """ML6: confusion counts at the 0.70 threshold."""
    return MT.confusion(C.warehouse(spark, sf_dir).scored())


@query("binary_metrics", sql_with(_metrics_select(), _BM_SELECT, _SV))
def binary_metrics(spark, sf_dir):
    """ML7 / ML8: precision, recall, f1, AUC, false positive rate."""
    return MT.binary_metrics(C.warehouse(spark, sf_dir).scored())


@query("auc_rank", sql_with(_metrics_select(), "SELECT auc FROM au", _SV))
def auc_rank(spark, sf_dir):
    """ML8: rank-sum ROC AUC with tie mid-ranks."""
    return MT.auc(C.warehouse(spark, sf_dir).scored())


@query("class_report", sql_with(_metrics_select() + """,
per AS (
  SELECT 'not_churned' AS class_name, COALESCE(tn / nullif(tn + fn, 0), 0.0) AS precision,
         COALESCE(tn / nullif(tn + fp, 0), 0.0) AS recall,
         COALESCE(2 * tn / nullif(2 * tn + fn + fp, 0), 0.0) AS f1, tn + fp AS support FROM cm
  UNION ALL
  SELECT 'churned', COALESCE(tp / nullif(tp + fp, 0), 0.0), COALESCE(tp / nullif(tp + fn, 0), 0.0),
         COALESCE(2 * tp / nullif(2 * tp + fp + fn, 0), 0.0), tp + fn FROM cm),
allr AS (
  SELECT * FROM per
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM per
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                   sum(f1 * support) / sum(support), sum(support) FROM per)
""", """
SELECT class_name, round_even(precision, 4) AS precision, round_even(recall, 4) AS recall,
       round_even(f1, 4) AS f1, CAST(support AS BIGINT) AS support FROM allr""", _SV))
def class_report(spark, sf_dir):
    """ML9: per-class report with macro and weighted averages."""
    return MT.class_report(C.warehouse(spark, sf_dir).scored())


_QA_WHERE = (f"WHERE scored_date > DATE '{_AS_OF.isoformat()}' - 7 "
             f"AND scored_date <= DATE '{_AS_OF.isoformat()}'")


@query("production_quality_alerts", sql_with(_metrics_select(_QA_WHERE) + f""",
bm AS ({_BM_SELECT})
""", """
SELECT 'precision' AS metric, precision AS value, CAST(0.72 AS DOUBLE) AS threshold, precision < 0.72 AS alert FROM bm
UNION ALL
SELECT 'recall', recall, CAST(0.6 AS DOUBLE), recall < 0.6 FROM bm""", _SV))
def production_quality_alerts(spark, sf_dir):
    """ML16 / ML17: precision/recall alerts over the last 7 scoring days."""
    return MT.quality_alerts(C.warehouse(spark, sf_dir).scored(), _AS_OF)


@query("split_stratified", sql_with("""
h AS (SELECT customer_id, label,
             CAST(('0x' || substr(md5('42:' || CAST(customer_id AS VARCHAR)), 1, 8)) AS BIGINT) AS u FROM scored_v),
r AS (SELECT *, count(*) OVER (PARTITION BY label ORDER BY u) AS rk, count(*) OVER (PARTITION BY label) AS n FROM h)
""", """
SELECT customer_id, label, CASE WHEN rk <= floor(n * 0.2::DOUBLE + 0.5) THEN 'test' ELSE 'train' END AS split FROM r""", _SV))
def split_stratified(spark, sf_dir):
    """ML2: stratified 80/20 split, exact per class."""
    s = C.warehouse(spark, sf_dir).scored()
    return MT.stratified_split(s).select("customer_id", "label", "split")
