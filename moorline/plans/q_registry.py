"""Queries: run log, registry gate/promote/resolve/listing, metric trend
(ML11-ML14, AG20, AG21).  Runs are evaluations of the scored rows per
scoring day, so the registry grows with the data."""

from __future__ import annotations

from .. import constants as K
from ..operators import registry as RG
from . import common as C
from .oracle_frag import sql_with
from .oracle_views import SNAP
from .registry import query

_SV = ("scored_v",)

RUNS = f"""
cm AS (SELECT scored_date,
              count(*) FILTER (WHERE score >= 0.7 AND label = 1) AS tp,
              count(*) FILTER (WHERE score >= 0.7 AND label <> 1) AS fp,
              count(*) FILTER (WHERE score < 0.7 AND label <> 1) AS tn,
              count(*) FILTER (WHERE score < 0.7 AND label = 1) AS fn
       FROM scored_v GROUP BY scored_date),
rk AS (SELECT scored_date, label,
              rank() OVER (PARTITION BY scored_date ORDER BY score)
              + (count(*) OVER (PARTITION BY scored_date, score) - 1) / 2.0 AS r
       FROM scored_v),
au AS (SELECT scored_date,
              (sum(r) FILTER (WHERE label = 1)
               - count(*) FILTER (WHERE label = 1) * (count(*) FILTER (WHERE label = 1) + 1) / 2.0)
              / nullif(count(*) FILTER (WHERE label = 1) * count(*) FILTER (WHERE label <> 1), 0) AS auc
       FROM rk GROUP BY scored_date),
runs AS (
  SELECT 'run-' || strftime(cm.scored_date, '%Y%m%d') AS run_id, cm.scored_date AS run_date,
         CAST(date_diff('day', {SNAP}, cm.scored_date) + 1 AS VARCHAR) AS version,
         CAST(0.7 AS DOUBLE) AS churn_threshold, tp + fp + tn + fn AS n_rows,
         round_even(COALESCE(tp / nullif(tp + fp, 0), 0.0), 4) AS precision,
         round_even(COALESCE(tp / nullif(tp + fn, 0), 0.0), 4) AS recall,
         round_even(COALESCE(2 * tp / nullif(2 * tp + fp + fn, 0), 0.0), 4) AS f1,
         round_even(au.auc, 4) AS auc,
         round_even(COALESCE(fp / nullif(fp + tn, 0), 0.0), 4) AS false_positive_rate
  FROM cm JOIN au ON cm.scored_date = au.scored_date),
reg AS (
  SELECT version, 'staging' AS status, 'v1' AS dataset_version, run_date AS snapshot_date,
         precision, recall, f1, auc
  FROM runs WHERE precision >= {K.PRECISION_GATE})
"""


def _runs(spark, sf_dir):
    w = C.warehouse(spark, sf_dir)
    return RG.runs_by_day(w.scored(), w.snapshot)


@query("run_log", sql_with(RUNS, "SELECT * FROM runs", _SV))
def run_log(spark, sf_dir):
    """ML11: one evaluation run per scoring day."""
    return _runs(spark, sf_dir)


@query("registry_gate", sql_with(RUNS, "SELECT * FROM reg", _SV))
def registry_gate(spark, sf_dir):
    """ML12 / ML18: runs passing the precision gate become staging versions."""
    return RG.gate(_runs(spark, sf_dir))


_PROMOTED = RUNS + """,
tgt AS (SELECT max(CAST(version AS INTEGER)) AS v FROM reg WHERE status = 'staging'),
promoted AS (
  SELECT reg.version,
         CASE WHEN CAST(reg.version AS INTEGER) = tgt.v THEN 'production'
              WHEN reg.status = 'production' AND tgt.v IS NOT NULL THEN 'retired'
              ELSE reg.status END AS status,
         dataset_version, snapshot_date, precision, recall, f1, auc
  FROM reg, tgt)
"""


@query("registry_promote", sql_with(_PROMOTED, "SELECT * FROM promoted", _SV))
def registry_promote(spark, sf_dir):
    """ML14: promote the newest staging version."""
    return RG.promote(RG.gate(_runs(spark, sf_dir)))


@query("registry_resolve", sql_with(_PROMOTED, """
SELECT * FROM promoted
WHERE status IN ('production', 'staging')
ORDER BY CASE status WHEN 'production' THEN 0 ELSE 1 END, CAST(version AS INTEGER) DESC
LIMIT 1""", _SV))
def registry_resolve(spark, sf_dir):
    """ML13: production version, else newest staging."""
    return RG.resolve(RG.promote(RG.gate(_runs(spark, sf_dir))))


@query("registry_listing", sql_with(_PROMOTED, """
SELECT *,
       CAST(max(CASE WHEN status = 'production' THEN CAST(version AS INTEGER) END) OVER () AS VARCHAR)
           AS production_version,
       count(*) FILTER (WHERE status = 'staging') OVER () AS staging_count,
       count(*) OVER () AS total_versions
FROM promoted""", _SV))
def registry_listing(spark, sf_dir):
    """AG20: registry with production/staging/total counts."""
    return RG.listing(RG.promote(RG.gate(_runs(spark, sf_dir))))


@query("run_metric_trend", sql_with(RUNS + """,
top AS (SELECT *, row_number() OVER (ORDER BY run_date DESC, run_id DESC) - 1 AS run_index
        FROM runs ORDER BY run_date DESC, run_id DESC LIMIT 20)
""", """
SELECT run_index, run_id, metric, value FROM top
UNPIVOT (value FOR metric IN (precision, recall, f1, auc))""", _SV))
def run_metric_trend(spark, sf_dir):
    """AG21 / WN3 / PV4: 20 newest runs, metrics melted."""
    return RG.metric_trend(_runs(spark, sf_dir))
