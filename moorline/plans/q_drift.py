"""Queries: feature drift on the events stream (ML15, ML17)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import drift as DR
from . import common as C
from .registry import query

SPLIT = dt.datetime(2024, 1, 16)

_EVENTS_LONG = """
long AS (
  SELECT event_type AS feature,
         CASE WHEN event_type = 'click' AND ts >= TIMESTAMP '2024-01-16 00:00:00' THEN value + 40.0::DOUBLE ELSE value END
           AS value,
         CASE WHEN ts < TIMESTAMP '2024-01-16 00:00:00' THEN 'reference'
              WHEN ts < TIMESTAMP '2024-01-23 00:00:00' THEN 'production' END AS period
  FROM events WHERE value IS NOT NULL)"""

DRIFT_BODY = """
l AS (SELECT * FROM long WHERE period IS NOT NULL AND value IS NOT NULL),
g AS (SELECT feature, value, count(*) FILTER (WHERE period = 'reference') AS rn,
             count(*) FILTER (WHERE period = 'production') AS pn FROM l GROUP BY feature, value),
c AS (SELECT feature, value, lag(value) OVER w AS prev,
             COALESCE(sum(rn) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cr,
             COALESCE(sum(pn) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cp
      FROM g WINDOW w AS (PARTITION BY feature ORDER BY value)),
st AS (SELECT feature, count(*) FILTER (WHERE period = 'reference') AS n_reference,
              count(*) FILTER (WHERE period = 'production') AS n_production,
              stddev_pop(value) FILTER (WHERE period = 'reference') AS sd,
              min(value) AS lo, max(value) AS hi FROM l GROUP BY feature),
w1 AS (SELECT c.feature,
              sum(CASE WHEN prev IS NOT NULL THEN
                  abs(cr / nullif(st.n_reference, 0) - cp / nullif(st.n_production, 0)) * (value - prev) END) AS w
       FROM c JOIN st ON c.feature = st.feature GROUP BY c.feature),
hb AS (SELECT l.feature,
              CASE WHEN st.hi = st.lo THEN 0
                   ELSE CAST(least(floor((l.value - st.lo) / ((st.hi - st.lo) / 20.0)), 19) AS INTEGER) END AS bin,
              l.period FROM l JOIN st ON l.feature = st.feature),
hc AS (SELECT hb.feature, bin,
              count(*) FILTER (WHERE period = 'reference') / nullif(max(st.n_reference), 0) AS p,
              count(*) FILTER (WHERE period = 'production') / nullif(max(st.n_production), 0) AS q
       FROM hb JOIN st ON hb.feature = st.feature GROUP BY hb.feature, bin),
js AS (SELECT feature,
              round(sum(0.5 * CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0.0 END
                        + 0.5 * CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0.0 END), 6) AS js_divergence
       FROM hc GROUP BY feature),
rep AS (SELECT st.feature, st.n_reference, st.n_production, round(w1.w, 6) AS wasserstein,
               round(st.sd, 6) AS ref_stddev, round(w1.w / nullif(st.sd, 0.0), 6) AS wasserstein_norm,
               js.js_divergence,
               COALESCE(round(w1.w / nullif(st.sd, 0.0), 6) > 0.15, false) AS drifted
        FROM st JOIN w1 ON st.feature = w1.feature LEFT JOIN js ON st.feature = js.feature)
"""

_LONG = "WITH " + _EVENTS_LONG.strip() + "," + DRIFT_BODY


def _long(spark, sf_dir):
    """The events in long form.  Clicks of the production window are staged 40 higher,
    so that one event type drifts and the others do not."""
    e = C.warehouse(spark, sf_dir).raw("events", ["ts", "event_type", "value"])
    late = F.col("ts").cast("timestamp_ntz") >= F.lit(SPLIT.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    moved = F.when((F.col("event_type") == "click") & late, F.col("value") + F.lit(40.0)).otherwise(F.col("value"))
    return DR.event_drift_input(e.withColumn("value", moved), SPLIT)


def _report(spark, sf_dir):
    return DR.drift_report(_long(spark, sf_dir))


@query("drift_wasserstein", _LONG + """
SELECT feature, n_reference, n_production, wasserstein, ref_stddev, wasserstein_norm FROM rep""")
def drift_wasserstein(spark, sf_dir):
    """ML15: normalised Wasserstein-1 per event type (reference vs production week)."""
    return DR.wasserstein(_long(spark, sf_dir))


@query("drift_js", _LONG + "SELECT feature, js_divergence FROM js")
def drift_js(spark, sf_dir):
    """ML15 / SEM14: Jensen-Shannon divergence per event type."""
    return DR.jensen_shannon(_long(spark, sf_dir))


@query("drift_report", _LONG + "SELECT * FROM rep")
def drift_report(spark, sf_dir):
    """ML15: both drift metrics and the drift flag."""
    return _report(spark, sf_dir)


@query("drift_alerts", _LONG + """
SELECT feature, metric, value, CAST(0.15 AS DOUBLE) AS threshold FROM (
  SELECT feature, 'wasserstein_norm' AS metric, wasserstein_norm AS value FROM rep
  UNION ALL SELECT feature, 'js_divergence', js_divergence FROM rep) u
WHERE value > 0.15""")
def drift_alerts(spark, sf_dir):
    """ML17: drift alert rows above the threshold."""
    return DR.drift_alerts(_report(spark, sf_dir))
