"""Shared plan fragments: staged inputs, rollups, labels and features for one run.

The day rollups of transactions and sessions and the per-customer holdings
rollup are computed once per run and checkpointed into the shared folder:
the lineitem x orders join behind the transactions and holdings views is the
most expensive step, and labels, features, marts and profiles all read the
(much smaller) rollups instead of re-deriving them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import constants as K
from ..operators import asof
from ..operators import features as FT
from ..operators import labels as LB
from ..operators import preprocess as PP
from ..session import materialize
from ..sources.staging import Warehouse


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    return Warehouse(spark, sf_dir, K.TEST_SNAPSHOT)


def _memo(w: Warehouse, name: str, build):
    cache = w.__dict__.setdefault("_memo", {})
    if name not in cache:
        cache[name] = build()
    return cache[name]


def daily_transactions(w: Warehouse) -> DataFrame:
    return _memo(w, "daily_t", lambda: materialize(FT.daily_transactions(w.transactions())))


def daily_sessions(w: Warehouse) -> DataFrame:
    return _memo(w, "daily_s", lambda: materialize(FT.daily_sessions(w.app_sessions())))


def holding_stats(w: Warehouse) -> DataFrame:
    return _memo(w, "holding", lambda: materialize(FT.holding_stats(w.customer_products(), w.snapshot)))


def labelled_customers(w: Warehouse, keep_stats: bool = False, holding: DataFrame | None = None) -> DataFrame:
    """Customers with label columns (one customer scan, one join chain)."""
    return LB.labelled(w.customers(), w.snapshot, daily_transactions(w), daily_sessions(w),
                       holding if holding is not None else holding_stats(w), keep_stats=keep_stats)


def labels(w: Warehouse) -> DataFrame:
    return labelled_customers(w).select("customer_id", *LB.LABEL_COLUMNS)


def features(w: Warehouse, compat: str = "canonical") -> DataFrame:
    return FT.feature_snapshot(None, None, None, None, w.complaints(), w.nps_responses(), None,
                               w.snapshot, compat=compat, labelled=labelled_customers(w, keep_stats=True))


def model_features(w: Warehouse) -> DataFrame:
    return PP.model_ready(features(w))


def holding_stats_at(w: Warehouse, as_of) -> DataFrame:
    if as_of == w.snapshot:
        return holding_stats(w)
    return _memo(w, f"holding@{as_of}", lambda: materialize(FT.holding_stats(w.customer_products(), as_of)))


def features_at(w: Warehouse, as_of) -> DataFrame:
    """Feature snapshot as of another date over the same data (backfill, drift):
    the shared day rollups are reused, only the holdings rollup depends on the
    date.  Labels belong to the staged snapshot, so ``churned`` is NULL here."""
    from pyspark.sql import functions as F
    cust = w.customers().withColumn("snapshot_date", F.lit(as_of))
    return FT.feature_snapshot(cust, None, None, None, w.complaints(), w.nps_responses(), None, as_of,
                               daily_s=daily_sessions(w), daily_t=daily_transactions(w),
                               holding=holding_stats_at(w, as_of))


def features_many(w: Warehouse, dates) -> DataFrame:
    """Feature snapshots of many dates from one read of every child."""
    return asof.snapshots(w.customers(), dates, daily_sessions(w), daily_transactions(w), w.customer_products(),
                          w.complaints(), w.nps_responses())


def features_variant(w: Warehouse, as_of_holdings: bool = False, nps_mode: str = "max") -> DataFrame:
    """SEM2 / SEM4 options: holdings counted by activity on the snapshot date
    instead of current status; NPS as the latest score within 180 days."""
    hold = holding_stats(w) if not as_of_holdings else _memo(
        w, "holding_asof", lambda: materialize(FT.holding_stats(w.customer_products(), w.snapshot, as_of=True)))
    return FT.feature_snapshot(None, None, None, None, w.complaints(), w.nps_responses(), None,
                               w.snapshot, daily_s=daily_sessions(w), daily_t=daily_transactions(w),
                               holding=hold, labelled=labelled_customers(w), nps_mode=nps_mode)
