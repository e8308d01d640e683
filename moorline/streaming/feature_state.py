"""ST2: the windowed features FT2-FT4 as incremental state.

Logins of 30 and 90 days and competitor transfers of 90 days are kept per customer: one entry per day, and only
the days that the longest window can still reach, so the state of a customer has at most 91 entries however
long the history and however busy the day.  Customers are dealt by hash into groups and a group's entries are
packed arrays, so that a call of the processor updates all its customers at once; their number per group sets the cost
of a call, the number of groups that of a batch.

A row of the input changes the entry of its day and the customer's features are emitted as of
the newest day seen.  Features also change when nothing happens: a day leaves a window 31 or 91
days later.  An event-time timer of the group stands at the next such day of any of its customers; when the
watermark passes it, the features of those it has passed are emitted as of the watermark's day, days out of reach are
dropped, and a customer without any is forgotten.
(Spark's state TTL counts processing time and would drop days by the
clock of the cluster, so expiry is left to event time.)

Rows up to the allowed lateness behind the newest event are counted in whatever order they
arrive; older ones are dropped by the watermark.  Every batch is written to a folder of its own, which a
repeated batch replaces; the read side takes each customer's last row.
"""

from __future__ import annotations

import datetime as dt
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from .. import constants as K

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ACTIVITY = "customer_id long, ts timestamp, logins long, transfers long"
FEATURES = "customer_id long, as_of date, app_logins_last_30d long, app_logins_last_90d long, competitor_transfer_count long"
DAY_MS = 86_400_000
LATE_DAYS = 30
# A checkpoint keeps the number of groups it began with.
GROUPS = 1024
CUSTOMERS_PER_GROUP = 500
# A task of the stream starts a Python worker and a state store in every batch, which takes longer than these groups do.
GROUPS_PER_TASK = 50
# Rows without a customer are one customer of a group of their own.
NOBODY = -1
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
PARTITIONS = "spark.sql.shuffle.partitions"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


ENTRY = np.dtype([("customer", "<i8"), ("day", "<i8"), ("logins", "<i8"), ("transfers", "<i8")])
NEWEST = np.dtype([("customer", "<i8"), ("day", "<i8")])


def _summed(entries: np.ndarray) -> np.ndarray:
    """One entry per customer and day, ascending."""
    e = entries[np.lexsort((entries["day"], entries["customer"]))]
    if not len(e):
        return e
    at = np.flatnonzero(np.append(True, (np.diff(e["customer"]) != 0) | (np.diff(e["day"]) != 0)))
    out = e[at]
    for c in ("logins", "transfers"):
        out[c] = np.add.reduceat(e[c], at)
    return out


def _newest(days: np.ndarray) -> np.ndarray:
    """The newest day of every customer, customers ascending."""
    d = days[np.lexsort((days["day"], days["customer"]))]
    return d[np.append(np.diff(d["customer"]) != 0, True)] if len(d) else d


class WindowedFeatures(StatefulProcessor):
    def __init__(self, recent: int = K.RECENT_LOGIN_DAYS, lookback: int = K.FEATURE_LOOKBACK_DAYS, groups: int = GROUPS):
        self.recent, self.lookback, self.groups = recent, lookback, groups

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "groups int, newest binary, entries binary")

    def _known(self):
        """The newest day and the entries of the group's customers."""
        held = self.held.get()
        if held is None:
            return np.zeros(0, NEWEST), np.zeros(0, ENTRY)
        if held[0] != self.groups:
            raise ValueError(f"the checkpoint holds {held[0]} groups of customers, not {self.groups}")
        return np.frombuffer(held[1], NEWEST), np.frombuffer(held[2], ENTRY)

    def _leaving(self, newest: np.ndarray, entries: np.ndarray):
        """Per entry the position of its customer in ``newest`` and the next day on which it leaves a window."""
        of = np.searchsorted(newest["customer"], entries["customer"])
        soon = entries["day"] + self.recent + 1
        return of, np.where(soon > newest["day"][of], soon, entries["day"] + self.lookback + 1)

    def _emit(self, key, newest: np.ndarray, entries: np.ndarray, changed: np.ndarray):
        """Keep what is in reach, set the timer of the next change, and return the features of the changed customers."""
        of = np.searchsorted(newest["customer"], entries["customer"])
        entries = entries[entries["day"] >= newest["day"][of] - self.lookback]
        of, leaves = self._leaving(newest, entries)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if len(entries):
            self.held.update((self.groups, newest[np.unique(of)].tobytes(), entries.tobytes()))
            self.handle.registerTimer(int(leaves.min()) * DAY_MS)
        else:
            self.held.clear()
        recent = entries["day"] >= newest["day"][of] - self.recent
        sums = np.zeros((3, len(newest)), dtype=np.int64)
        for total, value in zip(sums, (entries["logins"] * recent, entries["logins"], entries["transfers"])):
            np.add.at(total, of, value)
        out = newest[changed]
        yield pd.DataFrame({
            "customer_id": pd.array([None] * len(out) if key[0] == NOBODY else out["customer"], dtype="Int64"),
            "as_of": out["day"].astype("datetime64[D]").astype(object),
            **{name: total[changed] for name, total in zip(_VALUES, sums)}})

    def handleInputRows(self, key, rows, timerValues):
        newest, entries = self._known()
        arrived = []
        for pdf in rows:
            new = np.zeros(len(pdf), ENTRY)
            new["customer"] = pdf["customer_id"]
            new["day"] = pdf["ts"].dt.tz_localize(None).to_numpy().astype("datetime64[D]").astype("int64")
            new["logins"], new["transfers"] = pdf["logins"], pdf["transfers"]
            entries = _summed(np.concatenate([entries, new]))
            arrived.append(np.unique(new["customer"]))
        # Days held from before are no newer than the day that was newest then.
        days = np.zeros(len(entries), NEWEST)
        days["customer"], days["day"] = entries["customer"], entries["day"]
        newest = _newest(np.concatenate([newest, days]))
        changed = np.searchsorted(newest["customer"], np.unique(np.concatenate(arrived))) if arrived else []
        yield from self._emit(key, newest, entries, np.array(changed, dtype=np.int64))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        newest, entries = self._known()
        watermark = timerValues.getCurrentWatermarkInMs()
        of, leaves = self._leaving(newest, entries)
        due = np.unique(of[leaves * DAY_MS <= watermark])
        newest = newest.copy()
        newest["day"][due] = np.maximum(newest["day"][due], watermark // DAY_MS)
        yield from self._emit(key, newest, entries, due)

    def close(self) -> None:
        pass


def activity(sessions: DataFrame, transactions: DataFrame) -> DataFrame:
    """Sessions and competitor transfers as rows of one stream."""
    zero = F.lit(0).cast("long")
    logins = sessions.select("customer_id", F.col("session_date").cast("timestamp").alias("ts"), F.lit(1).cast("long").alias("logins"),
                             zero.alias("transfers"))
    transfers = transactions.where("is_competitor_transfer").select(
        "customer_id", F.col("transaction_date").cast("timestamp").alias("ts"), zero.alias("logins"), F.lit(1).cast("long").alias("transfers"))
    return logins.unionByName(transfers)


def feature_stream(rows: DataFrame, late_days: int = LATE_DAYS, groups: int = GROUPS) -> DataFrame:
    """Streaming features from a streaming ``activity``."""
    group = F.when(F.col("customer_id").isNull(), F.lit(NOBODY)).otherwise(F.pmod(F.xxhash64("customer_id"), F.lit(groups)).cast("int"))
    # Without nulls the identifiers stay integers in pandas.
    dealt = rows.withColumn("group", group).withColumn("customer_id", F.coalesce("customer_id", F.lit(0)))
    return dealt.withWatermark("ts", f"{late_days} days").groupBy("group").transformWithStateInPandas(
        statefulProcessor=WindowedFeatures(groups=groups), outputStructType=FEATURES, outputMode="Update", timeMode="EventTime")


def run(spark: SparkSession, source_dir: str, log_dir: str, checkpoint_dir: str, late_days: int = LATE_DAYS,
        files_per_batch: int | None = None, groups: int = GROUPS):
    """Process what is new in ``source_dir`` (files of ACTIVITY) and stop; returns the finished query."""
    tasks = max(spark.sparkContext.defaultParallelism, groups // GROUPS_PER_TASK)
    settings = {PROVIDER: ROCKS_DB, PARTITIONS: str(min(int(spark.conf.get(PARTITIONS)), tasks))}
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        reader = spark.readStream.schema(ACTIVITY)
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)

        def sink(batch: DataFrame, number: int):
            batch.write.mode("overwrite").parquet(f"{log_dir}/batch={number}")
        q = feature_stream(reader.parquet(source_dir), late_days, groups).writeStream.outputMode("update").foreachBatch(sink) \
            .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start()
        q.awaitTermination()
        if q.exception():
            raise q.exception()
        return q
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def latest(spark: SparkSession, log_dir: str) -> DataFrame:
    """Every customer's last features."""
    log = spark.read.schema(FEATURES + ", batch int").parquet(log_dir)
    return log.groupBy("customer_id").agg(F.max_by(F.struct("as_of", *_VALUES), F.struct("batch", "as_of")).alias("f")).select(
        "customer_id", "f.*")


_VALUES = ["app_logins_last_30d", "app_logins_last_90d", "competitor_transfer_count"]


def heartbeat(spark: SparkSession, day: dt.date, late_days: int = LATE_DAYS) -> DataFrame:
    """A row of no customer that moves the watermark to ``day``."""
    at = dt.datetime.combine(day + dt.timedelta(days=late_days), dt.time()).strftime("%Y-%m-%d %H:%M:%S")
    return spark.range(1).select(F.lit(-1).cast("long").alias("customer_id"), F.lit(at).cast("timestamp").alias("ts"),
                                 F.lit(0).cast("long").alias("logins"), F.lit(0).cast("long").alias("transfers"))
