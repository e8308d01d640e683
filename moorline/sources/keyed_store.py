"""Keyed tables whose writes cost what they change (IO11-IO14).

A store is a folder of commits and a log of them.  A commit holds the rows of one write only, hash
partitioned by key into buckets: new values (``upsert``), new keys (``insert_absent``) or tombstones (``delete``,
``retain``).  Reading merges: of every key the newest row counts, and a tombstone hides it.  ``compact`` folds the
commits of single buckets into a new base for these buckets; commits before it are no longer read for them.

Buckets and commits are partition columns, so a lookup reads the buckets of its keys, and an insert reads
the keys of the buckets (and of the partitions, such as batch dates) that it touches.

A commit becomes visible when its row is appended to the log, as a whole file: a reader sees the state before or
after, and what a failed write left behind is never read.  A log that cannot be read is an error, not an empty store.
One writer at a time.

Defined results: rows of one write with equal keys are reduced to the smallest; null keys are keys like others; an empty write makes an
empty commit; columns must be the same in every write; names that begin with ``_kept_`` are the store's own.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StringType, StructField, StructType

from ..functions.joins import broadcast_if_bounded
from .io import exists

LOG = "seq long, name string, kind string, buckets array<int>, schema string"
BUCKETS = 64


class KeyedStore:
    def __init__(self, spark: SparkSession, base: str, keys: list[str], buckets: int = BUCKETS, partitions: tuple = ()):
        self.spark, self.base, self.keys, self.buckets, self.partitions = spark, base, list(keys), buckets, tuple(partitions)

    # -- log ----------------------------------------------------------------------------------
    def history(self) -> list:
        """The log, oldest first (one row per write; compacted stores read its end only)."""
        if not exists(self.spark, f"{self.base}/_log"):
            return []
        return sorted(self.spark.read.schema(LOG).parquet(f"{self.base}/_log").collect())

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _commit(self, rows: DataFrame, kind: str, gone: bool, buckets: list[int] | None = None) -> str:
        """Write ``rows`` (with the store's columns) as one commit and log it."""
        log = self.history()
        name = uuid.uuid4().hex
        schema = rows.schema.simpleString()
        if log and log[0].schema != schema:
            raise ValueError(f"columns differ from those of the store: {schema} instead of {log[0].schema}")
        out = rows.withColumns({"_kept_gone": F.lit(gone), "_kept_bucket": self._bucket()})
        out.repartition("_kept_bucket").write.mode("errorifexists").partitionBy(*self.partitions, "_kept_bucket") \
            .parquet(f"{self.base}/_kept_commit={name}")
        self.spark.createDataFrame([((log[-1].seq if log else 0) + 1, name, kind, buckets, schema)], LOG).coalesce(1) \
            .write.mode("append").parquet(f"{self.base}/_log")
        return name

    # -- reading ------------------------------------------------------------------------------
    def _live(self, log: list) -> DataFrame | None:
        """All rows of the commits that still count, with their commit number as ``_kept_seq``."""
        first = [0] * self.buckets                          # number of the base of every bucket
        for c in log:
            if c.kind == "base":
                for b in c.buckets:
                    first[b] = c.seq
        live = [c for c in log if c.seq >= min(first) and exists(self.spark, f"{self.base}/_kept_commit={c.name}")]
        if not log:
            return None
        kept = StructType([*self.spark.createDataFrame([], log[0].schema).schema, StructField("_kept_gone", BooleanType()),
                           StructField("_kept_bucket", IntegerType()), StructField("_kept_commit", StringType())])
        if not live:
            return self.spark.createDataFrame([], kept).withColumn("_kept_seq", F.lit(0).cast("long"))
        rows = self.spark.read.schema(kept).option("basePath", self.base).parquet(*[f"{self.base}/_kept_commit={c.name}" for c in live])
        numbers = F.create_map(*[F.lit(x) for c in live for x in (c.name, c.seq)])
        seq = F.element_at(numbers, F.col("_kept_commit"))
        based = F.array(*[F.lit(n) for n in first])
        # Both columns are partitions, so the files of folded commits are not opened.
        return rows.where(seq >= F.get(based, F.col("_kept_bucket"))).withColumn("_kept_seq", seq)

    def _merged(self, rows: DataFrame) -> DataFrame:
        """The newest row of every key, tombstones included."""
        rest = [c for c in rows.columns if c not in self.keys]
        return rows.groupBy(*self.keys).agg(F.max_by(F.struct(*rest), "_kept_seq").alias("_kept_row")).select(*self.keys, "_kept_row.*")

    def read(self, where: Column | None = None) -> DataFrame | None:
        """The rows of the store (None before the first write); ``where`` is a condition on its partitions."""
        log = self.history()
        rows = self._live(log)
        if rows is None:
            return None
        columns = [c for c in rows.columns if not c.startswith("_kept_")]
        if where is not None:
            rows = rows.where(where)
        return self._merged(rows).where(~F.col("_kept_gone")).select(*columns)

    def _touched(self, keys: DataFrame) -> Column:
        """The condition on partitions that holds where rows with these keys can be."""
        found = [r[0] for r in keys.select(self._bucket().alias("b")).distinct().collect()]     # at most one row a bucket
        condition = F.col("_kept_bucket").isin(found) if found else F.lit(False)
        for p in self.partitions:
            if p in self.keys:
                values = [r[0] for r in keys.select(p).distinct().limit(1001).collect()]
                if len(values) <= 1000 and None not in values:
                    condition = condition & F.col(p).isin(values)
        return condition

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The stored rows with the given keys; only their buckets are read."""
        wanted = keys.select(*self.keys).distinct()
        return self.read(self._touched(wanted)).join(broadcast_if_bounded(wanted), self.keys, "left_semi")

    # -- writing ------------------------------------------------------------------------------
    def _one(self, rows: DataFrame) -> DataFrame:
        rest = [c for c in rows.columns if c not in self.keys]
        if not rest:
            return rows.distinct()
        return rows.groupBy(*self.keys).agg(F.min(F.struct(*rest)).alias("_kept_row")).select(*self.keys, "_kept_row.*").select(*rows.columns)

    def upsert(self, rows: DataFrame) -> str:
        return self._commit(self._one(rows), "delta", False)

    def insert_absent(self, rows: DataFrame) -> DataFrame:
        """Write the rows whose key is not stored yet and return them; a repeated call adds nothing."""
        new = self._one(rows)
        have = self.read(self._touched(rows))
        if have is not None:
            new = new.join(have.select(*self.keys), self.keys, "left_anti").select(*rows.columns)
        name = self._commit(new, "delta", False)
        return self.spark.read.schema(rows.schema).parquet(f"{self.base}/_kept_commit={name}").select(*rows.columns)

    def _tombstones(self, keys: DataFrame) -> str:
        log = self.history()
        columns = self._live(log).columns
        rows = self._live(log).limit(0).select(*[c for c in columns if not c.startswith("_kept_")])
        return self._commit(rows.unionByName(keys.select(*self.keys), allowMissingColumns=True).select(*rows.columns), "delta", True)

    def delete(self, keys: DataFrame) -> str:
        """Hide the rows with the given keys; only tombstones are written."""
        return self._tombstones(keys.select(*self.keys).distinct())

    def retain(self, active: DataFrame) -> str:
        """Hide the rows whose key is not active; the keys are read, only tombstones are written."""
        return self._tombstones(self.read().select(*self.keys).join(active.select(*self.keys), self.keys, "left_anti"))

    def compact(self, share: float = 0.5) -> list[int]:
        """Fold the buckets in which at least ``share`` of the stored rows are outdated or tombstones; returns them."""
        log = self.history()
        rows = self._live(log)
        if rows is None:
            return []
        count = rows.groupBy("_kept_bucket").count().withColumnRenamed("count", "stored")
        alive = self._merged(rows).where(~F.col("_kept_gone")).groupBy("_kept_bucket").agg(F.count(F.lit(1)).alias("alive"))
        sizes = count.join(alive, "_kept_bucket", "left").select("_kept_bucket", "stored", F.coalesce("alive", F.lit(0)).alias("alive")).collect()
        chosen = sorted(r["_kept_bucket"] for r in sizes if r.stored - r.alive >= share * r.stored and r.stored > r.alive)
        if chosen:
            folded = self.read(F.col("_kept_bucket").isin(chosen))
            self._commit(folded, "base", False, chosen)
        return chosen
