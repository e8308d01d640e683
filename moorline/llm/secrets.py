"""Secret scan over an incremental ledger of blobs.

Every version of every path is addressed by the digest of its content.  The
ledger records which (blob, rule version) pairs were scanned and what was found;
a scan reads only contents with an unseen pair, once per digest, and appends to
the ledger.  Findings are then joined back to all paths that hold the blob.
All of it is DataFrame expressions; no Python runs in tasks.

Defined results: null text is the empty text and has no finding; rows that repeat a
path or a text each get the findings of their blob; an empty table gives no rows;
a rule whose version changes is scanned anew, others are not; other columns
are not read.  Positions are code points, ends are exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.joins import broadcast_if_bounded
from .common import BROADCAST_ROWS, SPANS, count_kind, cut, kinded, span_text, spans, work_uri, written


@dataclass(frozen=True)
class Rule:
    """A kind of secret: a pattern of positive width, an optional test of the match
    (as SQL over ``m``), and a version to raise when either changes."""

    kind: str
    pattern: str
    test: str | None = None
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"

    def find(self, text: Column) -> Column:
        keep = None if self.test is None else lambda m: _apply(self.test, m)
        return kinded(spans(text, self.pattern), self.kind, keep)


def _apply(test: str, m: Column) -> Column:
    kind, _, arg = test.partition(":")
    if kind == "length":
        return F.length(m) >= int(arg)
    pattern, group, least = arg.rsplit("|", 2)
    return F.length(F.regexp_extract(m, pattern, int(group))) >= int(least)


# Patterns and tests, fixed values.  hex and access take the minimum length into the
# pattern: their matches are maximal runs, so this drops the same ones as a later test.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = [
    Rule("assign", ASSIGN, f"group:{ASSIGN}|2|8"),
    Rule("access", r"AKIA[A-Z0-9]+", "length:16"),
    Rule("hex", r"[0-9a-f]{32,}"),
]
ADDED = [
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}+"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}+"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]++"),
    Rule("url_login", r"://[^\s:/@]{1,256}+:[^\s:/@]{1,256}+@"),
]
RULES = BASE + ADDED
KINDS = [r.kind for r in RULES]
LEDGER = f"digest binary, rules array<string>, found {SPANS}, run string"


class BlobLedger:
    """Scanned (blob, rule version) pairs and their findings in a shared folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _exists(self) -> bool:
        from pyspark.errors import AnalysisException
        try:
            self.spark.read.parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return False
            raise
        return True

    def read(self) -> DataFrame:
        if not self._exists():
            return self.spark.range(0).selectExpr(
                "cast(null as binary) as digest", "cast(array() as array<string>) as rules",
                f"cast(array() as {SPANS}) as found", "cast(null as string) as run")
        return self.spark.read.schema(LEDGER).parquet(self.path)

    def scan(self, versions: DataFrame, rules: list[Rule], run: str, id_col="doc_id", text_col="text") -> DataFrame:
        """Scan what is unseen and return (doc_id, digest, found) for every row of ``versions``."""
        text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
        rows = versions.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text")) \
            .withColumn("digest", F.unhex(F.sha2("text", 256)))
        paths = written(rows.select("doc_id", "digest"), "blob-paths")
        wanted = [r.key for r in rules]
        key_array = F.array(*[F.lit(k) for k in wanted])
        seen = self.read().groupBy("digest").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen")) \
            .select("digest", F.array_except(key_array, "seen").alias("missing"))
        # The second scan meets the first by the digest alone, which is the same however the
        # input is split.  Blobs for which nothing is missing go; blobs of several rows are
        # reduced to one text each (added up map-side first), the others are read in place.
        # Tables of their own, so that the joins with them can split a hot digest by its rows.
        repeats = broadcast_if_bounded(cut(paths.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                                           .select("digest")), BROADCAST_ROWS)
        known = broadcast_if_bounded(cut(seen), BROADCAST_ROWS)
        blobs = rows.select("digest", "text")
        blobs = blobs.join(repeats, "digest", "left_anti").unionByName(
            blobs.join(repeats, "digest", "left_semi").groupBy("digest").agg(F.first("text").alias("text")))
        todo = blobs.join(known, "digest", "left") \
            .withColumn("missing", F.coalesce("missing", key_array)).where(F.size("missing") > 0)
        none = F.expr(f"cast(array() as {SPANS})")
        found = F.concat(*[F.when(F.array_contains("missing", r.key), r.find(F.col("text"))).otherwise(none) for r in rules])
        todo.select("digest", F.col("missing").alias("rules"), found.alias("found"), F.lit(run).alias("run")) \
            .write.mode("append").parquet(self.path)
        # Only findings of the rule versions asked for, and only blobs that have any.
        current = F.array(*[F.lit(r.kind) for r in rules])
        valid = F.filter("found", lambda x: F.array_contains(current, x["kind"]))
        hits = self.read().where(F.arrays_overlap("rules", key_array)) \
            .withColumn("found", F.filter(valid, lambda x: F.exists(
                "rules", lambda k: F.array_contains(key_array, k) & (F.substring_index(k, "@", 1) == x["kind"])))) \
            .where(F.size("found") > 0).groupBy("digest").agg(F.flatten(F.collect_list("found")).alias("found"))
        return paths.join(cut(hits), "digest", "left").select("doc_id", "digest", F.coalesce("found", none).alias("found"))


def scan(docs: DataFrame, rules: list[Rule] = RULES, id_col="doc_id", text_col="text") -> DataFrame:
    """One scan with a new ledger in the shared folder."""
    spark = docs.sparkSession
    return BlobLedger(spark, work_uri(spark, "blob-ledger")).scan(docs, rules, "first", id_col, text_col)


def digest_columns(found: DataFrame) -> DataFrame:
    base = F.filter("found", lambda x: x["kind"].isin(*[r.kind for r in BASE]))
    return found.select(
        "doc_id", *[count_kind(F.col("found"), r.kind).alias(f"n_{r.kind}") for r in BASE],
        F.sha2(span_text(base, KINDS, by_start=True), 256).alias("base_sha256"),
        span_text(F.col("found"), KINDS, by_start=True).alias("spans"))
