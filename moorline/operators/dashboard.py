"""Campaign read models (AG7-AG19, AG25, J7, J8, PV1-PV3, PF7, PF8, SO1, SO5, WN4, SC16, SC17).

Each read model is one or two grouped aggregates over the outreach tables.
pandas drops NULL group keys (SEM11), so keys are filtered first; pivots use
fixed value lists so no extra job is needed to discover columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.joins import broadcast_if_bounded
from ..functions.text import preview, total_tokens, violation_ids
from ..session import materialize
from .decisions import RULES

RULE_IDS = [r for r, _ in RULES]
TOKEN_COLS = ("agent1_tokens", "agent2_tokens", "agent3_tokens")


def _tagged(approved: DataFrame, queue: DataFrame, cols: list[str], a_tag="approved", q_tag="queued",
            tag_col="src") -> DataFrame:
    """SE1: tagged UNION ALL of approved and queued rows."""
    return approved.select(*cols, F.lit(a_tag).alias(tag_col)).unionByName(
        queue.select(*cols, F.lit(q_tag).alias(tag_col)))


def home_kpis(approved: DataFrame, queue: DataFrame) -> DataFrame:
    """AG7: processed, pass rate, approved, queued, tokens (one pass over a tagged union)."""
    u = _tagged(approved.withColumn("_tok", total_tokens(*TOKEN_COLS)),
                queue.withColumn("_tok", F.lit(None).cast("int")), ["_tok"])
    a = F.count(F.when(F.col("src") == "approved", 1))
    total = F.count(F.lit(1))
    return u.agg(
        total.alias("processed"),
        F.coalesce(a / F.nullif(total, F.lit(0)), F.lit(0.0)).alias("pass_rate"),
        a.alias("approved"),
        F.count(F.when(F.col("src") == "queued", 1)).alias("queued"),
        F.coalesce(F.sum("_tok"), F.lit(0)).cast("long").alias("tokens"),
    )


def batch_summary(approved: DataFrame, queue: DataFrame) -> DataFrame:
    """AG8 / J7: per batch approved and review counts (the full outer join is a
    single grouped aggregate over the tagged union - one shuffle)."""
    u = _tagged(approved, queue, ["batch_date"])
    g = u.groupBy("batch_date").agg(
        F.count(F.when(F.col("src") == "approved", 1)).alias("approved_count"),
        F.count(F.when(F.col("src") == "queued", 1)).alias("review_count"))
    total = F.col("approved_count") + F.col("review_count")
    return g.withColumn("pass_rate", F.col("approved_count") / F.nullif(total, F.lit(0)))


def pass_rate_trend(approved: DataFrame, queue: DataFrame) -> DataFrame:
    """AG15: AG8 with total and pass percentage (numpy half-even rounding)."""
    b = batch_summary(approved, queue)
    return b.select("batch_date", "approved_count", "review_count",
                    (F.col("approved_count") + F.col("review_count")).alias("total"),
                    F.bround(F.col("pass_rate") * 100, 1).alias("pass_pct"))


def outreach_kpis(approved: DataFrame) -> DataFrame:
    """AG9: total, email, call, average total tokens (truncated to int)."""
    tok = total_tokens(*TOKEN_COLS)
    return approved.agg(
        F.count(F.lit(1)).alias("total"),
        F.count(F.when(F.col("channel") == "email", 1)).alias("email"),
        F.count(F.when(F.col("channel") == "call", 1)).alias("call"),
        F.floor(F.avg(tok)).cast("long").alias("avg_tokens"))


def queue_kpis(queue: DataFrame) -> DataFrame:
    """AG12: total / pending / approved / rejected."""
    return queue.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count(F.when(F.col("status") == s, 1)).alias(s) for s in ("pending", "approved", "rejected")])


def rule_frequency(queue: DataFrame, missing: str | None = "unknown") -> DataFrame:
    """AG13 (before the top-k): violation count per rule id."""
    ids = queue.select(F.explode(violation_ids(F.col("violated_rules"), missing)).alias("rule_id"))
    return ids.groupBy("rule_id").agg(F.count(F.lit(1)).alias("violations"))


def rule_top10(queue: DataFrame, n: int = 10) -> DataFrame:
    """AG13 / SO5: top-n violated rules (count desc, rule id asc)."""
    return rule_frequency(queue).orderBy(F.desc("violations"), F.asc("rule_id")).limit(n)


def pass_rate_by_reason(approved: DataFrame, queue: DataFrame) -> DataFrame:
    """AG14: per non-null reason: total, approved, pass rate and percent."""
    u = _tagged(approved, queue, ["churn_reason"]).where(F.col("churn_reason").isNotNull())
    g = u.groupBy("churn_reason").agg(F.count(F.lit(1)).alias("total"),
                                      F.count(F.when(F.col("src") == "approved", 1)).alias("approved"))
    rate = F.col("approved") / F.col("total")
    return g.select("churn_reason", "total", "approved", rate.alias("pass_rate"),
                    F.bround(rate * 100, 1).alias("pass_pct"))


def signals_vs_outcome(approved: DataFrame, queue: DataFrame, labelled: DataFrame) -> DataFrame:
    """AG16 / J8 / PV1: outcome counts per churn_signal_count, Pass/Fail
    columns forced, total and pass percent.  Rows are counted per customer before
    the join, so a customer with many rows is one row there.  Unmatched rows are
    dropped (the left join plus not-null filter becomes an inner join)."""
    u = _tagged(approved, queue, ["customer_id"], "Pass", "Fail", "outcome")
    c = u.groupBy("customer_id").agg(F.count(F.when(F.col("outcome") == "Pass", 1)).alias("Pass"),
                                     F.count(F.when(F.col("outcome") == "Fail", 1)).alias("Fail"))
    j = c.join(labelled.select("customer_id", "churn_signal_count"), "customer_id", "left") \
        .where(F.col("churn_signal_count").isNotNull())
    p = j.groupBy("churn_signal_count").agg(F.sum("Pass").alias("Pass"), F.sum("Fail").alias("Fail"))
    total = F.col("Pass") + F.col("Fail")
    return p.select("churn_signal_count", F.col("Pass").cast("long").alias("Pass"),
                    F.col("Fail").cast("long").alias("Fail"), total.cast("long").alias("total"),
                    F.bround(F.col("Pass") / total * 100, 1).alias("pass_pct"))


OTHER_RULES = "other"


def rule_counts(queue: DataFrame) -> DataFrame:
    """AG17: violations per (reason, rule id), for every id that occurs.  Rows with
    NULL reason or a rule without id are dropped (SEM18, page-5 mode)."""
    q = queue.where(F.col("violated_rules").isNotNull() & (F.col("violated_rules") != "[]")
                    & F.col("churn_reason").isNotNull())
    e = q.select("churn_reason", F.explode(violation_ids(F.col("violated_rules"), None)).alias("rule_id"))
    return e.groupBy("churn_reason", "rule_id").agg(F.count(F.lit(1)).alias("n"))


def rule_heatmap(queue: DataFrame) -> DataFrame:
    """AG17 / PV2: reason x rule counts; one column per catalogue rule and one for
    all ids outside the catalogue."""
    known = F.when(F.col("rule_id").isin(*RULE_IDS), F.col("rule_id")).otherwise(F.lit(OTHER_RULES))
    cols = [*RULE_IDS, OTHER_RULES]
    p = rule_counts(queue).withColumn("rule_id", known).groupBy("churn_reason").pivot("rule_id", cols) \
        .agg(F.sum("n")).fillna(0)
    return p.select("churn_reason", *[F.col(f"`{r}`").cast("long").alias(r) for r in cols])


def tokens_by_reason(approved: DataFrame) -> DataFrame:
    """AG18: customers (non-null totals), mean (half-even to int) and sum of tokens."""
    tok = total_tokens(*TOKEN_COLS)
    a = approved.where(F.col("churn_reason").isNotNull()).withColumn("_tok", tok)
    return a.groupBy("churn_reason").agg(
        F.count("_tok").alias("customers"),
        F.bround(F.avg("_tok"), 0).cast("long").alias("avg_tokens"),
        F.sum("_tok").cast("long").alias("total_tokens"))


def channel_by_reason(approved: DataFrame, queue: DataFrame, channels=("email", "call")) -> DataFrame:
    """AG19 / PV3: reason x channel counts."""
    u = _tagged(approved, queue, ["churn_reason", "channel"]).where(
        F.col("churn_reason").isNotNull() & F.col("channel").isNotNull())
    p = u.groupBy("churn_reason").pivot("channel", list(channels)).count().fillna(0)
    return p.select("churn_reason", *[F.col(c).cast("long").alias(c) for c in channels])


def filter_outreach(df: DataFrame, batch_date=None, status=None, channel=None, churn_reason=None) -> DataFrame:
    """PF7: optional equality filters ("All"/None = no filter), pushed to the scan."""
    for col, val in (("batch_date", batch_date), ("status", status), ("channel", channel),
                     ("churn_reason", churn_reason)):
        if val is not None and val != "All" and col in df.columns:
            df = df.where(F.col(col) == F.lit(val))
    return df


def approved_view(approved: DataFrame, **filters) -> DataFrame:
    """PF2 + PF7 + SC16 + SC17 + SO1: filtered approved rows with preview and
    total tokens, newest first."""
    a = filter_outreach(approved, **filters)
    a = a.withColumn("message_preview", preview(F.col("message_draft"))) \
        .withColumn("total_tokens", total_tokens(*TOKEN_COLS))
    return a.orderBy(F.desc("approved_at"), F.asc("id"))


def queue_view(queue: DataFrame, **filters) -> DataFrame:
    """PF7 + SC16 + SO1 for the review queue."""
    q = filter_outreach(queue, **filters).withColumn("message_preview", preview(F.col("message_draft")))
    return q.orderBy(F.desc("created_at"), F.asc("id"))


def first_message(approved: DataFrame) -> DataFrame:
    """WN4: the message for each (customer, batch) - the first row under an
    explicit order (newest approval, then lowest id), as a ``max_by``
    aggregate: partial aggregation keeps a customer with many messages from
    landing in one task, unlike a row_number window."""
    key = F.struct(F.col("approved_at"), (-F.col("id")).alias("neg_id"))
    return approved.groupBy("customer_id", "batch_date").agg(
        F.max_by("message_draft", key).alias("message_draft"))


def queue_items(queue: DataFrame) -> DataFrame:
    """AG25: queue item details with parsed violation ids."""
    return queue.select("id", "customer_id", "status", "churn_reason",
                        F.array_join(violation_ids(F.col("violated_rules")), ",").alias("rule_ids"))


def batch_history(batch_summary_df: DataFrame, runs: DataFrame) -> DataFrame:
    """AG24: per batch month, the pass rate next to the precision of the latest
    evaluation run in that month, plus their correlation over all batches
    (one grouped aggregate + one small join + one global aggregate)."""
    month = F.trunc(F.col("batch_date"), "month")
    b = batch_summary_df.groupBy(month.alias("month")).agg(
        F.sum("approved_count").alias("approved_count"), F.sum("review_count").alias("review_count"))
    b = b.withColumn("pass_rate", F.col("approved_count") / F.nullif(
        F.col("approved_count") + F.col("review_count"), F.lit(0)))
    r = runs.groupBy(F.trunc(F.col("run_date"), "month").alias("month")).agg(
        F.max_by("precision", "run_date").alias("model_precision"))
    j = materialize(b.join(r, "month", "inner"))       # one row per month, read twice
    corr = j.agg(F.corr("model_precision", "pass_rate").alias("precision_pass_rate_corr"))
    return j.join(F.broadcast(corr.withColumn("_k", F.lit(0))), F.lit(0) == F.col("_k")).drop("_k")


def weekly_history(approved: DataFrame, queue: DataFrame, runs: DataFrame) -> DataFrame:
    """AG24: one row per week with outreach: the version in use (that of the newest evaluation run up to
    the week), its precision, and the share of messages that passed and failed review.  ``runs`` has
    run_date, version and precision; weeks before the first run have no version."""
    def weeks(df, at, passed):
        return df.select(F.trunc(F.col(at).cast("date"), "week").alias("batch_date"), F.lit(passed).alias("passed"))
    counts = weeks(approved, "approved_at", 1).unionByName(weeks(queue, "created_at", 0)).groupBy("batch_date").agg(
        F.sum("passed").alias("approved_count"), F.sum(1 - F.col("passed")).alias("review_count"))
    # Weeks and runs are few and counted, so every week may look at every earlier run.
    known = broadcast_if_bounded(materialize(runs.select("run_date", "version", "precision")))
    newest = counts.join(known, F.col("run_date") <= F.col("batch_date"), "left").groupBy("batch_date", "approved_count", "review_count") \
        .agg(F.max_by(F.struct("version", "precision"), "run_date").alias("run"))
    rate = F.col("approved_count") / (F.col("approved_count") + F.col("review_count"))
    return newest.select("batch_date", F.col("run.version").alias("model_version"), F.col("run.precision").alias("model_precision"),
                         F.round(rate, 6).alias("pass_rate"), F.round(1 - rate, 6).alias("failure_rate"), "approved_count", "review_count")
