"""Classification metrics on (label, score) rows (ML6-ML9, ML16, ML17, ML2).

All metrics are single-pass conditional aggregates (partial aggregation on
every executor, one tiny final row).  ROC AUC uses the rank-sum form with
mid-ranks for ties, evaluated on per-distinct-score counts with a
distributed prefix sum (no global sort into one task).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.joins import broadcast_if_bounded
from ..functions.ordered import prefix_sums
from ..session import materialize


def confusion(scored: DataFrame, threshold: float = K.HIGH_RISK_THRESHOLD,
              label: str = "label", score: str = "score") -> DataFrame:
    """ML6: tp, fp, tn, fn at ``score >= threshold``."""
    pred = F.col(score) >= F.lit(threshold)
    pos = F.col(label) == 1
    return scored.agg(
        F.count(F.when(pred & pos, 1)).alias("tp"),
        F.count(F.when(pred & ~pos, 1)).alias("fp"),
        F.count(F.when(~pred & ~pos, 1)).alias("tn"),
        F.count(F.when(~pred & pos, 1)).alias("fn"),
    )


def _ratio(a, b):
    return F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))


def auc(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """ML8: ROC AUC = P(score_pos > score_neg) + 0.5 P(tie), one row ``auc``
    (NULL when a class is missing)."""
    g = materialize(scored.groupBy(F.col(score).alias("s")).agg(
        F.count(F.when(F.col(label) == 1, 1)).alias("pos"),
        F.count(F.when(F.col(label) != 1, 1)).alias("neg"),
    ))
    c = prefix_sums(g, "s", ["neg"], inclusive=False)
    return c.agg(
        ((F.sum(F.col("pos") * (F.col("cum_neg") + F.col("neg") * 0.5)))
         / F.nullif(F.sum("pos") * F.sum("neg"), F.lit(0))).alias("auc"))


def binary_metrics(scored: DataFrame, threshold: float = K.HIGH_RISK_THRESHOLD,
                   label: str = "label", score: str = "score", places: int = 4) -> DataFrame:
    """ML7 + ML8: precision, recall, f1 (zero division -> 0), auc, false positive rate."""
    # Counts per distinct score hold both the confusion counts and the rank sums.
    pred, pos = F.col(score) >= F.lit(threshold), F.col(label) == 1
    g = materialize(scored.groupBy(F.col(score).alias("s")).agg(
        F.count(F.when(pos, 1)).alias("pos"), F.count(F.when(~pos, 1)).alias("neg"),
        F.count(F.when(pred & pos, 1)).alias("tp"), F.count(F.when(pred & ~pos, 1)).alias("fp"),
        F.count(F.when(~pred & ~pos, 1)).alias("tn"), F.count(F.when(~pred & pos, 1)).alias("fn")))
    c = prefix_sums(g, "s", ["neg"], inclusive=False)
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    m = c.agg(*[F.coalesce(F.sum(x), F.lit(0)).alias(x) for x in ("tp", "fp", "tn", "fn")],
              (F.sum(F.col("pos") * (F.col("cum_neg") + F.col("neg") * 0.5))
               / F.nullif(F.sum("pos") * F.sum("neg"), F.lit(0))).alias("auc")).select(
        F.bround(_ratio(tp, tp + fp), places).alias("precision"),
        F.bround(_ratio(tp, tp + fn), places).alias("recall"),
        F.bround(_ratio(2 * tp, 2 * tp + fp + fn), places).alias("f1"),
        F.bround(F.col("auc"), places).alias("auc"),
        F.bround(_ratio(fp, fp + tn), places).alias("false_positive_rate"),
        "tp", "fp", "tn", "fn",
    )
    return m


def class_report(scored: DataFrame, threshold: float = K.HIGH_RISK_THRESHOLD,
                 label: str = "label", score: str = "score", places: int = 4) -> DataFrame:
    """ML9: per-class precision/recall/f1/support plus macro and weighted averages."""
    cm = confusion(scored, threshold, label, score)
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    # class 1 counts as given; class 0 swaps the roles.
    rows = []
    for name, t, p_, n_ in (("not_churned", tn, fn, fp), ("churned", tp, fp, fn)):
        prec = _ratio(t, t + p_)
        rec = _ratio(t, t + n_)
        rows.append(cm.select(
            F.lit(name).alias("class_name"), prec.alias("precision"), rec.alias("recall"),
            _ratio(2 * t, 2 * t + p_ + n_).alias("f1"), (t + n_).alias("support")))
    per = reduce(DataFrame.unionByName, rows)
    macro = per.agg(F.lit("macro avg").alias("class_name"), F.avg("precision").alias("precision"),
                    F.avg("recall").alias("recall"), F.avg("f1").alias("f1"),
                    F.sum("support").alias("support"))
    tot = F.sum("support")
    weighted = per.agg(F.lit("weighted avg").alias("class_name"),
                       _ratio(F.sum(F.col("precision") * F.col("support")), tot).alias("precision"),
                       _ratio(F.sum(F.col("recall") * F.col("support")), tot).alias("recall"),
                       _ratio(F.sum(F.col("f1") * F.col("support")), tot).alias("f1"),
                       tot.alias("support"))
    out = per.unionByName(macro).unionByName(weighted)
    return out.select("class_name", *[F.bround(c, places).alias(c) for c in ("precision", "recall", "f1")],
                      F.col("support").cast("long").alias("support"))


def quality_alerts(scored: DataFrame, as_of, window_days: int = K.DRIFT_WINDOW_DAYS,
                   threshold: float = K.HIGH_RISK_THRESHOLD, precision_alert: float = K.PRECISION_ALERT,
                   recall_alert: float = K.RECALL_ALERT, date_col: str = "scored_date") -> DataFrame:
    """ML16 / ML17: precision and recall over the last ``window_days`` of
    scored-and-labelled rows; one row per metric with its alert flag."""
    d = F.col(date_col)
    recent = scored.where((d > F.date_sub(F.lit(as_of), window_days)) & (d <= F.lit(as_of)))
    tp, fp, fn = (F.col(c) for c in ("tp", "fp", "fn"))
    m = confusion(recent, threshold).select(
        F.explode(F.array(
            F.struct(F.lit("precision").alias("metric"), F.bround(_ratio(tp, tp + fp), 4).alias("value"),
                     F.lit(precision_alert).alias("threshold")),
            F.struct(F.lit("recall").alias("metric"), F.bround(_ratio(tp, tp + fn), 4).alias("value"),
                     F.lit(recall_alert).alias("threshold")))).alias("m")).select("m.*")
    return m.withColumn("alert", F.col("value") < F.col("threshold"))


def hash_unit(key, seed: int = 42):
    """Deterministic uniform [0,1) from md5 of "seed:key" (same in any SQL engine)."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def class_cuts(df: DataFrame, key: str, label: str, fractions: list[float], seed: int = 42) -> DataFrame:
    """Per class the hash value up to which the first ``fractions[i]`` of its rows lie
    (columns ``cut_<i>``, -1 for none).  Ranks come from a distributed prefix sum over
    the hash values of each class."""
    g = df.select(F.col(label).alias("_class"), hash_unit(F.col(key), seed).alias("u")) \
        .groupBy("_class", "u").agg(F.count(F.lit(1)).alias("n")).where(F.col("_class").isNotNull())
    g = materialize(g)
    c = prefix_sums(g, "u", ["n"], partition_cols=["_class"])
    sizes = g.groupBy("_class").agg(F.sum("n").alias("total"))
    j = c.join(broadcast_if_bounded(sizes), "_class")
    return j.groupBy("_class").agg(*[
        F.coalesce(F.max(F.when(F.col("cum_n") <= F.floor(F.col("total") * F.lit(f) + 0.5), F.col("u"))), F.lit(-1.0))
        .alias(f"cut_{i}") for i, f in enumerate(fractions)])


def stratified_split(df: DataFrame, key: str = "customer_id", label: str = "label", test_fraction: float = 0.2,
                     validation_fraction: float = 0.0, seed: int = 42) -> DataFrame:
    """ML2: of every class the rows with the lowest key hashes are the test set (exactly
    ``test_fraction`` of the class, to the nearest row), the next ones the validation
    set.  Independent of partitioning and reproducible after executor loss.  Adds
    ``split``; rows without a label train."""
    cuts = broadcast_if_bounded(materialize(class_cuts(
        df, key, label, [test_fraction, test_fraction + validation_fraction], seed)))
    u = hash_unit(F.col(key), seed)
    return df.join(cuts, df[label] == F.col("_class"), "left").withColumn(
        "split", F.when(u <= F.col("cut_0"), F.lit("test"))
        .when(F.lit(validation_fraction > 0) & (u <= F.col("cut_1")), F.lit("validation"))
        .otherwise(F.lit("train"))).drop("_class", "cut_0", "cut_1")


def split_counts(split_df: DataFrame, label: str = "label") -> DataFrame:
    return split_df.groupBy(label, "split").agg(F.count(F.lit(1)).alias("n"))


def grouped_metrics(scored: DataFrame, by: list[str], threshold: float = K.HIGH_RISK_THRESHOLD,
                    label: str = "label", score: str = "score", places: int = 4) -> DataFrame:
    """ML7 + ML8 per group (e.g. per scoring day): one grouped aggregate for the
    confusion counts, per-group AUC from per-(group, score) counts with a
    prefix sum partitioned by group."""
    pred = F.col(score) >= F.lit(threshold)
    pos = F.col(label) == 1
    # Counts per (group, score), written once, hold the confusion counts and the rank sums.
    g = materialize(scored.groupBy(*by, F.col(score).alias("s")).agg(
        F.count(F.when(pos, 1)).alias("pos"), F.count(F.when(~pos, 1)).alias("neg"),
        F.count(F.when(pred & pos, 1)).alias("tp"), F.count(F.when(pred & ~pos, 1)).alias("fp"),
        F.count(F.when(~pred & ~pos, 1)).alias("tn"), F.count(F.when(~pred & pos, 1)).alias("fn")))
    cm = g.groupBy(*by).agg(*[F.sum(x).alias(x) for x in ("tp", "fp", "tn", "fn")])
    c = prefix_sums(g, "s", ["neg"], partition_cols=by, inclusive=False)
    a = c.groupBy(*by).agg(
        (F.sum(F.col("pos") * (F.col("cum_neg") + F.col("neg") * 0.5))
         / F.nullif(F.sum("pos") * F.sum("neg"), F.lit(0))).alias("auc"))
    tp, fp, tn, fn = (F.col(x) for x in ("tp", "fp", "tn", "fn"))
    return cm.join(a, by).select(
        *by,
        F.bround(_ratio(tp, tp + fp), places).alias("precision"),
        F.bround(_ratio(tp, tp + fn), places).alias("recall"),
        F.bround(_ratio(2 * tp, 2 * tp + fp + fn), places).alias("f1"),
        F.bround(F.col("auc"), places).alias("auc"),
        F.bround(_ratio(fp, fp + tn), places).alias("false_positive_rate"),
        (tp + fp + tn + fn).alias("n_rows"),
    )
