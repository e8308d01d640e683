"""The histogram booster against a plain numpy version, and its scores through DuckDB."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from moorline.operators import boosting as B
from moorline.operators import metrics as MT

FEATURES = ["a", "b", "c"]


def _data(n=600, seed=7):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 40, n), rng.normal(size=n).round(2), rng.integers(0, 2, n)]).astype(float)
    z = 0.15 * (x[:, 0] - 20) + 1.5 * x[:, 1] * (x[:, 2] - 0.5)
    y = (rng.random(n) < 1 / (1 + np.exp(-z))).astype(float)
    x[rng.random(n) < 0.05, 1] = np.nan
    return x, y


def _table(spark, x, y, parts=3):
    rows = [(i, *[None if np.isnan(v) else float(v) for v in r], float(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y double").repartition(parts)


def plain_fit(x, y, edges, p):
    """Leaf-by-leaf growth over rows, without histograms by level; no sampling."""
    bins = np.column_stack([np.where(np.isnan(x[:, f]), 0, np.searchsorted(e, x[:, f], "left")) for f, e in enumerate(edges)])
    margin = np.full(len(y), np.log(y.mean() / (1 - y.mean())))

    def worth(g, h):
        return max(abs(g) - p.l1, 0) ** 2 / (h + p.l2)
    for _ in range(p.trees):
        q = 1 / (1 + np.exp(-margin))
        g, h = q - y, q * (1 - q)
        leaves = [(np.arange(len(y)), 0)]
        while len(leaves) < p.leaves:
            best = None
            for i, (rows, depth) in enumerate(leaves):
                if depth == p.depth:
                    continue
                for f in range(len(edges)):
                    for b in range(len(edges[f])):
                        left, right = rows[bins[rows, f] <= b], rows[bins[rows, f] > b]
                        if min(len(left), len(right)) < p.min_rows:
                            continue
                        gain = round(worth(g[left].sum(), h[left].sum()) + worth(g[right].sum(), h[right].sum())
                                     - worth(g[rows].sum(), h[rows].sum()), 9)
                        if gain > 0 and (best is None or gain > best[0]):
                            best = (gain, i, left, right, depth)
            if best is None:
                break
            _, i, left, right, depth = best
            leaves[i:i + 1] = [(left, depth + 1), (right, depth + 1)]
        for rows, _ in leaves:
            s = g[rows].sum()
            margin[rows] -= p.rate * np.sign(s) * max(abs(s) - p.l1, 0) / (h[rows].sum() + p.l2)
    return margin


def test_equals_growing_leaf_by_leaf(spark):
    x, y = _data()
    p = B.Params(trees=4, depth=4, leaves=6, rate=0.3, bins=12, row_fraction=1.0, column_fraction=1.0)
    model = B.fit(_table(spark, x, y), FEATURES, "y", "id", F.lit(0), p)
    assert np.allclose(model.margins(x), plain_fit(x, y, model.edges, p), atol=1e-9)
    assert max(sum(f < 0 for f in t.feature) for t in model.trees) == 6


def test_partitions_and_written_margins_do_not_matter(spark, monkeypatch):
    x, y = _data()
    p = B.Params(trees=7, depth=3, bins=16)
    one = B.fit(_table(spark, x, y, 1), FEATURES, "y", "id", F.lit(0), p)
    monkeypatch.setattr(B, "ROWS_PER_TASK", 100)
    monkeypatch.setattr(B, "MARGINS_EVERY", 2)
    many = B.fit(_table(spark, x, y, 5), FEATURES, "y", "id", F.lit(0), p)
    assert np.allclose(one.margins(x), many.margins(x), atol=1e-9)


def test_a_tree_costs_one_job_per_level(spark, monkeypatch):
    """No query is planned and no state rewritten per level or tree: jobs by level, one checkpoint each ``MARGINS_EVERY``."""
    x, y = _data()
    monkeypatch.setattr(B, "MARGINS_EVERY", 100)
    table = _table(spark, x, y).localCheckpoint()
    context = spark.sparkContext

    def jobs(trees):
        group = f"fit-{trees}"
        context.setJobGroup(group, group)
        model = B.fit(table, FEATURES, "y", "id", F.lit(0), B.Params(trees=trees, depth=3))
        assert len(model.trees) == trees
        return len(context.statusTracker().getJobIdsForGroup(group))
    try:
        assert jobs(9) - jobs(3) <= 6 * 3
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def test_patience_keeps_the_best_number_of_trees(spark):
    x, y = _data()
    fold = F.when(F.col("id") % 4 == 0, 1).otherwise(0)
    p = B.Params(trees=60, depth=3, rate=0.5, bins=16, patience=5)
    table = _table(spark, x, y)
    model = B.fit(table, FEATURES, "y", "id", fold, p)
    held = np.arange(len(y)) % 4 == 0
    z = [np.full(held.sum(), model.base)]
    for t in model.trees:
        z.append(z[-1] + np.array(t.value)[t.leaf_of(B._binned(x[held], model.edges))])
    losses = [float((np.logaddexp(0, m) - y[held] * m).mean()) for m in z]
    assert np.allclose(losses, model.losses[:len(losses)], atol=1e-9)
    assert len(model.trees) == int(np.argmin(model.losses)) and len(model.losses) == len(model.trees) + 1 + p.patience


def test_saved_model_scores_alike_and_duckdb_confirms_its_metrics(spark, tmp_path):
    x, y = _data()
    table = _table(spark, x, y)
    model = B.fit(table, FEATURES, "y", "id", F.lit(0), B.Params(trees=10, depth=4))
    model.save(spark, str(tmp_path / "model"))
    again = B.load(spark, str(tmp_path / "model"))
    scored = table.select("id", F.col("y").cast("int").alias("label"), again.score_column().alias("score"))
    scored.write.parquet(str(tmp_path / "scores"))
    want = 1 / (1 + np.exp(-model.margins(x)))
    assert np.allclose([r.score for r in scored.orderBy("id").collect()], want)
    tp, fp, tn, fn, auc = duckdb.execute(f"""
        WITH s AS (SELECT * FROM '{tmp_path}/scores/*.parquet')
        SELECT count(*) FILTER (score >= 0.7 AND label = 1), count(*) FILTER (score >= 0.7 AND label = 0),
               count(*) FILTER (score < 0.7 AND label = 0), count(*) FILTER (score < 0.7 AND label = 1),
               (SELECT avg((a.score > b.score)::INT + 0.5 * (a.score = b.score)::INT) FROM s a, s b WHERE a.label = 1 AND b.label = 0)
        FROM s""").fetchone()
    m = MT.binary_metrics(scored).first()
    assert (m.tp, m.fp, m.tn, m.fn) == (tp, fp, tn, fn) and abs(m.auc - auc) < 1e-4 and auc > 0.7
    share = model.importance()
    assert abs(sum(g for _, g, _ in share) - 1) < 1e-9 and sum(s for _, _, s in share) == sum(
        f >= 0 for t in model.trees for f in t.feature)


@pytest.mark.parametrize("labels", [[], [None, None], [1.0] * 50, [0.0, 1.0]])
def test_little_or_one_sided_data(spark, labels):
    rows = [(i, 1.0, None, 0.0, v) for i, v in enumerate(labels)]
    table = spark.createDataFrame(rows, "id long, a double, b double, c double, y double")
    model = B.fit(table, FEATURES, "y", "id", F.lit(0), B.Params(trees=3))
    scores = [r[0] for r in table.select(model.score_column()).collect()]
    assert all(0 <= s <= 1 for s in scores) and all(len(t.feature) == 1 for t in model.trees)
