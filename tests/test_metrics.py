"""Metrics edge cases checked against brute-force Python computations."""

import random

import numpy as np
import pytest

from moorline.functions.ordered import prefix_sums
from moorline.operators import drift as DR
from moorline.operators import metrics as MT


def brute_auc(labels, scores):
    pos = [s for l, s in zip(labels, scores) if l == 1]
    neg = [s for l, s in zip(labels, scores) if l != 1]
    if not pos or not neg:
        return None
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_auc_matches_brute_force_with_ties(spark, seed):
    rnd = random.Random(seed)
    rows = [(i, rnd.randint(0, 1), rnd.choice([0.1, 0.2, 0.5, 0.7, 0.9]) + rnd.choice([0, 0, 0.01]))
            for i in range(400)]
    df = spark.createDataFrame(rows, "customer_id long, label int, score double")
    got = MT.auc(df).first()[0]
    exp = brute_auc([r[1] for r in rows], [r[2] for r in rows])
    assert abs(got - exp) < 1e-12


def test_single_class_and_zero_positives(spark):
    df = spark.createDataFrame([(i, 1, 0.1) for i in range(10)], "customer_id long, label int, score double")
    m = MT.binary_metrics(df).first()
    assert m.auc is None                       # one class only
    assert m.precision == 0.0 and m.recall == 0.0 and m.f1 == 0.0   # no predicted positives
    assert m.false_positive_rate == 0.0


def test_prefix_sums_against_cumsum(spark):
    rnd = random.Random(7)
    vals = sorted({round(rnd.uniform(-50, 50), 3) for _ in range(3000)})
    rows = [(v, rnd.randint(0, 5)) for v in vals]
    df = spark.createDataFrame(rows, "v double, w long")
    got = {r.v: (r.cum_w, r.prev_v) for r in prefix_sums(df, "v", ["w"], buckets=16, with_prev=True).collect()}
    run, prev = 0, None
    for v, w in rows:
        run += w
        assert got[v] == (run, prev)
        prev = v


def test_wasserstein_against_numpy(spark):
    rnd = np.random.default_rng(3)
    ref = rnd.normal(0, 1, 500).round(2)
    prod = rnd.normal(0.5, 1.2, 300).round(2)
    rows = [("f", float(x), "reference") for x in ref] + [("f", float(x), "production") for x in prod]
    df = spark.createDataFrame(rows, "feature string, value double, period string")
    got = DR.wasserstein(df, places=9).first()
    xs = np.unique(np.concatenate([ref, prod]))
    cr = np.searchsorted(np.sort(ref), xs, side="right") / len(ref)
    cp = np.searchsorted(np.sort(prod), xs, side="right") / len(prod)
    w1 = float(np.sum(np.abs(cr - cp)[:-1] * np.diff(xs)))
    assert abs(got.wasserstein - w1) < 1e-6
    assert abs(got.wasserstein_norm - w1 / ref.std()) < 1e-6
