"""Gradient boosting on histograms, grown once (ML3, ML4, ML10).

The state holds the binned features, label, a hash of the key and the margin of every training or validation
row, packed into blocks of rows so that reading it costs no work per row.  The first pass of a tree adds the tree
before it to the margins, which stay persisted for the passes that follow; every ``MARGINS_EVERY`` trees
the state is checkpointed in the shared folder, so a lost executor costs those trees at most.

Per tree and level one tree-wise reduction adds up gradients, hessians and rows per (node, feature, bin): a single Spark job
without a query to plan.  Tasks add up their own rows first, so at most nodes x features x bins sums per task are
passed on and the driver reads sums, never rows.  All nodes of a level are split by their best gain; the leaves are
then limited best first, which gives the tree that splitting leaf by leaf would.  The first pass
of a tree also adds up the validation loss of the trees before it, so patience is judged
while the model grows and nothing is fitted twice.

Rows are sampled by key hash for ``row_period`` trees at a time, columns by tree.  Leaf weights carry L1 and
L2 terms.  Bin edges are discrete quantiles; ties between splits go to the lower feature, then the lower bin.

Null features fall into the lowest bin; rows without a label are not used.  Without training rows the model
has no trees and scores 0.5; without validation rows all trees are kept.
"""

from __future__ import annotations

import heapq
import math
import sys
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ..session import materialize

# Functions that run in tasks travel by value: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROWS_PER_TASK = 200_000
# Fewer rows than that per task only while cores are idle.
SPREAD_ROWS = 25_000
BLOCK_ROWS = 50_000
MARGINS_EVERY = 20
# Gains are compared to this many places, so the order of summation does not decide ties.
GAIN_PLACES = 9


@dataclass(frozen=True)
class Params:
    trees: int = 500
    depth: int = 6
    leaves: int = 31
    rate: float = 0.05
    bins: int = 64
    l1: float = 0.1
    l2: float = 0.1
    min_rows: int = 20
    min_hessian: float = 1e-3
    row_fraction: float = 0.8
    row_period: int = 5
    column_fraction: float = 0.8
    patience: int = 50
    seed: int = 42


@dataclass
class Tree:
    """Nodes as parallel lists; ``feature`` is -1 in a leaf.  Rows with a bin above ``bin`` go right."""
    feature: list = field(default_factory=list)
    bin: list = field(default_factory=list)
    left: list = field(default_factory=list)
    right: list = field(default_factory=list)
    value: list = field(default_factory=list)
    gain: list = field(default_factory=list)
    rows: list = field(default_factory=list)

    def add(self, value: float, rows: int) -> int:
        for name, x in zip(TREE_FIELDS, (-1, -1, -1, -1, value, 0.0, rows)):
            getattr(self, name).append(x)
        return len(self.feature) - 1

    def split(self, node: int, feature: int, bin_: int, gain: float, left: int, right: int) -> None:
        self.feature[node], self.bin[node], self.gain[node] = feature, bin_, gain
        self.left[node], self.right[node] = left, right

    def leaf_of(self, bins: np.ndarray) -> np.ndarray:
        """The node at which every row (of binned features) ends."""
        feature, bin_, left, right = (np.array(x) for x in (self.feature, self.bin, self.left, self.right))
        node, row = np.zeros(len(bins), dtype=np.int64), np.arange(len(bins))
        while True:
            inner = np.flatnonzero(feature[node] >= 0)
            if not len(inner):
                return node
            at = node[inner]
            node[inner] = np.where(bins[row[inner], feature[at]] > bin_[at], right[at], left[at])


TREE_FIELDS = ("feature", "bin", "left", "right", "value", "gain", "rows")


def _margin(bins: np.ndarray, trees: list[Tree], start) -> np.ndarray:
    margin = np.array(start, dtype=np.float64)
    for t in trees:
        margin = margin + np.array(t.value)[t.leaf_of(bins)]
    return margin


def _binned(values: np.ndarray, edges: list[list[float]]) -> np.ndarray:
    """Number of edges below each value, per column; nulls (NaN) have none."""
    cols = [np.where(np.isnan(values[:, i]), 0, np.searchsorted(np.array(e, dtype=np.float64), values[:, i], "left"))
            for i, e in enumerate(edges)]
    return np.stack(cols, axis=1).astype(np.uint8) if cols else np.zeros((len(values), 0), np.uint8)


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-x))


@dataclass
class Booster:
    features: list[str]
    edges: list[list[float]]
    base: float
    trees: list[Tree]
    losses: list[float] = field(default_factory=list)

    def margins(self, values: np.ndarray) -> np.ndarray:
        return _margin(_binned(values, self.edges), self.trees, np.full(len(values), self.base))

    def score_column(self) -> Column:
        """Probability of the positive class, from the feature columns (Arrow batches)."""
        model = replace(self, losses=[])

        @pandas_udf("double")
        def score(*cols: pd.Series) -> pd.Series:
            return pd.Series(_sigmoid(model.margins(np.column_stack([c.to_numpy(dtype=float, na_value=np.nan) for c in cols]))))
        return score(*[F.col(c).cast("double") for c in self.features])

    def importance(self) -> list[tuple[str, float, int]]:
        """(feature, share of the total gain, number of splits)."""
        gain, splits = np.zeros(len(self.features)), np.zeros(len(self.features), dtype=int)
        for t in self.trees:
            for f, g in zip(t.feature, t.gain):
                if f >= 0:
                    gain[f] += g
                    splits[f] += 1
        share = gain / gain.sum() if gain.sum() else gain
        return [(n, float(g), int(s)) for n, g, s in zip(self.features, share, splits)]

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(i, node, *[getattr(t, f)[node] for f in TREE_FIELDS]) for i, t in enumerate(self.trees) for node in range(len(t.value))]
        spark.createDataFrame(rows, _TREES).coalesce(1).write.parquet(f"{path}/trees")
        spark.createDataFrame([(self.features, self.edges, self.base)], _META).coalesce(1).write.parquet(f"{path}/model")


_TREES = "tree int, node int, feature int, bin int, left int, right int, value double, gain double, rows bigint"
_META = "features array<string>, edges array<array<double>>, base double"


def load(spark: SparkSession, path: str) -> Booster:
    meta = spark.read.schema(_META).parquet(f"{path}/model").first()
    trees: dict[int, Tree] = {}
    for r in sorted(spark.read.schema(_TREES).parquet(f"{path}/trees").collect()):
        t = trees.setdefault(r.tree, Tree())
        for f in TREE_FIELDS:
            getattr(t, f).append(r[f])
    return Booster(list(meta.features), [list(e) for e in meta.edges], meta.base, [trees[i] for i in sorted(trees)])


# -- state and sums -----------------------------------------------------------------------------------
# A row is a block: arrays of equal length as little-endian bytes.
STATE = "bins binary, label binary, fold binary, key binary, margin binary"
STATE_TYPES = ("u1", "<f8", "<i4", "<i8", "<f8")


def bin_edges(rows: DataFrame, features: list[str], bins: int) -> list[list[float]]:
    """Distinct discrete quantiles at 1/bins, 2/bins, ... of every feature; the largest value needs no edge."""
    at = [i / bins for i in range(1, bins)]
    found = rows.agg(*[F.percentile_approx(F.col(c).cast("double"), at, 10_000).alias(f"q{i}") for i, c in enumerate(features)],
                     *[F.max(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(features)]).first()
    return [sorted({q for q in found[f"q{i}"] or [] if q < found[f"m{i}"]}) for i in range(len(features))]


def _state(rows: DataFrame, features: list[str], edges: list[list[float]], base: float, parts: int) -> RDD:
    def block(held):
        columns = [np.concatenate(c) for c in zip(*held)]
        values = np.column_stack(columns[:-3])
        packed = [_binned(values, edges), *columns[-3:], np.full(len(values), base)]
        return pa.RecordBatch.from_arrays([pa.array([x.astype(t).tobytes()], pa.binary()) for x, t in zip(packed, STATE_TYPES)],
                                          names=["bins", "label", "fold", "key", "margin"])

    def run(batches):
        held, n = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            n += batch.num_rows
            if n >= BLOCK_ROWS:
                yield block(held)
                held, n = [], 0
        if held:
            yield block(held)
    blocks = rows.select(*features, "label", "fold", "key").repartition(parts).mapInArrow(run, STATE)
    return materialize(blocks).rdd.map(tuple)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _sampled(key: np.ndarray, fraction: float, draw: int) -> np.ndarray:
    if fraction >= 1:
        return np.ones(len(key), dtype=bool)
    u = _mixed(key.astype(np.uint64) + np.uint64((draw * 0x9E3779B97F4A7C15) % 2 ** 64))
    return u < np.uint64(int(fraction * 2.0 ** 64))


def _columns(block, width):
    bins, *others = (np.frombuffer(x, dtype=t) for x, t in zip(block, STATE_TYPES))
    return bins.reshape(-1, width), *others


def _merged(one, other):
    """Two sets of sums (slots ascending; gradient, hessian, rows; loss and its rows) as one."""
    slots = np.concatenate([one[0], other[0]])
    used, at = np.unique(slots, return_inverse=True)
    values = np.concatenate([one[1], other[1]], axis=1)
    return used, np.stack([np.bincount(at, weights=v, minlength=len(used)) for v in values]), one[2] + other[2]


def _sums(state: RDD, width: int, bins: int, tree: Tree, active: list[int], columns: list[int], fraction: float, draw: int):
    """Sums of gradient, hessian and rows as an array (3, active nodes, features, bins), and the validation loss and rows
    of the trees so far (added up with the root only)."""
    size = len(active) * width * bins

    def run(blocks):
        total, loss = np.zeros((3, size)), np.zeros(2)
        nth = np.full(len(tree.feature), -1)
        nth[active] = np.arange(len(active))
        for block in blocks:
            x, label, fold, key, margin = _columns(block, width)
            if tree.feature[0] < 0:
                z, y = margin[fold == 1], label[fold == 1]
                loss += (float((np.logaddexp(0, z) - y * z).sum()), len(z))
            use = np.flatnonzero((fold == 0) & _sampled(key, fraction, draw))
            x = x[use]
            at = nth[tree.leaf_of(x)]
            live = np.flatnonzero(at >= 0)
            x, use, at = x[live], use[live], at[live] * (width * bins)
            p = _sigmoid(margin[use])
            g, h = p - label[use], p * (1 - p)
            for f in columns:
                slot = at + f * bins + x[:, f]
                for s, v in zip(total, (g, h, None)):
                    s += np.bincount(slot, weights=v, minlength=size)
        used = np.flatnonzero(total[2])
        yield used, total[:, used], loss
    used, values, loss = state.mapPartitions(run).treeReduce(_merged)
    hist = np.zeros((3, size))
    hist[:, used] = values
    return hist.reshape(3, len(active), width, bins), loss


# -- growing ------------------------------------------------------------------------------------------
def _shrunk(g, l1: float):
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0)


def _worth(g, h, p: Params):
    return _shrunk(g, p.l1) ** 2 / (h + p.l2)


def _leaf(g: float, h: float, p: Params) -> float:
    return float(-p.rate * _shrunk(g, p.l1) / (h + p.l2)) if h + p.l2 > 0 else 0.0


def best_split(hist: np.ndarray, p: Params):
    """(gain, feature, bin, sums of the left rows, sums of the right rows) of a (3, features, bins) histogram, or None."""
    left = np.cumsum(hist, axis=2)[:, :, :-1]
    right = hist.sum(axis=2)[:, :, None] - left
    whole = hist.sum(axis=2)
    fits = (left[2] >= p.min_rows) & (right[2] >= p.min_rows) & (left[1] >= p.min_hessian) & (right[1] >= p.min_hessian)
    if not fits.any():
        return None
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = _worth(left[0], left[1], p) + _worth(right[0], right[1], p) - _worth(whole[0], whole[1], p)[:, None]
    gain = np.round(np.where(fits, gain, -np.inf), GAIN_PLACES)
    f, b = np.unravel_index(int(gain.argmax()), gain.shape)
    return (float(gain[f, b]), int(f), int(b), left[:, f, b], right[:, f, b]) if gain[f, b] > 0 else None


def _limited(full: Tree, leaves: int) -> Tree:
    """The tree of at most ``leaves`` leaves that splits the best leaf first."""
    out = Tree()
    out.add(full.value[0], full.rows[0])
    heap, made = [], 1

    def offer(own, node):
        if full.feature[node] >= 0:
            heapq.heappush(heap, (-full.gain[node], node, own))
    offer(0, 0)
    while heap and made < leaves:
        gain, node, own = heapq.heappop(heap)
        left, right = (out.add(full.value[k], full.rows[k]) for k in (full.left[node], full.right[node]))
        out.split(own, full.feature[node], full.bin[node], -gain, left, right)
        offer(left, full.left[node])
        offer(right, full.right[node])
        made += 1
    return out


def _grow(state: RDD, number: int, width: int, p: Params):
    """One tree and the validation loss (or None) of the trees before it."""
    rng = np.random.default_rng([p.seed, number])
    columns = sorted(rng.choice(width, max(1, math.ceil(p.column_fraction * width)), replace=False).tolist())
    tree, loss, active = Tree(), None, [0]
    tree.add(0.0, 0)
    for level in range(p.depth):
        hist, (total, n) = _sums(state, width, p.bins, tree, active, columns, p.row_fraction, p.seed + number // p.row_period)
        if level == 0:
            loss = float(total / n) if n else None
            whole = hist[:, 0, columns[0]].sum(axis=1)
            tree.value[0], tree.rows[0] = _leaf(whole[0], whole[1], p), int(whole[2])
        following = []
        for nth, node in enumerate(active):
            found = best_split(hist[:, nth], p)
            if found is None:
                continue
            gain, f, b, *sides = found
            kids = [tree.add(_leaf(s[0], s[1], p), int(s[2])) for s in sides]
            tree.split(node, f, b, gain, *kids)
            following += [k for k in kids if tree.rows[k] >= 2 * p.min_rows]
        active = following
        if not active:
            break
    return _limited(tree, p.leaves), loss


def fit(rows: DataFrame, features: list[str], label: str, key: str, fold: Column, params: Params = Params()) -> Booster:
    """Fit on ``rows``; ``fold`` is 0 for training, 1 for validation rows, anything else is not used."""
    p, width = params, len(features)
    used = rows.select(*[F.col(c).cast("double").alias(c) for c in features], F.col(label).cast("double").alias("label"),
                       fold.cast("int").alias("fold"), F.xxhash64(F.col(key)).alias("key")).where("fold in (0, 1) and label is not null")
    train = used.where("fold = 0")
    size = used.agg(F.count(F.lit(1)), F.count(F.when(F.col("fold") == 0, 1)), F.avg(F.when(F.col("fold") == 0, F.col("label")))).first()
    if not size[1]:
        return Booster(list(features), [[] for _ in features], 0.0, [])
    mean = min(max(size[2], 1e-9), 1 - 1e-9)
    base = math.log(mean / (1 - mean))
    edges = bin_edges(train, features, p.bins)
    idle = min(rows.sparkSession.sparkContext.defaultParallelism, size[0] // SPREAD_ROWS)
    state = _state(used, features, edges, base, max(1, idle, -(-size[0] // ROWS_PER_TASK)))
    trees, losses, best, previous = [], [], 0, None
    while len(trees) < p.trees:
        tree, loss = _grow(state, len(trees), width, p)
        previous = _released(previous)
        if loss is not None:
            losses.append(loss)        # of the trees so far, without the new one
            if loss < losses[best]:
                best = len(losses) - 1
            if len(losses) - 1 - best >= p.patience:
                break
        if len(tree.value) == 1 and tree.value[0] == 0:
            break
        trees.append(tree)
        previous, state = state, _moved(state, tree, width).persist(StorageLevel.MEMORY_AND_DISK)
        if len(trees) % MARGINS_EVERY == 0:
            state.checkpoint()
    keep = best if losses and size[0] > size[1] else len(trees)
    if losses and keep == len(losses) - 1 and len(trees) == len(losses):
        # The loss of the very last tree was not added up by a following pass.
        _, last = _sums(state, width, p.bins, _stump(), [0], [], 1.0, 0)
        losses.append(float(last[0] / last[1]))
        keep = len(trees) if losses[-1] < losses[best] else best
    _released(previous)
    _released(state)
    return Booster(list(features), edges, base, trees[:keep], losses)


def _released(state: RDD | None) -> None:
    """Give up the persisted blocks of a state that the next one has replaced."""
    if state is not None and state.is_cached:
        state.unpersist()


def _stump() -> Tree:
    out = Tree()
    out.add(0.0, 0)
    return out


def _moved(state: RDD, tree: Tree, width: int) -> RDD:
    """The state with the margins that ``tree`` adds."""
    def run(blocks):
        for block in blocks:
            x, *_, margin = _columns(block, width)
            yield *block[:4], _margin(x, [tree], margin).astype("<f8").tobytes()
    return state.mapPartitions(run, preservesPartitioning=True)
