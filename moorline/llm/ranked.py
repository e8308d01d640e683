"""Ranked lexical search by hybrid term-at-a-time and document-at-a-time scoring.

``index`` writes one row per block of documents: the block's distinct terms (bytes),
their postings (document within the block, occurrences), the documents' identifiers
and lengths.  A block holds about ``BLOCK_BYTES`` of text, so neither building nor
searching depends on how often a term occurs in the corpus: a term that stands in every
document is one list per block.  Postings are never shuffled.

``search`` works through the queries in blocks of at most ``QUERIES``:

1. document frequencies of their terms are added up over the blocks of the index;
2. in every block the short lists of a query are summed up term at a time into
   accumulators.  These are from then on one more iterator, sorted by document
   and bounded by its largest sum, beside the long lists;
3. windows of documents are walked in order.  Iterators whose bounds together stay below the
   query's tenth best score so far (the task keeps it from block to block) propose no
   documents; they are probed only at the documents that the others propose and that can
   still reach that score, and windows without such documents are skipped;
4. the ten best of every task are merged per query.

The score is integer arithmetic (``weight``, ``norms``, ``impact``), so results
do not depend on the order in which blocks are met.

Defined results: null and empty texts have no terms, count in no statistic and are never
found; a query without terms, or whose terms occur nowhere, has no rows; only scores above 0 count;
equal scores go by ascending identifier, null identifiers last; repeated rows of documents
or queries each count for themselves; a text of any length is read whole and is part of one
block; empty tables give no rows; other columns are not read, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ALNUM_WORDS, bounded_arrow, cut, split_words, work_uri, written

BLOCK_BYTES = 16 << 20
QUERIES = 2000
# Lists of at most this share of a block's documents are short.
SHORT = 1 / 16
WINDOW = 4096

INDEX = ("ids array<bigint>, lengths binary, n_docs bigint, n_terms bigint, terms array<binary>, "
         "first binary, docs binary, counts binary, width int")


# -- the score ------------------------------------------------------------------------------------
def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def norms(lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    return 100 - 90 + (90 * lengths * n_docs) // max(n_terms, 1)


def impact(w: int, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return w * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


# -- the index ------------------------------------------------------------------------------------
def _block(ids: pa.Array, text: pa.Array) -> pa.RecordBatch:
    codes, terms, at = split_words(text, ALNUM_WORDS)
    n = len(ids)
    lengths = np.diff(at)
    row = np.repeat(np.arange(n, dtype=np.int64), lengths)
    pairs, counts = np.unique(codes * n + row, return_counts=True)
    first = np.searchsorted(pairs, np.arange(len(terms) + 1, dtype=np.int64) * n)
    width = 1 if not len(counts) or counts.max() < 256 else 4
    return pa.RecordBatch.from_arrays(
        [pa.array([ids.to_pylist()], pa.list_(pa.int64())), pa.array([lengths.astype("<i8").tobytes()], pa.binary()),
         pa.array([int((lengths > 0).sum())], pa.int64()), pa.array([int(at[-1])], pa.int64()),
         pa.ListArray.from_arrays(pa.array([0, len(terms)], pa.int32()), terms.cast(pa.binary())),
         pa.array([first.astype("<i8").tobytes()], pa.binary()),
         pa.array([(pairs % max(n, 1)).astype("<i4").tobytes()], pa.binary()),
         pa.array([counts.astype(f"<u{width}").tobytes()], pa.binary()), pa.array([width], pa.int32())],
        names=["ids", "lengths", "n_docs", "n_terms", "terms", "first", "docs", "counts", "width"])


def index(docs: DataFrame, path: str | None = None, id_col="doc_id", text_col="text") -> DataFrame:
    """Write the index of all documents and return it, one row per block."""
    spark = docs.sparkSession

    def run(batches):
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= BLOCK_BYTES:
                yield _block(*_columns(held))
                held, size = [], 0
        if any(b.num_rows for b in held):
            yield _block(*_columns(held))

    path = path or work_uri(spark, "ranked-index")
    bounded_arrow(docs).select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(run, INDEX).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(INDEX).parquet(path)


def _columns(batches):
    table = pa.Table.from_batches(batches)
    return [table.column(i).combine_chunks() if table.column(i).num_chunks != 1 else table.column(i).chunk(0) for i in (0, 1)]


# -- the search -----------------------------------------------------------------------------------
class _Best:
    """The best documents of one query so far."""

    def __init__(self, k: int):
        self.k, self.rows, self.least = k, [], 1

    def add(self, scores, ids) -> None:
        fits = np.flatnonzero(scores >= self.least)
        if len(fits):
            new = [(-int(scores[i]), ids[i] is None, ids[i] or 0, ids[i]) for i in fits]
            self.rows = sorted(self.rows + new, key=lambda r: r[:3])[:self.k]
            if len(self.rows) == self.k:
                self.least = -self.rows[-1][0]


def _accumulate(lists: list):
    """Sum up lists of (documents, impacts) term at a time into one such list."""
    docs = np.concatenate([d for d, _ in lists])
    order = np.argsort(docs, kind="stable")
    docs, values = docs[order], np.concatenate([v for _, v in lists])[order]
    starts = np.flatnonzero(np.concatenate([[True], docs[1:] != docs[:-1]]))
    return docs[starts], np.add.reduceat(values, starts)


def score_block(lists: list, ids: list, best: _Best, short: float = SHORT, window: int = WINDOW) -> None:
    """Score one block for one query; ``lists`` are (documents, impacts), sorted by document."""
    few = [x for x in lists if len(x[0]) <= short * len(ids)]
    iterators = [x for x in lists if len(x[0]) > short * len(ids)]
    if few:
        iterators.append(_accumulate(few))
    bounds = np.array([int(v.max()) for _, v in iterators], dtype=np.int64)
    order = np.argsort(bounds, kind="stable")
    iterators, bounds = [iterators[i] for i in order], bounds[order]
    below = np.cumsum(bounds)                       # what the first i + 1 iterators can add at most
    if not len(below) or below[-1] < best.least:
        return
    for lo in range(0, len(ids), window):
        hi = min(len(ids), lo + window)
        # The iterators from ``split`` on propose documents, the others are probed.
        split = int(np.searchsorted(below, best.least, "left"))
        if split == len(iterators):
            return
        sums = np.zeros(hi - lo, dtype=np.int64)
        for docs, values in iterators[split:]:
            a, b = np.searchsorted(docs, (lo, hi))
            sums[docs[a:b] - lo] += values[a:b]
        rest = int(below[split - 1]) if split else 0
        found = np.flatnonzero((sums > 0) & (sums + rest >= best.least))
        for i in range(split - 1, -1, -1):
            if not len(found):
                break
            docs, values = iterators[i]
            at = np.minimum(np.searchsorted(docs, found + lo), len(docs) - 1)
            sums[found] += np.where(docs[at] == found + lo, values[at], 0)
            rest -= int(bounds[i])
            found = found[sums[found] + rest >= best.least]
        best.add(sums[found], [ids[d + lo] for d in found])


def _matches(terms: pa.Array, vocabulary: pa.Array):
    """(position in the block's terms, position in the vocabulary) of the common terms."""
    where = pc.index_in(terms, value_set=vocabulary)
    at = np.flatnonzero(where.is_valid().to_numpy(zero_copy_only=False))
    return at, where.drop_null().to_numpy().astype(np.int64)


def frequencies(blocks: DataFrame, vocabulary) -> DataFrame:
    """(term, df): documents that hold each term of a broadcast vocabulary (by its position)."""
    def run(batches):
        words = cloudpickle.loads(vocabulary.value)
        total = np.zeros(len(words), dtype=np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                at, term = _matches(batch.column(0)[i].values, words)
                first = np.frombuffer(batch.column(1)[i].as_py(), "<i8")
                total[term] += first[at + 1] - first[at]
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen])], names=["term", "df"])
    return blocks.select("terms", "first").mapInArrow(run, "term bigint, df bigint") \
        .groupBy("term").agg(F.sum("df").alias("df"))


def _found(blocks: DataFrame, plan, k: int) -> DataFrame:
    """The k best of every task: query, doc_id, score."""
    def run(batches):
        words, weights, queries, n_docs, n_terms = cloudpickle.loads(plan.value)
        best = {q: _Best(k) for q in queries}
        for batch in batches:
            for row in range(batch.num_rows):
                ids, lengths, _, _, terms, first, docs, counts, width = (c[row] for c in batch.columns)
                ids, first = ids.as_py(), np.frombuffer(first.as_buffer(), "<i8")
                m = norms(np.frombuffer(lengths.as_buffer(), "<i8"), n_docs, n_terms)
                docs, counts = np.frombuffer(docs.as_buffer(), "<i4"), np.frombuffer(counts.as_buffer(), f"<u{width.as_py()}")
                lists = {}
                for at, term in zip(*_matches(terms.values, words)):
                    d = docs[first[at]:first[at + 1]]
                    lists[term] = (d, impact(weights[term], counts[first[at]:first[at + 1]].astype(np.int64), m[d]))
                for q, of in queries.items():
                    held = [lists[t] for t in of if t in lists]
                    if held:
                        score_block(held, ids, best[q])
        rows = [(q, r[3], -r[0]) for q, b in best.items() for r in b.rows]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(3)],
                                         names=["query", "doc_id", "score"])
    return blocks.mapInArrow(run, "query bigint, doc_id bigint, score bigint")


def query_terms(queries: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(query, item, terms): every row of ``queries`` under a number of its own."""
    def run(batches):
        for batch in batches:
            codes, terms, at = split_words(batch.column(2), ALNUM_WORDS)
            own = [terms.take(pa.array(np.unique(codes[at[i]:at[i + 1]]))).to_pylist() for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(own, pa.list_(pa.binary()))],
                                             names=["query", "item", "terms"])
    item = queries.schema[id_col].dataType.simpleString()
    rows = queries.select(F.monotonically_increasing_id().alias("query"), F.col(id_col).alias("item"),
                          F.col(text_col).cast("string").alias("text"))
    return written(rows.mapInArrow(run, f"query bigint, item {item}, terms array<binary>"), "ranked-queries")


def search(blocks: DataFrame, queries: DataFrame, k: int = 10, id_col="item_id", text_col="text",
           at_once: int = QUERIES) -> DataFrame:
    """The k best documents of every query, as (``id_col``, rank, doc_id, score)."""
    spark = blocks.sparkSession
    asked = query_terms(queries, id_col, text_col)
    size = blocks.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    found, parts = None, max(1, -(-asked.count() // at_once))
    for part in range(parts):
        rows = asked.where(F.pmod(F.xxhash64("query"), F.lit(parts)) == part).select("query", "terms").collect()
        code: dict[bytes, int] = {}
        wanted = {r.query: [code.setdefault(bytes(t), len(code)) for t in r.terms] for r in rows}
        words = pa.array(list(code), pa.binary())
        df = {r.term: r.df for r in frequencies(blocks, spark.sparkContext.broadcast(cloudpickle.dumps(words))).collect()}
        weights = [weight(size[0] or 0, df.get(t, 0)) for t in range(len(code))]
        plan = (words, weights, wanted, size[0] or 0, size[1] or 0)
        own = _found(blocks, spark.sparkContext.broadcast(cloudpickle.dumps(plan)), k)
        found = own if found is None else found.unionByName(own)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = cut(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k))
    return ranked.join(asked.select("query", "item"), "query").select(F.col("item").alias(id_col), "rank", "doc_id", "score")
