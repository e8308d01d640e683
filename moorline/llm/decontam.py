"""Benchmark decontamination as a prefix-filtered set join.

The query side are the windows of the benchmark: ``window`` consecutive words of an
item, or the whole item where it has fewer words.  A document contains a
window only if it contains the window's rarest shingle (with full containment
the necessary prefix is one shingle), so:

1. ``rarity`` counts the windows' shingles over all documents;
2. every window is indexed under its rarest shingle and that shingle's offset;
3. documents look up their shingles; each hit fixes where the window would have to
   start.  Starts outside the document (length and positional bound) go, the
   rest is verified word for word over the window.

The benchmark is worked through in blocks of at most ``BLOCK`` windows, so what
tasks hold is bounded whatever its size; documents are read twice per block.
Words are compared by their bytes: a block's distinct words are numbered, and words of documents
take the number of the equal word or 0.  Hashes of shingles only propose places.

Defined results: a null or empty document has no words, no hits and is not
contaminated; a null or empty item has no window; an item without identifier
marks words under the identifier ''; rows that repeat an item or a document count
each for themselves (items are reported once); an empty benchmark leaves all
documents clean; documents without identifier are judged like others; texts and words of any length are read
whole; an empty table of documents has no rows; other columns are not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM_WORDS, bounded_arrow, mix, split_words, without, written

WINDOW, SHINGLE = 13, 3
BLOCK = 100_000


def windows(benchmark: DataFrame, id_col="item_id", text_col="text", window: int = WINDOW) -> DataFrame:
    """(item, words) for every window."""
    def run(batches):
        for batch in batches:
            codes, terms, at = split_words(batch.column(1), ALNUM_WORDS)
            terms = terms.to_pylist()
            items, out = [], []
            for i in range(batch.num_rows):
                w = [terms[c] for c in codes[at[i]:at[i + 1]]]
                for s in range(max(0, len(w) - window) + 1 if w else 0):
                    items.append(batch.column(0)[i].as_py())
                    out.append(w[s:s + window])
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(out, pa.list_(pa.string()))],
                                             names=["item", "words"])
    return benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"),
                            F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(run, "item string, words array<string>").distinct()


def numbered_words(text: pa.Array, vocabulary: pa.Array):
    """Per word of all texts its number in the vocabulary (from 1, 0 for others), and the row boundaries."""
    codes, terms, at = split_words(text, ALNUM_WORDS)
    numbers = pc.fill_null(pc.index_in(terms, value_set=vocabulary), -1).to_numpy().astype(np.int64) + 1
    return numbers.astype(np.uint64)[codes], at


def _shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each position on (row boundaries are not looked at)."""
    n = max(0, len(words) - k + 1)
    out = np.full(n, k, dtype=np.uint64)
    for i in range(k):
        out = mix(out + words[i:n + i])
    return out


class _Lookup:
    """Sorted keys with a bit table in front, by which most probes end."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.unique(keys)
        self.bits = np.zeros(1 << 20, dtype=bool)
        self.bits[self.keys & np.uint64((1 << 20) - 1)] = True

    def find(self, probe: np.ndarray):
        """(positions in probe, positions in keys) of all equal pairs."""
        at = np.flatnonzero(self.bits[probe & np.uint64((1 << 20) - 1)])
        where = np.searchsorted(self.keys, probe[at])
        where[where == len(self.keys)] = 0
        same = self.keys[where] == probe[at]
        return at[same], where[same]


def _length_of_shingle(words: np.ndarray, k: int) -> int:
    return min(k, len(words))


def rarity(docs: DataFrame, vocabulary: pa.Array, wanted: dict[int, np.ndarray]) -> DataFrame:
    """(k, shingle, n): occurrences over all documents of the wanted k-word shingles.
    Each task adds up before the shuffle."""
    def run(batches):
        looks = {k: _Lookup(v) for k, v in wanted.items()}
        totals = {k: np.zeros(len(x.keys), dtype=np.int64) for k, x in looks.items()}
        for batch in batches:
            words, _ = numbered_words(batch.column(0), vocabulary)
            for k, look in looks.items():
                _, where = look.find(_shingles(words, k))
                totals[k] += np.bincount(where, minlength=len(look.keys))
        for k, look in looks.items():
            seen = np.flatnonzero(totals[k])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(seen), k, dtype=np.int32)), pa.array(look.keys[seen].astype(np.int64)),
                 pa.array(totals[k][seen])], names=["k", "shingle", "n"])
    return docs.select("text").mapInArrow(run, "k int, shingle bigint, n bigint") \
        .groupBy("k", "shingle").agg(F.sum("n").alias("n"))


class _Index:
    """One block of windows by their rarest shingle."""

    def __init__(self, items: list[str], lines: list[list[str]], shingle: int):
        number: dict[str, int] = {}
        words = [np.array([number.setdefault(x, len(number) + 1) for x in line], dtype=np.uint64) for line in lines]
        self.vocabulary = pa.array(list(number), pa.large_string())
        distinct: dict[bytes, int] = {}
        self.items: list[list[str]] = []
        self.words: list[np.ndarray] = []
        for item, w in zip(items, words):
            i = distinct.setdefault(w.tobytes(), len(distinct))
            if i == len(self.items):
                self.items.append([])
                self.words.append(w)
            self.items[i].append(item)
        self.of = {}
        for i, w in enumerate(self.words):
            k = _length_of_shingle(w, shingle)
            self.of.setdefault(k, []).append((i, _shingles(w, k)))
        self.longest = max((len(w) for w in self.words), default=0)
        self.lengths = np.array([len(w) for w in self.words], dtype=np.int64)
        self.padded = np.zeros((len(self.words), self.longest), dtype=np.uint64)
        for i, w in enumerate(self.words):
            self.padded[i, :len(w)] = w

    def wanted(self) -> dict[int, np.ndarray]:
        return {k: np.unique(np.concatenate([s for _, s in v])) for k, v in self.of.items()}

    def order(self, counts: dict[tuple[int, int], int]) -> None:
        """Choose each window's prefix: the shingle with the fewest occurrences."""
        self.prefix = {}
        for k, entries in self.of.items():
            rows = []
            for i, s in entries:
                rel = min(range(len(s)), key=lambda r: (counts.get((k, int(s[r].astype(np.int64))), 0), int(s[r])))
                rows.append((int(s[rel]), i, rel))
            rows.sort()
            key = np.array([r[0] for r in rows], dtype=np.uint64)
            look = _Lookup(key)
            first = np.searchsorted(key, look.keys, "left")
            last = np.searchsorted(key, look.keys, "right")
            self.prefix[k] = (look, first, last, np.array([r[1] for r in rows]), np.array([r[2] for r in rows]))
        del self.of

    def occurrences(self, words: np.ndarray, at: np.ndarray):
        """(start, window) of all occurrences inside the rows bounded by ``at``."""
        starts, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for k, (look, first, last, window, rel) in self.prefix.items():
            pos, where = look.find(_shingles(words, k))
            many = last[where] - first[where]
            entry = np.repeat(first[where] - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum()) \
                if len(many) else np.zeros(0, np.int64)
            pos = np.repeat(pos, many)
            start, w = pos - rel[entry], window[entry]
            row = np.searchsorted(at, pos, "right") - 1
            fits = (start >= at[row]) & (start + self.lengths[w] <= at[row + 1])
            start, w = start[fits], w[fits]
            same = np.ones(len(start), dtype=bool)
            for j in range(self.longest):
                look_at = np.minimum(start + j, len(words) - 1)
                same &= (j >= self.lengths[w]) | (words[look_at] == self.padded[w, j])
            starts.append(start[same])
            found.append(w[same])
        return np.concatenate(starts), np.concatenate(found)


def _marks(docs: DataFrame, index, every_row: bool) -> DataFrame:
    """Per document: number of words, bit per hit word, items with an occurrence."""
    def run(batches):
        ix = cloudpickle.loads(index.value)
        for batch in batches:
            words, at = numbered_words(batch.column(2), ix.vocabulary)
            n = np.diff(at)
            start, w = ix.occurrences(words, at)
            edge = np.zeros(len(words) + 1, dtype=np.int64)
            np.add.at(edge, start, 1)
            np.add.at(edge, start + ix.lengths[w], -1)
            hit = np.cumsum(edge)[:-1] > 0
            row = np.searchsorted(at, start, "right") - 1
            items: dict[int, set[str]] = {}
            for r, x in set(zip(row.tolist(), w.tolist())):
                items.setdefault(r, set()).update(ix.items[x])
            rows = range(batch.num_rows) if every_row else sorted(items)
            bits = [np.packbits(hit[at[r]:at[r + 1]]).tobytes() if r in items else None for r in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), batch.column(1).take(pa.array(rows, pa.int64())),
                 pa.array([n[r] for r in rows], pa.int64()),
                 pa.array([int(hit[at[r]:at[r + 1]].sum()) for r in rows], pa.int64()),
                 pa.array(bits, pa.binary()), pa.array([sorted(items.get(r, ())) for r in rows], pa.list_(pa.string()))],
                names=["row", "doc_id", "n_words", "n_hit", "bits", "items"])
    return docs.select("row", "doc_id", "text").mapInArrow(run, MARKS.format(docs.schema["doc_id"].dataType.simpleString()))


MARKS = "row bigint, doc_id {}, n_words bigint, n_hit bigint, bits binary, items array<string>"


def _merge(marks: DataFrame) -> DataFrame:
    """Join the marks that several blocks left on one document."""
    def run(pdf):
        first = pdf.iloc[0]
        if len(pdf) > 1:
            bits = [np.frombuffer(b, np.uint8) for b in pdf["bits"] if b is not None]
            items = sorted(set().union(*pdf["items"]))
            hit = int(np.unpackbits(np.bitwise_or.reduce(bits)).sum()) if bits else 0
            return pdf.head(1).assign(n_hit=hit, items=[items])
        return pdf.assign(n_hit=first["n_hit"])
    return marks.groupBy("row").applyInPandas(run, marks.schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col="doc_id", text_col="text", window: int = WINDOW,
                  shingle: int = SHINGLE, block: int = BLOCK, part: int = 20) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, items (with an occurring window)
    and contaminated (n_hit > 0 and part * n_hit >= n_words)."""
    spark = docs.sparkSession
    docs = bounded_arrow(docs) \
        .select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .withColumn("row", F.monotonically_increasing_id())
    lines = written(windows(benchmark, window=window), "benchmark-windows")
    blocks = max(1, -(-lines.count() // block))
    if blocks > 1:
        # Marks of several blocks meet by row number, which must be the same in every scan.
        docs = written(docs, "benchmark-documents")
    marks = None
    for b in range(blocks):
        rows = lines.where(F.pmod(F.xxhash64("item", "words"), F.lit(blocks)) == b).collect()
        index = _Index([r.item for r in rows], [r.words for r in rows], shingle)
        counts = {(r.k, r.shingle): r.n for r in rarity(docs, index.vocabulary, index.wanted()).collect()} if rows else {}
        index.order(counts)
        own = _marks(docs, spark.sparkContext.broadcast(cloudpickle.dumps(index)), every_row=b == 0)
        marks = own if marks is None else marks.unionByName(own)
    if blocks > 1:
        marks = _merge(marks)
    return marks.select("doc_id", "n_words", "n_hit", "items",
                        ((F.col("n_hit") > 0) & (part * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))


def keep_rows(docs: DataFrame, benchmark: DataFrame, id_col="doc_id", text_col="text", **how) -> DataFrame:
    """The documents that are not contaminated, with all their columns.  Equal texts share their
    verdict, so rows are told apart by the digest of their text, whatever their identifiers."""
    def digest(df):
        return F.sha2(F.coalesce(df[text_col].cast("string"), F.lit("")), 256)
    judged = docs.select(digest(docs).alias("__print"), docs[text_col].alias("text"))
    gone = decontaminate(judged, benchmark, "__print", "text", **how).where("contaminated")
    return without(docs, gone, [(digest(docs), "doc_id")])
