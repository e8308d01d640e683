"""Suffix-array deduplication: passages of ``length`` bytes that stand in several places.

A start is a byte position followed by ``length`` bytes of its document.  Its key is the least hash of
the 40-byte strings in them, so equal strings have equal keys.  Neighbouring starts mostly share
their key: such a run is described by its key and the digest of the bytes its strings cover.

1. Keys are counted over the corpus.  Those that occur once cannot be part of a repetition;
   a bit table of fixed size lets most of their runs go (it only ever lets too many through).
   Runs of periodic text, in which a string may stand twice, count twice.
2. Runs with equal key and digest are copies of each other: one *class*, with its number and
   first place.  All classes but the first of a key, and all members but the first of a class,
   need no bytes to be told apart.
3. Keys with several classes (or periodic runs): the bytes of one member of each class are sorted in suffix
   order.  With LCP values between neighbours, the previous and next suffix that stands earlier in
   the corpus give the longest previous factor of every start, those that stand later the longest next factor.
   A start whose previous factor has ``length`` bytes is a later copy.  Keys of more than ``MOST`` starts
   are not gathered: blocks of their strings are counted by digest, ever finer where they differ.
4. Repeated starts go back to all members, and their strings are cut out of the documents.

Places are ordered by identifier (null last) and position.  ``keep="first"`` removes every byte
that belongs to a string of ``length`` bytes found earlier; ``keep="none"`` removes those of every
string that is found anywhere else.

Defined results: null and empty texts have no bytes and keep none; texts shorter than ``length``
stay whole; texts of any length are read whole, in segments; rows that repeat identifier and
text are copies like any others (which of them counts as first is arbitrary); matches never cross
documents; removed bytes may cut a character, so what is kept is binary; an empty table has no
rows; other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.joins import broadcast_if_bounded
from .common import POWERS, BROADCAST_ROWS, bounded_arrow, mix, written

LENGTH, GRAM = 200, 40
# Starts of a run, and bytes that are hashed at a time.
RUN, SEGMENT = 512, 1 << 20
# Bits of the table of keys that occur more than once; suffixes that are gathered for one sort (a key
# with more of them, 100 MB of strings, is not gathered) and that small keys are collected to.
TABLE_BITS, MOST, BATCH = 1 << 27, 1 << 19, 1 << 16
NEVER = np.iinfo(np.uint64).max


# -- runs of starts -----------------------------------------------------------------------------------
def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    up, down = POWERS.get(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=total[1:])
    return mix((total[gram:] - total[:-gram]) * down[:len(data) - gram + 1])


def _sliding(values: np.ndarray, w: int, best, blank) -> np.ndarray:
    """``best`` (np.minimum or np.maximum) of every ``w`` consecutive values."""
    blocks = np.full(-(-len(values) // w) * w, blank, dtype=np.uint64)
    blocks[:len(values)] = values
    blocks = blocks.reshape(-1, w)
    before = best.accumulate(blocks, axis=1).ravel()
    after = best.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(values) - w + 1
    return best(after[:n], before[w - 1:w - 1 + n])


def least_hashes(data: np.ndarray, length: int):
    """For every start the least hash of the strings of GRAM bytes in its ``length`` bytes; and the
    positions (q, r) of neighbouring least strings that are equal, as in periodic text."""
    h = _gram_hashes(data, min(GRAM, length))
    w = length - min(GRAM, length) + 1
    least = _sliding(h, w, np.minimum, NEVER)
    # A string is the least of some start if its hash is the largest of the least hashes around it.
    around = _sliding(np.concatenate([np.zeros(w - 1, np.uint64), least, np.zeros(w - 1, np.uint64)]), w, np.maximum, 0)
    at = np.flatnonzero(h == around)
    same = np.flatnonzero(h[at[1:]] == h[at[:-1]])
    return least, at[same], at[same + 1]


def _pieces(text: pa.Array, length: int):
    """(bytes, document and position of their first byte, edges of documents) in pieces of about SEGMENT bytes.
    Long documents are cut at multiples of SEGMENT, with an overlap; short ones share a piece."""
    text = text.cast(pa.large_binary()).fill_null(b"")
    at = np.frombuffer(text.buffers()[1], dtype=np.int64, count=len(text) + 1 + text.offset)[text.offset:]
    raw = np.frombuffer(text.buffers()[2] or b"", dtype=np.uint8)
    i = 0
    while i < len(text):
        if at[i + 1] - at[i] > SEGMENT:
            for s in range(0, at[i + 1] - at[i] - length + 1, SEGMENT):
                part = raw[at[i] + s:min(at[i + 1], at[i] + s + SEGMENT + length - 1)]
                yield part, np.array([0, len(part)]), i, s
            i += 1
            continue
        j = max(i + 1, int(np.searchsorted(at, at[i] + SEGMENT, "right")) - 1)
        yield raw[at[i]:at[j]], at[i:j + 1] - at[i], i, 0
        i = j


def runs_of(text: pa.Array, length: int = LENGTH):
    """(bytes, document, position in it, position in the bytes, starts, key, whether a string may stand
    twice in the run) arrays of all runs, piece by piece."""
    for data, edges, i, s in _pieces(text, length):
        if len(data) < length:
            continue
        key, left, right = least_hashes(data, length)
        sizes = np.diff(edges)
        doc = np.repeat(np.arange(len(sizes)), sizes)[:len(key)]
        valid = np.arange(length, length + len(key)) <= np.repeat(edges[1:], sizes)[:len(key)]
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (doc[1:] != doc[:-1]) | ~valid[:-1]]) & valid
        first = np.flatnonzero(new)
        if not len(first):
            continue
        stops = np.append(np.flatnonzero(new | ~valid), len(key))
        n = stops[np.searchsorted(stops, first, "right")] - first
        own = np.searchsorted(right, first + n - 1 + length - min(GRAM, length), "right") > np.searchsorted(left, first, "left")
        # Runs of periodic text are cut into pieces of RUN starts.
        parts = -(-n // RUN)
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        start = np.repeat(first, parts) + nth * RUN
        n = np.minimum(np.repeat(n, parts) - nth * RUN, RUN)
        yield data, i + doc[start], s + start - edges[doc[start]], start, n, key[start], np.repeat(own, parts)


def _keys(docs: DataFrame, length: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for *_, key, own in runs_of(batch.column(0), length):
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(key, own + 1).astype(np.int64))], names=["key"])
    return docs.select("text").mapInArrow(run, "key bigint")


def _repeated(docs: DataFrame, length: int, bits: int) -> np.ndarray:
    """Bit table (packed) of the keys that occur more than once; its size does not depend on the corpus."""
    twice = _keys(docs, length).groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    bit = F.pmod("key", F.lit(bits)) + 1        # bucket 1 starts with number 1
    rows = twice.groupBy(F.bitmap_bucket_number(bit).alias("bucket")) \
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits")).collect()
    width = len(rows[0].bits) if rows else 4096
    table = np.zeros(-(-bits // (8 * width)) * width + width, dtype=np.uint8)
    for r in rows:
        table[(r.bucket - 1) * width:r.bucket * width] = np.frombuffer(r.bits, np.uint8)
    return table


RUNS = "key bigint, digest binary, doc bigint, row bigint, at bigint, n int, own boolean"


def _runs(docs: DataFrame, table, length: int, bits: int) -> DataFrame:
    """The runs whose key may occur more than once."""
    def run(batches):
        held = table.value
        for batch in batches:
            doc_id, row = batch.column(0), batch.column(1)
            for data, i, at, start, n, key, own in runs_of(batch.column(2), length):
                bit = key.astype(np.int64) % bits
                likely = np.flatnonzero((held[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1)
                raw = data.tobytes()
                digests = [hashlib.blake2b(raw[a:b], digest_size=16).digest()
                           for a, b in zip(start[likely].tolist(), (start + n + length - 1)[likely].tolist())]
                of = pa.array(i[likely])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[likely].astype(np.int64)), pa.array(digests, pa.binary()), doc_id.take(of), row.take(of),
                     pa.array(at[likely], pa.int64()), pa.array(n[likely], pa.int32()), pa.array(own[likely])],
                    names=["key", "digest", "doc", "row", "at", "n", "own"])
    return docs.select("doc_id", "row", "text").mapInArrow(run, RUNS)


# -- suffix order -------------------------------------------------------------------------------------
def _nearest_smaller(place: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """For every rank of a suffix array the LCP with the nearest suffix before it that has a
    smaller place (0 if there is none); ``lcp[r]`` is that of ranks r - 1 and r.  Ranks
    jump over those that are not smaller, all at once."""
    n = len(place)
    to = np.arange(-1, n - 1)
    least = lcp.copy()
    todo = np.flatnonzero(to >= 0)
    while len(todo):
        todo = todo[(to[todo] >= 0) & (place[to[todo]] > place[todo])]
        via = to[todo]
        least[todo] = np.minimum(least[todo], least[via])
        to[todo] = to[via]
    return np.where(to >= 0, least, 0)


def _lcp(strings: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Bytes that every string shares with the one before it in ``order``, compared eight at a time."""
    n, width = strings.shape
    words = strings if width % 8 == 0 else np.pad(strings, ((0, 0), (0, -width % 8)))
    words = np.ascontiguousarray(words).view("<u8")
    out = np.zeros(n, dtype=np.int64)
    for a in range(1, n, 1 << 14):
        b = min(n, a + (1 << 14))
        mixed = words[order[a:b]] ^ words[order[a - 1:b - 1]]
        first = (mixed != 0).argmax(axis=1)
        word = mixed[np.arange(b - a), first]
        lowest = word & (~word + np.uint64(1))          # the lowest set bit lies in the first differing byte
        byte = np.searchsorted(_BYTE_ENDS, lowest, "right")
        out[a:b] = np.where(word == 0, width, 8 * first + byte)
    return out


_BYTE_ENDS = np.array([1 << (8 * i) for i in range(1, 8)], dtype=np.uint64)


def factors(strings: np.ndarray):
    """Longest previous and longest next factor of every string (rows of bytes, in the order of their
    places): how many bytes it shares with any earlier and any later one."""
    n, width = strings.shape
    order = np.argsort(np.ascontiguousarray(strings).view(f"S{width}").ravel(), kind="stable")
    lcp = _lcp(strings, order)
    back, down = order[::-1], np.concatenate([[0], lcp[:0:-1]])
    previous, following = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    previous[order] = _nearest_smaller(order, lcp)
    previous[back] = np.maximum(previous[back], _nearest_smaller(back, down))
    following[order] = _nearest_smaller(-order, lcp)
    following[back] = np.maximum(following[back], _nearest_smaller(-back, down))
    return previous, following


def _merged(pairs: list[int]) -> np.ndarray:
    """Intervals (from, to, from, to, ...) as disjoint ones in order.  Sorted starts and ends pair up where a
    start lies beyond all ends before it; intervals that touch are one."""
    both = np.sort(np.array(pairs, dtype=np.int64).reshape(-1, 2), axis=0)
    if not len(both):
        return both
    new = np.flatnonzero(np.concatenate([[True], both[1:, 0] > both[:-1, 1]]))
    return np.stack([both[new, 0], both[np.append(new[1:] - 1, len(both) - 1), 1]], axis=1)


def _intervals(flags: np.ndarray, length: int) -> list[int]:
    """Bytes covered by the strings at flagged starts: from, to, from, to, ..."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.stack([np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + length - 1], axis=1).ravel().tolist()


CONTEXTS = ("key bigint, digest binary, copies bigint, starts bigint, own boolean, doc bigint, row bigint, at bigint, n int, "
            "bytes binary")
COVERED = "key bigint, digest binary, earlier array<int>, other array<int>"


def _strings(contexts: list[dict], length: int) -> np.ndarray:
    blob = np.frombuffer(b"".join(c["bytes"] for c in contexts), dtype=np.uint8)
    n = np.array([c["n"] for c in contexts])
    base = np.cumsum(n + length - 1) - (n + length - 1)
    start = np.repeat(base - (np.cumsum(n) - n), n) + np.arange(n.sum())
    return np.lib.stride_tricks.sliding_window_view(blob, length)[start]


def _place(c: dict):
    return c["doc"] is None, c["doc"] or 0, c["row"], c["at"]


def _suffix_order(contexts: DataFrame, length: int, batch_starts: int) -> DataFrame:
    """COVERED for every class: whole keys are sorted in suffix order, as many as fit into a batch."""
    def solve(held):
        held.sort(key=_place)
        previous, following = factors(_strings(held, length))
        at, out = 0, []
        for c in held:
            own = slice(at, at + c["n"])
            at += c["n"]
            earlier = previous[own] >= length
            other = earlier | (following[own] >= length) | (c["copies"] > 1)
            out.append((c["key"], c["digest"], _intervals(earlier, length), _intervals(other, length)))
        return _covered(out)

    def run(batches):
        held, starts, key = [], 0, None
        for batch in batches:
            for c in batch.to_pylist():
                if c["key"] != key and starts >= batch_starts:
                    yield solve(held)
                    held, starts = [], 0
                key = c["key"]
                held.append(c)
                starts += c["n"]
        if held:
            yield solve(held)
    parts = int(contexts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return contexts.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(run, COVERED)


def _covered(rows: list) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32()))
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                                      names=["key", "digest", "earlier", "other"])


WIDTHS = (64, 16, 4, 1)
PIECES = ("key bigint, digest binary, copies bigint, own boolean, doc bigint, row bigint, at bigint, low int, n int, anchor int, "
          "bytes binary, block int, core binary, whole binary")


def _anchor(key: int, data: bytes, length: int) -> int:
    """Position of the string of GRAM bytes whose hash is the key."""
    return int(np.argmax(_gram_hashes(np.frombuffer(data, np.uint8), min(GRAM, length)) == np.uint64(key % 2 ** 64)))


def _blocks(pieces: DataFrame, width: int, length: int) -> DataFrame:
    """Cut pieces of starts into blocks of ``width`` by their distance from the anchor, with digests of the
    bytes that every string of a full block holds (core) and of all bytes of the block (whole)."""
    def run(batches):
        for batch in batches:
            out = []
            for c in batch.to_pylist():
                data, n = c["bytes"], c["n"]
                anchor = c["anchor"] if c["anchor"] is not None else _anchor(c["key"], data, length)
                if c["own"] and width > 1:
                    out.append(c | {"anchor": anchor, "block": None, "core": None, "whole": None})
                    continue
                start = 0
                while start < n:
                    block = (anchor - start) // width
                    end = min(n, anchor - block * width + 1)
                    first = anchor - block * width
                    own, core = data[start:end + length - 1], data[first:first + length - width + 1]
                    out.append(c | {"low": c["low"] + start, "n": end - start, "anchor": anchor - start, "bytes": own,
                                    "block": 0 if c["own"] else block, "core": hashlib.blake2b(core, digest_size=16).digest(),
                                    "whole": hashlib.blake2b(own, digest_size=16).digest()})
                    start = end
            yield pa.RecordBatch.from_pylist(out, schema=_PIECES)
    return pieces.mapInArrow(run, PIECES)


_PIECES = pa.schema([(x.split()[0], {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}[x.split()[1]])
                     for x in PIECES.split(", ")])


def _counted(contexts: DataFrame, length: int) -> DataFrame:
    """COVERED for the classes of very frequent keys, which no task gathers: blocks of starts are counted by the
    digest of their bytes.  Blocks that stand elsewhere are settled, but for the first of each kind; blocks whose core stands
    nowhere else hold no repeated string; the others are cut finer, down to single starts."""
    pieces = contexts.select("key", "digest", "copies", "own", "doc", "row", "at", F.lit(0).alias("low"), "n",
                             F.lit(None).cast("int").alias("anchor"), "bytes")
    place = F.struct(F.col("doc").isNull().alias("last"), "doc", "row", (F.col("at") + F.col("low")).alias("at"))
    settled = None
    for width in WIDTHS:
        cut = written(_blocks(pieces, width, length).withColumn("place", place), "suffix-blocks")
        kinds = written(cut.where("block is not null").groupBy("key", "block", "core", "whole")
                        .agg(F.count(F.lit(1)).alias("places"), F.min("place").alias("first")), "suffix-kinds")
        cores = kinds.groupBy("key", "block", "core").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
        counted = cut.join(kinds.where("places > 1"), ["key", "block", "core", "whole"], "left")
        later = F.coalesce(F.col("place") > F.col("first"), F.lit(False))
        flagged = counted.where("places is not null").select(
            "key", "digest", F.array(F.col("low"), F.col("low") + F.col("n") + length - 1).alias("span"), later.alias("earlier"))
        settled = flagged if settled is None else settled.unionByName(flagged)
        if width > 1:
            pieces = counted.where(~later).join(cores.withColumn("open", F.lit(True)), ["key", "block", "core"], "left") \
                .where("block is null or open").select(*pieces.columns)
    spans = settled.groupBy("key", "digest").agg(
        F.flatten(F.collect_list(F.when(F.col("earlier"), F.col("span")))).alias("earlier"),
        F.flatten(F.collect_list("span")).alias("other"))

    def merge(batches):
        for batch in batches:
            yield _covered([(key, digest, *[_merged(x).ravel().tolist() for x in pairs])
                            for key, digest, *pairs in zip(*(batch.column(i).to_pylist() for i in range(4)))])
    return spans.mapInArrow(merge, COVERED)


# -- the operator -------------------------------------------------------------------------------------
def _contexts(docs: DataFrame, classes: DataFrame, length: int) -> DataFrame:
    """The bytes of the first member of every class."""
    wanted = classes.groupBy("row").agg(F.collect_list(F.struct("key", "digest", "copies", "starts", "own", "doc", "at", "n")).alias("wanted"))
    rows = docs.select("row", "text").join(wanted, "row")

    def run(batches):
        for batch in batches:
            for row, text, wanted in zip(*(batch.column(i) for i in range(3))):
                data, out = text.as_buffer(), []
                for c in wanted.as_py():
                    out.append(c | {"row": row.as_py(), "bytes": data[c["at"]:c["at"] + c["n"] + length - 1].to_pybytes()})
                yield pa.RecordBatch.from_pylist(out, schema=_CONTEXTS)
    return rows.select("row", F.col("text").cast("binary").alias("text"), "wanted").mapInArrow(run, CONTEXTS)


_CONTEXTS = pa.schema([("key", pa.int64()), ("digest", pa.binary()), ("copies", pa.int64()), ("starts", pa.int64()), ("own", pa.bool_()),
                       ("doc", pa.int64()), ("row", pa.int64()), ("at", pa.int64()), ("n", pa.int32()), ("bytes", pa.binary())])


def _spans(docs: DataFrame, keep: str, length: int, table_bits: int, batch: int, most: int) -> DataFrame:
    """(row, cuts): byte intervals of every document with something to remove."""
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(_repeated(docs, length, table_bits))
    runs = written(_runs(docs, table, length, table_bits), "suffix-runs")
    place = F.struct(F.col("doc").isNull().alias("last"), "doc", "row", "at")
    classes = written(runs.groupBy("key", "digest").agg(F.count(F.lit(1)).alias("copies"), F.min(place).alias("first"),
                                                        F.max("n").alias("n"), F.max("own").alias("own")), "suffix-classes")
    keys = classes.groupBy("key").agg(F.count(F.lit(1)).alias("classes"), F.sum("n").alias("starts"), F.max("own").alias("own")) \
        .where("classes > 1 or own")
    several = classes.drop("own").join(keys, "key").select("key", "digest", "copies", "first.doc", "first.row", "first.at", "n", "starts", "own")
    contexts = written(_contexts(docs, several, length), "suffix-contexts")
    covered = _suffix_order(contexts.where(F.col("starts") <= most), length, batch) \
        .unionByName(_counted(contexts.where(F.col("starts") > most), length))

    whole = F.array(F.lit(0), F.col("n") + length - 1)
    none = F.array().cast("array<int>")
    known = classes.join(written(covered, "suffix-covered"), ["key", "digest"], "left") \
        .where("copies > 1 or coalesce(size(other), 0) > 0").select("key", "digest", "copies", "first", "earlier", "other")
    members = runs.join(known, ["key", "digest"])
    if keep == "none":
        cuts = F.when(F.col("copies") > 1, whole).otherwise(F.col("other"))
    else:
        later = (F.col("row") != F.col("first.row")) | (F.col("at") != F.col("first.at"))
        cuts = F.when(later, whole).otherwise(F.coalesce("earlier", none))
    return members.select("row", F.transform(cuts, lambda x: x + F.col("at")).alias("cuts")).where("size(cuts) > 0") \
        .groupBy("row").agg(F.flatten(F.collect_list("cuts")).alias("cuts"))


CUT = "doc_id bigint, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary"


def dedup(docs: DataFrame, keep: str = "first", length: int = LENGTH, id_col="doc_id", text_col="text",
          table_bits: int = TABLE_BITS, batch: int = BATCH, most: int = MOST) -> DataFrame:
    """One row per document: doc_id, n_bytes, spans (maximal removed byte runs, end exclusive) and kept
    (the remaining bytes)."""
    docs = written(bounded_arrow(docs).select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")), "suffix-docs")
    cuts = written(_spans(docs, keep, length, table_bits, batch, most), "suffix-cuts")

    def run(batches):
        for rows in batches:
            sizes, spans, kept = [], [], []
            for text, cut in zip(rows.column(1), rows.column(2)):
                data = text.as_buffer()
                merged = _merged(cut.as_py())
                edges = [0, *merged.ravel().tolist(), data.size]
                sizes.append(data.size)
                spans.append([{"start": a, "end": b} for a, b in merged.tolist()])
                kept.append(b"".join(data[a:b].to_pybytes() for a, b in zip(edges[::2], edges[1::2])))
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(sizes, pa.int64()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "spans", "kept"])

    touched = docs.join(cuts, "row").select("doc_id", F.col("text").cast("binary").alias("text"), "cuts").mapInArrow(run, CUT)
    whole = docs.join(broadcast_if_bounded(cuts.select("row"), BROADCAST_ROWS), "row", "left_anti").select(
        "doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"),
        F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)").alias("spans"), F.col("text").cast("binary").alias("kept"))
    return touched.unionByName(whole)
