"""Bounded-space online packing of token sequences.

Every partition keeps ``open_windows`` open sequences.  A document longer than the
capacity fills sequences of its own; what remains is placed best-fit (into the
open sequence it leaves least room in).  When none fits, the fullest open one is
filled with as much as it takes and emitted, so no sequence is padded while its
partition goes on.  At the end the open sequences of all partitions are merged:
grouped by a bounded number of tokens, cut and filled again in a second pass,
and the tail of each group is cut to powers of two, which need no padding.

Tokens come from a byte-level BPE file given by path.  Long texts are encoded in
segments that end where no token can span (before a single space between two
non-blank characters), so memory does not follow the text's length.  Both file
kinds of the vocabulary give the same ids; the rank file is encoded with
tiktoken, which takes about a third of the time.

Defined results: a null or empty text is the end token alone; strings of special
tokens in a text are ordinary text; a null identifier is carried along;
repeated rows are packed each for themselves; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_arrow, written

CAPACITY, OPEN_WINDOWS, END_ID = 2048, 32, 1
# Tokens of left-over sequences that one merge group holds.
MERGE_TOKENS = 1 << 21
SEGMENT = 1 << 20
MERGED = 1 << 62

PIECES = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
          "offset bigint, ids binary, left boolean")


# Blank runs from this length on go to the JSON tokenizer: the other one's regular
# expressions recurse over a blank run.
LONG_BLANK = re.compile(r"\s{2048}")


def bpe_encoder(json_path: str, rank_path: str | None = None, pattern: str | None = None):
    """ids of a text by the tokenizer file ``json_path``; with the rank file of the
    same vocabulary (base64 token and rank per line) most texts take the faster way."""
    def load():
        held = []

        def plain(text):
            if not held:
                from tokenizers import Tokenizer
                held.append(Tokenizer.from_file(json_path))
                held[0].encode_special_tokens = True
            return held[0].encode(text, add_special_tokens=False).ids

        if rank_path is None:
            return plain
        import tiktoken
        with open(rank_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        return lambda text: plain(text) if LONG_BLANK.search(text) else fast(text)
    return load


def segments(text: str, size: int = SEGMENT):
    """Parts of a text whose ids, put together, are the ids of the text."""
    at = 0
    while len(text) - at > size:
        to = at + size
        while to < len(text) - 1 and not (text[to] == " " and not text[to - 1].isspace() and not text[to + 1].isspace()):
            to += 1
        if to >= len(text) - 1:
            break
        yield text[at:to]
        at = to
    yield text[at:]


def _ids(encode, text: str, end_id: int) -> np.ndarray:
    parts = [np.array(encode(s), dtype="<u4") for s in segments(text)] if text else []
    return np.concatenate([*parts, np.array([end_id], dtype="<u4")])


class _Rows:
    def __init__(self, with_ids: bool):
        self.with_ids, self.columns = with_ids, [[] for _ in range(9)]

    def add(self, piece, sequence: int, offset: int, left: bool) -> None:
        doc_id, start, ids, doc_tokens = piece
        raw = ids.tobytes()
        for c, v in zip(self.columns, (doc_id, start, len(ids), zlib.crc32(raw), doc_tokens, sequence, offset,
                                       raw if left or self.with_ids else None, left)):
            c.append(v)

    def sequence(self, pieces, sequence: int, left: bool = False) -> None:
        offset = 0
        for p in pieces:
            self.add(p, sequence, offset, left)
            offset += len(p[2])

    def batch(self) -> pa.RecordBatch:
        kinds = [pa.int64()] * 7 + [pa.binary(), pa.bool_()]
        out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(self.columns, kinds)],
                                         names=[x.split()[0] for x in PIECES.split(", ")])
        self.columns = [[] for _ in range(9)]
        return out


class _Open:
    """The open sequences of one partition."""

    def __init__(self, rows: _Rows, capacity: int, limit: int, first: int):
        self.rows, self.capacity, self.limit, self.next = rows, capacity, limit, first
        self.pieces: list[list] = []
        self.free: list[int] = []

    def _emit(self, pieces, left=False) -> None:
        self.rows.sequence(pieces, self.next, left)
        self.next += 1

    def place(self, doc_id, ids: np.ndarray) -> None:
        n, start = len(ids), 0
        while n - start >= self.capacity:
            self._emit([(doc_id, start, ids[start:start + self.capacity], n)])
            start += self.capacity
        while start < n:
            size = n - start
            fits = [(f, i) for i, f in enumerate(self.free) if f >= size]
            if fits:
                at, take = min(fits)[1], size
            elif len(self.free) < self.limit:
                self.pieces.append([])
                self.free.append(self.capacity)
                at, take = len(self.free) - 1, size
            else:
                take, at = min((f, i) for i, f in enumerate(self.free))
            self.pieces[at].append((doc_id, start, ids[start:start + take], n))
            self.free[at] -= take
            start += take
            if not self.free[at]:
                self._emit(self.pieces.pop(at))
                self.free.pop(at)

    def close(self) -> None:
        for pieces in self.pieces:
            self._emit(pieces, left=True)


def _merge(left: DataFrame, capacity: int, with_ids: bool) -> DataFrame:
    """Fill sequences anew from left-over pieces; tails become powers of two."""
    def run(batches):
        rows, group, nxt, open_, fill = _Rows(with_ids), None, 0, [], 0

        def tail():
            nonlocal open_, fill, nxt
            while fill:
                size, pieces, have = 1 << (fill.bit_length() - 1), [], 0
                while have < size:
                    doc_id, start, ids, n = open_.pop(0)
                    take = min(len(ids), size - have)
                    pieces.append((doc_id, start, ids[:take], n))
                    if take < len(ids):
                        open_.insert(0, (doc_id, start + take, ids[take:], n))
                    have += take
                rows.sequence(pieces, MERGED + (group << 32) + nxt)
                nxt, fill = nxt + 1, fill - size

        for batch in batches:
            for r in batch.to_pylist():
                if r["grp"] != group:
                    tail()
                    group, nxt = r["grp"], 0
                ids, start = np.frombuffer(r["ids"], dtype="<u4"), r["start"]
                while len(ids):
                    take = min(len(ids), capacity - fill)
                    open_.append((r["doc_id"], start, ids[:take], r["doc_tokens"]))
                    ids, start, fill = ids[take:], start + take, fill + take
                    if fill == capacity:
                        rows.sequence(open_, MERGED + (group << 32) + nxt)
                        open_, fill, nxt = [], 0, nxt + 1
            if rows.columns[0]:
                yield rows.batch()
        tail()
        yield rows.batch()
    return left.mapInArrow(run, PIECES)


def pack(docs: DataFrame, encoder, id_col="doc_id", text_col="text", end_id: int = END_ID, capacity: int = CAPACITY,
         open_windows: int = OPEN_WINDOWS, merge_tokens: int = MERGE_TOKENS, with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset and (unless ``with_ids`` is off) the ids as little-endian 32-bit numbers."""
    def run(batches):
        encode, rows = encoder(), _Rows(with_ids)
        open_ = _Open(rows, capacity, open_windows, TaskContext.get().partitionId() << 32)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                open_.place(doc_id, _ids(encode, text.as_py() or "", end_id))
                if len(rows.columns[0]) >= 4096:
                    yield rows.batch()
        open_.close()
        yield rows.batch()

    pieces = written(bounded_arrow(docs).select(F.col(id_col).cast("bigint").alias("doc_id"),
                                 F.col(text_col).cast("string").alias("text")).mapInArrow(run, PIECES), "pieces")
    left = pieces.where("left")
    tokens = left.agg(F.sum("length")).first()[0] or 0
    groups = max(1, -(-tokens // merge_tokens))
    left = left.withColumn("grp", F.pmod(F.xxhash64("sequence_id"), F.lit(groups))) \
        .repartition(groups, "grp").sortWithinPartitions("grp", "sequence_id", "offset")
    return pieces.where("not left").unionByName(_merge(left, capacity, with_ids)).drop("left", *([] if with_ids else ["ids"]))


def digest_columns(pieces: DataFrame) -> DataFrame:
    """The pieces with length and checksum taken from their stored ids, without the ids."""
    return pieces.withColumn("length", (F.octet_length("ids") / 4).cast("bigint")) \
        .withColumn("ids_crc32", F.crc32("ids")).drop("ids")
