"""Shared helpers: scratch tables, vectorised tokenisation over Arrow buffers, native spans."""

from __future__ import annotations

import uuid
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.joins import broadcast_if_bounded
from ..session import ensure_checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Arrow batches are bounded in rows and bytes, so that a worker holds a few
# megabytes of text at a time whatever the length of a document.
ARROW_ROWS = 2000
ARROW_BYTES = 16 << 20
# Identifiers (8 to 48 bytes each) are broadcast up to this checked number of rows.
BROADCAST_ROWS = 1_000_000
# Texts of no fixed width are broadcast up to this checked number of bytes.
BROADCAST_BYTES = 64 << 20


def bounded_arrow(df: DataFrame) -> DataFrame:
    """Bound the batches in which Python reads rows of the session; returns ``df``."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    return df


def work_uri(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder (its scheme is kept)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage is cut,
    the rows survive the loss of any executor."""
    spark = df.sparkSession
    path = work_uri(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint for small intermediate tables."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


# -- native text -------------------------------------------------------------------------------
def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only.  ``lower`` is used where every character is ASCII
    (there the two agree); other texts go through ``translate``."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)) \
        .otherwise(F.translate(text, UPPER, UPPER.lower()))


SPAN_BLOCK = 256


def spans(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as array<struct<start,end,match>> in code points.

    The gaps come from ``split`` with the same pattern, the matches from
    ``regexp_extract_all``; their running lengths give the positions.  Matches are
    walked in blocks whose starts are summed up first, so that the work grows with the
    number of matches and not with its square.  A match must have a positive width.
    Null or unmatched text gives an empty array.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    empty = F.expr("cast(array() as array<struct<start:bigint,end:bigint,match:string>>)")

    def width(x):
        return F.length(x["gap"]) + F.length(x["match"])

    def blocked(pieces):
        last = F.floor((F.size(pieces) - 1) / SPAN_BLOCK).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(pieces, b * SPAN_BLOCK + 1, F.lit(SPAN_BLOCK)))

    def started(blocks):
        """Every block with the position at which it starts."""
        return F.aggregate(
            blocks, F.struct(F.lit(0).cast("bigint").alias("at"), F.expr("cast(array() as array<bigint>)").alias("starts")),
            lambda acc, block: F.struct(
                (acc["at"] + F.aggregate(block, F.lit(0).cast("bigint"), lambda s, x: s + width(x))).alias("at"),
                F.concat(acc["starts"], F.array(acc["at"])).alias("starts")),
            lambda acc: F.zip_with(blocks, acc["starts"], lambda x, y: F.struct(x.alias("block"), y.alias("start"))))

    def walked(z):
        return F.aggregate(
            z["block"], F.struct(z["start"].alias("at"), empty.alias("out")),
            lambda acc, x: F.struct(
                (acc["at"] + width(x)).cast("bigint").alias("at"),
                F.concat(acc["out"], F.array(F.struct(
                    (acc["at"] + F.length(x["gap"])).cast("bigint").alias("start"),
                    (acc["at"] + width(x)).cast("bigint").alias("end"),
                    x["match"].alias("match")))).alias("out")),
            lambda acc: acc["out"])

    pieces = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(found)).alias("gap"), found.alias("match"))
    # transform over a one-element array binds the pieces and the blocks once.
    out = F.transform(F.array(pieces), lambda p: F.flatten(F.transform(
        F.flatten(F.transform(F.array(blocked(p)), started)), walked)))
    return F.when(text.rlike(pattern), F.element_at(out, 1)).otherwise(empty)


# -- vectorised words --------------------------------------------------------------------------
SPACE_WORDS = np.arange(256, dtype=np.uint8)
SPACE_WORDS[[0x20, 9, 10, 11, 12, 13]] = 0x20
SPACE_WORDS[65:91] += 32

ALNUM_WORDS = np.full(256, 0x20, dtype=np.uint8)
ALNUM_WORDS[0x30:0x3A] = np.arange(0x30, 0x3A)
ALNUM_WORDS[0x61:0x7B] = np.arange(0x61, 0x7B)
ALNUM_WORDS[0x41:0x5B] = np.arange(0x61, 0x7B)
ALNUM_WORDS[0x80:] = np.arange(0x80, 0x100)



def split_words(text: pa.Array, table: np.ndarray):
    """The words of all texts of an Arrow array: a code per word, the distinct words (by
    their bytes) that the codes stand for, and the row boundaries in the codes (n + 1
    offsets).  Null texts have no words."""
    text = text.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(text.buffers()[1], dtype=np.int64, count=len(text) + 1 + text.offset)[text.offset:]
    raw = np.frombuffer(text.buffers()[2] or b"", dtype=np.uint8)
    plain = pa.LargeStringArray.from_buffers(len(text), pa.py_buffer((offsets - offsets[0]).tobytes()),
                                             pa.py_buffer(table[raw[offsets[0]:offsets[-1]]]))
    words = pc.ascii_split_whitespace(plain)
    flat = words.flatten()
    real = pc.greater(pc.binary_length(flat), 0)
    before = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    coded = flat.filter(real).dictionary_encode()
    at = words.offsets.to_numpy()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary, before[at - at[0]]


_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (bijective)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of an odd number and of its inverse, for hashes of all strings of one length (they
    only propose candidates: such a hash is easily collided)."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def get(self, n: int):
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), (1 << 20) + 1)
            up, down = np.full(size, _P, dtype=np.uint64), np.full(size, _P_INV, dtype=np.uint64)
            up[0] = down[0] = 1
            self.up, self.down = np.cumprod(up), np.cumprod(down)
        return self.up, self.down


POWERS = _Powers()


def word_hashes(text: pa.Array, table: np.ndarray):
    """64-bit hashes (BLAKE2b of their bytes) of all words of all texts of an Arrow array, and the row
    boundaries in them (n + 1 offsets).  Null texts have no words."""
    codes, terms, at = split_words(text, table)
    digests = b"".join(blake2b(w, digest_size=8).digest() for w in terms.cast(pa.large_binary()).to_pylist())
    return np.frombuffer(digests, dtype="<u8")[codes].astype(np.uint64), at


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word shingles of one text; a text of fewer words, but not
    none, is one shingle."""
    n = len(words)
    if n == 0:
        return words
    k = min(k, n)
    out = np.zeros(n - k + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(k):
            out = mix(out + words[i:n - k + 1 + i] + np.uint64(i + 1))
    return out


def without(docs: DataFrame, gone: DataFrame, on: list[tuple[Column, str]]) -> DataFrame:
    """Rows of ``docs`` that no row of ``gone`` matches on (column of docs, column of
    gone); all columns stay.  ``gone`` is broadcast only below a checked number of rows."""
    names = [f"__gone_{i}" for i in range(len(on))]
    keys = cut(gone.select(*[F.col(g).alias(n) for (_, g), n in zip(on, names)]).distinct())
    match = F.lit(True)
    for (c, _), n in zip(on, names):
        match = match & (c == F.col(n))
    return docs.join(broadcast_if_bounded(keys, BROADCAST_ROWS), match, "left_anti")


# -- native span lists: array<struct<kind,start,end>> --------------------------------------------
SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"


def kinded(found: Column, kind: str, keep=None) -> Column:
    """Name the matches of ``spans`` and drop those that fail ``keep`` (match -> boolean)."""
    if keep is not None:
        found = F.filter(found, lambda x: keep(x["match"]))
    return F.transform(found, lambda x: F.struct(F.lit(kind).alias("kind"), x["start"].alias("start"), x["end"].alias("end")))


def span_text(found: Column, kinds: list[str], by_start: bool) -> Column:
    """kind:start:end, comma-joined, by start and then kind as listed, or the other way round."""
    def at(kind):
        return F.array_position(F.array(*[F.lit(k) for k in kinds]), kind)

    keyed = F.transform(found, lambda x: F.struct(
        *[c.alias(f"k{i}") for i, c in enumerate(
            (x["start"], at(x["kind"])) if by_start else (at(x["kind"]), x["start"]))],
        x["end"].alias("end"), F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string")).alias("s")))
    return F.array_join(F.transform(F.array_sort(keyed), lambda x: x["s"]), ",")


def count_kind(found: Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda x: x["kind"] == kind)).cast("bigint")
