"""Fixtures and brute-force versions shared by the tests of the training-data operators."""

import contextlib
import re

import duckdb

from moorline.llm.common import work_uri

SMALL = "/root/testdata/sf0.001"
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}

# Column names that operators use inside; tables may have them too.
CLASH = ["row", "digest", "words", "base", "kept", "size", "parts", "key", "n", "item", "found", "label", "known", "copies"]

LONG = "password = abcdefgh1234 " + "lorem ipsum dolor " * 60000 + " mit license"

EDGES = [(1, None), (2, ""), (3, " \n\t "), (4, "Mit License"), (5, "Mit License"), (5, "Mit License"), (None, "Mit License"),
         (None, None), (6, LONG), (7, LONG), (8, "x" * 200000), (9, "1" * 50000), (10, "a.b-c" * 20000), (11, " " * 100000 + "é"),
         (12, "ÀÉ 日本語 🙂 cc by"), (13, "12345 !!! 678")]


def edges(spark):
    """Nulls, empty and very long texts, ties, repeated rows and clashing columns."""
    fields = ", ".join(f"{c} string" for c in CLASH)
    return spark.createDataFrame([(i, t, None, None, None, *[c for c in CLASH]) for i, t in EDGES],
                                 f"doc_id bigint, text string, lang string, source string, n_chars bigint, {fields}")


def empty(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")


@contextlib.contextmanager
def moving(spark, monkeypatch, module, rows, schema):
    """The rows as a table that is split otherwise from the first table on that ``module``
    writes, as when executors are lost after the first job."""
    path, least = work_uri(spark, "moving"), "spark.sql.files.minPartitionNum"
    for i in range(0, len(rows), 10):
        spark.createDataFrame(rows[i:i + 10], schema).coalesce(1).write.mode("append").parquet(path)

    def turning(f):
        def run(*a, **b):
            out = f(*a, **b)
            spark.conf.set(least, "1")
            return out
        return run
    for name in {"written", "cut"} & set(dir(module)):
        monkeypatch.setattr(module, name, turning(getattr(module, name)))
    try:
        spark.conf.set(least, "64")
        yield spark.read.schema(schema).parquet(path)
    finally:
        spark.conf.unset(least)


def thue_morse(n):
    """Two different words of 2 ** n letters whose polynomial hashes modulo 2 ** 64 are equal."""
    word = "a"
    for _ in range(n):
        word += word.translate({97: 98, 98: 97})
    return word, word.translate({97: 98, 98: 97})


def documents():
    return duckdb.connect().execute(f"SELECT doc_id, text, lang FROM '{SMALL}/documents.parquet'").fetchall()


def words(text):
    return ALNUM.findall((text or "").translate(LOWER))


def shingles(text, k):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def components(docs, k, num, den):
    """doc_id -> smallest doc_id reachable, by comparing all pairs."""
    sets = {i: shingles(t, k) for i, t in docs}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(i for i in sets if sets[i])
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            if both and den * both >= num * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}, {i: len(s) for i, s in sets.items()}
