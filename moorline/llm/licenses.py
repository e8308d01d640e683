"""Licence scan with a positional index of rare words.

Licence templates are passages with mandatory key phrases.  Document frequencies of all template
words are counted over the whole corpus, and an index holds the templates and positions at which each word stands.

In a document the licence words that occur in it decide which templates are possible at all: those of whose key phrases
no word is missing, and whose words that do occur carry enough IDF for the least score (both are bounds, so
nothing is lost).  For every possible template the document's own highest-IDF words of it are looked up; each
occurrence fixes where the template would start, its key phrases are verified word for word at their relative positions, and
the score is the IDF-weighted share of the template's words found in place.  One such word in place is enough to be scored.

The base phrases are templates that consist of their key phrase alone, so every place
where their words stand consecutively is found.  A document is judged from its own
row; the only shuffle is that of the word counts.  All of it is DataFrame
expressions; no Python runs in tasks.

Defined results: null text has no words, no label and score 0; a null identifier is reported like any other; texts of
any length are read whole; places that overlap all count; words of equal IDF are taken in the template's order; repeated rows are judged
alike; an empty table gives no rows; other columns are not read, whatever their names.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower

# Words of a text without A-Z: all characters but \x00-\x2F, \x3A-\x60 and \x7B-\x7F,
# written as the class of what is left, which is matched in less than half the time.
WORD = r"[0-9a-z\x{80}-\x{10FFFF}]+"
RARE, LEAST_SCORE = 4, 0.6


@dataclass(frozen=True)
class Template:
    """A passage in lower case, and the phrases of it that must stand in place."""

    label: str
    text: str
    keys: tuple[str, ...] = field(default=())
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()

    def key_positions(self) -> list[int]:
        """Positions of all words of the key phrases (the whole text for a base phrase)."""
        words, out = self.words, set()
        for phrase in (self.keys or (self.text,)):
            p = phrase.split()
            at = next(i for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p)
            out.update(range(at, at + len(p)))
        return sorted(out)


# Base phrases and passages of published licences, fixed values.
TEMPLATES = [
    Template("gpl", "gnu general public license", base=True),
    Template("apache", "apache license", base=True),
    Template("cc-by", "cc by", base=True),
    Template("mit", "mit license", base=True),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
             "associated documentation files the software to deal in the software without restriction",
             ("permission is hereby granted free of charge", "associated documentation files")),
    Template("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions "
             "of the software", ("this permission notice shall be included in all copies",)),
    Template("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the "
             "following disclaimer", ("redistributions of source code must retain",)),
    Template("bsd", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
             "following disclaimer in the documentation and or other materials provided with the distribution",
             ("redistributions in binary form must reproduce",)),
    Template("gpl", "without any warranty without even the implied warranty of merchantability or fitness for a particular purpose "
             "see the gnu general public license for more details", ("gnu general public license for more details",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
             "provided that the following conditions are met", ("redistribution and use in source and binary forms",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
             "hereby granted", ("permission to use copy modify",)),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0",
             ("mozilla public license",)),
    Template("mpl", "mozilla public license", ("mozilla public license",)),
    Template("lgpl", "gnu lesser general public license", ("lesser general public license",)),
    Template("lgpl", "gnu library general public license", ("library general public license",)),
    Template("agpl", "gnu affero general public license", ("affero general public license",)),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
             "general public license as published by the free software foundation", ("free software foundation",)),
    Template("apache", "licensed under the apache license version 2 0 the license you may not use this file except in "
             "compliance with the license", ("apache license version 2 0",)),
    Template("epl", "eclipse public license", ("eclipse public license",)),
    Template("boost", "boost software license version 1 0", ("boost software license",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain",
             ("unencumbered software released into the public domain",)),
    Template("cc0", "cc0 1 0 universal", ("cc0 1 0",)),
    Template("cc-by", "creative commons attribution 4 0 international license", ("creative commons attribution",)),
    Template("bsd", "bsd license", ("bsd license",)),
    Template("zlib", "this software is provided as is without any express or implied warranty in no event will the authors "
             "be held liable for any damages arising from the use of this software",
             ("in no event will the authors be held liable",)),
]


def words(text: Column) -> Column:
    """Words of the whole text, A-Z lower-cased (none for null)."""
    return F.coalesce(F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0)), F.expr("cast(array() as array<string>)"))


def inverse_frequencies(docs: DataFrame, vocabulary: list[str], text_col="text") -> dict[str, float]:
    """IDF of each word of a fixed vocabulary, over all documents."""
    said = docs.select(F.explode(F.array_distinct(F.filter(words(F.col(text_col)), lambda w: w.isin(vocabulary)))).alias("w"))
    df = {r.w: r.n for r in said.groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = max(docs.count(), 1)
    return {w: math.log1p(n / (df.get(w, 0) + 1)) for w in vocabulary}


def _literal(values, kind: str) -> Column:
    return F.array(*[F.lit(v).cast(kind) for v in values]) if values else F.expr(f"cast(array() as array<{kind}>)")


def scan(docs: DataFrame, templates: list[Template] = TEMPLATES, rare: int = RARE,
         least_score: float = LEAST_SCORE, id_col="doc_id", text_col="text") -> DataFrame:
    """One row per document: doc_id, n_words and matches, an array of
    struct<template, start, score> with every accepted place of every template."""
    vocabulary = sorted({w for t in templates for w in t.words})
    idf = inverse_frequencies(docs, vocabulary, text_col)
    index: dict[str, list[tuple[int, int]]] = {}
    table = []
    for i, t in enumerate(templates):
        w, keys = t.words, t.key_positions()
        for j, x in enumerate(w):
            index.setdefault(x, []).append((i, j))
        rarest = list(dict.fromkeys(w[j] for j in sorted(range(len(w)), key=lambda j: (-idf[w[j]], j))))
        total = sum(idf[x] for x in w)
        table.append(F.struct(
            _literal(w, "string").alias("words"), _literal([idf[x] for x in w], "double").alias("idf"),
            F.lit(total).alias("total"), F.lit(least_score * total - 1e-9).alias("least"), _literal(keys, "int").alias("keys"),
            _literal(sorted({w[j] for j in keys}), "string").alias("key_words"), _literal(rarest, "string").alias("rarest"),
            F.lit(1 if t.base else rare).alias("take")))
    table = F.array(*table)
    postings = F.create_map(*[c for w, at in sorted(index.items()) for c in (
        F.lit(w), F.array(*[F.struct(F.lit(t).alias("t"), F.lit(j).alias("j")) for t, j in at]))])
    said, present, lookup = F.col("words"), F.col("present"), F.col("lookup")

    def wanted(t):
        """The document's highest-IDF words of a template, none if the template cannot be in it."""
        held = F.aggregate(F.zip_with(t["words"], t["idf"], lambda w, x: F.when(F.array_contains(present, w), x).otherwise(0.0)),
                           F.lit(0.0), lambda a, x: a + x)
        possible = F.forall(t["key_words"], lambda w: F.array_contains(present, w)) & (held >= t["least"])
        return F.when(possible, F.slice(F.filter(t["rarest"], lambda w: F.array_contains(present, w)), F.lit(1), t["take"])) \
            .otherwise(F.expr("cast(array() as array<string>)"))

    def in_place(t, start):
        return lambda j: F.get(said, start + j).eqNullSafe(F.element_at(t["words"], j + 1))

    def place(i):
        word = F.get(said, i)

        def verified(p):
            t, start = F.element_at(table, p["t"] + 1), i - p["j"]
            score = F.aggregate(F.sequence(F.lit(0), F.size(t["words"]) - 1), F.lit(0.0), lambda s, j: s + F.when(
                in_place(t, start)(j), F.element_at(t["idf"], j + 1)).otherwise(0.0)) / t["total"]
            return F.when(F.forall(t["keys"], in_place(t, start)), F.struct(
                p["t"].alias("template"), start.alias("start"), F.least(F.round(score, 6), F.lit(1.0)).alias("score")))
        looked_up = F.filter(F.element_at(postings, word), lambda p: F.array_contains(F.get(lookup, p["t"]), word))
        return F.filter(F.transform(looked_up, verified), lambda m: m.isNotNull() & (m["score"] >= least_score))

    spoken = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), words(F.col(text_col).cast("string")).alias("words")) \
        .withColumn("present", F.array_intersect(said, _literal(vocabulary, "string"))) \
        .withColumn("lookup", F.transform(table, wanted)) \
        .withColumn("active", F.array_distinct(F.flatten("lookup")))
    hits = F.filter(F.transform(said, lambda w, i: F.when(F.array_contains("active", w), i)), lambda i: i.isNotNull())
    spoken = spoken.withColumn("hits", F.when(F.size("active") > 0, hits).otherwise(F.expr("cast(array() as array<int>)")))
    return spoken.select("doc_id", F.size(said).cast("bigint").alias("n_words"),
                         F.array_distinct(F.flatten(F.transform("hits", place))).alias("matches"))


def labelled(found: DataFrame, templates: list[Template] = TEMPLATES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    names = _literal([t.label for t in templates], "string")
    base = _literal([i for i, t in enumerate(templates) if t.base], "int")

    def label(matches):
        return F.array_join(F.array_sort(F.array_distinct(
            F.transform(matches, lambda m: F.element_at(names, m["template"] + 1)))), ",")
    return found.withColumn("base", F.filter("matches", lambda m: F.array_contains(base, m["template"]))).select(
        "doc_id", "n_words", F.size("base").cast("bigint").alias("n_base"),
        F.array_min("base.start").cast("bigint").alias("first_word"),
        F.array_max("base.start").cast("bigint").alias("last_word"),
        label("base").alias("base_labels"), label("matches").alias("labels"),
        F.coalesce(F.array_max("matches.score"), F.lit(0.0)).alias("score"))
