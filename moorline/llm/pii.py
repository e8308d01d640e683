"""Information-theoretic sanitisation of personal data.

Protected entities are the e-mail addresses, IP addresses, card numbers and phone
numbers of all texts.  How strongly a term reveals an entity is estimated from the
corpus: with document probabilities p, the disclosure of entity c by term t is

    PMI(c; t) / IC(c) = log2(p(c, t) / (p(c) p(t))) / -log2 p(c),

where p(c, t) counts documents that have c and, anywhere outside their entities, t.  It
is 1 when every document with t has c.  Terms of at least ``support`` different
contexts (a document's words outside its entities) and a disclosure of ``generalise``
or more are replaced by their class in the documents that have the entity; from
``remove`` on they are removed.  All of it is DataFrame expressions; no Python runs in
tasks.

Scale: equal texts are one text with a weight, and entities that occur in the same
texts are one group.  Only groups and terms of ``support`` texts or more are paired,
and only pairs whose counts so far let them reach the threshold; word counts cover
all documents but only the terms of such pairs.

Defined results: null text is the empty text and has no span; repeated rows count as
documents of their own, but equal contexts support a term once; an empty table gives
no rows; other columns are not read.  Positions are code points, ends exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.joins import bounded, broadcast_if_bounded, text_bytes
from .common import BROADCAST_BYTES, BROADCAST_ROWS, SPANS, count_kind, cut, kinded, span_text, spans, written

# Patterns, fixed values; runs are possessive and start at their first character
# (or where the last match ended), so that no text makes them backtrack.
EMAIL = (r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@"
         r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
IP_FITS = r"^0*(25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})(\.0*(25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})){3}$"
# Only where a chain of digits starts and at least 13 of them follow.
CARD = r"(?<![0-9])(?<![0-9][\x20-])(?=[0-9](?:[\x20-]?[0-9]){12})[0-9]++(?:[\x20-][0-9]++)*+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
WORD = r"[\p{L}\p{N}][\p{L}\p{N}'_-]*+"
BASE = ["email", "ip", "card", "phone"]
KINDS = [*BASE, "general", "removed"]

GENERALISE, REMOVE, SUPPORT = 0.8, 0.95, 2
# Rounding of the bounds by which pairs are dropped before they are scored.
SLACK = 1e-9


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Luhn check of a digit string."""
    n = F.length(digits)
    total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda s, i: s + F.when(
        i % 2 == 1, F.substring(digits, n - i + 1, F.lit(1)).cast("int")).otherwise(
        F.element_at(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]),
                     F.substring(digits, n - i + 1, F.lit(1)).cast("int") + 1)))
    return total % 10 == 0


def base_spans(text: Column) -> Column:
    """E-mail, IP, card and phone spans of a text."""
    return F.concat(
        kinded(spans(text, EMAIL), "email"),
        kinded(spans(text, IP), "ip", lambda m: m.rlike(IP_FITS)),
        kinded(spans(text, CARD), "card", lambda m: F.when(
            F.length(_digits(m)).between(13, 19), luhn(_digits(m))).otherwise(False)),
        kinded(spans(text, PHONE), "phone", lambda m: F.length(_digits(m)).between(9, 15)))


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def _outside(text: Column, base: Column) -> Column:
    """The text with blanks in place of its spans; positions stay."""
    def blanked(p, kind):
        def part(x, i):
            start = F.when(i > 0, F.element_at(x["found"], F.greatest(i, F.lit(1)))["end"]).otherwise(0)
            after = F.get(x["found"], i)
            return F.concat(F.substring(x["text"], (start + 1).cast("int"),
                                        (F.coalesce(after["start"], F.length(x["text"])) - start).cast("int")),
                            F.repeat(F.lit(" "), F.coalesce(after["end"] - after["start"], F.lit(0)).cast("int")))
        bound = F.array(F.struct(p["text"].alias("text"), F.filter(p["base"], lambda x: x["kind"] == kind).alias("found")))
        return F.element_at(F.transform(bound, lambda x: F.when(F.size(x["found"]) == 0, x["text"]).otherwise(F.array_join(
            F.transform(F.sequence(F.lit(0), F.size(x["found"])), lambda i: part(x, i)), ""))), 1)

    out = F.array(F.struct(text.alias("text"), base.alias("base")))
    def without(kind):
        return lambda p: F.struct(blanked(p, kind).alias("text"), p["base"].alias("base"))
    for kind in BASE:
        out = F.transform(out, without(kind))
    return F.element_at(out, 1)["text"]


def entities(docs: DataFrame) -> DataFrame:
    """row, doc_id, digest, base spans, entity per span and, for texts with a span, the
    text outside its spans."""
    text = F.col("text")

    def entity(x):
        value = F.substring(text, (x["start"] + 1).cast("int"), (x["end"] - x["start"]).cast("int"))
        name = F.when(x["kind"].isin("card", "phone"), _digits(value)).otherwise(F.lower(value))
        return F.concat_ws(":", x["kind"], name)

    found = docs.withColumn("base", base_spans(text))
    return found.select("row", "doc_id", F.unhex(F.sha2("text", 256)).alias("digest"), "base",
                        F.transform("base", entity).alias("entities"),
                        F.when(F.size("base") > 0, _outside(text, F.col("base"))).alias("outside"))


def disclosing_terms(docs: DataFrame, found: DataFrame, generalise: float, support: int) -> DataFrame:
    """(digest, term, disclosure) for the terms that reveal an entity of the text."""
    total = max(docs.count(), 1)
    n = F.lit(float(total))
    held = found.where(F.size("base") > 0)
    repeats = cut(held.groupBy("digest").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("w")).where("w > 1"))
    texts = held.join(broadcast_if_bounded(repeats, BROADCAST_ROWS), "digest", "left") \
        .where("first is null or row = first").withColumn("w", F.coalesce("w", F.lit(1)))
    named = texts.select("digest", "w", F.explode(F.array_distinct("entities")).alias("entity"))
    # Entities of the same texts have the same counts with every term: they are one group.
    same = cut(named.groupBy("entity").agg(
        F.count(F.lit(1)).alias("texts"), F.sum("w").alias("n_c"), F.bit_xor(F.xxhash64("digest")).alias("a"),
        F.bit_xor(F.xxhash64("digest", F.lit(1))).alias("b")).where((F.col("texts") >= support) & (F.col("n_c") < total))
        .select("entity", "n_c", F.concat_ws(":", "texts", "a", "b").alias("grp")))
    groups = cut(named.join(broadcast_if_bounded(same, BROADCAST_ROWS), "entity").select("digest", "grp", "n_c").distinct())
    most = groups.agg(F.max("n_c")).first()[0] or 1
    live = cut(groups.select("digest").distinct())

    def reached(both, n_c, n_t):
        return F.log2(both * n / (n_c * n_t)) >= generalise * F.log2(n / n_c) - SLACK

    spoken = texts.join(broadcast_if_bounded(live, BROADCAST_ROWS), "digest", "left_semi") \
        .select("digest", "w", _words(F.col("outside")).alias("words")) \
        .select("digest", "w", F.xxhash64("words").alias("context"), F.explode(F.array_distinct("words")).alias("term"))
    # ``least`` documents have the term, at least; no more of them have it with an entity.
    known = cut(spoken.groupBy("term").agg(F.count(F.lit(1)).alias("texts"), F.sum("w").alias("least"))
                .where(F.col("texts") >= support)
                .where(reached(F.least(F.col("least"), F.lit(most)), F.lit(most), F.col("least"))
                       | (F.col("least") <= most)).select("term", "least"))
    near = written(spoken.join(broadcast_if_bounded(known, BROADCAST_ROWS, BROADCAST_BYTES), "term").join(groups, "digest")
                   .where(reached(F.least("least", "n_c"), F.col("n_c"), F.col("least"))), "pii-near")
    # Distinct contexts and documents of a pair: two counts over small keys, added up map-side first.
    pairs = cut(near.groupBy("grp", "term", "context").agg(
        F.sum("w").alias("w"), F.first("n_c").alias("n_c"), F.first("least").alias("least"))
        .groupBy("grp", "term").agg(F.sum("w").alias("n_ct"), F.count(F.lit(1)).alias("support"),
                                    F.first("n_c").alias("n_c"), F.first("least").alias("least"))
        .where(F.col("support") >= support).where(reached(F.col("n_ct"), F.col("n_c"), F.col("least"))))
    terms = cut(pairs.select("term").distinct())
    said = docs.select(F.explode(F.array_distinct(_words(F.col("text")))).alias("term"))
    n_t = said.join(broadcast_if_bounded(terms, BROADCAST_ROWS, BROADCAST_BYTES), "term").groupBy("term") \
        .agg(F.count(F.lit(1)).alias("n_t"))
    pmi = F.log2(F.col("n_ct") * n / (F.col("n_c") * F.greatest("n_t", "least")))
    scored = cut(pairs.join(n_t, "term", "left").withColumn("disclosure", pmi / F.log2(n / F.col("n_c")))
                 .where(F.col("disclosure") >= generalise).select("grp", "term", "disclosure"))
    return near.join(broadcast_if_bounded(scored, BROADCAST_ROWS, BROADCAST_BYTES), ["grp", "term"]) \
        .groupBy("digest", "term").agg(F.max("disclosure").alias("disclosure"))


def _find(docs: DataFrame, id_col="doc_id", text_col="text", generalise: float = GENERALISE, remove: float = REMOVE,
          support: int = SUPPORT) -> DataFrame:
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # Rows are numbered by this one scan; what follows reads the numbers from the written
    # table and meets other scans by content only, whatever their splits.
    found = written(entities(docs.withColumn("row", F.monotonically_increasing_id())), "pii-entities")
    terms = cut(disclosing_terms(docs, found, generalise, support))
    marked = cut(terms.groupBy("digest").agg(
        F.collect_list(F.when(F.col("disclosure") < remove, F.col("term"))).alias("general"),
        F.collect_list(F.when(F.col("disclosure") >= remove, F.col("term"))).alias("removed")))
    # The lists of a text are as long as it has terms, so the terms are what is checked.
    marked = F.broadcast(marked) if bounded(terms, BROADCAST_ROWS) and text_bytes(terms) <= BROADCAST_BYTES else marked
    words = F.transform(F.array(spans(F.col("outside"), WORD)), lambda s: F.concat(
        kinded(s, "general", lambda m: F.array_contains("general", F.lower(m))),
        kinded(s, "removed", lambda m: F.array_contains("removed", F.lower(m)))))
    extra = F.when(F.col("general").isNotNull(), F.element_at(words, 1)).otherwise(F.expr(f"cast(array() as {SPANS})"))
    some = found.where(F.size("base") > 0).join(marked, "digest", "left") \
        .select("row", "doc_id", "digest", F.concat("base", extra).alias("found"))
    return some.unionByName(found.where(F.size("base") == 0).select("row", "doc_id", "digest", F.col("base").alias("found")))


def find(docs: DataFrame, id_col="doc_id", text_col="text", **how) -> DataFrame:
    """One row per document: row, doc_id and found (all spans; entity kinds, ``general``
    for terms to generalise, ``removed`` for terms to remove).  ``how``: ``generalise``,
    ``remove``, ``support``."""
    return _find(docs, id_col, text_col, **how).drop("digest")


def rewrite(text: Column, found: Column) -> Column:
    """The text with its spans generalised to [KIND] or removed; of overlapping spans the first counts."""
    ordered = F.array_sort(F.transform(found, lambda x: F.struct(x["start"], x["end"], x["kind"])))
    return F.aggregate(
        ordered, F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out")),
        lambda acc, x: F.when(x["start"] < acc["at"], acc).otherwise(F.struct(
            x["end"].alias("at"),
            F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), (x["start"] - acc["at"]).cast("int")),
                     F.when(x["kind"] == "removed", F.lit("")).otherwise(F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]"))))
            .alias("out"))),
        lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))))


def sanitise(docs: DataFrame, id_col="doc_id", text_col="text", **how) -> DataFrame:
    """(doc_id, text) with protected entities and disclosing terms generalised or removed."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")) \
        .withColumn("digest", F.unhex(F.sha2("text", 256)))
    # Equal texts have equal spans.
    found = _find(docs, id_col, text_col, **how).where(F.size("found") > 0).groupBy("digest").agg(F.first("found").alias("found"))
    return rows.join(broadcast_if_bounded(cut(found), BROADCAST_ROWS), "digest", "left").select(
        "doc_id", F.when(F.col("found").isNull(), F.col("text")).otherwise(rewrite(F.col("text"), F.col("found"))).alias("text"))


def digest_columns(found: DataFrame) -> DataFrame:
    base = F.filter("found", lambda x: x["kind"].isin(*BASE))
    return found.select("doc_id", *[count_kind(F.col("found"), k).alias(f"n_{k}") for k in BASE],
                        F.sha2(span_text(base, KINDS, by_start=False), 256).alias("base_sha256"),
                        span_text(F.col("found"), KINDS, by_start=False).alias("spans"))
