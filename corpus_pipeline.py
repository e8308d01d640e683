"""From raw documents to packed token sequences.

``STAGES`` are applied in order; every stage works on all rows that its predecessor
kept, is written as Parquet in the shared folder and read again by the next one.
All but the last return the columns of ``documents``.  SQL cannot express the
stages (a trained network, sketches, tokens), so ``ORACLE_SQL`` is None; the tests
compare ``run`` with a brute-force version.

Defined results: a null, empty or letterless text goes at the first stage; of equal texts one row stays, that with the
largest identifier, and rows that repeat identifier and text are one, so a table united with itself gives the same
result; rows with null or shared identifiers are judged each by their own text; of near duplicates the smallest identifier
stays; texts of any length pass whole; columns beside those of ``documents`` are carried along, whatever their names, up to
the last stage; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from moorline.llm import decontam, exact_dedup, langid, packing, setsketch
from moorline.llm.common import written
from moorline.llm.queries import byte_bpe, table

ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the network, trained on the labelled ones, identifies."""
    return langid.keep_rows(docs, langid.train(langid.sample(docs)))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest identifier."""
    return exact_dedup.keep_rows(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similarity 0.8 on five-word shingles."""
    return setsketch.keep_rows(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark windows cover less than a twentieth."""
    return decontam.keep_rows(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of 2048, with their token ids."""
    return packing.pack(docs, byte_bpe())


STAGES = [("language_id", language_id), ("exact_dedup", exact_duplicates), ("near_dedup", near_duplicates),
          ("decontaminate", decontaminate), ("pack", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
