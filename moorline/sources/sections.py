"""IO20: typed tables from sectioned Markdown (catalogues, rules, message examples).

A section starts with a heading of level three; its fields are list items of the form
``- **name:** value``, whose values may run over several indented lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HEADING = r"(?m)^### "
FIELD = r"(?m)^- \*\*"


def read_sections(spark: SparkSession, path: str) -> DataFrame:
    """(file, title, fields): one row per section, ``fields`` a map of its list items."""
    text = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), "value")
    sections = text.select("file", F.explode(F.slice(F.split("value", HEADING, -1), F.lit(2), F.lit(1 << 30))).alias("s"))
    items = F.slice(F.split(F.col("s"), FIELD, -1), F.lit(2), F.lit(1 << 30))

    def entry(x):
        value = F.regexp_extract(x, r"(?s):\*\*(.*?)(\n---|\n#|\n\n|$)", 1)
        return F.struct(F.substring_index(x, ":**", 1).alias("key"),
                        F.trim(F.regexp_replace(value, r"\s+", " ")).alias("value"))
    return sections.select("file", F.trim(F.substring_index("s", "\n", 1)).alias("title"),
                           F.map_from_entries(F.transform(items, entry)).alias("fields"))


def typed(sections: DataFrame, columns: dict[str, str]) -> DataFrame:
    """A table from sections: field name -> Spark type; ``array<string>`` splits at commas."""
    out = []
    for name, kind in columns.items():
        value = F.col("fields")[name]
        out.append((F.split(value, r"\s*,\s*") if kind == "array<string>" else value.cast(kind)).alias(name))
    return sections.select("title", *out)


def read_examples(spark: SparkSession, path: str) -> DataFrame:
    """Message examples: one file each, a head of ``name: value`` lines between two ``---`` lines and the message
    below.  Columns: file, fields (map), expected_status, expected_rules (array<string>), body; a file without a head has
    empty fields and is all body."""
    text = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.regexp_replace("value", "\r\n", "\n").alias("t"))
    head = F.regexp_extract("t", r"(?s)\A\s*---\n(.*?)\n---\s*(\n|\z)", 1)
    body = F.regexp_replace("t", r"(?s)\A\s*---\n.*?\n---\s*(\n|\z)", "")
    lines = F.filter(F.split(head, "\n"), lambda x: x.contains(":"))
    fields = F.map_from_entries(F.transform(lines, lambda x: F.struct(
        F.trim(F.substring_index(x, ":", 1)).alias("key"), F.trim(F.regexp_extract(x, r"^[^:]*:(.*)$", 1)).alias("value"))))
    rules = F.regexp_extract_all(F.coalesce(F.col("fields")["violated_rules"], F.lit("")), F.lit(r"[A-Z]+-[0-9]+"), F.lit(0))
    return text.select("file", fields.alias("fields"), F.btrim(body, F.lit(" \n\t")).alias("body")).select(
        "file", "fields", F.col("fields")["status"].alias("expected_status"), rules.alias("expected_rules"), "body")
