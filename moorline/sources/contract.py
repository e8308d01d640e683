"""Declared schemas (IO1, IO9): what a table must look like, checked before it is read.

``schema_faults`` compares the columns that are there with the declared ones, from metadata alone: missing,
extra and retyped columns.  ``conform`` gives the rows the declared columns in the declared order and
types, and names for every row the columns that do not fit: a required value that is null, or a value that
the declared type cannot hold.  Rows without such columns are the table, the others are quarantined with their raw values.

Defined results: a missing column is null; an extra one is dropped; names are matched exactly; a null in a column
that is not required fits; an empty table has no faults of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# FIXED VALUES: the columns and types of the staged tables.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
              "o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
                "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
}
# FIXED VALUES: the columns that identify a row and may not be null.
KEYS = {"region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"], "supplier": ["s_suppkey"], "part": ["p_partkey"],
        "orders": ["o_orderkey", "o_custkey"], "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"], "events": ["event_id"],
        "documents": ["doc_id"], "labels": ["doc_id"]}
FAULTS = "column_name string, fault string, declared string, found string"


def declared(spark: SparkSession, ddl: str) -> StructType:
    return spark.createDataFrame([], ddl).schema


def schema_faults(df: DataFrame, ddl: str) -> DataFrame:
    """One row per missing, extra or retyped column of ``df``."""
    spark = df.sparkSession
    want = {f.name: f.dataType.simpleString() for f in declared(spark, ddl)}
    have = {f.name: f.dataType.simpleString() for f in df.schema}
    rows = [(c, "missing", t, None) for c, t in want.items() if c not in have]
    rows += [(c, "extra", None, t) for c, t in have.items() if c not in want]
    rows += [(c, "retyped", t, have[c]) for c, t in want.items() if c in have and have[c] != t]
    return spark.createDataFrame(rows, FAULTS)


def _faulty(df: DataFrame, schema: StructType, required: list[str]) -> Column:
    """The names of the columns of a row that do not fit."""
    out = []
    for f in schema:
        raw = F.col(f.name) if f.name in df.columns else F.lit(None)
        bad = F.lit(False)
        if f.name in df.columns and df.schema[f.name].dataType != f.dataType:
            bad = raw.isNotNull() & raw.try_cast(f.dataType).isNull()
        if f.name in required:
            bad = bad | raw.isNull()
        out.append(F.when(bad, F.lit(f.name)))
    return F.filter(F.array(*out), lambda x: x.isNotNull())


def conform(df: DataFrame, ddl: str, required: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(the rows that fit, in the declared columns; the others as ``faults`` array<string> and ``raw`` JSON)."""
    schema = declared(df.sparkSession, ddl)
    judged = df.withColumn("_faults", _faulty(df, schema, list(required)))
    good = judged.where(F.size("_faults") == 0).select(*[
        (F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema])
    quarantined = judged.where(F.size("_faults") > 0).select(F.col("_faults").alias("faults"), F.to_json(F.struct(*df.columns)).alias("raw"))
    return good, quarantined


def read_checked(spark: SparkSession, path: str, name: str) -> tuple[DataFrame, DataFrame]:
    """A declared table and its quarantine; a missing or extra column is an error."""
    df = spark.read.parquet(path)
    faults = schema_faults(df, TABLES[name]).where(F.col("fault") != "retyped").collect()
    if faults:
        raise ValueError(f"{name}: " + ", ".join(f"{r.fault} column {r.column_name}" for r in faults))
    return conform(df, TABLES[name], KEYS[name])
