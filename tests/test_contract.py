"""Declared schemas: every table conforms; each kind of damage is told apart."""

import pytest
from pyspark.sql import functions as F

from moorline.operators import drift as DR
from moorline.sources import contract as CN
from moorline.sources.tables import table_path

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(CN.TABLES))
def test_tables_conform(spark, name):
    df = spark.read.parquet(table_path(SF, name))
    assert CN.schema_faults(df, CN.TABLES[name]).collect() == []
    good, bad = CN.read_checked(spark, table_path(SF, name), name)
    assert bad.count() == 0 and good.count() == df.count() and good.columns == df.columns


def test_damaged_rows_are_quarantined_with_their_values(spark):
    rows = spark.createDataFrame([("1", "a", 5), ("x", "b", 6), (None, "c", 7), ("4", None, None)], "k string, t string, more int")
    good, bad = CN.conform(rows, "k bigint, t string, late date", ["k"])
    assert good.dtypes == [("k", "bigint"), ("t", "string"), ("late", "date")]
    assert sorted(map(tuple, good.collect())) == [(1, "a", None), (4, None, None)]
    assert sorted((r.faults, r.raw) for r in bad.collect()) == [(["k"], '{"k":"x","t":"b","more":6}'), (["k"], '{"t":"c","more":7}')]


def test_missing_and_extra_columns_stop_a_checked_read(spark, tmp_path):
    spark.createDataFrame([(1, "x")], "r_regionkey int, other string").write.parquet(str(tmp_path / "r"))
    with pytest.raises(ValueError, match="missing column r_name.*extra column other"):
        CN.read_checked(spark, str(tmp_path / "r"), "region")


def test_stored_counts_of_any_window_equal_the_direct_ones(spark, tmp_path):
    import datetime as dt
    days = [dt.date(2024, 1, d) for d in (1, 8, 15, 22)]
    rows = [(i, days[i % 4], float(i * i % 7), float(i % 3) if i % 5 else None) for i in range(200)]
    table = spark.createDataFrame(rows, "id long, snapshot_date date, a double, b double")
    for d in days:
        DR.store_counts(table.where(F.col("snapshot_date") == F.lit(d)), str(tmp_path / "c"), ["a", "b"])
    DR.store_counts(table.where(F.col("snapshot_date") == F.lit(days[1])), str(tmp_path / "c"), ["a", "b"])     # replaces its own date only
    for ref, prod in (((days[0], days[1]), (days[2], days[3])), ((days[0], days[0]), (days[3], days[3])), ((days[0], days[2]), (days[1], days[3]))):
        def of(window):
            return table.where(F.col("snapshot_date").between(*[F.lit(d) for d in window]))
        direct = DR.drift_report(DR.feature_drift_input(of(ref), of(prod), ["a", "b"]))
        stored = DR.report_of_counts(DR.stored_counts(spark, str(tmp_path / "c"), ref, prod))
        assert sorted(map(tuple, stored.select(*direct.columns).collect())) == sorted(map(tuple, direct.collect()))
