"""Many snapshot dates in one pass against one snapshot at a time."""

import datetime as dt

from pyspark.sql import functions as F

from moorline.operators import asof, labels as LB
from moorline.plans import common as C

SF = "/root/testdata/sf0.001"
SNAP = dt.date(2024, 1, 16)


def _rows(df):
    return sorted(map(tuple, df.collect()))


def test_equals_single_snapshots(spark):
    w = C.warehouse(spark, SF)
    dates = [SNAP - dt.timedelta(days=n) for n in (0, 1, 7, 30, 31, 61, 89, 90)] + [SNAP + dt.timedelta(days=n) for n in (20, 75, 200)]
    many = C.features_many(w, dates)
    columns = many.columns
    for d in dates:
        assert _rows(many.where(F.col("snapshot_date") == F.lit(d))) == _rows(C.features_at(w, d).select(*columns)), d
    assert many.count() == len(dates) * w.customers().count()


def test_children_are_read_once_whatever_the_number_of_dates(spark):
    w = C.warehouse(spark, SF)
    C.daily_sessions(w), C.daily_transactions(w)

    def scans(n):
        plan = C.features_many(w, [SNAP - dt.timedelta(days=7 * i) for i in range(n)])._jdf.queryExecution().executedPlan().toString()
        return plan.count("FileScan"), plan.count("Scan ExistingRDD"), plan.count("Exchange hashpartitioning")
    assert scans(1) == scans(12)


def test_window_edges(spark):
    customers = spark.createDataFrame([(1, True, "s", "r"), (2, None, None, None)],
                                      "customer_id long, salary_account_flag boolean, segment string, region string")
    days = [SNAP - dt.timedelta(days=n) for n in (0, 30, 31, 90, 91)]
    sessions = spark.createDataFrame([(1, d, 2, 1) for d in days], "customer_id long, d date, n long, id_n long")
    transactions = spark.createDataFrame([(1, days[3], 1, 1050, 2), (1, days[4], 5, 99, 1)],
                                         "customer_id long, d date, competitor_n long, credit_cents long, credit_n long")
    got = {r.customer_id: r for r in asof.window_values(customers, [SNAP], sessions, transactions).collect()}
    assert (got[1].logins_recent, got[1].logins_window, got[1].competitor_n, got[1].credit_cents, got[1].credit_n) == (4, 4, 1, 1050, 2)
    assert got[1].last_session_date == SNAP and got[2].last_session_date is None and got[2].logins_window == 0


def test_label_windows_hold_a_bounded_number_of_days(spark):
    history = spark.range(3650).select(F.lit(1).cast("long").alias("customer_id"), F.date_sub(F.lit(SNAP), F.col("id").cast("int") - 200).alias("d"),
                                       F.lit(1).cast("long").alias("n"), F.lit(1).cast("long").alias("id_n"))
    plan = LB.session_stats(history, SNAP, 60, 90, 30)
    row = plan.first()
    assert (row.first_d, row.max_gap, row.logins_window) == (SNAP, 1, 91)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    window, below = text.index("Window"), text.index("Filter")
    assert below > window            # the range is filtered below the window
