"""Semantics options and streaming watermark behaviour on hand-made rows."""

import datetime as dt
import os
import uuid

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from moorline.operators import features as FT
from moorline.streaming import activity as ACT

SNAP = dt.date(2024, 1, 16)


def test_fanout_closed_form_equals_literal_join(spark):
    cust = spark.createDataFrame([(1, SNAP, True, "standard", "Flanders"), (2, SNAP, False, None, None)],
                                 "customer_id long, snapshot_date date, salary_account_flag boolean, "
                                 "segment string, region string")
    sess = spark.createDataFrame([(1, 1, SNAP - dt.timedelta(days=5)), (2, 1, SNAP - dt.timedelta(days=40)),
                                  (3, 2, SNAP - dt.timedelta(days=1))],
                                 "id long, customer_id long, session_date date")
    tx = spark.createDataFrame([(1, SNAP - dt.timedelta(days=3), "10.00", "credit", "salary", None, True),
                                (1, SNAP - dt.timedelta(days=4), "20.00", "debit", "transfer", None, False)],
                               "customer_id long, transaction_date date, amount_eur string, direction string, "
                               "merchant_category string, counterparty_bank_bic string, is_competitor_transfer boolean"
                               ).withColumn("amount_eur", F.col("amount_eur").cast("decimal(12,2)"))
    comp = spark.createDataFrame([(1, 1, "open"), (2, 1, "resolved"), (3, 1, "open")],
                                 "complaint_id long, customer_id long, status string")
    nps = spark.createDataFrame([(1, 1, SNAP, 4), (2, 1, SNAP, 9)], "id long, customer_id long, response_date date, score int")
    hold = spark.createDataFrame([(1, 1, "A", SNAP, None, "active", None), (2, 1, "B", SNAP, None, "active", None)],
                                 "id long, customer_id long, product_id string, start_date date, end_date date, "
                                 "status string, fixed_rate_end_date date")
    f = {r.customer_id: r for r in FT.feature_snapshot(cust, None, sess, tx, comp, nps, hold, SNAP,
                                                       compat="fanout").collect()}
    # literal join rows for customer 1: sessions 2 x tx 2 x complaints 3 x nps 2 x holdings 2
    assert f[1].app_logins_last_90d == 2 * 2 * 3 * 2 * 2
    assert f[1].app_logins_last_30d == 1 * 2 * 3 * 2 * 2
    assert f[1].competitor_transfer_count == 1 * 2 * 3 * 2 * 2
    assert f[1].complaints_open == 2 and f[1].product_count == 2 and f[1].nps_score_last == 9
    assert f[2].app_logins_last_90d == 1 and f[2].days_since_last_login == 1
    canon = {r.customer_id: r for r in FT.feature_snapshot(cust, None, sess, tx, comp, nps, hold, SNAP).collect()}
    assert canon[1].app_logins_last_90d == 2 and canon[1].competitor_transfer_count == 1


def test_nps_latest_and_as_of_holdings(spark):
    nps = spark.createDataFrame([(1, 1, SNAP - dt.timedelta(days=10), 3), (2, 1, SNAP - dt.timedelta(days=100), 9),
                                 (3, 2, SNAP - dt.timedelta(days=200), 7)],
                                "id long, customer_id long, response_date date, score int")
    latest = {r.customer_id: r.nps_score for r in FT.nps_aggregate(nps, SNAP, "latest_180d").collect()}
    assert latest == {1: 3}                       # most recent, older than 180 days dropped
    mx = {r.customer_id: r.nps_score for r in FT.nps_aggregate(nps).collect()}
    assert mx == {1: 9, 2: 7}
    hold = spark.createDataFrame([(1, "A", SNAP - dt.timedelta(days=5), SNAP + dt.timedelta(days=5), "closed", None),
                                  (1, "B", SNAP + dt.timedelta(days=5), None, "active", None)],
                                 "customer_id long, product_id string, start_date date, end_date date, status string, "
                                 "fixed_rate_end_date date")
    lit = FT.holding_stats(hold, SNAP).first()
    asof = FT.holding_stats(hold, SNAP, as_of=True).first()
    assert lit.product_n == 1 and asof.product_n == 1
    assert lit.active_n == 1 and lit.closed_n == 1


def test_watermark_drops_rows_of_final_days(spark, tmp_path):
    """The second run carries a row for a day that still has open windows (counted)
    and one for a day whose windows have all closed (ignored; a batch counts it)."""
    src = str(tmp_path / f"src-{uuid.uuid4().hex}")
    schema = "user_id long, ts timestamp_ntz, event_type string"
    day = lambda d, h=12, m=3: dt.datetime(2024, m, d, h)

    def write(name, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(os.path.join(src, name))

    def run():
        q = ACT.start_activity_stream(spark, os.path.join(src, "*"), str(tmp_path / "log"), str(tmp_path / "ck"),
                                      spark.read.parquet(os.path.join(src, "part1")).schema, late_days=1)
        q.awaitTermination()
        return {r.window_start: r.sessions for r in ACT.read_latest(spark, str(tmp_path / "log")).collect()}
    write("part1", [(1, day(1), "view"), (1, day(20), "view")])
    run()
    write("part2", [(1, day(2), "view"), (1, day(10, m=1), "view")])
    s = run()
    b = {r.window_start: r.sessions for r in ACT.batch_activity(spark.read.parquet(os.path.join(src, "*"))).collect()}
    assert s[dt.date(2024, 3, 1)] == b[dt.date(2024, 3, 1)] == 3
    assert dt.date(2024, 1, 1) in b and dt.date(2024, 1, 1) not in s
    assert {k: v for k, v in b.items() if k > dt.date(2024, 1, 10)} == s


def test_backlog_of_many_shuffled_files_equals_batch(spark, tmp_path):
    """More files than any trigger limit, newest events first."""
    rows = [(i % 37, dt.datetime(2024, 6, 1) - dt.timedelta(hours=5 * i), "view") for i in range(1100)]
    src = tmp_path / "src"
    src.mkdir()
    for i, (user, ts, kind) in enumerate(rows):
        pq.write_table(pa.table({"user_id": [user], "ts": pa.array([ts], pa.timestamp("us")), "event_type": [kind]}),
                       src / f"f{i:05d}.parquet")
    schema = spark.read.parquet(str(src)).schema
    s = ACT.run_activity_stream(spark, str(src), str(tmp_path / "log"), str(tmp_path / "ck"), schema)
    b = ACT.batch_activity(spark.read.parquet(str(src)))
    assert sorted(map(tuple, s.collect())) == sorted(map(tuple, b.collect()))


def test_lookback_window_edges(spark):
    cust = spark.createDataFrame([(1, SNAP, True, "standard", "Flanders")],
                                 "customer_id long, snapshot_date date, salary_account_flag boolean, "
                                 "segment string, region string")
    offs = [-91, -90, -30, 0, 1]
    sess = spark.createDataFrame([(i, 1, SNAP + dt.timedelta(days=o)) for i, o in enumerate(offs)],
                                 "id long, customer_id long, session_date date")
    tx = spark.createDataFrame(
        [(1, SNAP + dt.timedelta(days=o), "100.00", "credit", "transfer", "KREDBEBB", True) for o in offs],
        "customer_id long, transaction_date date, amount_eur string, direction string, merchant_category string, "
        "counterparty_bank_bic string, is_competitor_transfer boolean"
    ).withColumn("amount_eur", F.col("amount_eur").cast("decimal(12,2)"))
    empty_c = spark.createDataFrame([], "complaint_id long, customer_id long, status string")
    empty_n = spark.createDataFrame([], "id long, customer_id long, response_date date, score int")
    empty_h = spark.createDataFrame([], "id long, customer_id long, product_id string, start_date date, "
                                        "end_date date, status string, fixed_rate_end_date date")
    r = FT.feature_snapshot(cust, None, sess, tx, empty_c, empty_n, empty_h, SNAP).first()
    assert r.app_logins_last_90d == 3            # -90, -30, 0 (closed window, -91 and +1 excluded)
    assert r.app_logins_last_30d == 2            # -30 and 0
    assert r.days_since_last_login == 0
    assert r.competitor_transfer_count == 3
    assert r.avg_monthly_inflow_eur == 100.0
    assert r.nps_score_last is None and r.months_to_rate_reset is None and r.product_count == 0
