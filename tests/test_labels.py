"""Boundary rows for the label signals (window edges, gaps, rolling spans)."""

import datetime as dt

from moorline.operators import labels as LB

SNAP = dt.date(2024, 1, 16)


def d(n):
    return SNAP + dt.timedelta(days=n)


def _customers(spark, ids, salary=True):
    return spark.createDataFrame([(i, salary) for i in ids], "customer_id long, salary_account_flag boolean")


def _tx(spark, rows):
    return spark.createDataFrame(
        [(cid, day, "10.00", direction, cat, bic, bic is not None) for cid, day, direction, cat, bic in rows],
        "customer_id long, transaction_date date, amount_eur string, direction string, "
        "merchant_category string, counterparty_bank_bic string, is_competitor_transfer boolean",
    ).selectExpr("*", "cast(amount_eur as decimal(12,2)) as amt").drop("amount_eur") \
        .withColumnRenamed("amt", "amount_eur")


def _flags(df, col):
    return {r.customer_id: r[col] for r in df.collect()}


def test_salary_stop_edges(spark):
    cust = _customers(spark, [1, 2, 3, 4]).union(_customers(spark, [5], salary=False))
    rows = [
        (1, d(-10), "credit", "salary", None),                      # pre only -> fires
        (2, d(-10), "credit", "salary", None), (2, d(0), "credit", "salary", None),   # salary on snap = post
        (3, d(-91), "credit", "salary", None),                      # outside baseline -> no pre
        (4, d(-10), "credit", "salary", None), (4, d(60), "credit", "salary", None),  # post on day 60
        (5, d(-10), "credit", "salary", None),                      # flag false
    ]
    out = _flags(LB.salary_stop(cust, _tx(spark, rows), SNAP), "signal_salary_stop")
    assert out == {1: True, 2: False, 3: False, 4: False, 5: False}


def _sessions(spark, rows):
    return spark.createDataFrame([(i, cid, day) for i, (cid, day) in enumerate(rows)],
                                 "id long, customer_id long, session_date date")


def test_app_inactive_gaps(spark):
    cust = _customers(spark, range(1, 8))
    rows = [
        (1, d(29)), (1, d(45)),                 # start gap 29 < 30, end gap 15 -> no
        (2, d(30)), (2, d(45)),                 # start gap 30 -> fires
        (3, d(0)), (3, d(29)), (3, d(45)),      # gaps 29, 16, end 15 -> no
        (4, d(0)), (4, d(30)), (4, d(59)),      # middle gap 30 -> fires
        (5, d(0)), (5, d(31)),                  # end gap 29, middle 31 -> fires
        (6, d(-5)),                             # only before the window -> fires
    ]                                           # 7: no sessions at all -> fires
    out = _flags(LB.app_inactive(cust, _sessions(spark, rows), SNAP), "signal_app_inactive")
    assert out == {1: False, 2: True, 3: False, 4: True, 5: True, 6: True, 7: True}


def test_competitor_rolling_spans(spark):
    cust = _customers(spark, [1, 2, 3, 4, 5])
    b = "KREDBEBB"
    rows = [(1, d(k), "debit", "transfer", b) for k in (0, 5, 10)]                 # 3 -> no
    rows += [(2, d(k), "debit", "transfer", b) for k in (0, 5, 10, 30)]            # 4 within 30 -> fires
    rows += [(3, d(k), "debit", "transfer", b) for k in (0, 5, 10, 31)]            # 4 spanning 31 -> no
    rows += [(4, d(7), "debit", "transfer", b)] * 4                                 # 4 on one day -> fires
    rows += [(5, d(k), "credit", "transfer", b) for k in (0, 1, 2, 3)]             # credits -> no
    out = _flags(LB.competitor_rolling(cust, _tx(spark, rows), SNAP), "signal_competitor_transfers")
    assert out == {1: False, 2: True, 3: False, 4: True, 5: False}


def test_product_reduction(spark):
    cust = _customers(spark, [1, 2, 3, 4])
    h = spark.createDataFrame([
        (1, d(-100), d(0)), (1, d(-100), None),      # ends on snap (closed window) but only 1 active at snap
        (2, d(-100), d(60)), (2, d(-100), None),     # ends day 60, 2 active -> fires
        (3, d(-100), d(61)), (3, d(-100), None),     # ends day 61 -> no
        (4, d(-100), d(10)), (4, d(-100), d(20)), (4, d(-100), None),
    ], "customer_id long, start_date date, end_date date")
    out = _flags(LB.product_reduction(cust, h, SNAP), "signal_product_reduction")
    assert out == {1: False, 2: True, 3: False, 4: True}
