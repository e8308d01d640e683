"""Parallelism of the decisions."""

import datetime as dt

from moorline.operators import decisions as DC


def test_the_rules_of_a_small_batch_run_in_several_tasks(spark):
    day = dt.date(2024, 1, 16)
    batch = spark.createDataFrame([(i, 0.9) for i in range(40)], "customer_id bigint, churn_score double")
    customers = spark.createDataFrame([(i, 40, None, dt.date(2020, 1, 1)) for i in range(60)],
                                      "customer_id bigint, age int, relationship_manager_id string, customer_since_date date")
    holdings = spark.createDataFrame([(i, "P", "active", None) for i in range(0, 60, 2)],
                                     "customer_id bigint, product_id string, status string, fixed_rate_end_date date")
    products = spark.createDataFrame([("P", "mortgage", "Home loan")], "product_id string, product_kind string, product_name string")
    complaints = spark.createDataFrame([(3, "open", day, "fee_query")],
                                       "customer_id bigint, status string, opened_date date, category string")
    days = spark.createDataFrame([(i, day) for i in range(60)], "customer_id bigint, d date")
    profiles = batch.where("customer_id < 30").select("customer_id")
    ctx = DC.decision_context(batch, customers, holdings, products, complaints, None, profiles, day, daily_t=days)
    assert ctx.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = {r.customer_id: r for r in ctx.collect()}
    assert len(rows) == ctx.count() == 40
    assert rows[2].has_mortgage == 1 and rows[3].has_mortgage == 0 and rows[3].oldest_open_days == 0 and not rows[30].has_profile
