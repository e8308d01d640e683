"""Offer eligibility from a catalogue table (J10, DC5): relational division.

An offer's conditions are rows (offer, group, input, lowest, highest, whether the bounds themselves are excluded): group 0 holds the conditions that must all
hold, every other group needs one that does.  A customer qualifies for an offer if the satisfied conditions
of group 0 are as many as it has, and the other groups with a satisfied condition are all of them.

1. The customers' inputs are unpivoted to (customer, input, value).
2. Conditions of many offers repeat: each distinct one is tested once per customer, against the
   value of its input only.
3. Satisfied conditions are joined to the offers that ask for them, among those for the customer's reason and
   segment, and counted per customer and offer; partial counts are added up before the shuffle.

Nothing about the offers is code: a catalogue of any size is read from wherever a table can be.

Defined results: an unknown (null) input satisfies nothing; an offer without conditions suits every customer
of its reason and segment; a condition on an input that customers do not have is never met; equal counts go by
ascending offer id; a condition that an offer states twice counts once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.joins import broadcast_if_bounded
from . import decisions as DC

BOUNDS = ["input", "low", "high", "above", "below"]
# Catalogues above this number of rows are shuffled like any table.
CATALOGUE_ROWS = 100_000


def inputs() -> dict:
    """The inputs that conditions may name; a flag is 1 or 0."""
    def flag(c):
        return F.coalesce(c, F.lit(False)).cast("double")
    c = F.col
    return {"ten": c("tenure_months"), "comp": c("competitor_transfer_count"), "nps": c(DC.NPS), "mrr": c(DC.MRR),
            "dsl": c("days_since_last_login"), "age": c("age"), "pc": c("product_count"), "l30": c("app_logins_last_30d"),
            "l90": c("app_logins_last_90d"), "co": c("complaints_open"), "oldest": c("oldest_open_days"),
            "inflow": c("avg_monthly_inflow_eur"), "lasttx": c("days_since_last_tx"),
            "savings": flag(c("has_savings") == 1), "current": flag(c("has_current") == 1),
            "no_investment": flag(c("has_investment") == 0), "service_cat": flag(c("open_service_quality")),
            "no_rm": flag(c("relationship_manager_id").isNull()), "no_salary": flag(c("salary_account_flag") == 0),
            "milestone": flag(F.floor(c("tenure_months") / 12).isin(1, 3, 5, 10))}


def conditions(offers: DataFrame) -> DataFrame:
    """Condition rows of a catalogue with the columns offer_id, required and any_of, whose entries read
    ``input>=1``, ``input<2``, ``input=0``, ``input3-6`` (from 3 to 6) or ``input`` (a flag that must be set).
    Every offer also gets the condition that always holds, which does not count."""
    entry = F.explode(F.concat(
        F.transform("required", lambda x: F.struct(F.lit(0).alias("grp"), x.alias("text"))),
        F.transform("any_of", lambda x: F.struct(F.lit(1).alias("grp"), x.alias("text")))))
    rows = offers.select("offer_id", entry.alias("e")).select("offer_id", "e.grp", F.regexp_replace("e.text", r"\s", "").alias("text")).distinct()

    def part(pattern, group):
        return F.regexp_extract("text", pattern, group)
    compared, between = r"^([a-z][a-z0-9_]*?)(>=|<=|=|<|>)(-?[0-9.]+)$", r"^([a-z_]+)([0-9.]+)-([0-9.]+)$"
    sign, bound = part(compared, 2), part(compared, 3).try_cast("double")
    unbounded = F.lit(float("inf"))
    low = F.when(sign == "", F.coalesce(part(between, 2).try_cast("double"), F.lit(1.0))) \
        .when(sign.isin(">=", ">", "="), bound).otherwise(-unbounded)
    high = F.when(sign == "", F.coalesce(part(between, 3).try_cast("double"), F.lit(1.0))) \
        .when(sign.isin("<=", "<", "="), bound).otherwise(unbounded)
    name = F.when(sign != "", part(compared, 1)).when(part(between, 1) != "", part(between, 1)).otherwise(F.col("text"))
    stated = rows.select("offer_id", F.col("grp").cast("int").alias("grp"), name.alias("input"), low.alias("low"), high.alias("high"),
                         (sign == ">").alias("above"), (sign == "<").alias("below"), F.lit(True).alias("counts"))
    always = offers.select("offer_id", F.lit(0).alias("grp"), F.lit("always").alias("input"), F.lit(1.0).alias("low"),
                           F.lit(1.0).alias("high"), F.lit(False).alias("above"), F.lit(False).alias("below"), F.lit(False).alias("counts"))
    return stated.unionByName(always)


def satisfied(customers: DataFrame, asked: DataFrame, key: str = "customer_id") -> DataFrame:
    """(key, *BOUNDS): the distinct conditions that each customer's inputs satisfy."""
    known = {k: v.cast("double") for k, v in inputs().items()} | {"always": F.lit(1.0)}
    long = customers.select(key, *[v.alias(k) for k, v in known.items()]).unpivot([key], list(known), "input", "value") \
        .where(F.col("value").isNotNull())
    value = F.col("value")
    over = (value > F.col("low")) | (~F.col("above") & (value == F.col("low")))
    under = (value < F.col("high")) | (~F.col("below") & (value == F.col("high")))
    return long.join(asked, "input").where(over & under).drop("value")


def eligible_pairs(classified: DataFrame, offers: DataFrame, stated: DataFrame, key: str = "customer_id") -> DataFrame:
    """(key, offer_id, triggered): every offer that a classified customer qualifies for, with the number of
    its conditions that hold."""
    met = satisfied(classified, broadcast_if_bounded(stated.select(*BOUNDS).distinct(), CATALOGUE_ROWS), key)
    of = offers.select("offer_id", F.col("retention_use_case").alias("churn_reason"), F.explode("target_segments").alias("segment")).distinct()
    asking = broadcast_if_bounded(stated.join(of, "offer_id"), CATALOGUE_ROWS)
    groups = met.join(classified.select(key, "churn_reason", "segment"), key).join(asking, ["churn_reason", "segment", *BOUNDS]) \
        .groupBy(key, "offer_id", "grp").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("counts").cast("int")).alias("counted"))
    found = groups.groupBy(key, "offer_id").agg(
        F.sum(F.when(F.col("grp") == 0, F.col("n")).otherwise(0)).alias("all_met"),
        F.count(F.when(F.col("grp") != 0, 1)).alias("any_met"), F.sum("counted").alias("triggered"))
    needed = stated.groupBy("offer_id").agg(
        F.count(F.when(F.col("grp") == 0, 1)).alias("all_needed"),
        F.count_distinct(F.when(F.col("grp") != 0, F.col("grp"))).alias("any_needed"))
    return found.join(broadcast_if_bounded(needed, CATALOGUE_ROWS), "offer_id") \
        .where((F.col("all_met") == F.col("all_needed")) & (F.col("any_met") == F.col("any_needed"))) \
        .select(key, "offer_id", F.col("triggered").cast("int").alias("triggered"))


def eligible_offers(classified: DataFrame, offers: DataFrame, key: str = "customer_id") -> DataFrame:
    """The classified customers with ``eligible``: (neg_triggered, offer_id, triggered) best first, as
    ``decisions.eligible_offers`` gives it for the fixed catalogue."""
    pairs = eligible_pairs(classified, offers, conditions(offers), key)
    each = F.struct((-F.col("triggered")).alias("neg_triggered"), "offer_id", "triggered")
    best = pairs.groupBy(key).agg(F.array_sort(F.collect_list(each)).alias("eligible"))
    none = F.array().cast("array<struct<neg_triggered:int,offer_id:string,triggered:int>>")
    return classified.join(best, key, "left").withColumn("eligible", F.coalesce("eligible", none))
