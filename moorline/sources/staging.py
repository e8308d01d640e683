"""Staged views: give the TPC-H-like test tables the shapes of the retention
warehouse (customers, products, holdings, transactions, sessions,
complaints, NPS, outreach tables, scored rows).

The definitions follow FIXTURES.md section B exactly; each has a DuckDB twin
in ``moorline.plans.oracle_views`` that must return identical rows.
Dates from other years are folded onto ``[snap-90, snap+60)``.

All views are lazy DataFrames; nothing is collected.  Joins between the big
tables (lineitem x orders) are plain equi-joins left to Catalyst/AQE; only
the nation table (25 rows by construction) and the per-type product list are
broadcast.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from .tables import read_table

# ---------------------------------------------------------------------------
# FIXED VALUES: staging encodings (our own fixture design, FIXTURES.md B)
# ---------------------------------------------------------------------------
EPOCH_SHIP = dt.date(1995, 1, 1)
EPOCH_EVENTS = dt.date(2024, 1, 1)
REGION_BY_KEY = [(0, "Brussels"), (1, "Flanders"), (2, "Wallonia"), (3, "Other")]
SEGMENT_BY_MKT = [
    ("MACHINERY", "private_banking"),
    ("BUILDING", "standard"),
    ("FURNITURE", "starter"),
    ("HOUSEHOLD", "student"),
]
DIRTY_REASON_BY_PRIORITY = [
    ("1-URGENT", "Price_Sensitivity"),
    ("2-HIGH", " competitor fee concerns"),
    ("3-MEDIUM", "mortgage rate reset soon"),
    ("5-LOW", "disengaged / dormant"),
]
# p_type -> one of the six product kinds (first word of p_type decides).
KIND_BY_PTYPE = [
    ("ECONOMY", "current_account"),
    ("LARGE", "savings_account"),
    ("PROMO", "mortgage"),
    ("MEDIUM", "consumer_credit"),
    ("SMALL", "investment"),
    ("STANDARD", "insurance"),
]
LANGUAGE_BY_REGION = [("Flanders", "nl"), ("Wallonia", "fr"), ("Brussels", "fr")]
TX_CHANNELS = ["app", "web", "atm", "branch", "standing_order"]
COMPLAINT_CATEGORIES = ["card_dispute", "fee_query", "transfer_error", "product_query", "service_quality"]
VIOLATIONS_BY_MOD4 = [
    (0, "[]"),
    (1, '[{"rule_id": "BT-001", "severity": "hard_block", "finding": "urgency phrase"}]'),
    (2, '[{"rule_id": "CH-001", "severity": "hard_block", "finding": "no unsubscribe line"}, "BT-005", "XX-999"]'),
    (3, "[bad json"),
]


def case_map(col: Column, pairs, default=None) -> Column:
    """CASE col WHEN k THEN v ... [ELSE default] END."""
    expr = None
    for k, v in pairs:
        expr = F.when(col == F.lit(k), F.lit(v)) if expr is None else expr.when(col == F.lit(k), F.lit(v))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def day_number(col: Column, epoch: dt.date) -> Column:
    return F.datediff(col.cast("date"), F.lit(epoch))


class Warehouse:
    """Lazy staged views over one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str, snapshot: dt.date = K.TEST_SNAPSHOT):
        self.spark = spark
        self.sf_dir = sf_dir
        self.snapshot = snapshot

    # -- raw ---------------------------------------------------------------
    def raw(self, name: str, columns: list[str] | None = None) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name, columns)

    @property
    def snap(self) -> Column:
        return F.lit(self.snapshot)

    @property
    def fold_start(self) -> dt.date:
        return self.snapshot - dt.timedelta(days=90)

    # -- customers -----------------------------------------------------------
    def customers(self) -> DataFrame:
        c = self.raw("customer", ["c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"])
        n = self.raw("nation", ["n_nationkey", "n_regionkey"])
        region = case_map(F.col("n_regionkey"), REGION_BY_KEY)
        segment = case_map(F.col("c_mktsegment"), SEGMENT_BY_MKT)
        return (
            c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
            .select(
                F.col("c_custkey").alias("customer_id"),
                self.snap.alias("snapshot_date"),
                (F.lit(18) + F.col("c_custkey") % 57).cast("int").alias("age"),
                region.alias("region"),
                segment.alias("segment"),
                F.date_sub(self.snap, (F.lit(30) + (F.col("c_custkey") * 37) % 9095).cast("int"))
                .alias("customer_since_date"),
                case_map(region, LANGUAGE_BY_REGION, "en").alias("preferred_language"),
                (F.col("c_acctbal") > 0).alias("salary_account_flag"),
                F.when(segment == "private_banking",
                       F.concat(F.lit("RM"), F.lpad((F.col("c_custkey") % 40).cast("string"), 3, "0")))
                .alias("relationship_manager_id"),
            )
        )

    # -- products ----------------------------------------------------------
    def products(self) -> DataFrame:
        p = self.raw("part", ["p_type"]).distinct()
        kind = case_map(F.split(F.col("p_type"), " ").getItem(0), KIND_BY_PTYPE, "current_account")
        return p.select(
            F.col("p_type").alias("product_id"),
            F.lower("p_type").alias("product_type"),
            F.concat(F.col("p_type"), F.lit(" product")).alias("product_name"),
            kind.alias("product_kind"),
        )

    def customer_products(self) -> DataFrame:
        li = self.raw("lineitem", ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"])
        o = self.raw("orders", ["o_orderkey", "o_custkey"])
        p = self.raw("part", ["p_partkey", "p_type"])
        j = li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
        closed = F.col("l_suppkey") % 4 == 0
        return j.select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("p_type").alias("product_id"),
            F.date_add(F.lit(self.fold_start),
                       (day_number(F.col("l_shipdate"), EPOCH_SHIP) % 150 - 200).cast("int"))
            .alias("start_date"),
            F.when(closed, F.date_add(self.snap, (F.col("l_partkey") % 60).cast("int"))).alias("end_date"),
            F.when(closed, F.lit("closed")).otherwise(F.lit("active")).alias("status"),
            F.when(F.col("p_type") == "PROMO",
                   F.date_add(self.snap, ((F.col("l_partkey") % 120) * 30).cast("int")))
            .alias("fixed_rate_end_date"),
        )

    # -- transactions --------------------------------------------------------
    def transactions(self) -> DataFrame:
        li = self.raw("lineitem", ["l_orderkey", "l_suppkey", "l_linenumber", "l_extendedprice",
                                   "l_returnflag", "l_shipdate"])
        o = self.raw("orders", ["o_orderkey", "o_custkey", "o_orderpriority"])
        competitor = F.col("l_suppkey") % 10 == 0
        bic = case_map(F.expr("(l_suppkey div 10) % 4"), list(enumerate(K.COMPETITOR_BICS)))
        channel = case_map(F.col("l_linenumber") % 5, list(enumerate(TX_CHANNELS)))
        return li.join(o, li.l_orderkey == o.o_orderkey).select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("transaction_id"),
            F.col("o_custkey").alias("customer_id"),
            F.date_add(F.lit(self.fold_start),
                       (day_number(F.col("l_shipdate"), EPOCH_SHIP) % 150).cast("int"))
            .alias("transaction_date"),
            F.col("l_extendedprice").cast("decimal(12,2)").alias("amount_eur"),
            F.when(F.col("l_returnflag") == "R", F.lit("credit")).otherwise(F.lit("debit")).alias("direction"),
            F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("salary")).otherwise(F.lit("transfer"))
            .alias("merchant_category"),
            F.when(competitor, bic).alias("counterparty_bank_bic"),
            channel.alias("channel"),
            competitor.alias("is_competitor_transfer"),
        )

    # -- event-derived children ------------------------------------------------
    def _events(self, event_type: str, cols: list[str]) -> DataFrame:
        return self.raw("events", cols).where(F.col("event_type") == event_type)

    def app_sessions(self) -> DataFrame:
        e = self._events("view", ["event_id", "ts", "user_id", "event_type", "value"])
        return e.select(
            F.col("event_id").alias("id"),
            F.col("user_id").alias("customer_id"),
            F.date_add(F.lit(self.fold_start), (day_number(F.col("ts"), EPOCH_EVENTS) * 5).cast("int"))
            .alias("session_date"),
            F.floor(F.col("value") * 10).cast("int").alias("session_duration_seconds"),
        )

    def complaints(self) -> DataFrame:
        e = self._events("error", ["event_id", "ts", "user_id", "event_type", "value"])
        opened = F.date_add(F.lit(self.fold_start), (day_number(F.col("ts"), EPOCH_EVENTS) * 2).cast("int"))
        is_open = F.col("value") > 10
        res_days = (F.lit(2) + F.col("event_id") % 12).cast("int")
        return e.select(
            F.col("event_id").alias("complaint_id"),
            F.col("user_id").alias("customer_id"),
            opened.alias("opened_date"),
            F.when(~is_open, F.date_add(opened, res_days)).alias("closed_date"),
            case_map(F.col("event_id") % 5, list(enumerate(COMPLAINT_CATEGORIES))).alias("category"),
            F.when(is_open, F.lit("open")).otherwise(F.lit("resolved")).alias("status"),
            F.when(~is_open, res_days).alias("resolution_days"),
        )

    def nps_responses(self) -> DataFrame:
        e = self._events("signup", ["event_id", "ts", "user_id", "event_type", "value"])
        return e.select(
            F.col("event_id").alias("id"),
            F.col("user_id").alias("customer_id"),
            F.date_add(F.lit(self.snapshot - dt.timedelta(days=180)),
                       (day_number(F.col("ts"), EPOCH_EVENTS) * 6).cast("int")).alias("response_date"),
            (F.floor(F.col("value")) % 11).cast("int").alias("score"),
        )

    def branch_visits(self) -> DataFrame:
        e = self._events("click", ["event_id", "ts", "user_id", "event_type"])
        return e.select(
            F.col("event_id").alias("id"),
            F.col("user_id").alias("customer_id"),
            F.date_add(F.lit(self.fold_start), (day_number(F.col("ts"), EPOCH_EVENTS) * 5).cast("int"))
            .alias("visit_date"),
            F.concat(F.lit("BR"), (F.col("event_id") % 30).cast("string")).alias("branch_id"),
            F.lit("advice").alias("purpose"),
        )

    # -- outreach tables ---------------------------------------------------------
    def _outreach_base(self, approved: bool, drafts: bool) -> DataFrame:
        """Outreach rows; documents are joined only where the drafts are read."""
        o = self.raw("orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"])
        o = o.where(F.col("o_orderstatus") != "F") if approved else o.where(F.col("o_orderstatus") == "F")
        key = F.col("o_orderkey")
        if drafts:
            d = self.raw("documents", ["doc_id", "text"])
            o = o.join(d, o.o_orderkey == d.doc_id, "left").withColumnRenamed("text", "message_draft")
        return o.select(
            key.alias("id"),
            F.col("o_custkey").alias("customer_id"),
            F.trunc(F.col("o_orderdate").cast("date"), "month").alias("batch_date"),
            F.concat(F.lit("PR-"), F.lpad((F.lit(1) + key % 25).cast("string"), 3, "0")).alias("offer_id"),
            F.when(key % 3 == 0, F.lit("call")).otherwise(F.lit("email")).alias("channel"),
            case_map(F.col("o_orderpriority"), DIRTY_REASON_BY_PRIORITY).alias("churn_reason"),
            *(["message_draft"] if drafts else []),
            F.col("o_orderdate").cast("timestamp_ntz").alias("event_ts"),
        )

    def approved(self, drafts: bool = False) -> DataFrame:
        b = self._outreach_base(True, drafts)
        key = F.col("id")
        conf = F.when(key % 5 == 0, F.lit(None).cast("string")).otherwise(
            case_map(key % 3, [(0, "high"), (1, "medium"), (2, "low")]))
        return b.select(
            "id", "customer_id", "batch_date", "offer_id", "channel", "churn_reason",
            conf.alias("confidence"), *(["message_draft"] if drafts else []),
            (F.lit(100) + key % 700).cast("int").alias("agent1_tokens"),
            (F.lit(200) + key % 900).cast("int").alias("agent2_tokens"),
            (F.lit(300) + key % 500).cast("int").alias("agent3_tokens"),
            F.col("event_ts").alias("approved_at"),
        )

    def queue(self, drafts: bool = False) -> DataFrame:
        b = self._outreach_base(False, drafts)
        key = F.col("id")
        status = case_map(key % 5, [(0, "approved"), (1, "rejected")], "pending")
        reviewed = status != "pending"
        return b.select(
            "id", "customer_id", "batch_date", "offer_id", "channel", "churn_reason",
            *(["message_draft"] if drafts else []),
            case_map(key % 4, VIOLATIONS_BY_MOD4).alias("violated_rules"),
            F.lit(None).cast("string").alias("review_notes"),
            status.alias("status"),
            F.when(reviewed, F.concat(F.lit("reviewer_"), (key % 3).cast("string"))).alias("reviewed_by"),
            F.when(reviewed, F.col("event_ts") + F.expr("INTERVAL 1 DAY")).alias("reviewed_at"),
            F.col("event_ts").alias("created_at"),
        )

    # -- scored rows -------------------------------------------------------------
    def scored(self) -> DataFrame:
        lab = self.raw("labels", ["doc_id", "quality"])
        doc = self.raw("documents", ["doc_id", "n_chars"])
        return lab.join(doc, "doc_id").select(
            F.col("doc_id").alias("customer_id"),
            F.col("quality").cast("int").alias("label"),
            ((F.col("n_chars") % 97) / F.lit(97.0)).alias("score"),
            F.date_add(self.snap, (F.col("doc_id") % 14).cast("int")).alias("scored_date"),
        )
