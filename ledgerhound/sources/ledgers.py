"""Ledgers and master feeds derived from the driver tables.

Three ledgers share the reference's transaction schema:

* EVT  (``events``): hour resolution, 30 days, already conformed (keys are
  integers). Drives most detection rules, the features and the scoring.
* LIN  (``lineitem``/``orders``/``supplier``): a raw staging feed with the
  reference's injected defects (duplicate ids whose copies differ, orphan
  accounts, negative amounts, missing and badly cased countries). Drives
  cleaning, data quality and R007.
* SUP: LIN without the injected defects, keyed by supplier. Drives R003/R005.

All amounts are DECIMAL(18,2) so sums are exact and order independent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

MONEY = "decimal(18,2)"

# Channel per event type and the staging epoch dates of the fixtures.
EVT_CHANNELS = {"purchase": "cash", "signup": "wire", "click": "emt", "error": "cheque", "view": "pos"}
EVT_EPOCH = "2024-01-01"
LIN_EPOCH = "1995-01-01"
HIGH_RISK_REGION = 3
ONBOARDING_CHANNELS = ("branch", "online", "mobile", "advisor")
ACCOUNT_TYPES = ("chequing", "savings", "business")
BUSINESS_SEGMENTS = ("MACHINERY", "BUILDING")

# Column order of the conformed fact (reference grain: one settled transaction line).
FACT_COLUMNS = ["txn_id", "date_key", "account_key", "customer_key", "counterparty_country",
                "counterparty_id", "hour_of_day", "amount_cad", "direction", "channel",
                "signed_amount_cad"]

# Total order standing in for the feed's arrival order (first copy wins).
LIN_INGEST_ORDER = ["l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey",
                    "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_returnflag",
                    "l_linestatus"]


def _case_map(col: Column, mapping: dict[str, str], default: str | None = None) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == k, v) if expr is None else expr.when(col == k, v)
    return expr.otherwise(default) if default is not None else expr


def country_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dim_country: one member per nation plus the explicit ``UNK`` member.

    Bounded by the number of jurisdictions (a few hundred at most), so callers
    may broadcast it.
    """
    nation = read_table(spark, sf_dir, "nation", ["n_name", "n_regionkey"])
    known = nation.select(
        F.col("n_name").alias("country_code"),
        F.when(F.col("n_regionkey") == HIGH_RISK_REGION, "high_risk").otherwise("standard").alias("risk_tier"),
        (F.col("n_regionkey") == HIGH_RISK_REGION).cast("int").alias("is_high_risk"))
    unk = spark.range(1).select(F.lit("UNK").alias("country_code"), F.lit("standard").alias("risk_tier"),
                                F.lit(0).alias("is_high_risk"))
    return known.unionByName(unk)


def evt_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EVT ledger as a conformed ``fact_transaction``."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value", "props"])
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    n_nations = max(1, nation.count())  # a jurisdiction table: a few hundred rows at most
    k = F.get_json_object("props", "$.k").cast("long")
    amount = F.round(F.col("value") * 100, 2).cast(MONEY)
    direction = F.when(k % 2 == 0, F.lit("credit")).otherwise(F.lit("debit"))
    base = ev.select(
        F.concat(F.lit("E"), F.col("event_id").cast("string")).alias("txn_id"),
        F.datediff(F.to_date("ts"), F.lit(EVT_EPOCH).cast("date")).alias("date_key"),
        (F.col("user_id") * 2 + F.col("event_id") % 2).alias("account_key"),
        F.col("user_id").alias("customer_key"),
        (F.col("event_id") % n_nations).cast("int").alias("_nation"),
        F.concat(F.lit("P"), k.cast("string")).alias("counterparty_id"),
        F.hour("ts").alias("hour_of_day"),
        amount.alias("amount_cad"),
        direction.alias("direction"),
        _case_map(F.col("event_type"), EVT_CHANNELS).alias("channel"),
    )
    # Bounded by the number of jurisdictions; a key that the table lacks is the UNK member, no event is dropped.
    out = base.join(F.broadcast(nation), base["_nation"] == nation["n_nationkey"], "left")
    return out.select(
        *[F.col(c) for c in ("txn_id", "date_key", "account_key", "customer_key")],
        F.coalesce("n_name", F.lit("UNK")).alias("counterparty_country"),
        "counterparty_id", "hour_of_day", "amount_cad", "direction", "channel",
        F.when(F.col("direction") == "credit", F.col("amount_cad"))
         .otherwise(-F.col("amount_cad")).cast(MONEY).alias("signed_amount_cad"))


def _lin_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", LIN_INGEST_ORDER)
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    supplier = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"])
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    # Suppliers meet the lines before anything is shuffled: their own size tells Spark whether to broadcast them, that of a join would not.
    j = li.join(supplier, li["l_suppkey"] == supplier["s_suppkey"], "inner")
    # orders is as large as lineitem: a shuffled equi-join on the order key.
    j = j.join(orders, j["l_orderkey"] == orders["o_orderkey"], "inner")
    return j.join(F.broadcast(nation), j["s_nationkey"] == nation["n_nationkey"], "inner")


def lin_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All that the LIN feed is derived from: the line's own columns, its customer and its country. Half as wide as the feed."""
    j = _lin_joined(spark, sf_dir)
    return j.select(
        *LIN_INGEST_ORDER,
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("customer_id"),
        F.when((F.col("l_linestatus") == "O") & (F.col("l_partkey") % 33 == 0), F.lit(None).cast("string"))
         .when(F.col("l_suppkey") % 50 == 0, F.concat(F.lower("n_name"), F.lit(" ")))
         .otherwise(F.col("n_name")).alias("counterparty_country"))


def _txn_id() -> Column:
    return F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("txn_id")


def lin_feed(lines: DataFrame) -> DataFrame:
    """LIN raw transaction feed (``stg_transactions``) with injected defects, of some ``lin_lines``.

    Carries ``_ingest`` (a struct in arrival order) for first-copy-wins dedup.
    """
    amount = F.col("l_extendedprice").cast(MONEY)
    return lines.select(
        _txn_id(),
        F.when(F.col("l_partkey") % 499 == 1, F.lit("A9999999"))
         .otherwise(F.concat(F.lit("A"), F.substring("customer_id", 2, 20))).alias("account_id"),
        "customer_id",
        F.datediff(F.to_date("l_shipdate"), F.lit(LIN_EPOCH).cast("date")).alias("day_index"),
        (F.lit(8) + F.col("l_linenumber")).alias("hour"),
        F.when(F.col("l_partkey") % 997 == 0, -amount).otherwise(amount).cast(MONEY).alias("amount_cad"),
        F.when(F.col("l_returnflag") == "R", "debit").otherwise("credit").alias("direction"),
        F.when(F.col("l_linestatus") == "F", "cash").otherwise("wire").alias("channel"),
        "counterparty_country",
        F.concat(F.lit("P"), F.col("l_suppkey").cast("string")).alias("counterparty_id"),
        F.to_date("l_shipdate").alias("txn_date"),
        F.struct(*[F.col(c) for c in LIN_INGEST_ORDER]).alias("_ingest"),
    )


def first_lines(lines: DataFrame, *others: str) -> DataFrame:
    """The first copy of every txn_id: of equal lines the one with the least ``others``, the columns that the line doesn't decide.

    The feed's further columns follow from these, so they are derived after the shuffle instead of being sorted and sent.
    """
    from ..operators.clean import dedup_first  # local import: operators depend on sources

    # An order's key is never null after the join, so these two stand for txn_id: numbers sort faster, and sorted ones compress.
    return dedup_first(lines.select(*LIN_INGEST_ORDER, *others), LIN_INGEST_ORDER[:2], LIN_INGEST_ORDER[2:]).select(*LIN_INGEST_ORDER, *others)


def lin_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lin_feed(lin_lines(spark, sf_dir))


def sup_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SUP ledger: LIN lines without defects, deduplicated, keyed by supplier."""
    lines = _lin_joined(spark, sf_dir).select(*LIN_INGEST_ORDER, F.col("n_name").alias("counterparty_country"),
                                              F.concat(F.lit("P"), F.col("o_custkey").cast("string")).alias("counterparty_id"))
    amount = F.col("l_extendedprice").cast(MONEY)
    d = first_lines(lines, "counterparty_country", "counterparty_id").select(
        _txn_id(),
        F.datediff(F.to_date("l_shipdate"), F.lit(LIN_EPOCH).cast("date")).alias("date_key"),
        F.col("l_suppkey").alias("account_key"),
        F.col("l_suppkey").alias("customer_key"),
        "counterparty_country",
        "counterparty_id",
        (F.lit(8) + F.col("l_linenumber")).alias("hour_of_day"),
        amount.alias("amount_cad"),
        F.when(F.col("l_returnflag") == "R", "debit").otherwise("credit").alias("direction"),
        F.when(F.col("l_linestatus") == "F", "cash").otherwise("wire").alias("channel"))
    return d.select(*FACT_COLUMNS[:-1],
                    F.when(F.col("direction") == "credit", F.col("amount_cad"))
                     .otherwise(-F.col("amount_cad")).cast(MONEY).alias("signed_amount_cad"))


def customers_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``stg_customers``: the customer master feed derived from ``customer``."""
    cust = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"])
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_regionkey"])
    region = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    geo = nation.join(F.broadcast(region), nation["n_regionkey"] == region["r_regionkey"]).select("n_nationkey", "r_name")
    c = cust.join(F.broadcast(geo), cust["c_nationkey"] == geo["n_nationkey"], "left")
    key = F.col("c_custkey")
    kyc = F.when(key % 10 <= 6, "low").when(key % 10 <= 8, "medium").otherwise("high")
    chan = F.element_at(F.array(*[F.lit(v) for v in ONBOARDING_CHANNELS]), (key % 4 + 1).cast("int"))
    return c.select(
        key.alias("source_key"),
        F.concat(F.lit("C"), key.cast("string")).alias("customer_id"),
        F.when(F.col("c_mktsegment").isin(*BUSINESS_SEGMENTS), "business").otherwise("personal").alias("customer_segment"),
        F.lower("c_mktsegment").alias("occupation_or_business_type"),
        (key * 37 % 120).cast("int").alias("tenure_months"),
        kyc.alias("kyc_risk_rating"),
        F.when(key % 67 == 0, "True").otherwise("False").alias("is_pep"),
        ((F.col("c_acctbal") + 1000) * 10).alias("declared_annual_income_cad"),
        F.col("r_name").alias("home_province"),
        chan.alias("onboarding_channel"),
    )


def accounts_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``stg_accounts`` for LIN: one account per customer."""
    cust = read_table(spark, sf_dir, "customer", ["c_custkey"])
    key = F.col("c_custkey")
    return cust.select(
        F.concat(F.lit("A"), key.cast("string")).alias("account_id"),
        F.concat(F.lit("C"), key.cast("string")).alias("customer_id"),
        F.element_at(F.array(*[F.lit(v) for v in ACCOUNT_TYPES]), (key % 3 + 1).cast("int")).alias("account_type"),
        (key * 53 % 3000).cast("int").alias("opened_days_ago"),
    )


def evt_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dim_account for EVT: two accounts per customer (keys 2c and 2c+1)."""
    cust = read_table(spark, sf_dir, "customer", ["c_custkey"])
    a = cust.select(F.col("c_custkey").alias("customer_key"),
                    F.explode(F.array(F.lit(0), F.lit(1))).alias("_slot"))
    acct = F.col("customer_key") * 2 + F.col("_slot")
    return a.select(
        acct.alias("account_key"),
        F.concat(F.lit("A"), acct.cast("string")).alias("account_id"),
        "customer_key",
        F.element_at(F.array(*[F.lit(v) for v in ACCOUNT_TYPES]), (acct % 3 + 1).cast("int")).alias("account_type"),
        (acct * 53 % 3000).cast("int").alias("opened_days_ago"),
    )


def evt_date_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dim_date for EVT from its active days."""
    from ..operators.clean import date_dim

    f = evt_transactions(spark, sf_dir).select(
        F.col("date_key").alias("day_index"),
        F.date_add(F.lit(EVT_EPOCH).cast("date"), F.col("date_key")).alias("txn_date"))
    return date_dim(f)
