"""Cleaning and conforming: staging feeds -> star schema (O-10..O-20).

Order of operations follows the reference: deduplicate FIRST (first copy in
arrival order wins), then validate, so that one id can never be both loaded
and quarantined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import MONEY
from ..functions.ranking import dense_sequence

# The reference's cash-intensive occupations and tenure bands.
CASH_INTENSIVE = ("restaurant", "convenience_retail", "salon", "auto_dealer")
TENURE_BANDS = ((12, "00-11m"), (36, "12-35m"), (84, "36-83m"))
TENURE_TOP = "84m+"
MONTH_NAMES = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
REJECT_NEGATIVE = "negative_amount"
REJECT_ORPHAN = "orphan_account_id"
REJECT_UNPARSABLE = "unparsable_row"


def dedup_first(df: DataFrame, key: str | list[str], order_col: str | list[str]) -> DataFrame:
    """Keep the first row per ``key`` by ``order_col`` (a total order).

    Implemented as ``min(struct(order, row))`` per key rather than
    ``row_number`` over a key window: the aggregate is combined map-side, so a
    key whose copies make up a third of the feed is reduced to one row per map
    task before the shuffle instead of being sorted in one task.
    """
    key, order = ([c] if isinstance(c, str) else c for c in (key, order_col))
    payload = [c for c in df.columns if c not in (*key, *order)]
    agg = df.groupBy(*key).agg(F.min(F.struct(*order, *payload)).alias("_first"))
    return agg.select(*key, *[F.col("_first")[c].alias(c) for c in (*payload, *order)])


def customer_dim(stg_customers: DataFrame, cash_intensive: tuple[str, ...] = CASH_INTENSIVE,
                 key: str | None = None) -> DataFrame:
    """dim_customer (O-17). ``customer_key`` is ``ROW_NUMBER() OVER (ORDER BY
    customer_id)`` (O-10) unless ``key`` names a natural integer key to reuse."""
    tenure = F.col("tenure_months")
    band = None
    for limit, label in TENURE_BANDS:
        band = F.when(tenure < limit, label) if band is None else band.when(tenure < limit, label)
    band = band.otherwise(TENURE_TOP)
    df = stg_customers
    if key is None:
        df = dense_sequence(df, "customer_id", "customer_key")
    else:
        df = df.withColumn("customer_key", F.col(key).cast("long"))
    return df.select(
        "customer_key", "customer_id", "customer_segment", "occupation_or_business_type",
        F.col("occupation_or_business_type").isin(*cash_intensive).cast("int").alias("is_cash_intensive_business"),
        F.col("tenure_months").cast("int").alias("tenure_months"),
        band.alias("tenure_band"),
        "kyc_risk_rating",
        F.lower(F.col("is_pep").cast("string")).isin("true", "1").cast("int").alias("is_pep"),
        F.col("declared_annual_income_cad").cast("double").alias("declared_annual_income_cad"),
        "home_province", "onboarding_channel")


def account_dim(stg_accounts: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """dim_account (O-18): inner join to the customer dim, keys by account_id order."""
    a = stg_accounts.join(dim_customer.select("customer_id", "customer_key"), "customer_id", "inner")
    a = dense_sequence(a, "account_id", "account_key")
    return a.select("account_key", "account_id", "customer_key", "account_type",
                    F.col("opened_days_ago").cast("int").alias("opened_days_ago"))


def date_dim(stg: DataFrame) -> DataFrame:
    """dim_date (O-19) from the days present in the (un-deduplicated) feed."""
    d = stg.filter(F.col("day_index").isNotNull()).select("day_index", F.to_date("txn_date").alias("d")).distinct()
    dow = (F.dayofweek("d") - 1).cast("int")
    names = F.element_at(F.array(*[F.lit(m) for m in MONTH_NAMES]), F.month("d"))
    return d.select(
        F.col("day_index").cast("int").alias("date_key"),
        F.col("d").alias("calendar_date"),
        F.year("d").alias("year"), F.month("d").alias("month"),
        dow.alias("day_of_week"),
        dow.isin(0, 6).cast("int").alias("is_weekend"),
        names.alias("month_name"))


def quarantine(dedup: DataFrame, dim_account: DataFrame) -> DataFrame:
    """rejected_transaction (O-12, O-13). Reasons are exclusive: an orphan row is
    only rejected as orphan when its amount is positive."""
    neg = dedup.filter(F.col("amount_cad") <= 0).select(
        "txn_id", F.lit(REJECT_NEGATIVE).alias("reject_reason"),
        F.concat(F.lit("amount_cad="), F.col("amount_cad").cast("string")).alias("raw_payload"))
    orphan = (dedup.filter(F.col("amount_cad") > 0)
              .join(dim_account.select("account_id"), "account_id", "left_anti")
              .select("txn_id", F.lit(REJECT_ORPHAN).alias("reject_reason"),
                      F.concat(F.lit("account_id="), F.col("account_id")).alias("raw_payload")))
    return neg.unionByName(orphan)


def unparsable(bad: DataFrame) -> DataFrame:
    """Rows of rejected_transaction for the lines of a feed that don't parse; ``bad``: (txn_id, raw_line)."""
    return bad.select("txn_id", F.lit(REJECT_UNPARSABLE).alias("reject_reason"), F.col("raw_line").alias("raw_payload"))


def fact_transactions(dedup: DataFrame, dim_account: DataFrame, dim_customer: DataFrame,
                      dim_country: DataFrame) -> DataFrame:
    """fact_transaction (O-14, O-15, O-16).

    Country is normalised with ``upper(trim(coalesce(x, 'UNK')))``; anything that
    does not resolve becomes the explicit ``UNK`` member. dim_country is bounded
    by the number of jurisdictions, so it is broadcast; the account and customer
    dims grow with the data, so their join strategy is left to AQE.
    """
    s = dedup.filter(F.col("amount_cad") > 0)
    s = s.join(dim_account.select("account_id", "account_key"), "account_id", "inner")
    s = s.join(dim_customer.select("customer_id", "customer_key"), "customer_id", "inner")
    norm = F.upper(F.trim(F.coalesce(F.col("counterparty_country"), F.lit("UNK"))))
    s = s.withColumn("_cc", norm)
    cc = dim_country.select(F.col("country_code").alias("_dc"))
    s = s.join(F.broadcast(cc), s["_cc"] == cc["_dc"], "left")
    return s.select(
        "txn_id", F.col("day_index").cast("int").alias("date_key"), "account_key", "customer_key",
        F.coalesce(F.col("_dc"), F.lit("UNK")).alias("counterparty_country"),
        "counterparty_id", F.col("hour").cast("int").alias("hour_of_day"),
        F.col("amount_cad").cast(MONEY).alias("amount_cad"), "direction", "channel",
        F.when(F.col("direction") == "credit", F.col("amount_cad"))
         .otherwise(-F.col("amount_cad")).cast(MONEY).alias("signed_amount_cad"))


def quarantine_summary(rejected: DataFrame) -> DataFrame:
    """O-20: rejected rows by reason."""
    return rejected.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n_rejected"))
