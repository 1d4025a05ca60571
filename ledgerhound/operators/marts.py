"""Published marts and report measures (O-96..O-112)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import count_if
from ..params import CostParams

T1 = "T1_same_day"
TIERS = ("T1_same_day", "T2_five_day", "T3_thirty_day")


def mart_alert(alerts: DataFrame, dim_date: DataFrame, scored: DataFrame) -> DataFrame:
    """O-96: alert + calendar date + (left) score, tier, priority, reasons when present."""
    score_cols = [c for c in ("score", "score_percentile", "tier", "priority", "split", "is_true_positive",
                              "reason_1", "reason_2", "reason_3", "top_mitigant") if c in scored.columns]
    a = alerts.join(dim_date.select("date_key", "calendar_date"), "date_key", "inner")
    return a.join(scored.select("alert_id", *score_cols), "alert_id", "left").select(
        "alert_id", "rule_id", "customer_key", "date_key", "calendar_date", "trigger_amount",
        "trigger_txn_count", "detail", *score_cols)


def _txn_enriched(fact: DataFrame, dim_date: DataFrame, dim_country: DataFrame) -> DataFrame:
    cc = dim_country.select(F.col("country_code").alias("counterparty_country"), "is_high_risk")
    # dim_country is bounded by the number of jurisdictions; dim_date by the calendar.
    return (fact.join(F.broadcast(dim_date.select("date_key", "calendar_date")), "date_key", "inner")
            .join(F.broadcast(cc), "counterparty_country", "inner"))


def mart_customer_week(fact: DataFrame, dim_date: DataFrame, dim_country: DataFrame, alerts: DataFrame) -> DataFrame:
    """O-97: weekly measures (week = date_key div 7) for alerted customers only."""
    alerted = alerts.select("customer_key").distinct()
    t = _txn_enriched(fact, dim_date, dim_country).join(alerted, "customer_key", "left_semi")
    amt = F.col("amount_cad")
    zero = F.lit(0).cast("decimal(18,2)")
    credit = F.col("direction") == "credit"
    return t.groupBy("customer_key", (F.col("date_key") / 7).cast("int").alias("week_index")).agg(
        F.min("calendar_date").alias("week_start_date"),
        F.count(F.lit(1)).alias("n_txn"),
        F.sum(amt).alias("total_value"),
        F.sum(F.when(credit, amt).otherwise(zero)).alias("credit_value"),
        F.sum(F.when(F.col("direction") == "debit", amt).otherwise(zero)).alias("debit_value"),
        F.sum(F.when((F.col("channel") == "cash") & credit, amt).otherwise(zero)).alias("cash_credit_value"),
        F.sum(F.when(F.col("is_high_risk") == 1, amt).otherwise(zero)).alias("high_risk_value"),
        F.countDistinct("counterparty_id").alias("distinct_counterparties"))


def mart_txn_drill(fact: DataFrame, dim_date: DataFrame, dim_country: DataFrame, scored: DataFrame) -> DataFrame:
    """O-98: transactions of customers with any tier-1 alert."""
    t1 = scored.filter(F.col("tier") == T1).select("customer_key").distinct()
    t = _txn_enriched(fact, dim_date, dim_country).join(t1, "customer_key", "left_semi")
    return t.select("txn_id", "customer_key", "date_key", "calendar_date", "amount_cad", "direction", "channel",
                    "counterparty_country", "counterparty_id", "hour_of_day", "is_high_risk")


def volume_measures(scored: DataFrame, n_days: int) -> DataFrame:
    """O-99: total, tier-1 and deferred alerts, deferred share, alerts per day."""
    a = scored.agg(F.count(F.lit(1)).alias("total_alerts"), count_if(F.col("tier") == T1).alias("tier1_alerts"),
                   count_if(F.col("priority") == "deferred").alias("deferred_alerts"))
    return a.select("*", F.try_divide(F.col("deferred_alerts").cast("double"), F.col("total_alerts").cast("double"))
                    .alias("volume_deferred_pct"),
                    (F.col("total_alerts") / F.lit(float(n_days))).alias("alerts_per_day"))


def detection_measures(scored: DataFrame) -> DataFrame:
    """O-100/O-101 by tier: TP, FP, FPR, precision, precision at priority,
    recall against all positives (the tier filter does not shrink the
    denominator), lift and shares. Totals come from a window over the
    per-tier rows (one row per tier)."""
    g = scored.groupBy("tier").agg(F.count(F.lit(1)).alias("alerts"),
                                   F.sum("is_true_positive").cast("long").alias("true_positives"),
                                   count_if(F.col("priority") == "review").alias("_rev"),
                                   F.sum(F.when(F.col("priority") == "review", F.col("is_true_positive"))
                                         .otherwise(0)).cast("long").alias("_rev_tp"))
    w = Window.partitionBy()
    g = g.select("*", F.sum("alerts").over(w).alias("_n"), F.sum("true_positives").over(w).alias("_p"))
    d = lambda a, b: F.try_divide(a.cast("double"), b.cast("double"))
    prec_prio = d(F.col("_rev_tp"), F.col("_rev"))
    return g.select("tier", "alerts", "true_positives",
                    (F.col("alerts") - F.col("true_positives")).alias("false_positives"),
                    d(F.col("alerts") - F.col("true_positives"), F.col("alerts")).alias("false_positive_rate"),
                    d(F.col("true_positives"), F.col("alerts")).alias("precision"),
                    prec_prio.alias("precision_at_priority"),
                    d(F.col("true_positives"), F.col("_p")).alias("recall"),
                    F.try_divide(prec_prio, d(F.col("_p"), F.col("_n"))).alias("detection_lift"),
                    d(F.col("true_positives"), F.col("_p")).alias("share_of_true_positives"),
                    d(F.col("alerts"), F.col("_n")).alias("share_of_alert_volume"))


def capacity_measures(scored: DataFrame, n_days: int, cp: CostParams = CostParams()) -> DataFrame:
    """O-102: investigator hours and cost, hours and value released by deferral, annualised."""
    rate = round(cp.hourly_rate, 2)
    per = cp.minutes_per_alert_l1 / 60.0
    a = scored.agg(F.count(F.lit(1)).alias("total_alerts"), count_if(F.col("priority") == "deferred").alias("deferred"))
    hours = F.col("total_alerts") * per
    released = F.col("deferred") * per * cp.deferred_work_reduction
    return a.select(hours.alias("investigator_hours"), (hours * rate).alias("alert_handling_cost"),
                    released.alias("hours_released_by_deferral"), (released * rate).alias("value_released_by_deferral"),
                    (released * rate * 365.0 / float(n_days)).alias("annualised_value_released"))


def customer_measures(scored: DataFrame, customer_week: DataFrame, window_days: int = 30) -> DataFrame:
    """O-104..O-106 per customer: alerts before the customer's latest alert date,
    credit value of the weeks starting in the trailing ``window_days`` before the
    customer's latest week, cash share and high-risk exposure."""
    last = Window.partitionBy("customer_key")
    a = scored.select("customer_key", "date_key", F.max("date_key").over(last).alias("_last")) \
        .groupBy("customer_key").agg(count_if(F.col("date_key") < F.col("_last")).alias("prior_alerts_this_customer"))
    wk = customer_week.select("customer_key", F.to_date("week_start_date").alias("d"), "credit_value",
                              "cash_credit_value", "high_risk_value", "total_value",
                              F.max(F.to_date("week_start_date")).over(last).alias("_anchor"))
    in_win = F.col("d") > F.date_sub(F.col("_anchor"), window_days)
    zero = F.lit(0).cast("decimal(18,2)")
    c = wk.groupBy("customer_key").agg(
        F.sum(F.when(in_win, F.col("credit_value")).otherwise(zero)).alias("credit_value_30d"),
        F.try_divide(F.sum("cash_credit_value").cast("double"), F.sum("credit_value").cast("double")).alias("cash_share"),
        F.try_divide(F.sum("high_risk_value").cast("double"), F.sum("total_value").cast("double"))
        .alias("high_risk_exposure"))
    return a.join(c, "customer_key", "left")


def queue_listing(scored: DataFrame, dim_customer: DataFrame, dim_date: DataFrame,
                  date_from: int | None = None, date_to: int | None = None, tier: str | None = None,
                  rule_id: str | None = None, kyc: str | None = None, segment: str | None = None) -> DataFrame:
    """O-108: the investigator queue. Every alert that passes the slicers (date
    range, tier, rule, KYC rating, customer segment), highest score first; the
    whole queue, no row cap. The global sort is range-partitioned by Spark."""
    q = scored
    if date_from is not None:
        q = q.filter(F.col("date_key") >= date_from)
    if date_to is not None:
        q = q.filter(F.col("date_key") <= date_to)
    if tier:
        q = q.filter(F.col("tier") == tier)
    if rule_id:
        q = q.filter(F.col("rule_id") == rule_id)
    q = q.join(dim_customer.select("customer_key", "customer_segment", "kyc_risk_rating"), "customer_key", "left")
    if kyc:
        q = q.filter(F.col("kyc_risk_rating") == kyc)
    if segment:
        q = q.filter(F.col("customer_segment") == segment)
    # dim_date holds one row per calendar day: bounded, broadcast.
    q = q.join(F.broadcast(dim_date.select("date_key", "calendar_date")), "date_key", "left")
    return q.select("alert_id", "calendar_date", "customer_key", "customer_segment", "kyc_risk_rating", "rule_id",
                    "score", "tier", "priority").orderBy(F.col("score").desc(), F.col("alert_id"))


def queue_topk(scored: DataFrame, k: int, tier: str | None = None, rule_id: str | None = None) -> DataFrame:
    """O-83: the k highest-scoring alerts (the reference's top-k report)."""
    q = scored
    if tier:
        q = q.filter(F.col("tier") == tier)
    if rule_id:
        q = q.filter(F.col("rule_id") == rule_id)
    return q.orderBy(F.col("score").desc(), F.col("alert_id")).limit(k)


def month_tier(scored: DataFrame, dim_date: DataFrame) -> DataFrame:
    """O-109: alert counts by month x tier."""
    j = scored.join(F.broadcast(dim_date.select("date_key", "year", "month")), "date_key", "inner")
    return j.groupBy("year", "month").pivot("tier", list(TIERS)).agg(F.count(F.lit(1))).fillna(0)


def customer_trend(customer_week: DataFrame, alerts: DataFrame) -> DataFrame:
    """O-111: weekly series per alerted customer with the alert weeks flagged."""
    aw = alerts.select("customer_key", (F.col("date_key") / 7).cast("int").alias("week_index")).distinct() \
        .withColumn("has_alert", F.lit(1))
    return customer_week.join(aw, ["customer_key", "week_index"], "left").fillna({"has_alert": 0})


def rls_filter(mart: DataFrame, dim_customer: DataFrame, user_map: DataFrame, user: str) -> DataFrame:
    """O-112: rows of the customers in the caller's provinces (left semi joins)."""
    provinces = user_map.filter(F.col("user_name") == user).select(F.col("province").alias("home_province"))
    allowed = dim_customer.select("customer_key", "home_province").join(provinces, "home_province", "left_semi")
    return mart.join(allowed.select("customer_key"), "customer_key", "left_semi")
