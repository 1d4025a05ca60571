"""Point-in-time alert features (O-46..O-58).

Every feature of an alert dated D uses transactions and alerts on or before D.

Trailing windows run on the *sparse* customer-day table: every alert date has
a transaction of that customer (each rule dates its alert from a fact row), and
a RANGE frame over day numbers sums exactly the days a dense zero-filled grid
would, so the grid is never materialised for scoring. The three windows share
``partitionBy(customer_key).orderBy(date_key)``: one shuffle, one sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import count_if
from ..params import FeatureParams

MEASURES = ["n_txn", "vol_total", "vol_credit", "vol_debit", "n_cash_credit", "vol_cash_credit", "n_wire",
            "vol_wire", "n_highrisk", "vol_highrisk", "n_band_cash", "n_round", "n_offhours", "max_amt",
            "n_counterparties"]
RATIOS = ["vol_to_declared_30d", "vol_to_declared_90d", "cash_share_30d", "cash_share_90d", "highrisk_share_30d",
          "wire_share_30d", "offhours_share_30d", "round_share_30d", "band_share_30d", "retention_30d",
          "retention_90d", "velocity_ratio", "txn_velocity_ratio", "vol_per_counterparty_30d",
          "txn_per_active_day"]
CUSTOMER_FEATURES = ["customer_segment", "occupation_or_business_type", "is_cash_intensive_business",
                     "tenure_months", "tenure_band", "kyc_risk_rating", "is_pep", "declared_annual_income_cad",
                     "home_province", "onboarding_channel"]
CONTEXT_FEATURES = ["trigger_amount", "trigger_txn_count", "n_rules_same_day", "prior_alerts",
                    "days_since_prior_alert"]
# Columns never fed to a model, and the categorical inputs.
FEATURE_BLOCKLIST = ("alert_id", "customer_key", "date_key", "customer_id", "detail", "typology",
                     "campaign_start_day", "campaign_end_day", "is_true_positive", "monthly_declared")
CATEGORICAL = ("rule_id", "rule_family", "severity", "customer_segment", "occupation_or_business_type",
               "kyc_risk_rating", "home_province", "onboarding_channel", "tenure_band")
NO_PRIOR_ALERT = 999


def rolling_names(windows=(7, 30, 90)) -> list[str]:
    return [f"{m}_{w}d" for w in windows for m in MEASURES]


def customer_day(fact: DataFrame, dim_country: DataFrame, fp: FeatureParams = FeatureParams()) -> DataFrame:
    """O-46/O-47: one row per (customer, day) with 14 measures and distinct counterparties."""
    hr = dim_country.select(F.col("country_code").alias("counterparty_country"), "is_high_risk")
    # dim_country is bounded by the number of jurisdictions.
    t = fact.join(F.broadcast(hr), "counterparty_country", "inner")
    amt = F.col("amount_cad")
    credit = F.col("direction") == "credit"
    cash = F.col("channel") == "cash"
    wire = F.col("channel") == "wire"
    zero = F.lit(0).cast("decimal(18,2)")
    return t.groupBy("customer_key", "date_key").agg(
        F.count(F.lit(1)).alias("n_txn"),
        F.sum(amt).alias("vol_total"),
        F.sum(F.when(credit, amt).otherwise(zero)).alias("vol_credit"),
        F.sum(F.when(~credit, amt).otherwise(zero)).alias("vol_debit"),
        count_if(cash & credit).alias("n_cash_credit"),
        F.sum(F.when(cash & credit, amt).otherwise(zero)).alias("vol_cash_credit"),
        count_if(wire).alias("n_wire"),
        F.sum(F.when(wire, amt).otherwise(zero)).alias("vol_wire"),
        F.sum("is_high_risk").cast("long").alias("n_highrisk"),
        F.sum(F.when(F.col("is_high_risk") == 1, amt).otherwise(zero)).alias("vol_highrisk"),
        count_if(cash & credit & amt.between(fp.band_low, fp.band_high)).alias("n_band_cash"),
        count_if((amt % fp.round_unit == 0) & (amt >= fp.round_min)).alias("n_round"),
        count_if(~F.col("hour_of_day").between(fp.offhours_start, fp.offhours_end)).alias("n_offhours"),
        F.max(amt).alias("max_amt"),
        F.countDistinct("counterparty_id").alias("n_counterparties"))


def alert_span_days(daily: DataFrame, alerts: DataFrame, fp: FeatureParams = FeatureParams()) -> DataFrame:
    """Keep the customer-days any alert's trailing frame can reach: alerted
    customers only, from (first alert - longest frame + 1) to the last alert.
    Frames only look back, so the features at alert dates are unchanged; the
    windows then sort a fraction of the customer-days. The span table has one
    row per alerted customer, and the join's customer partitioning is the one
    the windows need, so it adds no exchange to the daily side."""
    reach = max(*fp.windows, fp.active_window) - 1
    span = alerts.groupBy("customer_key").agg(F.min("date_key").alias("_lo"), F.max("date_key").alias("_hi"))
    return (daily.join(span, "customer_key", "inner")
            .filter((F.col("date_key") >= F.col("_lo") - reach) & (F.col("date_key") <= F.col("_hi")))
            .drop("_lo", "_hi"))


def rolling_features(daily: DataFrame, fp: FeatureParams = FeatureParams()) -> DataFrame:
    """O-49/O-50: trailing SUM of every measure over 7/30/90 days (inclusive) and
    the number of active days in 90. Like the reference, ``max_amt_*d`` and
    ``n_counterparties_*d`` are sums of the daily values."""
    base = Window.partitionBy("customer_key").orderBy("date_key")
    cols = []
    for w in fp.windows:
        frame = base.rangeBetween(-(w - 1), Window.currentRow)
        cols += [F.sum(m).over(frame).alias(f"{m}_{w}d") for m in MEASURES]
    act = base.rangeBetween(-(fp.active_window - 1), Window.currentRow)
    cols.append(F.count(F.lit(1)).over(act).alias(f"active_days_{fp.active_window}d"))
    return daily.select("customer_key", "date_key", *cols)


def trailing_distinct(fact: DataFrame, dim_country: DataFrame, fp: FeatureParams = FeatureParams()) -> DataFrame:
    """O-47/O-49 over whole windows: per active (customer, day) the distinct counterparties and the largest
    transaction of the last 7/30/90 days (a day's counterparty isn't counted again on another day).

    A day of a counterparty stands for it from that day on until its next one or until it leaves the window, whichever
    comes first. So every counterparty-day adds one and takes it back later, and the count of a day is the running
    sum of these differences: no row is repeated for each window that it is in, and a window's size doesn't matter.
    """
    hr = dim_country.select(F.col("country_code").alias("counterparty_country"))
    t = fact.join(F.broadcast(hr), "counterparty_country", "inner")  # bounded by the number of jurisdictions
    days = t.groupBy("customer_key", "counterparty_id", "date_key").agg(F.max("amount_cad").alias("largest"))
    seen = days.withColumn("_next", F.lead("date_key").over(Window.partitionBy("customer_key", "counterparty_id").orderBy("date_key")))
    known = F.col("counterparty_id").isNotNull().cast("long")
    marks = [F.struct(F.col("date_key").alias("day"), F.col("largest").alias("largest"), *[known.alias(f"d{w}") for w in fp.windows])]
    for w in fp.windows:
        gone = F.least(F.coalesce("_next", F.col("date_key") + w), F.col("date_key") + w)
        marks.append(F.struct(gone.alias("day"), F.lit(None).cast("decimal(18,2)").alias("largest"),
                              *[(-known if v == w else F.lit(0).cast("long")).alias(f"d{v}") for v in fp.windows]))
    moves = seen.select("customer_key", F.explode(F.array(*marks)).alias("m")).select("customer_key", F.col("m.day").alias("date_key"), "m.*")
    daily = moves.groupBy("customer_key", "date_key").agg(F.max("largest").alias("largest"), *[F.sum(f"d{w}").alias(f"d{w}") for w in fp.windows])
    base = Window.partitionBy("customer_key").orderBy("date_key")
    run = base.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = daily.select("customer_key", "date_key", "largest", *[F.sum(f"d{w}").over(run).alias(f"distinct_counterparties_{w}d") for w in fp.windows],
                       *[F.max("largest").over(base.rangeBetween(-(w - 1), Window.currentRow)).alias(f"largest_txn_{w}d") for w in fp.windows])
    return out.filter(F.col("largest").isNotNull()).drop("largest")


def dense_grid(daily: DataFrame, n_days: int | None = None) -> DataFrame:
    """O-48: the zero-filled customer x day grid over days 0..n_days-1 for the
    customers present in ``daily``. Without ``n_days`` the horizon is the last
    active day (one small job reads it). Days are generated per customer with
    ``sequence`` + ``explode`` (no join of two relations); kept as an operator for
    users who need the zero days themselves."""
    if n_days is None:
        n_days = (daily.agg(F.max("date_key")).first()[0] or 0) + 1
    customers = daily.select("customer_key").distinct()
    grid = customers.select("customer_key", F.explode(F.sequence(F.lit(0), F.lit(n_days - 1))).alias("date_key"))
    g = grid.join(daily, ["customer_key", "date_key"], "left")
    fills = {m: 0 for m in MEASURES}
    return g.fillna(fills)


def alert_context(alerts: DataFrame) -> DataFrame:
    """O-51..O-53: per alert, distinct rules the same day, alerts strictly before
    the date, and days since the previous alert date (999 when none)."""
    # Rule ids come from the fixed catalogue, so the per-day set is bounded and
    # combines map-side (no second shuffle for a distinct aggregate).
    per_day = alerts.groupBy("customer_key", "date_key").agg(
        F.size(F.collect_set("rule_id")).cast("long").alias("n_rules_same_day"), F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("customer_key").orderBy("date_key")
    ctx = per_day.select(
        "customer_key", "date_key", "n_rules_same_day",
        F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long")
        .alias("prior_alerts"),
        F.coalesce(F.col("date_key") - F.lag("date_key").over(w), F.lit(NO_PRIOR_ALERT)).cast("int")
        .alias("days_since_prior_alert"))
    return alerts.join(ctx, ["customer_key", "date_key"], "left")


def account_summary(dim_account: DataFrame) -> DataFrame:
    """O-54: accounts per customer and the age of the newest one."""
    return dim_account.groupBy("customer_key").agg(F.count(F.lit(1)).alias("n_accounts"),
                                                   F.min("opened_days_ago").alias("newest_account_age"))


def add_ratios(df: DataFrame, eps: float = 1e-9) -> DataFrame:
    """O-56: the 15 ratio features, denominators + epsilon as in the reference."""
    c = {n: F.col(n).cast("double") for n in df.columns}
    m = F.col("declared_annual_income_cad") / 12.0
    e = F.lit(eps)
    exprs = {
        "vol_to_declared_30d": c["vol_credit_30d"] / (m + e),
        "vol_to_declared_90d": c["vol_credit_90d"] / (3 * m + e),
        "cash_share_30d": c["vol_cash_credit_30d"] / (c["vol_credit_30d"] + e),
        "cash_share_90d": c["vol_cash_credit_90d"] / (c["vol_credit_90d"] + e),
        "highrisk_share_30d": c["vol_highrisk_30d"] / (c["vol_total_30d"] + e),
        "wire_share_30d": c["vol_wire_30d"] / (c["vol_total_30d"] + e),
        "offhours_share_30d": c["n_offhours_30d"] / (c["n_txn_30d"] + e),
        "round_share_30d": c["n_round_30d"] / (c["n_txn_30d"] + e),
        "band_share_30d": c["n_band_cash_30d"] / (c["n_cash_credit_30d"] + e),
        "retention_30d": (c["vol_credit_30d"] - c["vol_debit_30d"]) / (c["vol_credit_30d"] + e),
        "retention_90d": (c["vol_credit_90d"] - c["vol_debit_90d"]) / (c["vol_credit_90d"] + e),
        "velocity_ratio": c["vol_credit_30d"] / (c["vol_credit_90d"] / 3 + e),
        "txn_velocity_ratio": c["n_txn_30d"] / (c["n_txn_90d"] / 3 + e),
        "vol_per_counterparty_30d": c["vol_total_30d"] / (c["n_counterparties_30d"] + e),
        "txn_per_active_day": c["n_txn_90d"] / (c["active_days_90d"] + e),
    }
    return df.select("*", *[v.alias(k) for k, v in exprs.items()])


def feature_frame(alerts: DataFrame, fact: DataFrame, dim_country: DataFrame, dim_customer: DataFrame,
                  dim_account: DataFrame, dim_rule: DataFrame, fp: FeatureParams = FeatureParams()) -> DataFrame:
    """O-55: alerts + context + trailing windows + customer + accounts + rule, then ratios."""
    daily = alert_span_days(customer_day(fact, dim_country, fp), alerts, fp)
    rolls = rolling_features(daily, fp)
    ctx = alert_context(alerts)
    df = ctx.join(rolls, ["customer_key", "date_key"], "left")
    df = df.join(dim_customer.select("customer_key", "customer_id", *CUSTOMER_FEATURES), "customer_key", "left")
    df = df.join(account_summary(dim_account), "customer_key", "left")
    # dim_rule has one row per rule.
    df = df.join(F.broadcast(dim_rule.select("rule_id", "rule_family", "severity")), "rule_id", "left")
    return add_ratios(df, fp.epsilon)


def campaigns(customers: DataFrame) -> DataFrame:
    """Ground-truth campaign windows for the fixture customers (stand-in for the
    reference's ground-truth file): customers with key % 4 = 0 run a 7-day
    campaign starting on day (key * 11) % 25."""
    c = customers.filter(F.col("customer_key") % 4 == 0)
    start = (F.col("customer_key") * 11 % 25).cast("int")
    return c.select("customer_key", F.lit("campaign").alias("typology"),
                    start.alias("campaign_start_day"), (start + 6).alias("campaign_end_day"))


#: Days of a label mask (a long holds their bits).
MASK_DAYS = 32


def label_alerts(alerts: DataFrame, campaign: DataFrame, grace: int = 7) -> DataFrame:
    """O-58: positive when the alert date is within [start - grace, end + grace] of any campaign of the customer.

    A customer can have many campaigns, which may overlap. The days that they cover are bits of one mask for each
    customer and stretch of ``MASK_DAYS`` days, combined map-side, so an alert meets one row at most and stays one row.
    """
    first, last = F.col("campaign_start_day").cast("long") - grace, F.col("campaign_end_day").cast("long") + grace
    spans = campaign.select(F.col("customer_key").alias("_customer"), first.alias("_first"), last.alias("_last")).filter("_first <= _last")
    stretch = lambda c: F.floor(c / F.lit(float(MASK_DAYS))).cast("long")
    parts = spans.withColumn("_stretch", F.explode(F.sequence(stretch(F.col("_first")), stretch(F.col("_last")))))
    start = F.col("_stretch") * MASK_DAYS
    low = F.greatest(F.col("_first") - start, F.lit(0)).cast("int")
    high = F.least(F.col("_last") - start, F.lit(MASK_DAYS - 1)).cast("int")
    upto = lambda c: F.call_function("shiftleft", F.lit(1).cast("long"), c)
    masks = parts.groupBy("_customer", "_stretch").agg(F.bit_or(upto(high + 1) - upto(low)).alias("_mask"))
    own = stretch(F.col("date_key"))
    j = alerts.join(masks, (F.col("customer_key") == F.col("_customer")) & (own == F.col("_stretch")), "left")
    bit = F.call_function("shiftright", F.col("_mask"), F.pmod(F.col("date_key"), F.lit(MASK_DAYS)).cast("int")).bitwiseAND(F.lit(1).cast("long"))
    return j.withColumn("is_true_positive", F.coalesce(bit, F.lit(0)).cast("int")).drop("_customer", "_stretch", "_mask")


def feature_matrix(frame: DataFrame) -> DataFrame:
    """O-57: model inputs (the frame minus the blocklist); NULL, NaN and both infinities -> 0.

    ``alert_id`` is kept as the row key; it is never a model input."""
    cols = [c for c in frame.columns if c not in FEATURE_BLOCKLIST]
    out = [F.col("alert_id")]
    for c in cols:
        if c in CATEGORICAL:
            out.append(F.col(c))
        else:
            v = F.col(c).cast("double")
            finite = v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
            out.append(F.when(finite, v).otherwise(F.lit(0.0)).alias(c))
    return frame.select(*out)
