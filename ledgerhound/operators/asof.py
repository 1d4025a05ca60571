"""As-of replay (O-116): the trailing features of every alert, computed again from the facts up to its date.

The replay shares nothing with the windows it checks: facts are long rows (customer, day, measure, value), alert days meet the
days before them in a range join over bins as long as the longest window, and a window is a condition in a sum. So a frame that looks
ahead, or forgets a day, differs for the alerts concerned, wherever they stand among their customer's alerts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..params import FeatureParams
from .features import NO_PRIOR_ALERT

#: Figures may differ by this part of themselves, and by this much.
TOLERANCE = 1e-9


def daily_measures(fact: DataFrame, dim_country: DataFrame, fp: FeatureParams = FeatureParams()) -> DataFrame:
    """(customer_key, day, measure, value): what each transaction adds to a measure of its day, summed; and the day's largest amount and counterparties."""
    t = fact.join(F.broadcast(dim_country.select(F.col("country_code").alias("counterparty_country"), "is_high_risk")), "counterparty_country")
    amount, one = F.col("amount_cad").cast("decimal(38,2)"), F.lit(1).cast("decimal(38,2)")
    is_ = lambda c, v: F.col(c) == v
    cash_in = is_("channel", "cash") & is_("direction", "credit")
    adds = [("n_txn", F.lit(True), one), ("vol_total", F.lit(True), amount), ("vol_credit", is_("direction", "credit"), amount),
            ("vol_debit", is_("direction", "debit"), amount), ("n_cash_credit", cash_in, one), ("vol_cash_credit", cash_in, amount),
            ("n_wire", is_("channel", "wire"), one), ("vol_wire", is_("channel", "wire"), amount), ("n_highrisk", is_("is_high_risk", 1), one),
            ("vol_highrisk", is_("is_high_risk", 1), amount), ("n_band_cash", cash_in & (amount >= fp.band_low) & (amount <= fp.band_high), one),
            ("n_round", (amount >= fp.round_min) & (amount % fp.round_unit == 0), one),
            ("n_offhours", (F.col("hour_of_day") < fp.offhours_start) | (F.col("hour_of_day") > fp.offhours_end), one)]
    rows = t.select("customer_key", F.col("date_key").alias("day"), F.explode(F.array(*[
        F.struct(F.lit(m).alias("measure"), F.when(cond, v).otherwise(F.lit(0).cast("decimal(38,2)")).alias("value")) for m, cond, v in adds])).alias("e"))
    summed = rows.groupBy("customer_key", "day", F.col("e.measure").alias("measure")).agg(F.sum("e.value").cast("double").alias("value"))
    largest = t.groupBy("customer_key", F.col("date_key").alias("day")).agg(F.max("amount_cad").cast("double").alias("value"))
    others = t.filter("counterparty_id IS NOT NULL").select("customer_key", F.col("date_key").alias("day"), "counterparty_id").distinct()
    parties = others.groupBy("customer_key", "day").agg(F.count(F.lit(1)).cast("double").alias("value"))
    active = largest.select("customer_key", "day", F.lit("active_days").alias("measure"), F.lit(1.0).alias("value"))
    return (summed.unionByName(largest.withColumn("measure", F.lit("max_amt"))).unionByName(parties.withColumn("measure", F.lit("n_counterparties")))
            .unionByName(active))


def replay(alerts: DataFrame, fact: DataFrame, dim_country: DataFrame, fp: FeatureParams = FeatureParams()) -> DataFrame:
    """(customer_key, date_key, feature, value): the trailing features and the alert context of every customer and day with an alert."""
    reach = max(*fp.windows, fp.active_window)
    days = alerts.select("customer_key", "date_key").distinct()
    bin_of = lambda c: F.floor(c / F.lit(float(reach))).cast("long")
    asked = days.withColumn("bin", F.explode(F.sequence(bin_of(F.col("date_key") - (reach - 1)), bin_of(F.col("date_key")))))
    known = daily_measures(fact, dim_country, fp).withColumn("bin", bin_of(F.col("day")))
    met = asked.join(known, ["customer_key", "bin"]).filter((F.col("day") <= F.col("date_key")) & (F.col("day") > F.col("date_key") - reach))
    within = lambda w: F.sum(F.when(F.col("day") > F.col("date_key") - w, F.col("value")).otherwise(0.0))
    windows = sorted({*fp.windows, fp.active_window})
    sums = met.groupBy("customer_key", "date_key", "measure").agg(*[within(w).alias(f"w{w}") for w in windows])
    long = sums.select("customer_key", "date_key", F.explode(F.array(*[
        F.struct(F.concat(F.col("measure"), F.lit(f"_{w}d")).alias("feature"), F.col(f"w{w}").alias("value")) for w in windows])).alias("e"))
    trailing = long.select("customer_key", "date_key", "e.feature", "e.value")
    # The alerts before each alert day, counted one by one.
    each = alerts.groupBy("customer_key", F.col("date_key").alias("day")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("rule_id").alias("rules"))
    before = F.col("day") < F.col("date_key")
    context = days.join(each, "customer_key").filter(F.col("day") <= F.col("date_key")).groupBy("customer_key", "date_key").agg(
        F.sum(F.when(before, F.col("n")).otherwise(0)).cast("double").alias("prior_alerts"),
        F.coalesce(F.min(F.when(before, F.col("date_key") - F.col("day"))), F.lit(NO_PRIOR_ALERT)).cast("double").alias("days_since_prior_alert"),
        F.max(F.when(~before, F.col("rules"))).cast("double").alias("n_rules_same_day"))
    names = ["prior_alerts", "days_since_prior_alert", "n_rules_same_day"]
    more = context.select("customer_key", "date_key", F.explode(F.array(*[F.struct(F.lit(n).alias("feature"), F.col(n).alias("value")) for n in names])).alias("e"))
    return trailing.unionByName(more.select("customer_key", "date_key", "e.feature", "e.value"))


def replayed_names(fp: FeatureParams = FeatureParams()) -> list[str]:
    from .features import rolling_names
    return rolling_names(fp.windows) + [f"active_days_{fp.active_window}d", "prior_alerts", "days_since_prior_alert", "n_rules_same_day"]


def replay_violations(frame: DataFrame, replayed: DataFrame, fp: FeatureParams = FeatureParams()) -> DataFrame:
    """(check_name, violations): how many alerts and figures were compared, and how many figures differ. ``frame`` has a row for each alert."""
    names = replayed_names(fp)
    own = frame.select("alert_id", "customer_key", "date_key", F.explode(F.array(*[
        F.struct(F.lit(n).alias("feature"), F.col(n).cast("double").alias("have")) for n in names])).alias("e"))
    both = own.select("alert_id", "customer_key", "date_key", "e.feature", "e.have").join(replayed, ["customer_key", "date_key", "feature"], "left")
    # A measure without any row in the window sums to zero in a frame, and has no row in the replay.
    want = F.coalesce(F.col("value"), F.lit(0.0))
    differs = ~F.coalesce(F.abs(F.col("have") - want) <= TOLERANCE * (1 + F.abs(want)), F.lit(False))
    got = both.agg(F.countDistinct("alert_id").alias("compared_alerts"), F.count(F.lit(1)).alias("compared_figures"),
                   F.sum(differs.cast("long")).alias("as_of_replay"))
    checks = ["compared_alerts", "compared_figures", "as_of_replay"]
    return got.select(F.explode(F.array(*[F.struct(F.lit(c).alias("check_name"), F.coalesce(F.col(c), F.lit(0)).alias("violations")) for c in checks])).alias("e")).select("e.*")
