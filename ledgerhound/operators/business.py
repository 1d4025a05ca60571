"""Business case: loaded rate, annualised volume, benefit/cost/payback, sensitivity (O-91..O-95).

Inputs are the trade-off curve (one row per recall target) and the tier
policy; every figure is a column expression over those rows.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..params import CostParams, SplitParams, replace

T1 = "T1_same_day"


def _trunc(c: Column) -> Column:
    """Python ``int()``: truncation toward zero."""
    return c.cast("long")


def policy_rows(tradeoff: DataFrame, tiers: DataFrame) -> DataFrame:
    """Trade-off rows with the tier-1 share of true positives attached.

    Both inputs are a handful of rows; the share is spread with a window over
    their union."""
    t1 = tiers.filter(F.col("tier") == T1).select(
        F.lit(None).cast("double").alias("recall_target"), F.lit(None).cast("double").alias("threshold"),
        F.lit(None).cast("double").alias("validation_recall"), F.lit(None).cast("double").alias("holdout_recall"),
        F.lit(None).cast("long").alias("holdout_alerts_reviewed"),
        F.lit(None).cast("double").alias("holdout_volume_deferred_pct"),
        F.lit(None).cast("double").alias("holdout_precision_in_review"),
        F.col("share_of_true_positives_pct").alias("t1_share_pct"))
    tr = tradeoff.select("*", F.lit(None).cast("double").alias("t1_share_pct"))
    u = tr.unionByName(t1)
    u = u.withColumn("t1_share_pct", F.max("t1_share_pct").over(Window.partitionBy()))
    return u.filter(F.col("recall_target").isNotNull())


def holdout_params(dates: DataFrame, split: SplitParams, cp: CostParams = CostParams()) -> CostParams:
    """``cp`` with the holdout's length: the days of the calendar after the validation window (one number is read)."""
    horizon = (dates.agg(F.max("date_key")).first()[0] or 0) + 1
    return replace(cp, holdout_window_days=max(1, horizon - split.valid_end_day))


def case_columns(minutes: Column, rate: Column, cp: CostParams) -> list[Column]:
    """O-92/O-93 over a policy row (needs the trade-off columns and t1_share_pct)."""
    window = float(cp.holdout_window_days)
    defer = F.col("holdout_volume_deferred_pct") / 100.0
    n_holdout = F.try_divide(F.col("holdout_alerts_reviewed").cast("double"),
                             1 - F.col("holdout_volume_deferred_pct") / 100.0)
    annual = n_holdout * (365.0 / window)
    hours_a = annual * defer * (minutes / 60.0) * cp.deferred_work_reduction
    benefit_a = hours_a * rate
    hours_b = (annual * cp.queue_position_gain * (minutes / 60.0) * (F.col("t1_share_pct") / 100.0)
               * cp.prioritisation_value_share)
    benefit_b = hours_b * rate
    gross = benefit_a + benefit_b
    build = cp.build_effort_person_days * cp.blended_day_rate_cad
    run = cp.annual_platform_cost_cad + cp.annual_model_governance_cost_cad
    net = gross - F.lit(run)
    payback = F.when(net > 0, F.lit(build) / (net / 12.0)).otherwise(F.lit(float("inf")))
    return [
        F.bround(rate, 2).alias("loaded_hourly_rate_cad"),
        minutes.alias("minutes_per_alert_l1"),
        _trunc(annual).alias("annual_alert_volume_est"),
        F.lit(cp.holdout_window_days).alias("holdout_window_days"),
        F.col("recall_target").alias("recall_policy"),
        F.bround(F.col("holdout_recall") * 100.0, 2).alias("holdout_recall_achieved_pct"),
        F.bround(defer * 100.0, 2).alias("deferred_share_pct"),
        _trunc(hours_a).alias("hours_freed_deferral"), _trunc(benefit_a).alias("value_deferral_cad"),
        _trunc(hours_b).alias("hours_freed_prioritisation"), _trunc(benefit_b).alias("value_prioritisation_cad"),
        _trunc(gross).alias("gross_annual_benefit_cad"),
        F.lit(int(build)).cast("long").alias("one_off_build_cad"),
        F.lit(int(run)).cast("long").alias("total_annual_run_cad"),
        _trunc(net).alias("net_annual_benefit_cad"),
        F.when(net > 0, F.bround(payback, 1)).otherwise(payback).alias("payback_months"),
        _trunc(net - F.lit(build)).alias("first_year_net_cad"),
    ]


def business_case(policies: DataFrame, cp: CostParams = CostParams(), recall_target: float = 1.0) -> DataFrame:
    """O-91..O-93: the case at one recall policy (default: full recall)."""
    row = policies.filter(F.col("recall_target") == F.lit(recall_target))
    return row.select(*case_columns(F.lit(cp.minutes_per_alert_l1), F.lit(cp.hourly_rate), cp))


def sensitivity_grid(spark: SparkSession, policies: DataFrame, cp: CostParams = CostParams()) -> DataFrame:
    """O-94: minutes x salary multiplier x recall policy (27 scenarios).

    The scenario grid is the parameter space itself (27 literal rows); it is
    equi-joined to the policy rows on the recall target."""
    grid = spark.createDataFrame(
        [(float(m), float(mult), label, float(t))
         for m, (mult, label), t in itertools.product(cp.sensitivity_minutes, cp.sensitivity_rates,
                                                      cp.sensitivity_targets)],
        "minutes double, rate_mult double, investigator_cost string, recall_target double")
    j = grid.join(F.broadcast(policies), "recall_target", "inner")
    rate = F.lit(cp.investigator_base_salary_cad) * F.col("rate_mult") * cp.loading_factor / cp.productive_hours_per_year
    c = case_columns(F.col("minutes"), rate, cp)
    out = j.select("minutes", "investigator_cost", "recall_target", *c)
    label = F.concat(F.round(F.col("recall_target") * 100.0, 0).cast("int").cast("string"), F.lit("%"))
    return out.select(F.col("minutes").cast("int").alias("minutes_per_alert"), "investigator_cost",
                      label.alias("recall_policy"), "holdout_recall_achieved_pct",
                      F.col("deferred_share_pct").alias("volume_deferred_pct"), "net_annual_benefit_cad",
                      "payback_months")


def sensitivity_pivot(grid: DataFrame, cp: CostParams = CostParams()) -> DataFrame:
    """O-95: net benefit with recall policies as columns."""
    labels = [f"{t * 100:.0f}%" for t in cp.sensitivity_targets]
    return grid.groupBy("minutes_per_alert", "investigator_cost").pivot("recall_policy", labels) \
        .agg(F.first("net_annual_benefit_cad"))
