"""Rule effectiveness, sole detection, overlap and dead rules (O-84..O-90)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import count_if
from ..params import CostParams

# The reference's recommendation texts (effectiveness table) and
# the report's rule status texts.
REC_RETIRE = "RETIRE - has produced zero alerts; no detection value"
REC_RECAL = "RECALIBRATE - low precision and fully covered by other rules"
REC_RETAIN = "RETAIN - contributes detection at acceptable precision"
STATUS_RETIRE = "RETIRE - never fires"
STATUS_SOLE = "RETAIN - sole detector"
STATUS_RECAL = "RECALIBRATE - low precision, covered elsewhere"
STATUS_RETAIN = "RETAIN"
LOW_PRECISION_PCT = 3.0
ANNUALISE_FACTOR = 2  # 180-day period -> year, as in the effectiveness table


def detection_by_rule(labelled: DataFrame) -> DataFrame:
    """O-86: per rule, distinct true-positive customers and those no other rule detects.

    A customer is a sole detection of rule r when r is the only rule with a
    true-positive alert on that customer: one groupBy per customer, no set
    materialisation."""
    tp = labelled.filter(F.col("is_true_positive") == 1).select("rule_id", "customer_key").distinct()
    per_cust = tp.groupBy("customer_key").agg(F.count(F.lit(1)).alias("n_rules"), F.min("rule_id").alias("only"))
    sole = per_cust.filter(F.col("n_rules") == 1).groupBy(F.col("only").alias("rule_id")) \
        .agg(F.count(F.lit(1)).alias("sole_detector_for"))
    det = tp.groupBy("rule_id").agg(F.count(F.lit(1)).alias("illicit_customers_detected"))
    return det.join(sole, "rule_id", "left")


def rule_effectiveness(labelled: DataFrame, dim_rule: DataFrame, cp: CostParams = CostParams()) -> DataFrame:
    """O-85/O-87: alerts, TPs, precision, hours, cost and recommendation per rule;
    zero-alert rules are kept."""
    g = labelled.groupBy("rule_id").agg(F.count(F.lit(1)).alias("alerts"),
                                        F.sum("is_true_positive").cast("long").alias("true_positives"),
                                        F.countDistinct("customer_key").alias("customers_alerted"))
    d = detection_by_rule(labelled)
    # dim_rule holds one row per rule.
    e = (F.broadcast(dim_rule.select("rule_id", "rule_name", "severity"))
         .join(g, "rule_id", "left").join(d, "rule_id", "left"))
    z = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    e = e.select("rule_id", "rule_name", "severity", z("alerts").alias("alerts"),
                 z("true_positives").alias("true_positives"), z("customers_alerted").alias("customers_alerted"),
                 z("illicit_customers_detected").alias("illicit_customers_detected"),
                 z("sole_detector_for").alias("sole_detector_for"))
    prec = F.when(F.col("alerts") > 0, F.bround(F.col("true_positives") / F.col("alerts") * 100.0, 2)).otherwise(0.0)
    hours = F.bround(F.col("alerts") * cp.minutes_per_alert_l1 / 60.0, 1)
    e = e.select("*", prec.alias("precision_pct"),
                 (F.col("alerts") - F.col("true_positives")).alias("false_positives"),
                 hours.alias("investigator_hours"))
    e = e.withColumn("annual_cost_cad",
                     F.bround(F.col("investigator_hours") * cp.hourly_rate * ANNUALISE_FACTOR, 0))
    sole_txt = F.concat(F.lit("RETAIN - sole detector for "), F.col("sole_detector_for").cast("string"),
                        F.lit(" illicit customer(s); cannot be retired at any precision"))
    rec = (F.when(F.col("alerts") == 0, REC_RETIRE).when(F.col("sole_detector_for") > 0, sole_txt)
           .when(F.col("precision_pct") < LOW_PRECISION_PCT, REC_RECAL).otherwise(REC_RETAIN))
    return e.withColumn("recommendation", rec)


#: Rules of one word of a mask (a long without its sign and one spare bit).
WORD_BITS = 62


def rule_overlap(alerts: DataFrame, rule_ids: list[str] | None = None) -> DataFrame:
    """O-88: pairwise overlap of rules on distinct (customer, date) events.

    No self-join and no pair emission over the data: every (customer, date)
    gets one bit mask of the rules that fired on it (``bit_or`` of as many longs as the catalogue
    needs, combined map-side, so a hot customer collapses before the shuffle). Equal masks then
    collapse to one row with a count. A mask goes once to each of its rules, where one aggregate adds up, for every
    other rule, the counts of the masks that hold it too: a row for each rule, a column for each rule.
    Pairs of rules with alerts but no shared event are kept
    with zero overlap; rules without alerts are absent.

    ``rule_ids`` is the rule catalogue (default: the fixed one of ``rules``).
    """
    from .rules import RULE_CATALOGUE
    ids = sorted(set(rule_ids or [r[0] for r in RULE_CATALOGUE]))
    words = range(-(-len(ids) // WORD_BITS))
    place = F.element_at(F.create_map(*[x for i, r in enumerate(ids) for x in (F.lit(r), F.lit(i))]), F.col("rule_id"))
    one = F.lit(1).cast("long")
    bit = F.call_function("shiftleft", one, F.col("_place") % WORD_BITS)
    masks = (alerts.select("customer_key", "date_key", place.alias("_place")).filter(F.col("_place").isNotNull())
             .groupBy("customer_key", "date_key")
             .agg(*[F.bit_or(F.when(F.floor(F.col("_place") / WORD_BITS) == w, bit).otherwise(F.lit(0).cast("long"))).alias(f"_w{w}") for w in words]))
    combos = masks.groupBy(*[f"_w{w}" for w in words]).agg(F.count(F.lit(1)).alias("_n"))

    def held(i: int) -> Column:
        return F.col(f"_w{i // WORD_BITS}").bitwiseAND(F.lit(1 << (i % WORD_BITS)).cast("long")) != 0

    own = F.filter(F.array(*[F.when(held(i), F.lit(i)) for i in range(len(ids))]), lambda x: x.isNotNull())
    rows = combos.select(F.explode(own).alias("_i"), "_n", *[f"_w{w}" for w in words])
    shared = rows.groupBy("_i").agg(F.array(*[F.coalesce(F.sum(F.when(held(j), F.col("_n"))), F.lit(0)).cast("long") for j in range(len(ids))]).alias("_shared"))
    # One row for each rule: their sizes fit one small map.
    all_ = shared.agg(F.map_from_entries(F.collect_list(F.struct("_i", "_shared"))).alias("_by"))
    names = F.array(*[F.lit(r) for r in ids])
    first = all_.select("_by", F.explode(F.map_keys("_by")).alias("_a"))
    both = first.select("_by", "_a", F.explode(F.map_keys("_by")).alias("_b")).filter("_a < _b")
    of = lambda a, b: F.get(F.element_at("_by", F.col(a)), F.col(b))
    o = both.select(F.get(names, F.col("_a")).alias("rule_a"), F.get(names, F.col("_b")).alias("rule_b"), of("_a", "_a").alias("alerts_a"),
                    of("_b", "_b").alias("alerts_b"), of("_a", "_b").alias("overlapping_events"))
    i = F.col("overlapping_events")
    union = F.col("alerts_a") + F.col("alerts_b") - i
    return o.select("rule_a", "rule_b", "alerts_a", "alerts_b", i.alias("overlapping_events"),
                    F.bround(i / union.cast("double"), 4).alias("jaccard"),
                    F.bround(i / F.col("alerts_a").cast("double") * 100.0, 2).alias("pct_of_a_covered_by_b"),
                    F.bround(i / F.col("alerts_b").cast("double") * 100.0, 2).alias("pct_of_b_covered_by_a"))


def top_overlap(overlap: DataFrame, k: int = 5) -> DataFrame:
    """O-90: the k most overlapping pairs (a top-k report)."""
    return overlap.orderBy(F.col("jaccard").desc(), "rule_a", "rule_b").limit(k)


def dead_rules(effectiveness: DataFrame) -> DataFrame:
    """O-89: rules that produced no alerts."""
    return effectiveness.filter(F.col("alerts") == 0).select("rule_id", "rule_name")


def rule_measures(scored: DataFrame, dim_rule: DataFrame, n_days: int, cp: CostParams = CostParams()) -> DataFrame:
    """O-103: report rule measures: precision, annual cost on a 365/``n_days``
    basis (``n_days`` = distinct days in the date dimension), sole detection
    (TP customers of this rule EXCEPT those of the other rules) and status text."""
    g = scored.groupBy("rule_id").agg(F.count(F.lit(1)).alias("alerts"),
                                      F.sum("is_true_positive").cast("long").alias("tp"))
    d = detection_by_rule(scored).select("rule_id", "sole_detector_for")
    r = F.broadcast(dim_rule.select("rule_id")).join(g, "rule_id", "left").join(d, "rule_id", "left")
    alerts = F.coalesce(F.col("alerts"), F.lit(0))
    prec = F.try_divide(F.col("tp").cast("double"), alerts.cast("double"))
    cost = alerts * (cp.minutes_per_alert_l1 / 60.0) * round(cp.hourly_rate, 2)
    sole = F.coalesce(F.col("sole_detector_for"), F.lit(0)).cast("long")
    status = (F.when(alerts == 0, STATUS_RETIRE).when(sole > 0, STATUS_SOLE)
              .when(prec < LOW_PRECISION_PCT / 100.0, STATUS_RECAL).otherwise(STATUS_RETAIN))
    return r.select("rule_id", alerts.cast("long").alias("alerts"), prec.alias("rule_precision"),
                    (cost * 365.0 / float(n_days)).alias("rule_annual_cost"),
                    sole.alias("sole_detection_count"), status.alias("rule_status"))


__all__ = ["rule_effectiveness", "rule_overlap", "top_overlap", "dead_rules", "detection_by_rule",
           "rule_measures"]
