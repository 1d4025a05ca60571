"""Scoring evaluation: split, thresholds, operating point, curves, tiers (O-59, O-64..O-76).

Inputs are DataFrames with at least ``alert_id, date_key, is_true_positive`` and
a score column. Global orderings (percentiles, tiers, PR/ROC areas, recall
targets) use :mod:`ledgerhound.functions.ranking`, which never pulls all rows
into one task. Thresholds are model parameters: the few operators that need
one as a literal collect it (one number per recall target).
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import count_if
from ..functions.ranking import running_totals, value_ranks
from ..params import EvalParams, SplitParams

Y = "is_true_positive"
TIERS = ("T1_same_day", "T2_five_day", "T3_thirty_day")


def split_column(date_key: Column, sp: SplitParams) -> Column:
    """O-59: temporal split by alert date."""
    return (F.when(date_key <= sp.train_end_day, "train")
            .when(date_key <= sp.valid_end_day, "valid").otherwise("holdout"))


def threshold_full_recall(df: DataFrame, score: str = "score", required_recall: float = 1.0) -> DataFrame:
    """O-66: the highest threshold whose recall on ``df`` reaches
    ``required_recall`` (trap T-15: the configured required validation recall
    is the parameter). At 1.0, the default, it is the minimum score among
    positives; below 1.0 it is the score of the ceil(r * P)-th best positive,
    as in the trade-off curve. 0.0 when there are no positives."""
    if required_recall >= 1.0:
        return df.agg(F.coalesce(F.min(F.when(F.col(Y) == 1, F.col(score))), F.lit(0.0)).alias("threshold"))
    t = recall_thresholds(df, (required_recall,), score)
    return t.select(F.coalesce(F.col("threshold").cast("double"), F.lit(0.0)).alias("threshold"))


def threshold_value(df: DataFrame, score: str = "score",
                    required_recall: float = EvalParams.required_validation_recall) -> float:
    return float(threshold_full_recall(df, score, required_recall).first()[0])


def evaluate_at_threshold(df: DataFrame, thr: float | Column, score: str = "score") -> DataFrame:
    """O-67: one row of operating-point metrics for ``score >= thr``."""
    thr_c = thr if isinstance(thr, Column) else F.lit(float(thr))
    review = F.col(score) >= thr_c
    a = df.agg(F.count(F.lit(1)).alias("n_alerts"),
               count_if(review).alias("n_reviewed_at_priority"),
               F.sum(F.col(Y)).cast("long").alias("tp_total"),
               F.sum(F.when(review, F.col(Y)).otherwise(0)).cast("long").alias("tp_review"))
    n = F.col("n_alerts").cast("double")
    return a.select(
        "n_alerts", "n_reviewed_at_priority",
        (F.col("n_alerts") - F.col("n_reviewed_at_priority")).alias("n_deferred"),
        F.when(F.col("n_alerts") > 0, (F.col("n_alerts") - F.col("n_reviewed_at_priority")) / n * 100.0)
         .alias("volume_reduction_pct"),
        F.when(F.col("tp_total") > 0, F.col("tp_review") / F.col("tp_total").cast("double")).alias("recall"),
        F.coalesce(F.col("tp_total"), F.lit(0)).alias("true_positives_total"),
        F.coalesce(F.col("tp_total") - F.col("tp_review"), F.lit(0)).alias("true_positives_missed"),
        F.when(F.col("n_reviewed_at_priority") > 0,
               F.col("tp_review") / F.col("n_reviewed_at_priority").cast("double")).otherwise(0.0)
         .alias("precision_at_priority"),
        F.when(F.col("n_alerts") > 0, F.col("tp_total") / n).otherwise(0.0).alias("baseline_precision"))


def average_precision(df: DataFrame, score: str = "score") -> DataFrame:
    """O-68: step-wise average precision, sum over distinct thresholds of
    (recall gained) x (precision at that threshold); ties share a threshold."""
    r = value_ranks(df, score, Y)
    ge_n = F.col("total_n") - F.col("less_n")
    ge_p = F.col("total_pos") - F.col("less_pos")
    return r.agg(F.round(F.try_divide(F.sum(F.col("pos") * (ge_p / ge_n.cast("double"))),
                                      F.max("total_pos").cast("double")), 6)
                 .alias("average_precision"))


def roc_auc(df: DataFrame, score: str = "score") -> DataFrame:
    """O-68: ROC area with ties as the Mann-Whitney statistic on average ranks.
    The rank sum is kept in integers (twice the average rank) so it is exact."""
    r = value_ranks(df, score, Y)
    s2 = F.sum(F.col("pos") * (2 * F.col("less_n") + F.col("cnt") + 1))
    p = F.max("total_pos")
    neg = F.max("total_n") - p
    return r.agg(F.round(F.try_divide((s2 - p * (p + 1)).cast("double"), (2.0 * p * neg).cast("double")), 6)
                 .alias("roc_auc"))


def recall_thresholds(valid: DataFrame, targets: tuple[float, ...], score: str = "score") -> DataFrame:
    """Per recall target t: the score of the ceil(t * P)-th best validation positive."""
    pos = valid.filter(F.col(Y) == 1)
    r = value_ranks(pos, score)
    ge = F.col("total_n") - F.col("less_n")
    need = lambda t: F.ceil(F.lit(t) * F.col("total_n"))
    row = r.agg(*[F.max(F.when(ge >= need(t), F.col(score))).alias(f"t{i}") for i, t in enumerate(targets)],
                *[F.max(need(t) / F.col("total_n").cast("double")).alias(f"v{i}") for i, t in enumerate(targets)])
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(t).alias("recall_target"), F.col(f"t{i}").alias("threshold"),
                 F.col(f"v{i}").alias("validation_recall")) for i, t in enumerate(targets)])).alias("r")).select("r.*")


def tradeoff_curve(valid: DataFrame, holdout: DataFrame, targets: tuple[float, ...],
                   score: str = "score") -> DataFrame:
    """O-69: thresholds set on validation, applied blind to the holdout.
    Collects one threshold per target (``len(targets)`` numbers)."""
    th = recall_thresholds(valid, targets, score).collect()
    aggs = [F.count(F.lit(1)).alias("n"), F.sum(F.col(Y)).cast("long").alias("p")]
    for i, r in enumerate(th):
        rev = F.col(score) >= F.lit(r["threshold"])
        aggs += [count_if(rev).alias(f"rev{i}"), F.sum(F.when(rev, F.col(Y)).otherwise(0)).cast("long").alias(f"tp{i}")]
    a = holdout.agg(*aggs)
    rows = []
    for i, r in enumerate(th):
        rev, tp = F.col(f"rev{i}"), F.col(f"tp{i}")
        rows.append(F.struct(
            F.lit(r["recall_target"]).alias("recall_target"), F.lit(r["threshold"]).cast("double").alias("threshold"),
            F.lit(r["validation_recall"]).cast("double").alias("validation_recall"),
            F.try_divide(tp.cast("double"), F.col("p").cast("double")).alias("holdout_recall"),
            rev.alias("holdout_alerts_reviewed"),
            (F.try_divide((F.col("n") - rev).cast("double"), F.col("n").cast("double")) * 100.0)
            .alias("holdout_volume_deferred_pct"),
            F.when(rev > 0, tp / rev.cast("double")).otherwise(0.0).alias("holdout_precision_in_review")))
    return a.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def tier_policy(holdout: DataFrame, ep: EvalParams = EvalParams(), score: str = "score") -> DataFrame:
    """O-70: rank by score (ties by alert_id), cut at int(10 % n) and int(40 % n)."""
    keyed = holdout.select("alert_id", (-F.col(score)).alias("_neg"), F.col(Y))
    pos = running_totals(keyed, ["_neg", "alert_id"], {"n": F.lit(1), "p": F.col(Y)})
    c1 = F.floor(F.col("total_n") * ep.tier1_pct)
    c2 = F.floor(F.col("total_n") * ep.tier2_pct)
    tier = F.when(F.col("before_n") < c1, TIERS[0]).when(F.col("before_n") < c2, TIERS[1]).otherwise(TIERS[2])
    t = pos.select(tier.alias("tier"), F.col(Y), "total_n", "total_p")
    g = t.groupBy("tier").agg(F.count(F.lit(1)).alias("alerts"), F.sum(F.col(Y)).cast("long").alias("true_positives"),
                              F.max("total_n").alias("n"), F.max("total_p").alias("p"))
    return g.select("tier", "alerts",
                    (F.col("alerts") / F.col("n").cast("double") * 100.0).alias("share_of_volume_pct"),
                    "true_positives",
                    (F.try_divide(F.col("true_positives").cast("double"), F.col("p").cast("double")) * 100.0)
                    .alias("share_of_true_positives_pct"),
                    (F.col("true_positives") / F.col("alerts").cast("double") * 100.0).alias("precision_pct"))


def percentile_and_tier(scored: DataFrame, ep: EvalParams = EvalParams(), score: str = "score") -> DataFrame:
    """O-71/O-72: ascending average-rank percentile (4 dp) and the tier from the
    descending average-rank percentile, over all rows of ``scored``."""
    r = value_ranks(scored, score)
    n = F.col("total_n").cast("double")
    asc = F.col("less_n") + (F.col("cnt") + 1) / 2.0
    desc = (F.col("total_n") - F.col("less_n") - F.col("cnt")) + (F.col("cnt") + 1) / 2.0
    ranks = r.select(score, F.round(asc / n, 4).alias("score_percentile"),
                     F.when(desc / n <= ep.tier1_pct, TIERS[0]).when(desc / n <= ep.tier2_pct, TIERS[1])
                      .otherwise(TIERS[2]).alias("tier"))
    # One row per distinct score; AQE splits a skewed score on the large side.
    return scored.join(ranks, score, "inner")


def scored_alerts(scored: DataFrame, threshold: float, ep: EvalParams = EvalParams(),
                  score: str = "score") -> DataFrame:
    """O-73/O-76: scored alert table: priority, percentile and tier (joined by value, never by position)."""
    t = percentile_and_tier(scored, ep, score)
    return t.withColumn("priority", F.when(F.col(score) >= F.lit(threshold), "review").otherwise("deferred"))


def all_alerts_baseline(holdout: DataFrame) -> DataFrame:
    """O-65: every alert worked: recall 1, no deferral, precision = base rate."""
    return holdout.agg(F.lit(1.0).alias("recall"), F.lit(0.0).alias("volume_reduction_pct"),
                       F.avg(F.col(Y).cast("double")).alias("precision_at_priority"))


def model_selection(eval_a: DataFrame, eval_b: DataFrame, name_a: str, name_b: str) -> DataFrame:
    """O-75: choose ``name_a`` when its holdout recall is 1 and it defers more than
    ``name_b``; else ``name_b``. Both inputs are one-row evaluations."""
    both = (eval_a.select(F.lit("a").alias("_m"), "recall", "volume_reduction_pct")
            .unionByName(eval_b.select(F.lit("b").alias("_m"), "recall", "volume_reduction_pct")))
    j = both.agg(F.max(F.when(F.col("_m") == "a", F.col("recall"))).alias("a_recall"),
                 F.max(F.when(F.col("_m") == "a", F.col("volume_reduction_pct"))).alias("a_defer"),
                 F.max(F.when(F.col("_m") == "b", F.col("volume_reduction_pct"))).alias("b_defer"))
    pick = F.when((F.col("a_recall") >= 1.0) & (F.col("a_defer") > F.col("b_defer")), name_a).otherwise(name_b)
    return j.select(pick.alias("selected"), F.col("a_defer").alias(f"{name_a}_deferred_pct"),
                    F.col("b_defer").alias(f"{name_b}_deferred_pct"))


def uniform(seed: int, draw: int, cell: int) -> float:
    """A number from (0, 1) that depends on nothing but its counters: 52 bits of an MD5 digest."""
    return (int(hashlib.md5(f"{seed}|{draw}|{cell}".encode()).hexdigest()[:13], 16) + 0.5) / (1 << 52)


def binomial_quantile(n: int, p: float, u: float) -> int:
    """The least k with P(Binomial(n, p) <= k) >= u; probabilities beyond a dozen deviations from the mean are zero here."""
    if n <= 0 or p <= 0:
        return 0
    if p >= 1:
        return n
    reach = 12 * math.sqrt(n * p * (1 - p)) + 30
    low, high = max(0, int(n * p - reach)), min(n, int(n * p + reach))
    k = np.arange(low, high)
    odds = math.log(p) - math.log1p(-p)
    first = math.lgamma(n + 1) - math.lgamma(low + 1) - math.lgamma(n - low + 1) + low * math.log(p) + (n - low) * math.log1p(-p)
    below = np.cumsum(np.exp(first + np.r_[0.0, np.cumsum(np.log((n - k) / (k + 1)) + odds)]))
    return low + min(int(np.searchsorted(below, u, side="left")), high - low)


def bootstrap_ci(spark: SparkSession, holdout: DataFrame, threshold: float, ep: EvalParams = EvalParams(),
                 seed: int = 20260723, score: str = "score") -> DataFrame:
    """O-74: percentile bootstrap of recall and volume reduction.

    Both statistics depend only on the four (label, reviewed) cell counts, so
    the alerts are aggregated once in Spark and each of the B resamples is a
    multinomial draw over those cells, run on executors with
    ``mapInPandas`` over ``spark.range(B)`` (never B x n rows). A draw is a chain of conditional binomials by their
    inverse distributions, from uniforms that are digests of (seed, draw, cell): any engine that follows this gets the same draws.
    """
    review = F.col(score) >= F.lit(threshold)
    cells = holdout.agg(count_if(review & (F.col(Y) == 1)).alias("tp_r"),
                        count_if(~review & (F.col(Y) == 1)).alias("tp_d"),
                        count_if(review & (F.col(Y) == 0)).alias("fp_r"),
                        count_if(~review & (F.col(Y) == 0)).alias("fp_d")).first()
    counts = [int(cells[c] or 0) for c in ("tp_r", "tp_d", "fp_r", "fp_d")]

    def resample(draw: int) -> list[int]:
        out, left, rest = [], sum(counts), sum(counts)
        for cell, c in enumerate(counts[:-1]):
            got = binomial_quantile(left, c / rest if rest else 0.0, uniform(seed, draw, cell))
            out.append(got)
            left, rest = left - got, rest - c
        return [*out, left]

    def draw(batches):
        for b in batches:
            rec, vol = [], []
            for i in b["id"].tolist():
                tp_r, tp_d, fp_r, fp_d = resample(int(i))
                pos, n = tp_r + tp_d, tp_r + tp_d + fp_r + fp_d
                rec.append(tp_r / pos if pos else None)
                vol.append((tp_d + fp_d) / n * 100.0 if pos else None)
            yield pd.DataFrame({"draw_recall": rec, "draw_volume_reduction": vol}, dtype="float64")

    schema = T.StructType([T.StructField("draw_recall", T.DoubleType()),
                           T.StructField("draw_volume_reduction", T.DoubleType())])
    draws = spark.range(ep.bootstrap_iterations).mapInPandas(draw, schema).filter(F.col("draw_recall").isNotNull())
    lo, hi = (1 - ep.bootstrap_ci) / 2, (1 + ep.bootstrap_ci) / 2
    at = lambda c, q, name: F.round(F.percentile(c, q), 9).alias(name)
    return draws.agg(F.count(F.lit(1)).alias("draws"),
                     at("draw_recall", lo, "recall_ci_low"), at("draw_recall", hi, "recall_ci_high"),
                     at("draw_volume_reduction", lo, "volume_reduction_ci_low"), at("draw_volume_reduction", hi, "volume_reduction_ci_high"))
