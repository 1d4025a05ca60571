"""Queries: split, thresholds, operating point, PR/ROC, trade-off, tiers, scored table (O-59, O-64..O-76).

The fixture's production score is deterministic integer arithmetic on the
alert key (identical in both engines), so every evaluation operator has an
oracle; the MLlib models are registered separately (rows-only checks).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import functions as F

from ..operators import evaluate as ev
from ..params import FIXTURE_SPLIT, EvalParams
from .catalog import register
from .oracle_ctes import cte, with_ctes
from .q_features import Scoring
from .store import stored

EP = EvalParams()
TR, VA = FIXTURE_SPLIT.train_end_day, FIXTURE_SPLIT.valid_end_day


def rule_number():
    return F.substring("rule_id", 2, 3).cast("int")


def fixture_score():
    """Deterministic stand-in for a model score in [0, 0.8)."""
    h = (F.col("customer_key") * 7919 + F.col("date_key") * 104729 + rule_number() * 1299709) % 10007
    return h / F.lit(10007.0) * F.lit(0.5) + F.lit(0.3) * F.col("is_true_positive")


def hash_score():
    """Deterministic 'random' baseline score (O-64)."""
    h = (F.col("customer_key") * 2654435761 + F.col("date_key") * 40503 + rule_number() * 9973) % 100003
    return h / F.lit(100003.0)


class Evaluation(Scoring):
    @cached_property
    def scored(self):
        lab = self.labelled
        return lab.select("alert_id", "rule_id", "customer_key", "date_key", "is_true_positive",
                          fixture_score().alias("score"), hash_score().alias("random_score"),
                          ev.split_column(F.col("date_key"), FIXTURE_SPLIT).alias("split"))

    def part(self, name):
        return self.scored.filter(F.col("split") == name)


cte("evt_scored", f"""
SELECT alert_id, rule_id, customer_key, date_key, is_true_positive,
       ((customer_key * 7919 + date_key * 104729 + CAST(substr(rule_id, 2, 3) AS INTEGER) * 1299709) % 10007)
         / CAST(10007.0 AS DOUBLE) * CAST(0.5 AS DOUBLE) + CAST(0.3 AS DOUBLE) * is_true_positive AS score,
       ((customer_key * 2654435761 + date_key * 40503 + CAST(substr(rule_id, 2, 3) AS INTEGER) * 9973) % 100003)
         / CAST(100003.0 AS DOUBLE) AS random_score,
       CASE WHEN date_key <= {TR} THEN 'train' WHEN date_key <= {VA} THEN 'valid' ELSE 'holdout' END AS split
FROM evt_labels""", ("evt_labels",))

cte("valid_thr", """
SELECT COALESCE(MIN(CASE WHEN is_true_positive = 1 THEN score END), 0.0) AS threshold
FROM evt_scored WHERE split = 'valid'""", ("evt_scored",))


def _eval_sql(score: str, thr_sql: str) -> str:
    return f"""
SELECT n_alerts, n_reviewed_at_priority, n_alerts - n_reviewed_at_priority AS n_deferred,
       CASE WHEN n_alerts > 0 THEN (n_alerts - n_reviewed_at_priority) / CAST(n_alerts AS DOUBLE) * 100.0 END
         AS volume_reduction_pct,
       CASE WHEN tp_total > 0 THEN tp_review / CAST(tp_total AS DOUBLE) END AS recall,
       COALESCE(tp_total, 0) AS true_positives_total, COALESCE(tp_total - tp_review, 0) AS true_positives_missed,
       CASE WHEN n_reviewed_at_priority > 0 THEN tp_review / CAST(n_reviewed_at_priority AS DOUBLE) ELSE 0.0 END
         AS precision_at_priority,
       CASE WHEN n_alerts > 0 THEN tp_total / CAST(n_alerts AS DOUBLE) ELSE 0.0 END AS baseline_precision
FROM (SELECT COUNT(*) AS n_alerts,
             CAST(SUM(CASE WHEN {score} >= ({thr_sql}) THEN 1 ELSE 0 END) AS BIGINT) AS n_reviewed_at_priority,
             CAST(SUM(is_true_positive) AS BIGINT) AS tp_total,
             CAST(SUM(CASE WHEN {score} >= ({thr_sql}) THEN is_true_positive ELSE 0 END) AS BIGINT) AS tp_review
      FROM evt_scored WHERE split = 'holdout')"""


@register("split", with_ctes("SELECT alert_id, split FROM evt_scored", "evt_scored"))
def q_split(spark, sf):
    return Evaluation(spark, sf).scored.select("alert_id", "split")


@register("threshold_full_recall", with_ctes("SELECT * FROM valid_thr", "valid_thr"))
def q_threshold(spark, sf):
    return ev.threshold_full_recall(Evaluation(spark, sf).part("valid"))


@register("evaluate_threshold", with_ctes(_eval_sql("score", "SELECT threshold FROM valid_thr"), "valid_thr"))
def q_evaluate(spark, sf):
    e = Evaluation(spark, sf)
    return ev.evaluate_at_threshold(e.part("holdout"), ev.threshold_value(e.part("valid")))


cte("random_thr", """
SELECT COALESCE(MIN(CASE WHEN is_true_positive = 1 THEN random_score END), 0.0) AS threshold
FROM evt_scored WHERE split = 'valid'""", ("evt_scored",))


@register("random_baseline", with_ctes(_eval_sql("random_score", "SELECT threshold FROM random_thr"), "random_thr"))
def q_random(spark, sf):
    e = Evaluation(spark, sf)
    return ev.evaluate_at_threshold(e.part("holdout"), ev.threshold_value(e.part("valid"), "random_score"),
                                    "random_score")


@register("all_alerts_baseline", with_ctes("""
SELECT 1.0::DOUBLE AS recall, 0.0::DOUBLE AS volume_reduction_pct, AVG(CAST(is_true_positive AS DOUBLE)) AS precision_at_priority
FROM evt_scored WHERE split = 'holdout'""", "evt_scored"))
def q_all_alerts(spark, sf):
    return ev.all_alerts_baseline(Evaluation(spark, sf).part("holdout"))


@register("model_selection", with_ctes(f"""
SELECT CASE WHEN a.recall >= 1.0 AND a.volume_reduction_pct > b.volume_reduction_pct THEN 'fixture' ELSE 'random' END
         AS selected,
       a.volume_reduction_pct AS fixture_deferred_pct, b.volume_reduction_pct AS random_deferred_pct
FROM ({_eval_sql("score", "SELECT threshold FROM valid_thr")}) a,
     ({_eval_sql("random_score", "SELECT threshold FROM random_thr")}) b""", "valid_thr", "random_thr"))
def q_model_selection(spark, sf):
    e = Evaluation(spark, sf)
    ho, va = e.part("holdout"), e.part("valid")
    a = ev.evaluate_at_threshold(ho, ev.threshold_value(va))
    b = ev.evaluate_at_threshold(ho, ev.threshold_value(va, "random_score"), "random_score")
    return ev.model_selection(a, b, "fixture", "random")


def _ap_sql(split: str) -> str:
    return f"""
SELECT ROUND(SUM(pos * (ge_p / CAST(ge_n AS DOUBLE))) / CAST(NULLIF(MAX(total_pos), 0) AS DOUBLE), 6) AS average_precision
FROM (SELECT score, SUM(is_true_positive) AS pos,
             SUM(COUNT(*)) OVER (ORDER BY score DESC) AS ge_n,
             SUM(SUM(is_true_positive)) OVER (ORDER BY score DESC) AS ge_p,
             SUM(SUM(is_true_positive)) OVER () AS total_pos
      FROM evt_scored WHERE split = '{split}' GROUP BY score)"""


@register("average_precision", with_ctes(_ap_sql("holdout"), "evt_scored"))
def q_ap(spark, sf):
    return ev.average_precision(Evaluation(spark, sf).part("holdout"))


@register("roc_auc", with_ctes("""
SELECT ROUND(CAST(SUM(pos * (2 * less_n + cnt + 1)) - MAX(total_pos) * (MAX(total_pos) + 1) AS DOUBLE)
             / CAST(NULLIF(2.0 * MAX(total_pos) * (MAX(total_n) - MAX(total_pos)), 0) AS DOUBLE), 6) AS roc_auc
FROM (SELECT score, COUNT(*) AS cnt, SUM(is_true_positive) AS pos,
             COALESCE(SUM(COUNT(*)) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS less_n,
             SUM(SUM(is_true_positive)) OVER () AS total_pos, SUM(COUNT(*)) OVER () AS total_n
      FROM evt_scored WHERE split = 'holdout' GROUP BY score)""", "evt_scored"))
def q_roc(spark, sf):
    return ev.roc_auc(Evaluation(spark, sf).part("holdout"))


_TARGETS = ", ".join(f"(CAST({t} AS DOUBLE))" for t in EP.recall_targets)


cte("evt_tradeoff", f"""
SELECT t.recall_target, t.threshold, t.validation_recall,
       h.tp / CAST(NULLIF(h.p, 0) AS DOUBLE) AS holdout_recall, h.rev AS holdout_alerts_reviewed,
       (h.n - h.rev) / CAST(NULLIF(h.n, 0) AS DOUBLE) * 100.0 AS holdout_volume_deferred_pct,
       CASE WHEN h.rev > 0 THEN h.tp / CAST(h.rev AS DOUBLE) ELSE 0.0 END AS holdout_precision_in_review
FROM (SELECT g.recall_target, MAX(v.score) AS threshold,
             MAX(CEIL(g.recall_target * v.total) / CAST(v.total AS DOUBLE)) AS validation_recall
      FROM (VALUES {_TARGETS}) AS g(recall_target)
      JOIN (SELECT score, ROW_NUMBER() OVER (ORDER BY score DESC) AS k, COUNT(*) OVER () AS total
            FROM evt_scored WHERE split = 'valid' AND is_true_positive = 1) v
        ON v.k = CEIL(g.recall_target * v.total)
      GROUP BY g.recall_target) t,
LATERAL (SELECT COUNT(*) AS n, SUM(is_true_positive) AS p,
                CAST(SUM(CASE WHEN score >= t.threshold THEN 1 ELSE 0 END) AS BIGINT) AS rev,
                CAST(SUM(CASE WHEN score >= t.threshold THEN is_true_positive ELSE 0 END) AS BIGINT) AS tp
         FROM evt_scored WHERE split = 'holdout') h""", ("evt_scored",))


@register("tradeoff_curve", with_ctes("SELECT * FROM evt_tradeoff", "evt_tradeoff"))
def q_tradeoff(spark, sf):
    e = Evaluation(spark, sf)
    return ev.tradeoff_curve(e.part("valid"), e.part("holdout"), EP.recall_targets)


cte("evt_tiers", f"""
SELECT tier, COUNT(*) AS alerts, COUNT(*) / CAST(MAX(n) AS DOUBLE) * 100.0 AS share_of_volume_pct,
       CAST(SUM(is_true_positive) AS BIGINT) AS true_positives,
       SUM(is_true_positive) / CAST(NULLIF(MAX(p), 0) AS DOUBLE) * 100.0 AS share_of_true_positives_pct,
       SUM(is_true_positive) / CAST(COUNT(*) AS DOUBLE) * 100.0 AS precision_pct
FROM (SELECT is_true_positive, n, p,
             CASE WHEN pos < floor(n * {EP.tier1_pct}) THEN 'T1_same_day'
                  WHEN pos < floor(n * {EP.tier2_pct}) THEN 'T2_five_day' ELSE 'T3_thirty_day' END AS tier
      FROM (SELECT is_true_positive, ROW_NUMBER() OVER (ORDER BY score DESC, alert_id) - 1 AS pos,
                   COUNT(*) OVER () AS n, SUM(is_true_positive) OVER () AS p
            FROM evt_scored WHERE split = 'holdout'))
GROUP BY tier""", ("evt_scored",))


@register("tier_policy", with_ctes("SELECT * FROM evt_tiers", "evt_tiers"))
def q_tier_policy(spark, sf):
    return ev.tier_policy(Evaluation(spark, sf).part("holdout"), EP)


cte("evt_pct", f"""
SELECT s.*, ROUND((less_n + (cnt + 1) / 2.0) / total_n, 4) AS score_percentile,
       CASE WHEN (total_n - less_n - cnt + (cnt + 1) / 2.0) / total_n <= {EP.tier1_pct} THEN 'T1_same_day'
            WHEN (total_n - less_n - cnt + (cnt + 1) / 2.0) / total_n <= {EP.tier2_pct} THEN 'T2_five_day'
            ELSE 'T3_thirty_day' END AS tier
FROM evt_scored s JOIN (
  SELECT score, COUNT(*) AS cnt,
         COALESCE(SUM(COUNT(*)) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS less_n,
         SUM(COUNT(*)) OVER () AS total_n
  FROM evt_scored GROUP BY score) r ON r.score = s.score""", ("evt_scored",))


@register("score_percentile", with_ctes("SELECT alert_id, score, score_percentile, tier FROM evt_pct", "evt_pct"))
def q_percentile(spark, sf):
    return ev.percentile_and_tier(Evaluation(spark, sf).scored, EP).select("alert_id", "score", "score_percentile",
                                                                            "tier")


SCORED_COLS = ["alert_id", "rule_id", "customer_key", "date_key", "score", "is_true_positive", "split",
               "priority", "score_percentile", "tier"]


cte("evt_scored_alerts", """
SELECT p.*, CASE WHEN p.score >= (SELECT threshold FROM valid_thr) THEN 'review' ELSE 'deferred' END AS priority
FROM evt_pct p""", ("evt_pct", "valid_thr"))


def scored_table(spark, sf):
    def build():
        e = Evaluation(spark, sf)
        return ev.scored_alerts(e.scored, ev.threshold_value(e.part("valid")), EP).select(*SCORED_COLS)
    return stored(spark, sf, "evt_scored_alerts", build, (Evaluation(spark, sf).rule_params, EP, FIXTURE_SPLIT))


@register("scored_alerts", with_ctes("SELECT " + ", ".join(SCORED_COLS) + " FROM evt_scored_alerts",
                                     "evt_scored_alerts"))
def q_scored(spark, sf):
    return scored_table(spark, sf)


_SEED, _DRAWS = 20260723, EP.bootstrap_iterations


def _uniform(cell: int) -> str:
    return f"(('0x' || substr(md5('{_SEED}|' || d || '|{cell}'), 1, 13))::BIGINT + 0.5) / 4503599627370496.0"


def _binomials(given: str, cell: int, c: str, rest: str) -> str:
    """``given`` (d, n, ...) with x{cell}, draws of Binomial(n, c / rest) by the inverse distribution, and n less these; its n are few numbers."""
    log_pmf = f"lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * ln({c} / ({rest})::DOUBLE) + (n - k) * ln(1 - {c} / ({rest})::DOUBLE)"
    return f"""
below{cell} AS (
  SELECT n, k, sum(exp({log_pmf})) OVER (PARTITION BY n ORDER BY k) AS p
  FROM (SELECT n, unnest(range(0, n + 1)) AS k FROM (SELECT DISTINCT n FROM {given})), cells WHERE {c} > 0 AND {c} < {rest}),
drawn{cell} AS (
  SELECT * REPLACE (n - x{cell} AS n) FROM (
    SELECT g.*, CASE WHEN {c} = 0 THEN 0 WHEN {c} = {rest} THEN n
                     ELSE coalesce((SELECT min(b.k) FROM below{cell} b WHERE b.n = g.n AND b.p >= {_uniform(cell)}), n) END AS x{cell}
    FROM {given} g, (SELECT c0, c1, c2, c3 FROM cells)))"""


cte("cells", """
SELECT count(*) FILTER (score >= threshold AND is_true_positive = 1) AS c0, count(*) FILTER (score < threshold AND is_true_positive = 1) AS c1,
       count(*) FILTER (score >= threshold AND is_true_positive = 0) AS c2, count(*) FILTER (score < threshold AND is_true_positive = 0) AS c3
FROM evt_scored, valid_thr WHERE split = 'holdout'""", ("evt_scored", "valid_thr"))
_LOW, _HIGH = (1 - EP.bootstrap_ci) / 2, (1 + EP.bootstrap_ci) / 2


@register("bootstrap_ci", with_ctes(f"""
SELECT count(*) AS draws, round(quantile_cont(r, {_LOW}), 9) AS recall_ci_low, round(quantile_cont(r, {_HIGH}), 9) AS recall_ci_high,
       round(quantile_cont(v, {_LOW}), 9) AS volume_reduction_ci_low, round(quantile_cont(v, {_HIGH}), 9) AS volume_reduction_ci_high
FROM (
  WITH draws AS (SELECT d, c0 + c1 + c2 + c3 AS n, c0 + c1 + c2 + c3 AS total FROM range({_DRAWS}) AS t(d), cells),
  {_binomials("draws", 0, "c0", "c0 + c1 + c2 + c3")},
  {_binomials("drawn0", 1, "c1", "c1 + c2 + c3")},
  {_binomials("drawn1", 2, "c2", "c2 + c3")}
  SELECT x0 / (x0 + x1)::DOUBLE AS r, (x1 + n) / total::DOUBLE * 100.0 AS v FROM drawn2 WHERE x0 + x1 > 0)""", "cells"))
def q_bootstrap(spark, sf):
    """O-74: every draw follows from its counters, so the oracle makes the same ones."""
    e = Evaluation(spark, sf)
    return ev.bootstrap_ci(spark, e.part("holdout"), ev.threshold_value(e.part("valid")), EP, _SEED)
