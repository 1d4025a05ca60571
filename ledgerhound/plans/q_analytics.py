"""Queries: rule analytics and the business case (O-84..O-95, O-103)."""

from __future__ import annotations

from ..operators import business as bz
from ..operators import evaluate as ev
from ..operators import rule_analytics as ra
from ..params import FIXTURE_SPLIT, CostParams, EvalParams
from .catalog import register
from .oracle_ctes import cte, with_ctes
from .q_scoring import Evaluation

CP = CostParams()
EP = EvalParams()
RATE = CP.hourly_rate

cte("evt_detect", """
SELECT t.rule_id, COUNT(*) AS illicit_customers_detected,
       COUNT(*) FILTER (WHERE s.n_rules = 1) AS sole_detector_for
FROM (SELECT DISTINCT rule_id, customer_key FROM evt_labels WHERE is_true_positive = 1) t
JOIN (SELECT customer_key, COUNT(DISTINCT rule_id) AS n_rules FROM evt_labels WHERE is_true_positive = 1
      GROUP BY customer_key) s ON s.customer_key = t.customer_key
GROUP BY t.rule_id""", ("evt_labels",))

cte("evt_effect", f"""
SELECT *, CASE WHEN alerts = 0 THEN '{ra.REC_RETIRE}'
               WHEN sole_detector_for > 0 THEN 'RETAIN - sole detector for ' || CAST(sole_detector_for AS VARCHAR)
                    || ' illicit customer(s); cannot be retired at any precision'
               WHEN precision_pct < {ra.LOW_PRECISION_PCT} THEN '{ra.REC_RECAL}'
               ELSE '{ra.REC_RETAIN}' END AS recommendation
FROM (
  SELECT *, round_even(investigator_hours * {RATE!r} * {ra.ANNUALISE_FACTOR}, 0) AS annual_cost_cad
  FROM (
    SELECT r.rule_id, r.rule_name, r.severity,
           CAST(COALESCE(g.alerts, 0) AS BIGINT) AS alerts, CAST(COALESCE(g.tp, 0) AS BIGINT) AS true_positives,
           CAST(COALESCE(g.customers_alerted, 0) AS BIGINT) AS customers_alerted,
           CAST(COALESCE(d.illicit_customers_detected, 0) AS BIGINT) AS illicit_customers_detected,
           CAST(COALESCE(d.sole_detector_for, 0) AS BIGINT) AS sole_detector_for,
           CASE WHEN COALESCE(g.alerts, 0) > 0 THEN round_even(g.tp / CAST(g.alerts AS DOUBLE) * 100.0, 2) ELSE 0.0 END
             AS precision_pct,
           CAST(COALESCE(g.alerts, 0) - COALESCE(g.tp, 0) AS BIGINT) AS false_positives,
           round_even(COALESCE(g.alerts, 0) * {CP.minutes_per_alert_l1!r} / 60.0, 1) AS investigator_hours
    FROM dim_rule r
    LEFT JOIN (SELECT rule_id, COUNT(*) AS alerts, SUM(is_true_positive) AS tp,
                      COUNT(DISTINCT customer_key) AS customers_alerted
               FROM evt_labels GROUP BY rule_id) g ON g.rule_id = r.rule_id
    LEFT JOIN evt_detect d ON d.rule_id = r.rule_id))""", ("dim_rule", "evt_labels", "evt_detect"))


def _effectiveness(spark, sf):
    e = Evaluation(spark, sf)
    return ra.rule_effectiveness(e.labelled, e.dim_rule, CP)


@register("rule_effectiveness", with_ctes("SELECT * FROM evt_effect", "evt_effect"))
def q_rule_effectiveness(spark, sf):
    return _effectiveness(spark, sf)


@register("sole_detector", with_ctes(
    "SELECT rule_id, illicit_customers_detected, sole_detector_for FROM evt_effect", "evt_effect"))
def q_sole(spark, sf):
    return _effectiveness(spark, sf).select("rule_id", "illicit_customers_detected", "sole_detector_for")


@register("dead_rules", with_ctes("SELECT rule_id, rule_name FROM evt_effect WHERE alerts = 0", "evt_effect"))
def q_dead(spark, sf):
    return ra.dead_rules(_effectiveness(spark, sf))


cte("evt_overlap", """
SELECT a.rule_id AS rule_a, b.rule_id AS rule_b, a.n AS alerts_a, b.n AS alerts_b,
       CAST(COALESCE(i.k, 0) AS BIGINT) AS overlapping_events,
       round_even(COALESCE(i.k, 0) / CAST(a.n + b.n - COALESCE(i.k, 0) AS DOUBLE), 4) AS jaccard,
       round_even(COALESCE(i.k, 0) / CAST(a.n AS DOUBLE) * 100.0, 2) AS pct_of_a_covered_by_b,
       round_even(COALESCE(i.k, 0) / CAST(b.n AS DOUBLE) * 100.0, 2) AS pct_of_b_covered_by_a
FROM (SELECT rule_id, COUNT(*) AS n FROM (SELECT DISTINCT rule_id, customer_key, date_key FROM evt_alerts) GROUP BY rule_id) a
JOIN (SELECT rule_id, COUNT(*) AS n FROM (SELECT DISTINCT rule_id, customer_key, date_key FROM evt_alerts) GROUP BY rule_id) b
  ON a.rule_id < b.rule_id
LEFT JOIN (SELECT x.rule_id AS ra, y.rule_id AS rb, COUNT(*) AS k
           FROM (SELECT DISTINCT rule_id, customer_key, date_key FROM evt_alerts) x
           JOIN (SELECT DISTINCT rule_id, customer_key, date_key FROM evt_alerts) y
             ON x.customer_key = y.customer_key AND x.date_key = y.date_key AND x.rule_id < y.rule_id
           GROUP BY x.rule_id, y.rule_id) i ON i.ra = a.rule_id AND i.rb = b.rule_id""", ("evt_alerts",))


@register("rule_overlap", with_ctes("SELECT * FROM evt_overlap", "evt_overlap"))
def q_overlap(spark, sf):
    return ra.rule_overlap(Evaluation(spark, sf).alerts)


@register("top_overlap", with_ctes(
    "SELECT * FROM evt_overlap ORDER BY jaccard DESC, rule_a, rule_b LIMIT 5", "evt_overlap"))
def q_top_overlap(spark, sf):
    return ra.top_overlap(ra.rule_overlap(Evaluation(spark, sf).alerts), 5)


def _policies(spark, sf):
    e = Evaluation(spark, sf)
    tr = ev.tradeoff_curve(e.part("valid"), e.part("holdout"), EP.recall_targets)
    return bz.policy_rows(tr, ev.tier_policy(e.part("holdout"), EP))


def _costs(spark, sf):
    return bz.holdout_params(Evaluation(spark, sf).dim_date, FIXTURE_SPLIT, CP)


# Days of the ledger's calendar after the validation window.
_HOLDOUT_DAYS = f"(SELECT greatest(1, max(date_key) + 1 - {FIXTURE_SPLIT.valid_end_day}) FROM evt_date)"


cte("evt_policy", """
SELECT t.*, (SELECT share_of_true_positives_pct FROM evt_tiers WHERE tier = 'T1_same_day') AS t1_share_pct
FROM evt_tradeoff t""", ("evt_tradeoff", "evt_tiers", "evt_date"))


def _case_sql(minutes: str, rate: str, target: str = "recall_target") -> str:
    build = CP.build_effort_person_days * CP.blended_day_rate_cad
    run = CP.annual_platform_cost_cad + CP.annual_model_governance_cost_cad
    annual = f"(holdout_alerts_reviewed / NULLIF(1 - holdout_volume_deferred_pct / 100.0, 0) * (365.0 / {_HOLDOUT_DAYS}))"
    ha = f"({annual} * (holdout_volume_deferred_pct / 100.0) * ({minutes} / 60.0) * {CP.deferred_work_reduction!r})"
    hb = (f"({annual} * {CP.queue_position_gain!r} * ({minutes} / 60.0) * (t1_share_pct / 100.0) "
          f"* {CP.prioritisation_value_share!r})")
    gross = f"({ha} * {rate} + {hb} * {rate})"
    net = f"({gross} - {run!r})"
    return f"""round_even(CAST({rate} AS DOUBLE), 2) AS loaded_hourly_rate_cad,
       CAST({minutes} AS DOUBLE) AS minutes_per_alert_l1,
       CAST(trunc({annual}) AS BIGINT) AS annual_alert_volume_est, CAST({_HOLDOUT_DAYS} AS INTEGER) AS holdout_window_days,
       {target} AS recall_policy, round_even(holdout_recall * 100.0, 2) AS holdout_recall_achieved_pct,
       round_even(holdout_volume_deferred_pct / 100.0 * 100.0, 2) AS deferred_share_pct,
       CAST(trunc({ha}) AS BIGINT) AS hours_freed_deferral, CAST(trunc({ha} * {rate}) AS BIGINT) AS value_deferral_cad,
       CAST(trunc({hb}) AS BIGINT) AS hours_freed_prioritisation,
       CAST(trunc({hb} * {rate}) AS BIGINT) AS value_prioritisation_cad,
       CAST(trunc({gross}) AS BIGINT) AS gross_annual_benefit_cad,
       CAST({int(build)} AS BIGINT) AS one_off_build_cad, CAST({int(run)} AS BIGINT) AS total_annual_run_cad,
       CAST(trunc({net}) AS BIGINT) AS net_annual_benefit_cad,
       CASE WHEN {net} > 0 THEN round_even({build!r} / ({net} / 12.0), 1) ELSE 'inf'::DOUBLE END AS payback_months,
       CAST(trunc({net} - {build!r}) AS BIGINT) AS first_year_net_cad"""


@register("business_case", with_ctes(
    f"SELECT {_case_sql(repr(CP.minutes_per_alert_l1), repr(RATE))} FROM evt_policy WHERE recall_target = 1.0",
    "evt_policy"))
def q_business_case(spark, sf):
    return bz.business_case(_policies(spark, sf), _costs(spark, sf), 1.0)


_GRID_VALUES = ", ".join(f"({m!r}, {mult!r}, '{lab}', {t!r})" for m in CP.sensitivity_minutes
                         for mult, lab in CP.sensitivity_rates for t in CP.sensitivity_targets)
_RATE_SQL = f"(CAST({CP.investigator_base_salary_cad!r} AS DOUBLE) * rate_mult * {CP.loading_factor!r} / {CP.productive_hours_per_year!r})"
cte("evt_sensitivity", f"""
SELECT CAST(minutes AS INTEGER) AS minutes_per_alert, investigator_cost,
       CAST(CAST(round(recall_target * 100.0) AS INTEGER) AS VARCHAR) || '%' AS recall_policy,
       holdout_recall_achieved_pct, deferred_share_pct AS volume_deferred_pct, net_annual_benefit_cad, payback_months
FROM (SELECT g.minutes, g.investigator_cost, p.recall_target, {_case_sql("g.minutes", _RATE_SQL, "p.recall_target")}
      FROM (SELECT CAST(m AS DOUBLE) AS minutes, CAST(r AS DOUBLE) AS rate_mult, c AS investigator_cost,
                   CAST(t AS DOUBLE) AS recall_target
            FROM (VALUES {_GRID_VALUES}) AS v(m, r, c, t)) g
      JOIN evt_policy p ON p.recall_target = g.recall_target)""", ("evt_policy",))


def _grid(spark, sf):
    return bz.sensitivity_grid(spark, _policies(spark, sf), _costs(spark, sf))


@register("sensitivity_grid", with_ctes("SELECT * FROM evt_sensitivity", "evt_sensitivity"))
def q_sensitivity(spark, sf):
    return _grid(spark, sf)


_PIVOT = ", ".join(f"MAX(CASE WHEN recall_policy = '{t * 100:.0f}%' THEN net_annual_benefit_cad END) AS \"{t * 100:.0f}%\""
                   for t in CP.sensitivity_targets)


@register("sensitivity_pivot", with_ctes(
    f"SELECT minutes_per_alert, investigator_cost, {_PIVOT} FROM evt_sensitivity GROUP BY minutes_per_alert, investigator_cost",
    "evt_sensitivity"))
def q_pivot(spark, sf):
    return bz.sensitivity_pivot(_grid(spark, sf), CP)
