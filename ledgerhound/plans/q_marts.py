"""Queries: marts, report measures and assertions (O-83, O-96..O-117)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from ..operators import asof as ao
from ..operators import assertions as asr
from ..operators import features as fe
from ..operators import marts as mt
from ..params import CostParams
from ..sources.tables import read_table
from .catalog import register
from .oracle_ctes import cte, with_ctes
from .q_features import FP
from .q_scoring import SCORED_COLS, Evaluation, scored_table
from .warehouse import Warehouse

CP = CostParams()
TOP_K = 5
RLS_USER = "analyst_america"


def _n_days(e) -> int:
    """Distinct days of the date dimension (the DAX filter-context day count)."""
    return e.dim_date.select("date_key").distinct().count()


cte("alert_days", "SELECT date_key, strftime(calendar_date, '%Y-%m-%d') AS calendar_date FROM evt_date", ("evt_date",))
cte("alert_scores", "SELECT alert_id, score, score_percentile, tier, priority, split, is_true_positive FROM evt_scored_alerts",
    ("evt_scored_alerts",))


@register("mart_alert", with_ctes("""
SELECT alert_id, rule_id, customer_key, date_key, calendar_date, trigger_amount, trigger_txn_count, detail,
       score, score_percentile, tier, priority, split, is_true_positive
FROM (evt_alerts NATURAL JOIN alert_days) LEFT JOIN alert_scores USING (alert_id)""", "evt_alerts", "alert_days", "alert_scores"))
def q_mart_alert(spark, sf):
    e = Evaluation(spark, sf)
    return mt.mart_alert(e.alerts, e.dim_date, scored_table(spark, sf))


# Weeks add up from days: one row a customer and day with its total for each kind of value, in long form.
cte("evt_day_values", """
SELECT customer_key, date_key, amount_cad, [x for x in [
         'total_value',
         if(direction = 'credit', 'credit_value', 'debit_value'),
         if(direction = 'credit' AND channel = 'cash', 'cash_credit_value', NULL),
         if(counterparty_country IN (SELECT country_code FROM dim_country WHERE is_high_risk = 1), 'high_risk_value', NULL)]
       if x IS NOT NULL] AS kinds, counterparty_id
FROM evt WHERE counterparty_country IN (SELECT country_code FROM dim_country)
  AND date_key IN (SELECT date_key FROM evt_date) AND customer_key IN (SELECT customer_key FROM evt_alerts)""",
    ("evt", "dim_country", "evt_date", "evt_alerts"))
cte("evt_week", """
WITH sums AS (
  SELECT customer_key, date_key // 7 AS week, kind, sum(amount_cad) AS amount
  FROM (SELECT customer_key, date_key, amount_cad, unnest(kinds) AS kind FROM evt_day_values) GROUP BY ALL),
wide AS (
  SELECT customer_key, week, map_from_entries(list((kind, amount))) AS by_kind FROM sums GROUP BY ALL),
counts AS (
  SELECT customer_key, date_key // 7 AS week, min(date_key) AS first_day, count(*) AS n_txn, count(DISTINCT counterparty_id) AS parties
  FROM evt_day_values GROUP BY ALL)
SELECT customer_key, CAST(week AS INTEGER) AS week_index, calendar_date AS week_start_date, n_txn,
       coalesce(by_kind['total_value'], 0) AS total_value, coalesce(by_kind['credit_value'], 0) AS credit_value,
       coalesce(by_kind['debit_value'], 0) AS debit_value, coalesce(by_kind['cash_credit_value'], 0) AS cash_credit_value,
       coalesce(by_kind['high_risk_value'], 0) AS high_risk_value, parties AS distinct_counterparties
FROM counts JOIN wide USING (customer_key, week) JOIN evt_date ON evt_date.date_key = first_day""", ("evt_day_values", "evt_date"))

_WEEK_OUT = """customer_key, week_index, strftime(week_start_date, '%Y-%m-%d') AS week_start_date, n_txn,
       CAST(total_value AS DOUBLE) AS total_value, CAST(credit_value AS DOUBLE) AS credit_value,
       CAST(debit_value AS DOUBLE) AS debit_value, CAST(cash_credit_value AS DOUBLE) AS cash_credit_value,
       CAST(high_risk_value AS DOUBLE) AS high_risk_value, distinct_counterparties"""


def _week(e):
    return mt.mart_customer_week(e.fact, e.dim_date, e.dim_country, e.alerts)


@register("mart_customer_week", with_ctes(f"SELECT {_WEEK_OUT} FROM evt_week", "evt_week"))
def q_mart_week(spark, sf):
    return _week(Evaluation(spark, sf))


cte("urgent", "SELECT customer_key FROM evt_scored_alerts GROUP BY customer_key HAVING bool_or(tier = 'T1_same_day')",
    ("evt_scored_alerts",))
cte("risk", "SELECT country_code AS counterparty_country, is_high_risk FROM dim_country", ("dim_country",))


@register("mart_txn_drill", with_ctes("""
SELECT txn_id, customer_key, date_key, strftime(DATE '2024-01-01' + date_key, '%Y-%m-%d') AS calendar_date,
       CAST(amount_cad AS DOUBLE) AS amount_cad, direction, channel, counterparty_country, counterparty_id, hour_of_day, is_high_risk
FROM evt SEMI JOIN urgent USING (customer_key) JOIN risk USING (counterparty_country)""",
                                        "evt", "urgent", "risk"))
def q_mart_drill(spark, sf):
    e = Evaluation(spark, sf)
    return mt.mart_txn_drill(e.fact, e.dim_date, e.dim_country, scored_table(spark, sf))


_NDAYS = "(SELECT COUNT(DISTINCT date_key) FROM evt_date)"


@register("measures_volume", with_ctes(f"""
SELECT COUNT(*) AS total_alerts,
       CAST(SUM(CASE WHEN tier = 'T1_same_day' THEN 1 ELSE 0 END) AS BIGINT) AS tier1_alerts,
       CAST(SUM(CASE WHEN priority = 'deferred' THEN 1 ELSE 0 END) AS BIGINT) AS deferred_alerts,
       SUM(CASE WHEN priority = 'deferred' THEN 1 ELSE 0 END) / CAST(COUNT(*) AS DOUBLE) AS volume_deferred_pct,
       COUNT(*) / CAST({_NDAYS} AS DOUBLE) AS alerts_per_day
FROM evt_scored_alerts""", "evt_scored_alerts", "evt_date"))
def q_measures_volume(spark, sf):
    e = Evaluation(spark, sf)
    return mt.volume_measures(scored_table(spark, sf), _n_days(e))


@register("measures_detection", with_ctes("""
SELECT tier, alerts, true_positives, alerts - true_positives AS false_positives,
       (alerts - true_positives) / CAST(alerts AS DOUBLE) AS false_positive_rate,
       true_positives / CAST(alerts AS DOUBLE) AS precision,
       CASE WHEN rev > 0 THEN rev_tp / CAST(rev AS DOUBLE) END AS precision_at_priority,
       CASE WHEN p > 0 THEN true_positives / CAST(p AS DOUBLE) END AS recall,
       CASE WHEN rev > 0 AND p > 0 THEN (rev_tp / CAST(rev AS DOUBLE)) / (p / CAST(n AS DOUBLE)) END AS detection_lift,
       CASE WHEN p > 0 THEN true_positives / CAST(p AS DOUBLE) END AS share_of_true_positives,
       alerts / CAST(n AS DOUBLE) AS share_of_alert_volume
FROM (SELECT tier, COUNT(*) AS alerts, CAST(SUM(is_true_positive) AS BIGINT) AS true_positives,
             SUM(CASE WHEN priority = 'review' THEN 1 ELSE 0 END) AS rev,
             SUM(CASE WHEN priority = 'review' THEN is_true_positive ELSE 0 END) AS rev_tp,
             SUM(COUNT(*)) OVER () AS n, SUM(SUM(is_true_positive)) OVER () AS p
      FROM evt_scored_alerts GROUP BY tier)""", "evt_scored_alerts"))
def q_measures_detection(spark, sf):
    return mt.detection_measures(scored_table(spark, sf))


_PER = CP.minutes_per_alert_l1 / 60.0
_RATE = round(CP.hourly_rate, 2)
_D = lambda v: f"CAST({v!r} AS DOUBLE)"


@register("measures_capacity", with_ctes(f"""
SELECT total * {_D(_PER)} AS investigator_hours, total * {_D(_PER)} * {_D(_RATE)} AS alert_handling_cost,
       deferred * {_D(_PER)} * {_D(CP.deferred_work_reduction)} AS hours_released_by_deferral,
       deferred * {_D(_PER)} * {_D(CP.deferred_work_reduction)} * {_D(_RATE)} AS value_released_by_deferral,
       deferred * {_D(_PER)} * {_D(CP.deferred_work_reduction)} * {_D(_RATE)} * 365.0 / CAST({_NDAYS} AS DOUBLE)
         AS annualised_value_released
FROM (SELECT COUNT(*) AS total, SUM(CASE WHEN priority = 'deferred' THEN 1 ELSE 0 END) AS deferred
      FROM evt_scored_alerts)""", "evt_scored_alerts", "evt_date"))
def q_measures_capacity(spark, sf):
    e = Evaluation(spark, sf)
    return mt.capacity_measures(scored_table(spark, sf), _n_days(e), CP)


@register("measures_rule", with_ctes(f"""
SELECT r.rule_id, CAST(COALESCE(g.alerts, 0) AS BIGINT) AS alerts,
       g.tp / CAST(g.alerts AS DOUBLE) AS rule_precision,
       COALESCE(g.alerts, 0) * {_D(_PER)} * {_D(_RATE)} * 365.0 / CAST({_NDAYS} AS DOUBLE) AS rule_annual_cost,
       CAST(COALESCE(d.sole_detector_for, 0) AS BIGINT) AS sole_detection_count,
       CASE WHEN COALESCE(g.alerts, 0) = 0 THEN 'RETIRE - never fires'
            WHEN COALESCE(d.sole_detector_for, 0) > 0 THEN 'RETAIN - sole detector'
            WHEN g.tp / CAST(g.alerts AS DOUBLE) < 0.03 THEN 'RECALIBRATE - low precision, covered elsewhere'
            ELSE 'RETAIN' END AS rule_status
FROM dim_rule r
LEFT JOIN (SELECT rule_id, COUNT(*) AS alerts, SUM(is_true_positive) AS tp FROM evt_scored_alerts GROUP BY rule_id) g
  ON g.rule_id = r.rule_id
LEFT JOIN (SELECT t.rule_id, COUNT(*) AS sole_detector_for
           FROM (SELECT DISTINCT rule_id, customer_key FROM evt_scored_alerts WHERE is_true_positive = 1) t
           JOIN (SELECT customer_key FROM evt_scored_alerts WHERE is_true_positive = 1
                 GROUP BY customer_key HAVING COUNT(DISTINCT rule_id) = 1) s ON s.customer_key = t.customer_key
           GROUP BY t.rule_id) d ON d.rule_id = r.rule_id""", "dim_rule", "evt_scored_alerts", "evt_date"))
def q_measures_rule(spark, sf):
    from ..operators import rule_analytics as ra
    e = Evaluation(spark, sf)
    return ra.rule_measures(scored_table(spark, sf), e.dim_rule, _n_days(e), CP)


@register("measures_customer", with_ctes("""
SELECT a.customer_key, a.prior_alerts_this_customer, c.credit_value_30d, c.cash_share, c.high_risk_exposure
FROM (SELECT customer_key, CAST(SUM(CASE WHEN date_key < mx THEN 1 ELSE 0 END) AS BIGINT) AS prior_alerts_this_customer
      FROM (SELECT customer_key, date_key, MAX(date_key) OVER (PARTITION BY customer_key) AS mx FROM evt_scored_alerts)
      GROUP BY customer_key) a
LEFT JOIN (
  SELECT customer_key,
         CAST(SUM(CASE WHEN week_start_date > anchor - INTERVAL 30 DAY THEN credit_value ELSE 0 END) AS DOUBLE)
           AS credit_value_30d,
         CASE WHEN SUM(credit_value) <> 0 THEN CAST(SUM(cash_credit_value) AS DOUBLE) / CAST(SUM(credit_value) AS DOUBLE) END
           AS cash_share,
         CASE WHEN SUM(total_value) <> 0 THEN CAST(SUM(high_risk_value) AS DOUBLE) / CAST(SUM(total_value) AS DOUBLE) END
           AS high_risk_exposure
  FROM (SELECT *, MAX(week_start_date) OVER (PARTITION BY customer_key) AS anchor FROM evt_week)
  GROUP BY customer_key) c ON c.customer_key = a.customer_key""", "evt_scored_alerts", "evt_week"))
def q_measures_customer(spark, sf):
    e = Evaluation(spark, sf)
    return mt.customer_measures(scored_table(spark, sf), _week(e))


@register("queue_topk", with_ctes(
    "SELECT " + ", ".join(SCORED_COLS) + f" FROM evt_scored_alerts ORDER BY score DESC, alert_id LIMIT {TOP_K}",
    "evt_scored_alerts"))
def q_queue_topk(spark, sf):
    return mt.queue_topk(scored_table(spark, sf), TOP_K)


_QUEUE_SQL = """
SELECT s.alert_id, strftime(d.calendar_date, '%Y-%m-%d') AS calendar_date, s.customer_key, c.customer_segment,
       c.kyc_risk_rating, s.rule_id, s.score, s.tier, s.priority
FROM evt_scored_alerts s
LEFT JOIN evt_customer c ON c.customer_key = s.customer_key
LEFT JOIN evt_date d ON d.date_key = s.date_key
WHERE {where}
ORDER BY s.score DESC, s.alert_id"""


def _queue(spark, sf, **slicers):
    e = Evaluation(spark, sf)
    return mt.queue_listing(scored_table(spark, sf), e.dim_customer, e.dim_date, **slicers)


@register("queue_all", with_ctes(_QUEUE_SQL.format(where="true"), "evt_scored_alerts", "evt_customer", "evt_date"))
def q_queue_all(spark, sf):
    """O-108 without a slicer: every alert, highest score first."""
    return _queue(spark, sf)


@register("queue_tier1_r004", with_ctes(
    _QUEUE_SQL.format(where="s.tier = 'T1_same_day' AND s.rule_id = 'R004'"),
    "evt_scored_alerts", "evt_customer", "evt_date"))
def q_queue_filtered(spark, sf):
    """O-108 with the tier and rule slicers set: the whole tier-1 R004 queue."""
    return _queue(spark, sf, tier="T1_same_day", rule_id="R004")


@register("queue_listing", with_ctes(
    _QUEUE_SQL.format(where="s.date_key BETWEEN 5 AND 25 AND c.kyc_risk_rating = 'low' "
                            "AND c.customer_segment = 'personal'"),
    "evt_scored_alerts", "evt_customer", "evt_date"))
def q_queue_listing(spark, sf):
    """O-108 with the date-range, KYC and segment slicers set."""
    return _queue(spark, sf, date_from=5, date_to=25, kyc="low", segment="personal")


@register("month_tier", with_ctes("""
SELECT d.year, d.month,
       COUNT(*) FILTER (WHERE s.tier = 'T1_same_day') AS T1_same_day,
       COUNT(*) FILTER (WHERE s.tier = 'T2_five_day') AS T2_five_day,
       COUNT(*) FILTER (WHERE s.tier = 'T3_thirty_day') AS T3_thirty_day
FROM evt_scored_alerts s JOIN evt_date d ON d.date_key = s.date_key GROUP BY d.year, d.month""",
                                  "evt_scored_alerts", "evt_date"))
def q_month_tier(spark, sf):
    e = Evaluation(spark, sf)
    return mt.month_tier(scored_table(spark, sf), e.dim_date)


@register("customer_trend", with_ctes(f"""
SELECT {_WEEK_OUT}, CASE WHEN EXISTS (SELECT 1 FROM evt_alerts a WHERE a.customer_key = w.customer_key
                                      AND a.date_key // 7 = w.week_index) THEN 1 ELSE 0 END AS has_alert
FROM evt_week w""", "evt_week", "evt_alerts"))
def q_customer_trend(spark, sf):
    e = Evaluation(spark, sf)
    return mt.customer_trend(_week(e), e.alerts)


def user_map(spark, sf):
    """Caller -> province mapping derived from the region table."""
    r = read_table(spark, sf, "region", ["r_name"])
    return r.select(F.concat(F.lit("analyst_"), F.lower(F.regexp_replace("r_name", " ", "_"))).alias("user_name"),
                    F.col("r_name").alias("province"))


@register("rls_filter", with_ctes(f"""
SELECT {", ".join("s." + c for c in SCORED_COLS)} FROM evt_scored_alerts s
WHERE s.customer_key IN (SELECT c.customer_key FROM evt_customer c
                         WHERE c.home_province IN (SELECT r_name FROM region
                                                   WHERE 'analyst_' || lower(replace(r_name, ' ', '_')) = '{RLS_USER}'))""",
                                  "evt_scored_alerts", "evt_customer"))
def q_rls(spark, sf):
    e = Evaluation(spark, sf)
    s = scored_table(spark, sf)
    return mt.rls_filter(s, e.dim_customer, user_map(spark, sf), RLS_USER).select(*SCORED_COLS)


# ------------------------------------------------------------- assertions

@register("assert_grain", with_ctes("""
SELECT 'alert_grain' AS check_name, COUNT(*) AS violations
FROM (SELECT rule_id, customer_key, date_key FROM evt_alerts GROUP BY 1, 2, 3 HAVING COUNT(*) > 1)""", "evt_alerts"))
def q_assert_grain(spark, sf):
    return asr.assert_grain(Evaluation(spark, sf).alerts, ["rule_id", "customer_key", "date_key"], "alert_grain")


@register("assert_sign", with_ctes("""
SELECT 'signed_amount_sign' AS check_name, COUNT(*) AS violations FROM fact
WHERE (direction = 'credit' AND signed_amount_cad <= 0) OR (direction <> 'credit' AND signed_amount_cad >= 0)""",
                                   "fact"))
def q_assert_sign(spark, sf):
    return asr.assert_sign(Warehouse(spark, sf).fact)


@register("assert_fk", with_ctes("""
SELECT 'fact_account' AS check_name, COUNT(*) AS violations FROM fact f
  WHERE f.account_key NOT IN (SELECT account_key FROM dim_account)
UNION ALL SELECT 'fact_customer', COUNT(*) FROM fact f WHERE f.customer_key NOT IN (SELECT customer_key FROM dim_customer)
UNION ALL SELECT 'alert_customer', COUNT(*) FROM fact_alerts a
  WHERE a.customer_key NOT IN (SELECT customer_key FROM dim_customer)
UNION ALL SELECT 'fact_country', COUNT(*) FROM fact f
  WHERE f.counterparty_country NOT IN (SELECT country_code FROM dim_country)""",
                                 "fact", "dim_account", "dim_customer", "fact_alerts", "dim_country"))
def q_assert_fk(spark, sf):
    w = Warehouse(spark, sf)
    cc = w.dim_country.select(F.col("country_code").alias("counterparty_country"))
    return asr.assert_fk([("fact_account", w.fact, "account_key", w.dim_account),
                          ("fact_customer", w.fact, "customer_key", w.dim_customer),
                          ("alert_customer", w.alerts, "customer_key", w.dim_customer),
                          ("fact_country", w.fact, "counterparty_country", cc)])


@register("assert_nested_windows", with_ctes("""
SELECT 'nested_windows' AS check_name, COUNT(*) AS violations FROM evt_rolls
WHERE n_txn_7d > n_txn_30d OR n_txn_30d > n_txn_90d OR vol_total_7d > vol_total_30d OR vol_total_30d > vol_total_90d""",
                                             "evt_rolls"))
def q_assert_nested(spark, sf):
    e = Evaluation(spark, sf)
    return asr.assert_nested_windows(fe.rolling_features(e.daily, FP))


_PLANTED = Decimal("1000000.00")


def later_alert_fact(fact, alerts):
    """``fact`` and one very large transaction the day after every alert that its customer has a later alert
    than; so the planted day lies inside the span that later alerts need. And the planted alerts' number."""
    last = alerts.groupBy("customer_key").agg(F.max("date_key").alias("_last"))
    days = (alerts.join(last, "customer_key").filter(F.col("date_key") < F.col("_last"))
            .select("customer_key", (F.col("date_key") + 1).alias("date_key"), "alert_id"))
    per_day = days.groupBy("customer_key", "date_key").agg(F.first("alert_id").alias("alert_id"))
    own = fact.groupBy("customer_key").agg(F.min(F.struct(*fact.columns)).alias("_row")).select("_row.*")
    planted = (per_day.join(own.drop("date_key"), "customer_key")
               .withColumn("txn_id", F.concat(F.lit("planted-"), F.col("alert_id")))
               .withColumn("amount_cad", F.lit(_PLANTED).cast("decimal(18,2)"))
               .withColumn("direction", F.lit("credit")).withColumn("signed_amount_cad", F.lit(_PLANTED).cast("decimal(18,2)")))
    return fact.unionByName(planted.select(*fact.columns)), days


def lookahead_violations(e, frame=None):
    """(planted transactions, alerts before a planted one, alerts whose features changed although only later days did).

    An alert is compared when every transaction planted for its customer lies after its date: that holds for the
    first alert day of each customer with a later one. ``frame`` computes the features (a test passes a leaky one)."""
    frame = frame or (lambda fact: fe.feature_frame(e.alerts, fact, e.dim_country, e.dim_customer, e.dim_account, e.dim_rule, FP))
    more, days = later_alert_fact(e.fact, e.alerts)
    first = days.groupBy("customer_key").agg((F.min("date_key") - 1).alias("date_key"))
    compared = e.alerts.join(first, ["customer_key", "date_key"], "left_semi").select("alert_id")
    cols = (["alert_id"] + fe.rolling_names(FP.windows) + ["active_days_90d"] + fe.RATIOS)
    base = frame(e.fact).join(compared, "alert_id", "left_semi").select(*cols)
    bumped = frame(more).join(compared, "alert_id", "left_semi").select(*cols)
    counts = (days.select("customer_key", "date_key").distinct().agg(F.count(F.lit(1)).alias("planted"))
              .select(F.lit("planted_transactions").alias("check_name"), F.col("planted").alias("violations")))
    tested = compared.agg(F.count(F.lit(1)).alias("n")).select(F.lit("compared_alerts").alias("check_name"), F.col("n").alias("violations"))
    return counts.unionByName(tested).unionByName(asr.assert_same(base, bumped, "no_lookahead"))


@register("assert_no_lookahead", with_ctes("""
SELECT 'planted_transactions' AS check_name, COUNT(*) AS violations FROM (
  SELECT DISTINCT customer_key, date_key FROM evt_alerts a
  WHERE EXISTS (SELECT 1 FROM evt_alerts b WHERE b.customer_key = a.customer_key AND b.date_key > a.date_key))
UNION ALL SELECT 'compared_alerts', COUNT(*) FROM evt_alerts a
  JOIN (SELECT customer_key, MIN(date_key) AS lo, MAX(date_key) AS hi FROM evt_alerts GROUP BY customer_key) s
    ON s.customer_key = a.customer_key AND a.date_key = s.lo AND s.hi > s.lo
UNION ALL SELECT 'no_lookahead', CAST(0 AS BIGINT)""", "evt_alerts"))
def q_assert_no_lookahead(spark, sf):
    """O-116: a very large transaction on the day after every alert that is not its customer's last must not change
    the features of each customer's first alert day (later alerts may see earlier planted rows; ``assert_asof_replay``
    compares those too). The rows also count what was planted and compared."""
    return lookahead_violations(Evaluation(spark, sf))


@register("assert_asof_replay", with_ctes(f"""
SELECT 'compared_alerts' AS check_name, COUNT(DISTINCT alert_id) AS violations FROM evt_alerts
UNION ALL SELECT 'compared_figures', COUNT(*) * {len(ao.replayed_names(FP))} FROM evt_alerts
UNION ALL SELECT 'as_of_replay', CAST(0 AS BIGINT)""", "evt_alerts"))
def q_assert_asof_replay(spark, sf):
    """O-116 for every alert: its trailing features and context equal a recount of the facts and alerts up to its date."""
    e = Evaluation(spark, sf)
    return ao.replay_violations(e.frame, ao.replay(e.alerts, e.fact, e.dim_country, FP), FP)
