"""Queries: customer-day aggregates, trailing windows, alert context, features and labels (O-46..O-58)."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import functions as F

from ..operators import features as fe
from ..params import FeatureParams
from .catalog import register
from .oracle_ctes import cte, with_ctes
from .store import stored
from .warehouse import Monitoring

FP = FeatureParams()


class Scoring(Monitoring):
    """EVT monitoring plus features and labels."""

    @cached_property
    def daily(self):
        return fe.customer_day(self.fact, self.dim_country, FP)

    @cached_property
    def campaigns(self):
        return fe.campaigns(self.dim_customer)

    @cached_property
    def labelled(self):
        return stored(self.spark, self.sf_dir, "evt_labelled",
                      lambda: fe.label_alerts(self.alerts, self.campaigns, FP.label_grace_days), (self.rule_params, FP))

    @cached_property
    def frame(self):
        def build():
            f = fe.feature_frame(self.alerts, self.fact, self.dim_country, self.dim_customer, self.dim_account,
                                 self.dim_rule, FP)
            lab = self.labelled.select("alert_id", "is_true_positive")
            return f.join(lab, "alert_id", "left")
        return stored(self.spark, self.sf_dir, "evt_frame", build, (self.rule_params, FP))


# ----------------------------------------------------------------- oracle
_MONEY = {"vol_total", "vol_credit", "vol_debit", "vol_cash_credit", "vol_wire", "vol_highrisk", "max_amt"}
# What a transaction adds to each summed measure of its day; the pairs are the oracle's own, one row a measure.
_ADDS = {
    "n_txn": "1", "vol_total": "amount_cad",
    "vol_credit": "if(direction = 'credit', amount_cad, 0)", "vol_debit": "if(direction = 'credit', 0, amount_cad)",
    "n_cash_credit": "if(cash_in, 1, 0)", "vol_cash_credit": "if(cash_in, amount_cad, 0)",
    "n_wire": "if(channel = 'wire', 1, 0)", "vol_wire": "if(channel = 'wire', amount_cad, 0)",
    "n_highrisk": "is_high_risk", "vol_highrisk": "is_high_risk * amount_cad",
    "n_band_cash": f"if(cash_in AND amount_cad >= {FP.band_low} AND amount_cad <= {FP.band_high}, 1, 0)",
    "n_round": f"if(amount_cad >= {FP.round_min} AND amount_cad % {FP.round_unit} = 0, 1, 0)",
    "n_offhours": f"if(hour_of_day < {FP.offhours_start} OR hour_of_day > {FP.offhours_end}, 1, 0)",
}
cte("evt_marks", f"""
SELECT t.customer_key, t.date_key, m.measure, m.value
FROM (SELECT f.*, c.is_high_risk, f.channel = 'cash' AND f.direction = 'credit' AS cash_in
      FROM evt f JOIN dim_country c ON c.country_code = f.counterparty_country) t,
     LATERAL (VALUES {", ".join(f"('{m}', CAST({v} AS DECIMAL(18,2)))" for m, v in _ADDS.items())}) AS m(measure, value)""", ("evt", "dim_country"))
cte("evt_daily", f"""
SELECT s.*, e.max_amt, e.n_counterparties
FROM (SELECT customer_key, date_key, {", ".join(f"CAST(sum(value) FILTER (measure = '{m}') AS {'DECIMAL(38,2)' if m in _MONEY else 'BIGINT'}) AS {m}" for m in _ADDS)}
      FROM evt_marks GROUP BY customer_key, date_key) s
JOIN (SELECT customer_key, date_key, max(amount_cad) AS max_amt, count(DISTINCT counterparty_id) AS n_counterparties
      FROM evt WHERE counterparty_country IN (SELECT country_code FROM dim_country) GROUP BY customer_key, date_key) e
  ON e.customer_key = s.customer_key AND e.date_key = s.date_key""", ("evt_marks", "evt", "dim_country"))


def _roll(m: str, w: int) -> str:
    frame = f"OVER (PARTITION BY customer_key ORDER BY date_key RANGE BETWEEN {w - 1} PRECEDING AND CURRENT ROW)"
    t = "DOUBLE" if m in _MONEY else "BIGINT"
    return f"CAST(SUM({m}) {frame} AS {t}) AS {m}_{w}d"


_ROLLS = ",\n       ".join(_roll(m, w) for w in FP.windows for m in fe.MEASURES)
cte("evt_rolls", f"""
SELECT customer_key, date_key,
       {_ROLLS},
       COUNT(*) OVER (PARTITION BY customer_key ORDER BY date_key
                      RANGE BETWEEN {FP.active_window - 1} PRECEDING AND CURRENT ROW) AS active_days_90d
FROM evt_daily""", ("evt_daily",))

cte("evt_ctx", """
SELECT a.*, d.n_rules_same_day, d.prior_alerts, d.days_since_prior_alert
FROM evt_alerts a LEFT JOIN (
  SELECT customer_key, date_key, n_rules_same_day,
         CAST(COALESCE(SUM(n) OVER (PARTITION BY customer_key ORDER BY date_key
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS prior_alerts,
         CAST(COALESCE(date_key - LAG(date_key) OVER (PARTITION BY customer_key ORDER BY date_key), 999) AS INTEGER)
           AS days_since_prior_alert
  FROM (SELECT customer_key, date_key, COUNT(DISTINCT rule_id) AS n_rules_same_day, COUNT(*) AS n
        FROM evt_alerts GROUP BY customer_key, date_key)) d
  ON d.customer_key = a.customer_key AND d.date_key = a.date_key""", ("evt_alerts",))

cte("evt_acct_summary", """
SELECT customer_key, COUNT(*) AS n_accounts, MIN(opened_days_ago) AS newest_account_age
FROM evt_account GROUP BY customer_key""", ("evt_account",))

# Each ratio: what is divided, what is taken off it first, by what, times and over how much. A table, so the oracle has one formula for all.
_RATIO_TABLE = [
    ("vol_to_declared_30d", "vol_credit_30d", None, "monthly_income", 1, 1), ("vol_to_declared_90d", "vol_credit_90d", None, "monthly_income", 3, 1),
    ("cash_share_30d", "vol_cash_credit_30d", None, "vol_credit_30d", 1, 1), ("cash_share_90d", "vol_cash_credit_90d", None, "vol_credit_90d", 1, 1),
    ("highrisk_share_30d", "vol_highrisk_30d", None, "vol_total_30d", 1, 1), ("wire_share_30d", "vol_wire_30d", None, "vol_total_30d", 1, 1),
    ("offhours_share_30d", "n_offhours_30d", None, "n_txn_30d", 1, 1), ("round_share_30d", "n_round_30d", None, "n_txn_30d", 1, 1),
    ("band_share_30d", "n_band_cash_30d", None, "n_cash_credit_30d", 1, 1), ("retention_30d", "vol_credit_30d", "vol_debit_30d", "vol_credit_30d", 1, 1),
    ("retention_90d", "vol_credit_90d", "vol_debit_90d", "vol_credit_90d", 1, 1), ("velocity_ratio", "vol_credit_30d", None, "vol_credit_90d", 1, 3),
    ("txn_velocity_ratio", "n_txn_30d", None, "n_txn_90d", 1, 3), ("vol_per_counterparty_30d", "vol_total_30d", None, "n_counterparties_30d", 1, 1),
    ("txn_per_active_day", "n_txn_90d", None, "active_days_90d", 1, 1),
]
_PARTS = sorted({x for r in _RATIO_TABLE for x in r[1:4] if x})
cte("ratio_table", "SELECT * FROM (VALUES " + ", ".join(
    f"('{n}', '{a}', {repr(b) if b else 'CAST(NULL AS VARCHAR)'}, '{c}', {t}, {d})" for n, a, b, c, t, d in _RATIO_TABLE) + ") AS r(ratio, over, less, under, times, parts)")
cte("ratio_values", f"""
UNPIVOT (SELECT alert_id, {", ".join(f"CAST({'declared_annual_income_cad / 12.0' if x == 'monthly_income' else x} AS DOUBLE) AS {x}" for x in _PARTS)} FROM evt_frame_base)
ON {", ".join(_PARTS)} INTO NAME part VALUE v""", ("evt_frame_base",))
cte("evt_ratios", f"""
SELECT alert_id, {", ".join(f"max(q) FILTER (ratio = '{r[0]}') AS {r[0]}" for r in _RATIO_TABLE)}
FROM (SELECT o.alert_id, r.ratio, (o.v - coalesce(l.v, 0)) / (u.v * r.times / r.parts + {FP.epsilon}) AS q
      FROM ratio_table r JOIN ratio_values o ON o.part = r.over
      JOIN ratio_values u ON u.part = r.under AND u.alert_id = o.alert_id
      LEFT JOIN ratio_values l ON l.part = r.less AND l.alert_id = o.alert_id)
GROUP BY alert_id""", ("ratio_table", "ratio_values"))

_CUST = ", ".join(f"c.{x}" for x in ["customer_id"] + fe.CUSTOMER_FEATURES)
cte("evt_frame_base", f"""
SELECT x.*, r.* EXCLUDE (customer_key, date_key), {_CUST}, s.n_accounts, s.newest_account_age,
       dr.rule_family, dr.severity
FROM evt_ctx x
LEFT JOIN evt_rolls r ON r.customer_key = x.customer_key AND r.date_key = x.date_key
LEFT JOIN evt_customer c ON c.customer_key = x.customer_key
LEFT JOIN evt_acct_summary s ON s.customer_key = x.customer_key
LEFT JOIN dim_rule dr ON dr.rule_id = x.rule_id""", ("evt_ctx", "evt_rolls", "evt_customer", "evt_acct_summary", "dim_rule"))

cte("evt_campaign", """
SELECT c_custkey AS customer_key, 'campaign' AS typology, CAST(c_custkey * 11 % 25 AS INTEGER) AS campaign_start_day,
       CAST(c_custkey * 11 % 25 AS INTEGER) + 6 AS campaign_end_day
FROM customer WHERE c_custkey % 4 = 0""")

cte("evt_labels", """
SELECT a.*, CASE WHEN g.campaign_start_day IS NOT NULL AND a.date_key >= g.campaign_start_day - 7
                  AND a.date_key <= g.campaign_end_day + 7 THEN 1 ELSE 0 END AS is_true_positive
FROM evt_alerts a LEFT JOIN evt_campaign g ON g.customer_key = a.customer_key""", ("evt_alerts", "evt_campaign"))

cte("evt_frame", f"""
SELECT b.*, q.* EXCLUDE (alert_id), l.is_true_positive
FROM evt_frame_base b LEFT JOIN evt_ratios q ON q.alert_id = b.alert_id LEFT JOIN evt_labels l ON l.alert_id = b.alert_id""", ("evt_frame_base", "evt_ratios", "evt_labels"))

_DAILY_OUT = ", ".join(f"CAST({m} AS DOUBLE) AS {m}" if m in _MONEY else m for m in fe.MEASURES)


@register("customer_day", with_ctes(f"SELECT customer_key, date_key, {_DAILY_OUT} FROM evt_daily", "evt_daily"))
def q_customer_day(spark, sf):
    return Scoring(spark, sf).daily


@register("rolling_features", with_ctes("SELECT * FROM evt_rolls", "evt_rolls"))
def q_rolling(spark, sf):
    return fe.rolling_features(Scoring(spark, sf).daily, FP)


_RECOUNT = ",\n       ".join(
    [f"COUNT(DISTINCT f.counterparty_id) FILTER (f.date_key > d.date_key - {w}) AS distinct_counterparties_{w}d" for w in FP.windows]
    + [f"CAST(MAX(f.amount_cad) FILTER (f.date_key > d.date_key - {w}) AS DOUBLE) AS largest_txn_{w}d" for w in FP.windows])


@register("rolling_distinct", with_ctes(f"""
SELECT d.customer_key, d.date_key, {_RECOUNT}
FROM (SELECT DISTINCT customer_key, date_key FROM evt WHERE counterparty_country IN (SELECT country_code FROM dim_country)) d
JOIN (SELECT * FROM evt WHERE counterparty_country IN (SELECT country_code FROM dim_country)) f
  ON f.customer_key = d.customer_key AND f.date_key BETWEEN d.date_key - {max(FP.windows) - 1} AND d.date_key
GROUP BY d.customer_key, d.date_key""", "evt", "dim_country"))
def q_rolling_distinct(spark, sf):
    """O-47/O-49 without trap T-4: counterparties counted once per window, and the window's largest transaction."""
    s = Scoring(spark, sf)
    got = fe.trailing_distinct(s.fact, s.dim_country, FP)
    return got.select(*[F.col(c).cast("double").alias(c) if c.startswith("largest") else F.col(c) for c in got.columns])


_GRID_OUT = ", ".join(f"CAST(COALESCE(d.{m}, 0) AS {'DOUBLE' if m in _MONEY else 'BIGINT'}) AS {m}"
                      for m in fe.MEASURES)


@register("dense_grid", with_ctes(f"""
SELECT g.customer_key, g.date_key, {_GRID_OUT}
FROM (SELECT customer_key, CAST(unnest(range(0, (SELECT MAX(date_key) + 1 FROM evt_daily))) AS INTEGER) AS date_key
      FROM (SELECT DISTINCT customer_key FROM evt_daily)) g
LEFT JOIN evt_daily d ON d.customer_key = g.customer_key AND d.date_key = g.date_key""", "evt_daily"))
def q_dense_grid(spark, sf):
    g = fe.dense_grid(Scoring(spark, sf).daily)
    return g.select("customer_key", F.col("date_key").cast("int").alias("date_key"), *fe.MEASURES)


@register("alert_context", with_ctes(
    "SELECT alert_id, n_rules_same_day, prior_alerts, days_since_prior_alert FROM evt_ctx", "evt_ctx"))
def q_alert_context(spark, sf):
    return fe.alert_context(Scoring(spark, sf).alerts).select(
        "alert_id", "n_rules_same_day", "prior_alerts", "days_since_prior_alert")


@register("account_summary", with_ctes("SELECT * FROM evt_acct_summary", "evt_acct_summary"))
def q_account_summary(spark, sf):
    return fe.account_summary(Scoring(spark, sf).dim_account)


@register("feature_ratios", with_ctes("SELECT alert_id, " + ", ".join(fe.RATIOS) + " FROM evt_frame", "evt_frame"))
def q_feature_ratios(spark, sf):
    return Scoring(spark, sf).frame.select("alert_id", *fe.RATIOS)


def _frame_cols():
    return (["alert_id", "rule_id", "customer_key", "date_key", "trigger_amount", "trigger_txn_count", "detail",
             "n_rules_same_day", "prior_alerts", "days_since_prior_alert"] + fe.rolling_names(FP.windows)
            + ["active_days_90d", "customer_id"] + fe.CUSTOMER_FEATURES
            + ["n_accounts", "newest_account_age", "rule_family", "severity"] + fe.RATIOS + ["is_true_positive"])


@register("feature_frame", with_ctes("SELECT " + ", ".join(_frame_cols()) + " FROM evt_frame", "evt_frame"))
def q_feature_frame(spark, sf):
    return Scoring(spark, sf).frame.select(*_frame_cols())


def feature_columns() -> list[str]:
    """The 81 model features: the frame's columns without the blocklist."""
    return [c for c in _frame_cols() if c not in fe.FEATURE_BLOCKLIST]


def matrix_sql() -> str:
    cols = []
    for c in _frame_cols():
        if c in fe.FEATURE_BLOCKLIST and c != "alert_id":
            continue
        if c == "alert_id" or c in fe.CATEGORICAL:
            cols.append(c)
        else:
            cols.append(f"CASE WHEN isfinite(CAST({c} AS DOUBLE)) THEN CAST({c} AS DOUBLE) ELSE 0.0 END AS {c}")
    return "SELECT " + ", ".join(cols) + " FROM evt_frame"


@register("feature_matrix", with_ctes(matrix_sql(), "evt_frame"))
def q_feature_matrix(spark, sf):
    return fe.feature_matrix(Scoring(spark, sf).frame.select(*_frame_cols()))


@register("labels", with_ctes("SELECT alert_id, customer_key, date_key, is_true_positive FROM evt_labels", "evt_labels"))
def q_labels(spark, sf):
    return Scoring(spark, sf).labelled.select("alert_id", "customer_key", "date_key", "is_true_positive")


@register("campaigns", with_ctes("SELECT * FROM evt_campaign", "evt_campaign"))
def q_campaigns(spark, sf):
    return Scoring(spark, sf).campaigns
