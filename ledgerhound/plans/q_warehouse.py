"""Queries: staging, cleaning, conforming and detection rules (O-01..O-30)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean, rules
from ..params import FIXTURE_RULES as P
from ..params import RuleParams
from .catalog import register
from .oracle_ctes import RULES, detection_sql, rule_sql, with_ctes
from .warehouse import Monitoring, Warehouse, sup_fact

DEDUP_COLS = ["txn_id", "account_id", "customer_id", "day_index", "hour", "amount_cad", "direction",
              "channel", "counterparty_country", "counterparty_id", "txn_date"]


@register("dim_country", with_ctes("SELECT * FROM dim_country", "dim_country"))
def q_dim_country(spark, sf):
    return Warehouse(spark, sf).dim_country


@register("dim_rule", with_ctes("""
SELECT r.*, (SELECT count(*) FROM evt_alerts a WHERE a.rule_id = r.rule_id) AS alerts FROM dim_rule r""", "dim_rule", "evt_alerts"))
def q_dim_rule(spark, sf):
    """O-03: the rule catalogue, with the alerts that each rule raises."""
    m = Monitoring(spark, sf)
    per = m.alerts.groupBy("rule_id").agg(F.count(F.lit(1)).alias("alerts"))
    return m.dim_rule.join(per, "rule_id", "left").withColumn("alerts", F.coalesce("alerts", F.lit(0)))


@register("alerts_default_rules", with_ctes("SELECT * FROM evt_alerts_default", "evt_alerts_default"))
def q_alerts_default(spark, sf):
    """O-29 under the default thresholds, next to the fixture's in one session."""
    return Monitoring(spark, sf, RuleParams()).alerts


@register("dim_customer_bands", with_ctes("SELECT * FROM dim_customer", "dim_customer"))
def q_dim_customer(spark, sf):
    return Warehouse(spark, sf).dim_customer


@register("dim_account", with_ctes("SELECT * FROM dim_account", "dim_account"))
def q_dim_account(spark, sf):
    return Warehouse(spark, sf).dim_account


@register("dim_date", with_ctes("SELECT * EXCLUDE (calendar_date), strftime(calendar_date, '%Y-%m-%d') AS calendar_date "
                                "FROM dim_date", "dim_date"))
def q_dim_date(spark, sf):
    return Warehouse(spark, sf).dim_date


@register("dedup_first", with_ctes(
    "SELECT " + ", ".join({"txn_date": "strftime(txn_date, '%Y-%m-%d') AS txn_date",
                           "amount_cad": "CAST(amount_cad AS DOUBLE) AS amount_cad"}.get(c, c) for c in DEDUP_COLS)
    + " FROM dedup", "dedup"))
def q_dedup(spark, sf):
    return Warehouse(spark, sf).dedup.select(*DEDUP_COLS)


@register("rejected_rows", with_ctes("SELECT * FROM rejected", "rejected"))
def q_rejected(spark, sf):
    return Warehouse(spark, sf).rejected


@register("quarantine_reasons", with_ctes(
    "SELECT reject_reason, COUNT(*) AS n_rejected FROM rejected GROUP BY reject_reason", "rejected"))
def q_quarantine_reasons(spark, sf):
    return clean.quarantine_summary(Warehouse(spark, sf).rejected)


MONEY_OUT = "REPLACE (CAST(amount_cad AS DOUBLE) AS amount_cad, CAST(signed_amount_cad AS DOUBLE) AS signed_amount_cad)"


@register("fact_conform", with_ctes(f"SELECT * {MONEY_OUT} FROM fact", "fact"))
def q_fact(spark, sf):
    return Warehouse(spark, sf).fact


@register("evt_ledger", with_ctes(
    "SELECT * REPLACE (CAST(amount_cad AS DOUBLE) AS amount_cad), "
    "CAST(CASE WHEN direction = 'credit' THEN amount_cad ELSE -amount_cad END AS DOUBLE) AS signed_amount_cad FROM evt",
    "evt"))
def q_evt(spark, sf):
    return Monitoring(spark, sf).fact


_RULE_FN = {"R001": rules.rule_r001, "R002": rules.rule_r002, "R003": rules.rule_r003, "R005": rules.rule_r005,
            "R006": rules.rule_r006, "R007": rules.rule_r007, "R008": rules.rule_r008}


def _rule_query(rule: str, ledger: str):
    def run(spark, sf):
        if ledger == "evt":
            m = Monitoring(spark, sf)
            fact, country = m.fact, m.dim_country
        elif ledger == "sup":
            fact, country = sup_fact(spark, sf), Warehouse(spark, sf).dim_country
        else:
            w = Warehouse(spark, sf)
            fact, country = w.fact, w.dim_country
        if rule == "R004":
            return rules.rule_r004(fact, country, P)
        return _RULE_FN[rule](fact, P)
    return run


# Each rule runs on the ledger where it fires.
RULE_LEDGER = {"R001": "evt", "R002": "evt", "R003": "sup", "R004": "evt", "R005": "sup",
               "R006": "evt", "R007": "fact", "R008": "evt"}
_SQL_DEPS = {"evt": ("evt", "dim_country"), "sup": ("sup", "dim_country"), "fact": ("fact", "dim_country")}

for _r in RULES:
    _led = RULE_LEDGER[_r]
    register(f"rule_{_r.lower()}", with_ctes(rule_sql(_r, _led), *_SQL_DEPS[_led]))(_rule_query(_r, _led))

def _detection_query(rule: str, ledger: str):
    def run(spark, sf):
        fact = sup_fact(spark, sf) if ledger == "sup" else Warehouse(spark, sf).fact
        return _RULE_FN[rule](fact, P, rules.DETECTION)
    run.__doc__ = f"{rule} dated at the moment at which its condition becomes true (O-23/O-27, trap T-3)."
    return run


for _r in ("R003", "R007"):
    _led = RULE_LEDGER[_r]
    register(f"rule_{_r.lower()}_detection", with_ctes(detection_sql(_r, _led), *_SQL_DEPS[_led]))(_detection_query(_r, _led))

register("rule_r003_evt", with_ctes(rule_sql("R003", "evt"), "evt"))(_rule_query("R003", "evt"))


@register("alerts_all", with_ctes("SELECT * FROM evt_alerts", "evt_alerts"))
def q_alerts_all(spark, sf):
    return Monitoring(spark, sf).alerts


@register("warehouse_alerts", with_ctes("SELECT * FROM fact_alerts", "fact_alerts"))
def q_warehouse_alerts(spark, sf):
    return Warehouse(spark, sf).alerts


@register("alerts_by_rule", with_ctes("""
SELECT r.rule_id, r.rule_name, COUNT(a.alert_id) AS alerts, COUNT(DISTINCT a.customer_key) AS customers
FROM dim_rule r LEFT JOIN evt_alerts a ON a.rule_id = r.rule_id
GROUP BY r.rule_id, r.rule_name""", "dim_rule", "evt_alerts"))
def q_alerts_by_rule(spark, sf):
    m = Monitoring(spark, sf)
    return rules.alerts_by_rule(m.alerts, m.dim_rule)


@register("surrogate_keys", with_ctes("SELECT customer_id, customer_key FROM dim_customer", "dim_customer"))
def q_surrogate_keys(spark, sf):
    """O-10 on its own: dense keys 1..n in customer_id order, computed in buckets."""
    return Warehouse(spark, sf).dim_customer.select("customer_id", "customer_key")
