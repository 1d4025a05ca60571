"""Queries: feed staging and export round trips (O-01, O-05..O-09)."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import functions as F

from ..operators import marts as mt
from ..operators.boosting import BoostedTrees
from ..sources import feeds, sinks
from .catalog import register
from .oracle_ctes import with_ctes
from .q_marts import _WEEK_OUT
from .q_scoring import Evaluation
from .warehouse import Warehouse

STG_COLS = [f.name for f in feeds.TRANSACTIONS.fields]


@register("stage_feed", with_ctes(
    "SELECT " + ", ".join({"txn_date": "strftime(txn_date, '%Y-%m-%d') AS txn_date",
                           "amount_cad": "CAST(amount_cad AS DOUBLE) AS amount_cad"}.get(c, c) for c in STG_COLS)
    + " FROM stg", "stg"))
def q_stage_feed(spark, sf):
    """O-01: the LIN transaction feed written as CSV and staged back with its schema."""
    path = sinks.write_csv(Warehouse(spark, sf).staging.select(*STG_COLS), sinks.export_dir(spark, "stg_transactions"))
    return feeds.stage_csv(spark, path, "transactions")


@register("stage_customers", with_ctes(
    "SELECT customer_id, customer_segment, occupation_or_business_type, tenure_months, kyc_risk_rating, is_pep, "
    "declared_annual_income_cad, home_province, onboarding_channel FROM stg_customers", "stg_customers"))
def q_stage_customers(spark, sf):
    cols = [f.name for f in feeds.CUSTOMERS.fields]
    path = sinks.write_csv(Warehouse(spark, sf).stg_customers.select(*cols), sinks.export_dir(spark, "stg_customers"))
    return feeds.stage_csv(spark, path, "customers")


@register("stage_accounts", with_ctes("SELECT account_id, customer_id, account_type, opened_days_ago FROM stg_accounts", "stg_accounts"))
def q_stage_accounts(spark, sf):
    cols = [f.name for f in feeds.ACCOUNTS.fields]
    path = sinks.write_csv(Warehouse(spark, sf).stg_accounts.select(*cols), sinks.export_dir(spark, "stg_accounts"))
    return feeds.stage_csv(spark, path, "accounts")


@register("export_roundtrip", with_ctes(f"SELECT {_WEEK_OUT} FROM evt_week", "evt_week"))
def q_export(spark, sf):
    """O-05: a mart exported as a CSV extract and read back."""
    e = Evaluation(spark, sf)
    week = mt.mart_customer_week(e.fact, e.dim_date, e.dim_country, e.alerts)
    path = sinks.write_csv(week, sinks.export_dir(spark, "mart_customer_week"))
    return spark.read.options(**feeds.CSV_OPTIONS).schema(week.schema).csv(path)


@register("metrics_json", with_ctes("SELECT * FROM evt_tiers", "evt_tiers"))
def q_metrics_json(spark, sf):
    """O-08: the tier policy written as a JSON metrics document and read back."""
    from ..operators import evaluate as ev
    t = ev.tier_policy(Evaluation(spark, sf).part("holdout"))
    path = sinks.write_json(t, sinks.export_dir(spark, "tier_policy"))
    return spark.read.schema(t.schema).json(path)


@register("model_save_load")
def q_model_io(spark, sf):
    """O-09: both models with their preparation saved, loaded back and used to score the raw features."""
    from ..operators import features as fe
    from ..operators import modeling as md
    from .q_models import ModelRun
    path = ModelRun.get(spark, sf).artefact
    notes = sinks.load_notes(spark, path)
    x = md.transform(fe.feature_matrix(Evaluation(spark, sf).frame), md.Prep(**notes["prep"]))
    scored = md.score(LogisticRegressionModel.load(f"{path}/logistic_regression"), x, "score_logistic")
    scored = md.score(BoostedTrees.read(spark.read.parquet(f"{path}/gradient_boosted")), scored, "score_gbm")
    production = "score_logistic" if notes["production_model"] == "logistic_regression" else "score_gbm"
    return scored.select("alert_id", "score_logistic", "score_gbm",
                         (F.col(production) >= notes["threshold"]).alias("is_priority"))


@register("sql_rule_summary", with_ctes("""
SELECT r.rule_id, r.rule_name, COUNT(a.alert_id) AS alerts, COUNT(DISTINCT a.customer_key) AS customers,
       CAST(SUM(s.is_true_positive) AS BIGINT) AS true_positives
FROM dim_rule r LEFT JOIN evt_alerts a ON a.rule_id = r.rule_id
LEFT JOIN evt_scored_alerts s ON s.alert_id = a.alert_id
GROUP BY r.rule_id, r.rule_name""", "dim_rule", "evt_alerts", "evt_scored_alerts"))
def q_sql_rule_summary(spark, sf):
    """O-04: the same summary a SQL user writes against the registered views."""
    from .views import register_views
    register_views(spark, sf, ("dim_rule", "evt_alert", "stg_scores"))
    return spark.sql("""
        SELECT r.rule_id, r.rule_name, COUNT(a.alert_id) AS alerts, COUNT(DISTINCT a.customer_key) AS customers,
               CAST(SUM(s.is_true_positive) AS BIGINT) AS true_positives
        FROM dim_rule r LEFT JOIN evt_alert a ON a.rule_id = r.rule_id
        LEFT JOIN stg_scores s ON s.alert_id = a.alert_id
        GROUP BY r.rule_id, r.rule_name""")


# The report's extract names, each mapped to the query that
# produces it, and the analysis tables republished next to them.
EXTRACTS = {
    "dim_customer": "dim_customer_bands",
    "dim_date": "dim_date",
    "dim_rule": "dim_rule",
    "dim_country": "dim_country",
    "fact_alert": "mart_alert_explained",
    "fact_customer_week": "mart_customer_week",
    "fact_txn_drill": "mart_txn_drill",
    "dq_scorecard": "dq_scorecard",
}
REPUBLISHED = {
    "rule_effectiveness": "rule_effectiveness",
    "rule_overlap": "rule_overlap",
    "cost_benefit_sensitivity": "sensitivity_grid",
    "feature_importance": "feature_importance",
    "scored_alerts_explained": "model_scored_alerts",
    "feature_attribution": "global_attribution",
}


def _publish_oracle() -> str:
    # The extracts' own queries (and oracles) are registered by these modules.
    from . import q_analytics, q_marts, q_quality, q_warehouse  # noqa: F401
    from .catalog import ORACLES
    from .oracle_ctes import with_ctes as ctes
    from .q_features import feature_columns
    counted = {name: f"SELECT count(*) FROM ({ORACLES[key]})" for name, key in {**EXTRACTS, **REPUBLISHED}.items() if key in ORACLES}
    counted["dim_rule"] = f"SELECT count(*) FROM ({ctes('SELECT * FROM dim_rule', 'dim_rule')})"
    # Fitted: one row for each feature or alert.
    counted["feature_importance"] = counted["feature_attribution"] = f"SELECT {len(feature_columns())}"
    counted["fact_alert"] = f"SELECT count(*) FROM ({ORACLES['mart_alert']})"
    counted["scored_alerts_explained"] = f"SELECT count(*) FROM ({ORACLES['alerts_all']})"
    return "\nUNION ALL\n".join(f"SELECT '{name}' AS extract, CAST(({sql}) AS BIGINT) AS n_rows, true AS same_content"
                                for name, sql in counted.items())


def _totals(df, name):
    """Rows and an order-free hash of all cells."""
    cells = F.xxhash64(*[F.col(c).cast("string") for c in df.columns]).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(cells).alias("content")).select(F.lit(name).alias("extract"), "n_rows", "content")


@register("publish_exports", _publish_oracle())
def q_publish_exports(spark, sf):
    """O-05..O-07: the 8 report extracts (alerts with their reasons and strongest mitigant) and the republished analysis tables
    written as CSV under one export folder, then read back: rows per extract, and
    whether every cell came back."""
    from functools import reduce

    from .catalog import QUERIES, report
    keys = {**EXTRACTS, **REPUBLISHED}
    frames = {name: report(Warehouse(spark, sf).dim_rule) if name == "dim_rule" else QUERIES[key](spark, sf) for name, key in keys.items()}
    paths = sinks.publish(frames, sinks.export_dir(spark, "report_extracts"))
    back = [_totals(spark.read.options(**feeds.CSV_OPTIONS).schema(frames[name].schema).csv(path), name) for name, path in paths.items()]
    sent = [_totals(df, name).withColumnsRenamed({"extract": "e", "n_rows": "n", "content": "c"}) for name, df in frames.items()]
    both = reduce(lambda a, b: a.unionByName(b), back).join(F.broadcast(reduce(lambda a, b: a.unionByName(b), sent)), F.col("extract") == F.col("e"))
    return both.select("extract", "n_rows", ((F.col("n_rows") == F.col("n")) & F.col("content").eqNullSafe(F.col("c"))).alias("same_content"))


_MART_VIEW_SQL = """
SELECT a.tier, COUNT(*) AS alerts, CAST(SUM(a.is_true_positive) AS BIGINT) AS true_positives,
       COUNT(DISTINCT a.customer_key) AS customers,
       (SELECT CAST(SUM(is_pass) AS BIGINT) FROM {mart_dq}) AS dq_checks_passed,
       (SELECT COUNT(*) FROM {mart_txn_drill}) AS drill_rows
FROM {mart_alert} a
GROUP BY a.tier"""


def _mart_view_oracle() -> str:
    from . import q_marts, q_quality  # noqa: F401  (register the marts' oracles)
    from .catalog import ORACLES
    return _MART_VIEW_SQL.format(mart_dq=f"({ORACLES['dq_scorecard']}) dq",
                                 mart_txn_drill=f"({ORACLES['mart_txn_drill']}) d",
                                 mart_alert=f"({ORACLES['mart_alert']})")


@register("sql_mart_views", _mart_view_oracle())
def q_sql_mart_views(spark, sf):
    """O-04: SQL over the reference's mart views (mart_alert, mart_dq, mart_txn_drill)."""
    from .views import register_views
    register_views(spark, sf, ("mart_alert", "mart_dq", "mart_txn_drill"))
    return spark.sql(_MART_VIEW_SQL.format(mart_dq="mart_dq", mart_txn_drill="mart_txn_drill",
                                           mart_alert="mart_alert"))
