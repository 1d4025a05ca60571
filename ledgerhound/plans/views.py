"""O-04: the star schema and marts as temporary views for SQL users."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .q_scoring import Evaluation, scored_table
from .warehouse import Warehouse

#: The views whose tables are made of the LIN feed.
LIN_VIEWS = {"dim_date", "fact_transaction", "rejected_transaction", "fact_alert", "stg_txn_dedup", "mart_dq"}


def register_views(spark: SparkSession, sf_dir: str, read: tuple[str, ...] | None = None) -> list[str]:
    """Register the LIN star schema, the EVT alert tables and the reference's
    five views (``stg_txn_dedup`` and the four marts) as temp views.

    ``read``: the views that will be queried; None: any. The LIN tables are written only if one of theirs
    is, else these views are lazy plans from the feed on, and nothing runs until a query does."""
    from ..operators import marts as mt
    from ..operators import quality
    from .q_quality import dq_results

    lin = read is None or not set(read).isdisjoint(LIN_VIEWS)
    w, e = Warehouse(spark, sf_dir, written=lin), Evaluation(spark, sf_dir)
    scored = scored_table(spark, sf_dir)
    views = {
        "dim_customer": w.dim_customer, "dim_account": w.dim_account, "dim_country": w.dim_country,
        "dim_date": w.dim_date, "dim_rule": w.dim_rule, "fact_transaction": w.fact,
        "rejected_transaction": w.rejected, "fact_alert": w.alerts,
        "evt_transaction": e.fact, "evt_alert": e.alerts, "stg_scores": scored,
        "stg_txn_dedup": w.dedup,
        "mart_alert": mt.mart_alert(e.alerts, e.dim_date, scored),
        "mart_customer_week": mt.mart_customer_week(e.fact, e.dim_date, e.dim_country, e.alerts),
        "mart_txn_drill": mt.mart_txn_drill(e.fact, e.dim_date, e.dim_country, scored),
        "mart_dq": quality.dq_scorecard(dq_results(spark, sf_dir, lin), with_run_ts=False),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return sorted(views)
