"""queries() against oracle_sql() on DuckDB at sf0.001 (the driver's gate runs sf0.01)."""

import duckdb
import pytest

import __spark_entry__ as entry
from tools.compare import TABLES, canon

from conftest import SF_SMALL

NAMES = ["dim_customer_bands", "dedup_first", "rejected_rows", "fact_conform", "rule_r001", "rule_r003",
         "rule_r004", "rule_r007", "alerts_all", "alerts_by_rule", "dq_scorecard", "feature_frame",
         "scored_alerts", "tier_policy", "rule_effectiveness", "rule_overlap", "mart_customer_week",
         "assert_fk", "rule_r002", "rule_r005", "rule_r006", "rule_r008", "queue_listing", "queue_tier1_r004",
         "sql_mart_views", "publish_exports", "alert_context"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    cols = df.columns
    got = canon([tuple(r) for r in df.collect()], cols)
    cur = duck.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(ocols)
    assert got == canon(cur.fetchall(), ocols)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and "alert_id" in df.columns
