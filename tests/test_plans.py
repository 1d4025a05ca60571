"""Physical-plan properties the scale design relies on (read from the
executed plan, so a regression shows up as a failing test, not a slow job)."""

import pytest
from conftest import SF_SMALL

from ledgerhound.operators import features as fe
from ledgerhound.operators import rule_analytics as ra
from ledgerhound.operators import rules
from ledgerhound.params import FIXTURE_RULES
from ledgerhound.plans.q_features import FP
from ledgerhound.plans.warehouse import Monitoring, run_rules

PAIR_JOINS = ("SortMergeJoin", "BroadcastNestedLoopJoin", "CartesianProduct", "ShuffledHashJoin", "BroadcastHashJoin")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def evt(spark):
    return Monitoring(spark, SF_SMALL)


def test_customer_window_rules_scan_once_and_shuffle_twice(evt):
    p = plan(rules.customer_window_rules(evt.fact, rules.customer_window_specs(FIXTURE_RULES)))
    assert p.count("FileScan parquet") == 1
    # (customer, date, hour) for the hourly totals, customer_key for every frame;
    # the per-alert grouping reuses the customer partitioning.
    assert p.count("Exchange hashpartitioning") == 2
    assert not any(j in p for j in PAIR_JOINS)


def test_customer_day_rules_scan_once(evt):
    p = plan(rules.customer_day_rules(evt.fact, evt.dim_country, FIXTURE_RULES))
    assert len([ln for ln in p.splitlines() if "FileScan parquet" in ln and "amount_cad" in ln]) == 1
    # (customer, date) for the daily totals, customer_key for R005's frames.
    assert p.count("Exchange hashpartitioning") == 2
    assert "SortMergeJoin" not in p and "BroadcastNestedLoopJoin" not in p


def test_alert_table_reads_the_fact_five_times(evt):
    p = plan(run_rules(evt.fact, evt.dim_country, FIXTURE_RULES))
    fact_scans = [ln for ln in p.splitlines() if "FileScan parquet" in ln and "amount_cad" in ln]
    assert len(fact_scans) == 5
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p


def test_rule_overlap_has_no_join(evt):
    p = plan(ra.rule_overlap(evt.alerts))
    assert not any(j in p for j in PAIR_JOINS)


def test_rolling_windows_share_one_window_operator(evt):
    daily = fe.customer_day(evt.fact, evt.dim_country, FP)
    p = plan(fe.rolling_features(daily, FP))
    assert p.count("Window [") == 1


def test_filters_reach_the_scan(evt):
    p = plan(rules.rule_r004(evt.fact, evt.dim_country, FIXTURE_RULES))
    scan = next(ln for ln in p.splitlines() if "FileScan parquet" in ln and "channel" in ln)
    assert "PushedFilters: [" in scan and "EqualTo(channel,wire)" in scan


def test_no_row_at_a_time_python_in_core_queries(spark):
    import __spark_entry__ as entry
    qs = entry.queries()
    names = ["fact_conform", "dedup_first", "alerts_all", "warehouse_alerts", "dq_scorecard", "feature_frame",
             "scored_alerts", "tradeoff_curve", "tier_policy", "rule_effectiveness", "rule_overlap",
             "business_case", "mart_customer_week", "mart_txn_drill", "measures_customer"]
    for n in names:
        p = plan(qs[n](spark, SF_SMALL))
        assert "BatchEvalPython" not in p, n
        assert "CartesianProduct" not in p, n


def test_r003_has_no_range_join(evt):
    p = plan(rules.rule_r003(evt.fact, FIXTURE_RULES))
    # Outflow comes from a forward RANGE window over hourly debits; credits
    # pick it up with an equi-join on (account, hour): no non-equi join.
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p
    assert p.count("Window [") == 1
    assert len([ln for ln in p.splitlines() if "FileScan parquet" in ln and "amount_cad" in ln]) == 2
