"""Warehouse-run checks modelled on the reference suite: blocking controls
pass, the load reconciles, the injected defects were present and removed, and
the ground-truth table is one row per customer."""

import pytest
from conftest import SF_MID
from pyspark.sql import functions as F

from ledgerhound.operators import clean, quality
from ledgerhound.plans.q_quality import dq_results
from ledgerhound.plans.warehouse import Monitoring, Warehouse


@pytest.fixture(scope="module")
def wh(spark):
    return Warehouse(spark, SF_MID)


def test_all_blocking_dq_checks_pass(spark):
    res = dq_results(spark, SF_MID)
    failed = res.filter((F.col("severity") == "blocking") & (F.col("status") != "PASS")).collect()
    assert failed == []
    assert quality.dq_gate(res).count() == 13


def test_reconciliation_balances(wh):
    staging = wh.staging.count()
    distinct = wh.staging.select("txn_id").distinct().count()
    fact = wh.fact.count()
    rejected = wh.rejected.select("txn_id").distinct().count()
    assert distinct == fact + rejected
    assert staging > distinct, "the duplicate defect is not present in the feed"


def test_defects_were_present_and_removed(wh):
    rej = {r["reject_reason"]: r["count"] for r in wh.rejected.groupBy("reject_reason").count().collect()}
    assert rej.get(clean.REJECT_ORPHAN, 0) > 0
    assert rej.get(clean.REJECT_NEGATIVE, 0) > 0
    assert wh.fact.filter(F.col("amount_cad") <= 0).count() == 0
    assert wh.fact.filter(~F.col("counterparty_country").isin(
        [r[0] for r in wh.dim_country.select("country_code").collect()])).count() == 0


def test_ground_truth_is_one_row_per_customer(spark):
    from ledgerhound.operators import features as fe
    camp = fe.campaigns(Monitoring(spark, SF_MID).dim_customer)
    assert camp.count() > 0
    assert camp.groupBy("customer_key").count().filter(F.col("count") > 1).count() == 0
    assert camp.filter(F.col("campaign_end_day") < F.col("campaign_start_day")).count() == 0
