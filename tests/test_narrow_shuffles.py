"""The LIN feed and its controls send narrow rows: what the wide ones gave stays the same."""

import datetime as dt
import re
from decimal import Decimal

from helpers import FACT_SCHEMA

from ledgerhound.operators import clean, quality
from ledgerhound.sources import ledgers

DAY = dt.datetime(1996, 1, 2)
LINES = "l_orderkey long, l_linenumber int, l_shipdate timestamp, l_partkey long, l_suppkey long, l_extendedprice double, l_quantity double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, customer_id string, counterparty_country string"


def lines(spark):
    one = lambda order, line, day, part, customer, country: (order, line, day, part, 7, 10.5, 1.0, 0.0, 0.0, "R", "F", customer, country)
    return spark.createDataFrame([
        one(1, 1, DAY, 2, "C9", "A"), one(1, 1, DAY, 2, "C10", "A"), one(1, 1, DAY, 2, "C10", None),  # equal lines of several customers
        one(1, 2, DAY, 500, "C9", "b "), one(1, 2, None, 500, "C9", "b "), one(1, 3, DAY, 997, None, "A"), one(1, 3, DAY, 997, None, "A"),
        one(2, None, DAY, 2, "C9", "A"), one(2, 1, DAY, 3, "C123456789012345678", "A")], LINES)


def test_first_lines_are_the_first_rows_of_the_whole_feed(spark):
    few = lines(spark)
    got = ledgers.lin_feed(ledgers.first_lines(few, "customer_id", "counterparty_country"))
    want = clean.dedup_first(ledgers.lin_feed(few), "txn_id", "_ingest")
    assert got.columns == want.columns and got.exceptAll(want).count() == want.exceptAll(got).count() == 0 and got.count() == 5
    accounts = {r.txn_id: r.account_id for r in got.collect()}
    assert accounts["1-1"] == "A10" and accounts["1-2"] == "A9999999" and accounts["1-3"] is None and accounts["2-1"] == "A123456789012345678"


def test_the_dedup_sends_no_derived_column(spark):
    plan = ledgers.first_lines(lines(spark), "customer_id", "counterparty_country")._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" in plan and not re.search("account_id|day_index|amount_cad|direction|channel|counterparty_id", plan)


def test_orphans_are_counted_by_key_before_a_dimension_meets_them(spark):
    row = lambda txn, day, account, customer, country: (txn, day, account, customer, country, "P1", 9, Decimal("5.00"), "credit", "cash", Decimal("5.00"))
    fact = spark.createDataFrame([row("a", 1, 1, 1, "X"), row("b", 1, 1, 2, "Y"), row("c", 3, None, 1, None), row("d", None, 9, None, "X"), row("e", 3, 9, 9, "X")], FACT_SCHEMA)
    staging = spark.createDataFrame([("a", "A1", "C1", Decimal("5.00")), ("b", "A1", "C1", Decimal("7.50")), ("c", "A1", "C9", Decimal("2.00")), ("d", "A9", "C1", Decimal("1.00")),
                                     ("e", None, None, Decimal("3.00")), ("f", "A1", "C1", Decimal("-4.00"))], "txn_id string, account_id string, customer_id string, amount_cad decimal(18,2)")
    accounts = spark.createDataFrame([(1, "A1"), (1, "A1")], "account_key long, account_id string")
    customers = spark.createDataFrame([(1, "C1"), (2, "C2")], "customer_key long, customer_id string")
    countries = spark.createDataFrame([("X",)], "country_code string")
    alerts = spark.createDataFrame([(1,), (5,)], "customer_key long")
    t = quality.dq_tallies(staging, staging, fact, staging.limit(0), accounts, customers, countries, alerts, customers)
    got = t.first()
    assert (got.orphan_acct, got.orphan_cust, got.country_orphan, got.alert_orphan, got.ddistinct) == (3, 2, 2, 1, 2)
    assert (got.acc_amt, got.dmin, got.dmax, got.stg_distinct) == (Decimal("12.50"), 1, 3, 6)
    plan = t._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"keys=\[account_key#\d+L?, customer_key", plan)
