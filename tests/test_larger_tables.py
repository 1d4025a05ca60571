"""What larger tables ask of the plans: the small side is never shuffled with the lines, and sorts and aggregates stay narrow."""

import datetime as dt
import time
from decimal import Decimal

import pytest
from conftest import SF_SMALL
from helpers import FACT_SCHEMA

from ledgerhound import session
from ledgerhound.operators import rules
from ledgerhound.plans import q_quality, store, warehouse
from ledgerhound.plans.catalog import queries
from ledgerhound.sources import ledgers

DAY = dt.datetime(1996, 1, 2)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def tables(spark, folder):
    line = lambda order, number, supplier, price: (order, number, DAY, 2, supplier, price, 1.0, 0.0, 0.0, "R", "F")
    rows = {
        "lineitem": ([line(1, 1, 7, 10.5), line(1, 1, 7, 9.5), line(1, 2, 8, 3.0), line(2, 1, 99, 4.0), line(3, 1, 7, 4.0), line(None, 1, 7, 4.0)],
                     "l_orderkey long, l_linenumber int, l_shipdate timestamp, l_partkey long, l_suppkey long, l_extendedprice double, l_quantity double, "
                     "l_discount double, l_tax double, l_returnflag string, l_linestatus string"),
        "orders": ([(1, 9), (1, 10), (2, 9)], "o_orderkey long, o_custkey long"),
        "supplier": ([(7, 0), (8, None), (99, 5)], "s_suppkey long, s_nationkey int"),
        "nation": ([(0, "A", 1), (5, "B", 3)], "n_nationkey int, n_name string, n_regionkey int")}
    for name, (values, schema) in rows.items():
        spark.createDataFrame(values, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_suppliers_meet_the_lines_unshuffled_by_their_own_size(spark, tmp_path):
    at = tables(spark, tmp_path)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100k")  # over the supplier file, under the size that a join with nations is taken for
    try:
        lines = ledgers.lin_lines(spark, at)
        assert "hashpartitioning(l_suppkey" not in plan(lines) and "hashpartitioning(s_suppkey" not in plan(lines)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    got = sorted((r.l_orderkey, r.l_linenumber, r.l_extendedprice, r.customer_id, r.counterparty_country) for r in lines.collect())
    assert got == [(1, 1, 9.5, "C10", "A"), (1, 1, 9.5, "C9", "A"), (1, 1, 10.5, "C10", "A"), (1, 1, 10.5, "C9", "A"), (2, 1, 4.0, "C9", "B")]


def test_the_dedup_sorts_numbers_and_each_column_once(spark, tmp_path):
    lines = ledgers.lin_lines(spark, tables(spark, tmp_path))
    first = ledgers.first_lines(lines, "customer_id", "counterparty_country")
    assert "txn_id" not in plan(first) and "_ingest" not in plan(first)
    assert sorted((r.l_orderkey, r.l_linenumber, r.l_extendedprice, r.customer_id) for r in first.collect()) == [(1, 1, 9.5, "C10"), (2, 1, 4.0, "C9")]


def test_high_risk_countries_of_a_day_need_no_sort(spark):
    codes = [f"C{k:03}" for k in range(130)]  # more than two whole numbers of bits
    country = spark.createDataFrame([(c, int(c != "C007")) for c in [*codes, codes[2]]], "country_code string, is_high_risk int")
    row = lambda customer, code, amount, channel="wire": ("t", 1, 1, customer, code, "P", 9, Decimal(amount), "credit", channel, Decimal(amount))
    fact = spark.createDataFrame([row(1, "C129", 6000), row(1, "C000", 6000), row(1, "C064", 7000), row(1, "C064", 7000), row(1, "C007", 9000), row(1, "C005", 9000, "cash"),
                                  row(1, "C006", 10), row(2, "C002", 5000), row(3, None, 9000), row(3, "X", 9000)], FACT_SCHEMA)
    got = rules.customer_day_rules(fact, country)
    assert "ObjectHashAggregate" not in plan(got) and "SortAggregate" not in plan(got)
    assert sorted((r.customer_key, r.trigger_amount, r.trigger_txn_count, r.detail.split(": ")[1]) for r in got.collect()) == \
        [(1, 26000.0, 4, "C000,C064,C129"), (2, 10000.0, 2, "C002")]
    assert rules.rule_r004(fact, country.filter("is_high_risk = 0")).count() == 0


def test_views_that_are_not_read_write_nothing_but_work(spark):
    was = spark.conf.get("spark.ledgerhound.store.namespace")
    spark.conf.set("spark.ledgerhound.store.namespace", was + "-views")
    built = []
    try:
        with pytest.MonkeyPatch.context() as patch:
            real = store.stored
            for module in (warehouse, q_quality):
                patch.setattr(module, "stored", lambda s, sf, name, build, params=(): built.append(name) or real(s, sf, name, build, params))
            got = queries()["sql_rule_summary"](spark, SF_SMALL)
            assert got.count() == 8 and not set(built) & {"lin_lines", "lin_first_lines", "lin_fact", "lin_alerts", "lin_rejected", "lin_dq_result"}
        want = warehouse.Warehouse(spark, SF_SMALL).fact
        lazy = spark.table("fact_transaction")
        assert lazy.count() == want.count() > 0 and lazy.exceptAll(want).count() == 0
        assert spark.table("mart_dq").columns == ["check_id", "check_name", "dimension", "severity", "metric_value", "threshold", "status", "is_pass"]
    finally:
        spark.conf.set("spark.ledgerhound.store.namespace", was)


def test_the_controls_parse_the_feed_once(spark):
    got = queries()["quarantine_unparsable"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert sum("from_csv" in line and "Project" in line for line in got.splitlines()) <= 1
    assert sum("Relation" in line and line.rstrip().endswith(" text") for line in got.splitlines()) == 2  # the lines themselves are counted too


def test_the_landed_lines_are_compressed_and_whole(spark, monkeypatch):
    monkeypatch.setattr(q_quality, "LINES_PER_FILE", 500)
    path, order = q_quality.landed_with_bad_lines(spark, SF_SMALL)
    lines = spark.read.text(path)
    assert lines.count() == warehouse.Warehouse(spark, SF_SMALL).staging.count() > 0
    files = lines.inputFiles()
    assert len(files) >= lines.count() / 500 and all(f.endswith(".txt.gz") for f in files)


def test_a_written_table_leaves_no_shuffle_files(spark, tmp_path):
    env = spark._jvm.org.apache.spark.SparkEnv.get()

    def shuffled():
        return {name for f in env.blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n") if (name := f.rsplit("/", 1)[-1]).startswith("shuffle_")}
    was, conf = shuffled(), spark.conf.get(session.CLEANUP_CONF)
    path = store._written(spark, str(tmp_path / "table"), lambda: spark.range(1000).repartition(3, "id"))
    for _ in range(40):  # they go in the background
        if shuffled() <= was:
            break
        time.sleep(0.25)
    assert shuffled() <= was
    assert spark.read.parquet(path).count() == 1000 and spark.conf.get(session.CLEANUP_CONF) == conf
