"""Whole-window features, as-of replay, rules dated at detection, labels of several campaigns."""

import random
from decimal import Decimal

import pytest
from conftest import SF_MID
from helpers import fact
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerhound.operators import asof as ao
from ledgerhound.operators import features as fe
from ledgerhound.operators import rules
from ledgerhound.params import RuleParams
from ledgerhound.plans.q_features import FP
from ledgerhound.plans.q_scoring import Evaluation


def test_trailing_distinct_against_a_recount(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(3), rng.randrange(0, 130), rng.choice([*"abcdefg", None]), rng.randrange(1, 900)) for _ in range(400)]
    df = spark.createDataFrame([(c, d, "X" if k % 9 else "gone", p, Decimal(a)) for k, (c, d, p, a) in enumerate(rows)],
                               "customer_key long, date_key int, counterparty_country string, counterparty_id string, amount_cad decimal(18,2)")
    kept = [r for k, r in enumerate(rows) if k % 9]
    got = {(r.customer_key, r.date_key): r for r in fe.trailing_distinct(df, spark.createDataFrame([("X", 0)], "country_code string, is_high_risk int")).collect()}
    assert set(got) == {(c, d) for c, d, _, _ in kept}
    for (c, d), r in got.items():
        for w in (7, 30, 90):
            inside = [x for x in kept if x[0] == c and d - w < x[1] <= d]
            assert r[f"distinct_counterparties_{w}d"] == len({x[2] for x in inside if x[2] is not None})
            assert r[f"largest_txn_{w}d"] == max(x[3] for x in inside)


def test_replay_compares_every_alert_and_catches_a_leak_after_earlier_alerts(spark):
    e = Evaluation(spark, SF_MID)
    again = ao.replay(e.alerts, e.fact, e.dim_country, FP)
    alerts = e.alerts.count()
    clean = {r[0]: r[1] for r in ao.replay_violations(e.frame, again, FP).collect()}
    assert clean == {"compared_alerts": alerts, "compared_figures": alerts * len(ao.replayed_names(FP)), "as_of_replay": 0}
    # A frame that sees the next days, but only of customers who had an alert before.
    ahead = Window.partitionBy("customer_key").orderBy("date_key").rangeBetween(-29, 5)
    leak = e.daily.select("customer_key", "date_key", F.sum("vol_total").over(ahead).alias("leak"))
    leaky = e.frame.join(leak, ["customer_key", "date_key"]).withColumn("vol_total_30d", F.when(F.col("prior_alerts") > 0, F.col("leak")).otherwise(F.col("vol_total_30d")))
    found = {r[0]: r[1] for r in ao.replay_violations(leaky, again, FP).collect()}
    assert found["compared_alerts"] == alerts and found["as_of_replay"] > 0
    assert leaky.filter("prior_alerts = 0").count() > 0
    short = ao.replay_violations(e.frame.withColumn("active_days_90d", F.col("active_days_90d") + 1), again, FP).collect()
    assert {r[0]: r[1] for r in short}["as_of_replay"] == alerts


def test_r007_dated_at_detection(spark):
    p = RuleParams()
    rows = [(0, 9, 10, "credit", "cash"), (70, 9, 20000, "credit", "cash"), (72, 9, 4000, "credit", "cash"), (74, 9, 6000, "credit", "cash"), (75, 9, 50000, "credit", "cash")]
    r = rules.rule_r007(fact(spark, rows), p, rules.DETECTION).collect()
    assert [(x["date_key"], x["trigger_amount"], x["detail"]) for x in r] == [(74, 30000.0, "reactivated after 70 dormant days")]
    # What comes after the detection doesn't matter.
    assert [tuple(x) for x in rules.rule_r007(fact(spark, rows[:4]), p, rules.DETECTION).collect()] == [tuple(x) for x in r]
    assert rules.rule_r007(fact(spark, rows[:3]), p, rules.DETECTION).count() == 0


def test_r003_dated_at_detection(spark):
    p = RuleParams()
    rows = [(10, 9, 20000, "credit", "wire"), (10, 9, 900, "debit", "wire"), (11, 9, 10000, "debit", "wire"), (12, 8, 5000, "debit", "wire"),
            (12, 9, 1500, "debit", "wire"), (13, 8, 9000, "debit", "wire")]
    r = rules.rule_r003(fact(spark, rows), p, rules.DETECTION).collect()
    assert [(x["date_key"], x["trigger_amount"], x["trigger_txn_count"]) for x in r] == [(12, 20000.0, 3)]
    assert rules.rule_r003(fact(spark, rows[:4]), p, rules.DETECTION).count() == 0
    late = rows[:3] + [(13, 10, 9000, "debit", "wire")]
    assert rules.rule_r003(fact(spark, late), p, rules.DETECTION).count() == 0  # 73 hours later
    with pytest.raises(ValueError):
        rules.rule_r003(fact(spark, rows), p, "sometime")


def test_overlapping_campaigns_keep_one_row_an_alert(spark):
    rng = random.Random(2)
    alerts = [(f"a{k}", rng.randrange(4), rng.randrange(-40, 200)) for k in range(300)] + [("none", None, 5)]
    camps = [(rng.randrange(3), s, s + rng.randrange(0, 50)) for s in rng.choices(range(-30, 180), k=9)] + [(3, 50, None), (3, None, 60), (2, 100, 80)]
    a = spark.createDataFrame(alerts, "alert_id string, customer_key long, date_key int")
    c = spark.createDataFrame([(k, "t", s, e) for k, s, e in camps], "customer_key long, typology string, campaign_start_day int, campaign_end_day int")
    got = fe.label_alerts(a, c, 7)
    assert got.columns == ["alert_id", "customer_key", "date_key", "is_true_positive"]
    rows = {r.alert_id: r.is_true_positive for r in got.collect()}
    want = {i: int(any(k == cust and s is not None and e is not None and s - 7 <= d <= e + 7 for k, s, e in camps)) for i, cust, d in alerts}
    assert got.count() == len(alerts) and rows == want and 0 < sum(want.values()) < len(want)
