"""Dedup order of operations, surrogate keys and exact global ranks."""

import random

import pandas as pd
from pyspark.sql import functions as F

from helpers import fact

from ledgerhound.functions.ranking import dense_sequence, running_totals, value_ranks
from ledgerhound.operators import clean, evaluate as ev, features as fe
from ledgerhound.operators.quality import DataQualityError, dq_gate


def test_dedup_first_copy_wins(spark):
    rows = [("T1", 1, 100.0, "clean"), ("T1", 2, -5.0, "corrupt"), ("T2", 2, 50.0, "clean"), ("T2", 1, -1.0, "bad")]
    df = spark.createDataFrame(rows, "txn_id string, seq int, amount double, tag string")
    out = {r["txn_id"]: r["tag"] for r in clean.dedup_first(df, "txn_id", "seq").collect()}
    assert out == {"T1": "clean", "T2": "bad"}


def test_dense_sequence_matches_row_number(spark):
    ids = [f"C{i}" for i in range(2000)]
    random.Random(1).shuffle(ids)
    df = spark.createDataFrame([(i,) for i in ids], "customer_id string")
    got = {r[0]: r[1] for r in dense_sequence(df, "customer_id", "k", rows_per_bucket=100).collect()}
    want = {c: i + 1 for i, c in enumerate(sorted(ids))}
    assert got == want


def test_value_ranks_match_pandas_average_rank(spark):
    rnd = random.Random(3)
    vals = [round(rnd.random(), 2) for _ in range(3000)]
    df = spark.createDataFrame([(i, v, int(rnd.random() < .1)) for i, v in enumerate(vals)], "id long, score double, y int")
    pct = {r["id"]: r["score_percentile"] for r in ev.percentile_and_tier(df, score="score").collect()}
    pd_pct = pd.Series(vals).rank(pct=True).round(4)
    assert all(abs(pct[i] - pd_pct[i]) < 1e-9 for i in range(len(vals)))


def test_running_totals_with_hot_value(spark):
    # a third of the rows share one score: ties collapse to one distinct row
    vals = [0.5] * 1000 + [i / 4000 for i in range(2000)] + [0.6 + i / 4000 for i in range(10)]
    df = spark.createDataFrame([(v,) for v in vals], "score double")
    r = value_ranks(df, "score").filter(F.col("score") == 0.5).first()
    assert r["cnt"] == 1000 and r["less_n"] == sum(1 for v in vals if v < 0.5)


def test_tier_cut_uses_positions(spark):
    df = spark.createDataFrame([(f"A{i:03d}", 1.0 - i / 100, i % 7 == 0) for i in range(100)],
                               "alert_id string, score double, p boolean") \
        .withColumn("is_true_positive", F.col("p").cast("int"))
    t = {r["tier"]: r["alerts"] for r in ev.tier_policy(df).collect()}
    assert t == {"T1_same_day": 10, "T2_five_day": 30, "T3_thirty_day": 60}


def test_roc_and_ap_against_bruteforce(spark):
    rnd = random.Random(5)
    rows = [(i, round(rnd.random(), 1), int(rnd.random() < 0.3)) for i in range(400)]
    df = spark.createDataFrame(rows, "alert_id long, score double, is_true_positive int")
    pos = [s for _, s, y in rows if y == 1]
    neg = [s for _, s, y in rows if y == 0]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert abs(ev.roc_auc(df).first()[0] - round(auc, 6)) < 1e-9
    ap = 0.0
    for s in sorted({s for _, s, _ in rows}, reverse=True):
        ge = [y for _, v, y in rows if v >= s]
        gain = sum(y for _, v, y in rows if v == s)
        ap += gain / len(pos) * (sum(ge) / len(ge))
    assert abs(ev.average_precision(df).first()[0] - round(ap, 6)) < 1e-9


def test_sparse_windows_equal_dense_grid(spark):
    f = fact(spark, [(0, 9, 100, "credit", "cash"), (29, 9, 200, "credit", "cash"), (30, 9, 400, "debit", "wire")])
    cc = spark.createDataFrame([("CA", 0)], "country_code string, is_high_risk int")
    daily = fe.customer_day(f, cc)
    sparse = {r["date_key"]: r["vol_total_30d"] for r in fe.rolling_features(daily).collect()}
    grid = fe.dense_grid(daily, 31).toPandas().sort_values("date_key")
    dense = grid["vol_total"].astype(float).rolling(30, min_periods=1).sum().tolist()
    assert {d: float(v) for d, v in sparse.items()} == {0: dense[0], 29: dense[29], 30: dense[30]}


def test_dq_gate_raises_on_blocking_failure(spark):
    res = spark.createDataFrame([("DQ01", "blocking", "FAIL"), ("DQ04", "warning", "FAIL")],
                                "check_id string, severity string, status string")
    try:
        dq_gate(res)
    except DataQualityError as e:
        assert "DQ01" in str(e) and "DQ04" not in str(e)
    else:
        raise AssertionError("gate did not raise")


def test_running_totals_with_many_buckets_and_a_composite_key(spark):
    # Hundreds of range partitions over a two-column key.
    rnd = random.Random(11)
    rows = list({(rnd.randrange(60), f"k{rnd.randrange(10_000):05d}") for _ in range(6000)})
    df = spark.createDataFrame([(a, b, a % 7) for a, b in rows], "a int, b string, w int")
    out = running_totals(df, ["a", "b"], {"w": F.col("w")}, rows_per_bucket=10, min_buckets=500)
    got = {(r["a"], r["b"]): r["before_w"] for r in out.collect()}
    acc, want = 0, {}
    for a, b in sorted(rows):
        want[(a, b)] = acc
        acc += a % 7
    assert got == want
    assert out.select("total_w").distinct().first()[0] == acc
