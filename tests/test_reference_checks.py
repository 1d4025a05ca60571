"""Checks modelled on the reference's own test suite: full-recall threshold and
monotone trade-off on seeded data, the leakage blocklist, strict prior-alert
counts, label sanity and rule-catalogue coverage."""

import random

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from ledgerhound.operators import evaluate as ev
from ledgerhound.operators import features as fe
from ledgerhound.operators import rules
from ledgerhound.plans.warehouse import Monitoring


def _scored(spark, seed, n=300):
    rnd = random.Random(seed)
    rows = [(f"A{i:04d}", round(rnd.random(), 3), int(rnd.random() < 0.15)) for i in range(n)]
    return spark.createDataFrame(rows, "alert_id string, score double, is_true_positive int")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_full_recall_threshold_reviews_every_positive(spark, seed):
    df = _scored(spark, seed)
    thr = ev.threshold_value(df)
    r = ev.evaluate_at_threshold(df, thr).first()
    assert r["recall"] == 1.0 and r["true_positives_missed"] == 0
    pdf = df.toPandas()
    assert thr == pdf.loc[pdf.is_true_positive == 1, "score"].min()


@pytest.mark.parametrize("seed", [4, 5])
def test_tradeoff_is_monotone_in_the_target(spark, seed):
    valid, holdout = _scored(spark, seed), _scored(spark, seed + 100)
    curve = ev.tradeoff_curve(valid, holdout, (1.0, 0.99, 0.95, 0.9, 0.8)).toPandas() \
        .sort_values("recall_target")
    assert curve.threshold.is_monotonic_decreasing
    assert curve.holdout_alerts_reviewed.is_monotonic_increasing
    assert curve.holdout_volume_deferred_pct.is_monotonic_decreasing
    assert (curve.validation_recall >= curve.recall_target - 1e-12).all()


def test_feature_matrix_has_81_inputs_and_no_leaks(spark):
    import __spark_entry__ as entry
    cols = entry.queries()["feature_matrix"](spark, SF_SMALL).columns
    inputs = [c for c in cols if c != "alert_id"]
    assert len(inputs) == 81
    assert not set(inputs) & set(fe.FEATURE_BLOCKLIST)
    assert "is_true_positive" not in inputs and "split" not in inputs


def test_prior_alerts_are_strictly_before(spark):
    alerts = Monitoring(spark, SF_SMALL).alerts
    got = fe.alert_context(alerts).select("alert_id", "customer_key", "date_key", "prior_alerts",
                                          "days_since_prior_alert").toPandas()
    a = alerts.select("customer_key", "date_key").toPandas()
    want = got.apply(lambda r: int(((a.customer_key == r.customer_key) & (a.date_key < r.date_key)).sum()), axis=1)
    assert (got.prior_alerts == want).all()
    first = got.groupby("customer_key").date_key.transform("min") == got.date_key
    assert (got.loc[first, "prior_alerts"] == 0).all()
    assert (got.loc[first, "days_since_prior_alert"] == fe.NO_PRIOR_ALERT).all()


def test_labels_are_binary_and_rules_come_from_the_catalogue(spark):
    import __spark_entry__ as entry
    labels = entry.queries()["labels"](spark, SF_SMALL).toPandas()
    assert set(labels.is_true_positive.unique()) <= {0, 1}
    alerts = Monitoring(spark, SF_SMALL).alerts.select("rule_id").distinct().toPandas()
    catalogue = {r[0] for r in rules.RULE_CATALOGUE}
    assert len(catalogue) == 8 and set(alerts.rule_id) <= catalogue
    grain = Monitoring(spark, SF_SMALL).alerts.groupBy("rule_id", "customer_key", "date_key").count()
    assert grain.filter(F.col("count") > 1).count() == 0


@pytest.mark.parametrize("target", [0.9, 0.75])
def test_threshold_at_a_required_recall(spark, target):
    import math
    df = _scored(spark, 9)
    thr = ev.threshold_value(df, required_recall=target)
    pos = sorted((r.score for r in df.filter("is_true_positive = 1").collect()), reverse=True)
    assert thr == pos[math.ceil(target * len(pos)) - 1]
    assert ev.evaluate_at_threshold(df, thr).first()["recall"] >= target
    assert ev.threshold_value(df, required_recall=1.0) == pos[-1]
