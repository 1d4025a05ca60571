"""Fits are checked by what defines them, on data; each check is shown to fail on a wrong model."""

import numpy as np
import pytest
from conftest import SF_MID
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ledgerhound.operators import explain as ex
from ledgerhound.operators import modeling as md
from ledgerhound.params import ModelParams
from ledgerhound.plans.q_models import MP, ModelRun


@pytest.fixture(scope="module")
def run(spark):
    return ModelRun.get(spark, SF_MID)


def gradient(m, coefficients, intercept):
    """Largest slope of the penalised loss C * sum(w * loss) + |b|^2 / 2, relative to the slope at zero."""
    rows = m.train.select(vector_to_array("features").alias("x"), "w", md.Y).collect()
    x, w, y = (np.array([r[k] for r in rows]) for k in range(3))

    def slope(b, c):
        p = 1 / (1 + np.exp(-(x @ b + c)))
        return np.abs(np.r_[MP.logistic_c * (x.T @ (w * (p - y))) + b, (w * (p - y)).sum()]).max()

    return slope(coefficients, intercept) / slope(0 * coefficients, 0.0)


def test_logistic_gradient_vanishes(run):
    b, c = run.logit.coefficients.toArray(), run.logit.intercept
    assert gradient(run, b, c) < 1e-3
    assert gradient(run, b * 1.2, c) > 1e-2  # the check sees a model that is off


def test_scores_separate_the_training_labels(run):
    s = run.scored.filter("split = 'train'")
    for score in ("score_logistic", "score_gbm"):
        lo, hi = (s.filter(f"is_true_positive = {k}").agg(F.avg(score)).first()[0] for k in (0, 1))
        assert hi > lo + 0.1
        ends = run.scored.agg(F.min(score), F.max(score), F.count(F.when(F.col(score).isNull(), 1))).first()
        assert ends[0] >= 0 and ends[1] <= 1 and ends[2] == 0


def test_unseen_levels_and_nulls_are_zeros(spark):
    train = spark.createDataFrame([("a", 1.0)] * 5 + [("rare", 2.0)] + [(None, 3.0)], "c string, x double")
    prep = md.fit_prep(train, ["x"], ["c"], ModelParams(min_category_rows=3))
    assert prep.names == ["x", "c_a", "c_infrequent"] and prep.inputs == ["x", "c", "c"]
    new = spark.createDataFrame([("a", 0.0), ("rare", 0.0), ("never", 0.0), (None, 0.0)], "c string, x double")
    got = [list(r[0])[1:] for r in md.transform(new, prep).select(vector_to_array("features")).collect()]
    assert got == [[1.0, 0.0], [0.0, 1.0], [0.0, 0.0], [0.0, 0.0]]


def test_infinity_is_zero_in_the_matrix(spark):
    from ledgerhound.operators.features import feature_matrix
    df = spark.createDataFrame([("i", float("inf")), ("m", float("-inf")), ("n", float("nan")), ("z", None), ("v", 2.5)], "alert_id string, x double")
    assert {r.alert_id: r.x for r in feature_matrix(df).collect()} == {"i": 0.0, "m": 0.0, "n": 0.0, "z": 0.0, "v": 2.5}


def test_importance_has_one_row_per_feature(spark, run):
    rows = md.feature_importance(run.gbt, run.prep, spark).collect()
    assert len(rows) == 81 and abs(sum(r.importance for r in rows) - 1) < 1e-6


def test_fewer_than_three_drivers(spark):
    from ledgerhound.operators.explain import reason_codes
    df = spark.createDataFrame([("a", [("up", 1.0), ("down", -2.0)]), ("b", [("down", -1.0)]), ("c", [("zero", 0.0)])],
                               "alert_id string, contrib array<struct<label:string,value:double>>")
    got = {r.alert_id: (r.reason_1, r.reason_2, r.top_mitigant, r.reason_summary) for r in reason_codes(df).collect()}
    assert got == {"a": ("up", "", "down", "up"), "b": ("", "", "down", ""), "c": ("", "", "", "")}


def test_shapley_values_add_up_to_the_margin(spark, run):
    from ledgerhound.operators import boosting as bo
    from ledgerhound.operators import explain as ex
    rows = run.scored.join(run.x.select("alert_id", vector_to_array("features").alias("x")), "alert_id").limit(300).collect()
    x = np.array([r.x for r in rows])
    margin = bo.shapley_values(run.gbt, x).sum(1) + bo.expected_margin(run.gbt)
    assert np.allclose(margin, run.gbt.margin(x), atol=1e-8)
    assert np.allclose([r.score_gbm for r in rows], 1 / (1 + np.exp(-margin)), atol=1e-9)
    got = ex.boosted_attribution(run.x, run.gbt, run.prep.inputs).collect()
    assert len(got) == 81 and got[0].mean_abs_contribution > 0


def test_trees_keep_their_bounds(run):
    assert len(run.gbt.trees) <= MP.n_estimators
    for t in run.gbt.trees:
        leaves = t.left < 0
        assert 2 <= leaves.sum() <= MP.num_leaves and t.cover[leaves].min() >= MP.min_child_samples
        assert np.allclose(t.cover[~leaves], t.cover[t.left[~leaves]] + t.cover[t.right[~leaves]])


def test_loaded_artefact_scores_like_the_fitted_models(spark, run):
    from ledgerhound.plans.catalog import queries
    loaded = {r.alert_id: r for r in queries()["model_save_load"](spark, SF_MID).collect()}
    for r in run.scored.collect():
        assert abs(loaded[r.alert_id].score_gbm - r.score_gbm) < 1e-9 and abs(loaded[r.alert_id].score_logistic - r.score_logistic) < 1e-9


def test_reason_codes_sort_only_the_drivers(spark):
    rows = [("a", [("x", 1.0), ("y", 3.0), ("z", 3.0), ("u", -2.0), ("t", -2.0), ("s", 0.5), ("r", 0.0)]), ("b", [("x", 0.0), ("y", -0.0)]),
            ("c", [("x", float("nan")), ("y", 2.0)]), ("d", [])]
    got = ex.reason_codes(spark.createDataFrame(rows, "alert_id string, contrib array<struct<label: string, value: double>>"))
    assert [tuple(r) for r in got.orderBy("alert_id").collect()] == [
        ("a", "z", "y", "x", "t", "z; y; x"), ("b", "", "", "", "", ""), ("c", "x", "y", "", "", "x; y"), ("d", "", "", "", "", "")]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("sort_array(") == 1 and "sort_array(filter(" in plan
