"""Boosted trees against a search that tries every split of every leaf, and Shapley values against all subsets."""

import itertools
import math

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from ledgerhound.operators import boosting as bo


def data(n=400, seed=3):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.integers(0, 6, n), rng.integers(0, 2, n), rng.integers(0, 12, n) / 4, np.zeros(n)], 1)
    y = (rng.random(n) < 1 / (1 + np.exp(-(x[:, 0] - 2.5 + 2 * x[:, 1] * (x[:, 2] > 1.2))))).astype(float)
    w = np.where(y == 1, 1.5, 0.75) * rng.uniform(0.8, 1.2, n)  # no two splits gain the same
    return x, y, w


def brute(x, y, w, n_trees, rate, leaves, least):
    """Margins, and the gains of the splits in the order in which best-first growth makes them."""
    margin, gains = np.full(len(y), np.log((w * y).sum() / (w * (1 - y)).sum())), []
    for _ in range(n_trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = w * (p - y), w * p * (1 - p)
        obj = lambda r: g[r].sum() ** 2 / h[r].sum()

        def best(rows):
            found = (0.0, None)
            for f in range(x.shape[1]):
                for at in np.unique(x[rows, f])[:-1]:
                    a, b = rows[x[rows, f] <= at], rows[x[rows, f] > at]
                    if min(len(a), len(b)) >= least:
                        gain = obj(a) + obj(b) - obj(rows)
                        if gain > found[0] + 1e-9:
                            found = (gain, (a, b))
            return found
        own = [(*best(np.arange(len(y))), np.arange(len(y)))]
        while len(own) < leaves:
            k = max(range(len(own)), key=lambda i: own[i][0])
            gain, split, _ = own[k]
            if split is None:
                break
            gains.append(gain)
            own[k:k + 1] = [(*best(r), r) for r in split]
        for _, _, rows in own:
            margin[rows] -= rate * g[rows].sum() / h[rows].sum()
    return margin, gains


@pytest.mark.parametrize("partitions, leaves, least", [(1, 6, 20), (4, 31, 5), (3, 2, 40)])
def test_growth_equals_trying_every_split(spark, monkeypatch, partitions, leaves, least):
    monkeypatch.setattr(bo, "CHECKPOINT_TREES", 2)
    x, y, w = data()
    df = spark.createDataFrame([(Vectors.dense(a), float(b), float(c)) for a, b, c in zip(x, y, w, strict=True)], ["features", "y", "w"]).repartition(partitions)
    model = bo.fit(df, "y", 3, 0.3, leaves, least)
    margin, gains = brute(x, y, w, 3, 0.3, leaves, least)
    assert np.allclose(model.margin(x), margin, atol=1e-9)
    assert np.allclose(sorted(g for t in model.trees for g in t.gain[t.left >= 0]), sorted(gains), atol=1e-6)
    assert all((t.left < 0).sum() <= leaves and t.cover[t.left < 0].min() >= least for t in model.trees)
    back = bo.BoostedTrees.read(model.frame(spark))
    assert np.array_equal(back.margin(x), model.margin(x))
    got = bo.score(model, df, "p").collect()
    assert np.allclose([r.p for r in got], 1 / (1 + np.exp(-model.margin(np.array([r.features.toArray() for r in got])))))


def test_one_class_or_no_rows(spark):
    rows = [(Vectors.dense([float(k)]), 1.0, 1.0) for k in range(9)]
    df = spark.createDataFrame(rows, ["features", "y", "w"])
    assert bo.fit(df, "y", 3, 0.1, 4, 1).trees == [] and bo.fit(df.limit(0), "y", 3, 0.1, 4, 1).trees == []
    assert bo.score(bo.fit(df, "y", 3, 0.1, 4, 1), df, "p").filter("p > 0.99").count() == 9


def enumerated(model, row, n):
    """Shapley values by all subsets; a tree's value of a subset weighs both children of an unknown input by their rows."""
    def value(tree, node, known):
        if tree.left[node] < 0:
            return tree.value[node]
        a, b = tree.left[node], tree.right[node]
        if tree.input[node] in known:
            return value(tree, a if row[tree.input[node]] <= tree.at[node] else b, known)
        return (tree.cover[a] * value(tree, a, known) + tree.cover[b] * value(tree, b, known)) / tree.cover[node]

    v = {s: sum(value(t, 0, set(s)) for t in model.trees) for k in range(n + 1) for s in itertools.combinations(range(n), k)}
    out = np.zeros(n)
    for f in range(n):
        for s in v:
            if f not in s:
                out[f] += math.factorial(len(s)) * math.factorial(n - len(s) - 1) / math.factorial(n) * (v[tuple(sorted((*s, f)))] - v[s])
    return out, v[()]


def test_shapley_values_equal_all_subsets(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 5, (300, 5)).astype(float)
    y = ((x[:, 0] > 2) ^ (x[:, 1] + x[:, 2] > 4) | (x[:, 4] == 1)).astype(float)
    df = spark.createDataFrame([(Vectors.dense(a), float(b), 1.0) for a, b in zip(x, y, strict=True)], ["features", "y", "w"])
    model = bo.fit(df, "y", 4, 0.5, 12, 8)
    assert any(max(len(p.input) for p in bo.leaf_paths(t)) >= 4 for t in model.trees)
    got = bo.shapley_values(model, x[:25])
    for row, have in zip(x[:25], got, strict=True):
        want, base = enumerated(model, row, 5)
        assert np.allclose(have, want, atol=1e-9) and abs(base + model.base - bo.expected_margin(model)) < 1e-9
    assert np.allclose(got.sum(1) + bo.expected_margin(model), model.margin(x[:25]))


@pytest.mark.parametrize("group, leaves, least", [(3, 6, 20), (1, 31, 5), (16, 2, 40)])
def test_growth_over_many_partitions_equals_trying_every_split_and_sends_no_histogram_to_the_driver(spark, monkeypatch, group, leaves, least):
    monkeypatch.setattr(bo, "CHECKPOINT_TREES", 2)
    monkeypatch.setattr(bo, "ONE_TASK_ROWS", 90)
    monkeypatch.setattr(bo, "PARTITION_ROWS", 90)
    monkeypatch.setattr(bo, "GROUP_INPUTS", group)
    sent = []
    collect = bo.RDD.collect

    def counted(rdd):
        out = collect(rdd)
        sent.extend(a.size for _, nodes in out for _, node in nodes for a in vars(node).values() if isinstance(a, np.ndarray))
        return out
    monkeypatch.setattr(bo.RDD, "collect", counted)
    x, y, w = data()
    df = spark.createDataFrame([(Vectors.dense(a), float(b), float(c)) for a, b, c in zip(x, y, w, strict=True)], ["features", "y", "w"])
    model = bo.fit(df, "y", 3, 0.3, leaves, least)
    margin, gains = brute(x, y, w, 3, 0.3, leaves, least)
    assert np.allclose(model.margin(x), margin, atol=1e-9)
    assert np.allclose(sorted(g for t in model.trees for g in t.gain[t.left >= 0]), sorted(gains), atol=1e-6)
    assert sent and max(sent) == 3


def test_rows_of_one_partition_grow_their_trees_in_one_job(spark, monkeypatch):
    x, y, w = data()
    df = spark.createDataFrame([(Vectors.dense(a), float(b), float(c)) for a, b, c in zip(x, y, w, strict=True)], ["features", "y", "w"])
    jobs = []
    collect = bo.RDD.collect
    monkeypatch.setattr(bo.RDD, "collect", lambda rdd: jobs.append(rdd) or collect(rdd))
    assert len(bo.fit(df, "y", 12, 0.3, 6, 20).trees) == 12 and len(jobs) == 1


@pytest.mark.parametrize("few", [0, 100, 1_024])
def test_one_task_sums_only_the_leaves_that_best_first_growth_splits(monkeypatch, few):
    monkeypatch.setattr(bo, "FEW_ROWS", few)
    x, y, w = data(2000)
    edges = [np.unique(c) for c in x.T]
    bins = np.stack([np.searchsorted(e, c) for e, c in zip(edges, x.T, strict=True)], 1).astype(np.uint8)
    parts = [(bins[k:k + 300], y[k:k + 300], w[k:k + 300], np.full(len(y[k:k + 300]), np.log((w * y).sum() / (w * (1 - y)).sum()))) for k in range(0, 2000, 300)]
    summed = []
    plain = bo.OwnHistograms._summed
    monkeypatch.setattr(bo.OwnHistograms, "_summed", lambda own, rows: summed.append(len(rows)) or plain(own, rows))
    monkeypatch.setattr(bo, "BLOCK_ROWS", 300)
    histograms = bo.OwnHistograms(edges, 20, parts)
    model = bo.BoostedTrees(float(parts[0][3][0]))
    for _ in range(3):
        tree, binned, order = bo.Grower(edges, 5).grow(histograms, 0.3)
        histograms.learn(order, binned[4])
        model.trees.append(tree)
    margin, gains = brute(x, y, w, 3, 0.3, 5, 20)
    assert len(summed) == 3 + len(gains) == 15  # a root and one child for each split
    assert np.allclose(histograms.margin, margin, atol=1e-9) and np.allclose(model.margin(x), margin, atol=1e-9)


@pytest.mark.parametrize("joint_bins, columns", [(1, 8), (4, 6), (256, 3), (4_096, 2)])
def test_inputs_of_few_bins_are_added_up_as_one_column(monkeypatch, joint_bins, columns):
    monkeypatch.setattr(bo, "JOINT_BINS", joint_bins)
    monkeypatch.setattr(bo, "FEW_ROWS", 0)
    monkeypatch.setattr(bo, "BLOCK_ROWS", 300)
    sizes, n = [2, 255, 6, 1, 2, 10, 2, 1, 3], 2000
    rng = np.random.default_rng(7)
    bins = np.stack([rng.integers(0, s, n) for s in sizes], 1).astype(np.uint8)
    y, w = rng.integers(0, 2, n).astype(float), rng.uniform(0.5, 1.5, n)
    own = bo.OwnHistograms([np.arange(s, dtype=float) for s in sizes], 20, [(bins, y, w, rng.normal(size=n))])
    own.root()
    calls, plain = [], np.bincount
    monkeypatch.setattr(bo.np, "bincount", lambda *a, **k: calls.append(1) or plain(*a, **k))
    for rows in (np.arange(n), np.flatnonzero(y == 1), np.array([5]), np.arange(0)):
        calls.clear()
        got = own._summed(rows)
        assert len(calls) == 3 * columns * -(-len(rows) // 300)
        want = [np.concatenate([plain(bins[rows, k], v[rows], s) for k, s in enumerate(sizes)]) for v in (own.g, own.h, np.ones(n))]
        assert np.allclose(got, want, atol=1e-12) and np.array_equal(got[2], want[2])


def test_shapley_values_count_the_patterns_of_few_conditions_without_sorting(monkeypatch):
    rng = np.random.default_rng(11)
    x = rng.integers(0, 5, (300, 6)).astype(float)
    edges = [np.unique(c) for c in x.T]
    y = ((x[:, 0] + x[:, 1] > 4) ^ (x[:, 2] > x[:, 3])).astype(float)
    own = bo.OwnHistograms(edges, 5, [(x.astype(np.uint8), y, np.ones(300), np.zeros(300))])
    model = bo.BoostedTrees(0.0, [bo.Grower(edges, 20).grow(own, 0.5)[0]])
    assert max(len(p.input) for p in bo.leaf_paths(model.trees[0])) >= 3
    monkeypatch.setattr(bo, "COUNTED_CONDITIONS", 0)
    want = bo.shapley_values(model, x)
    monkeypatch.setattr(bo, "COUNTED_CONDITIONS", 12)
    monkeypatch.setattr(bo.np, "unique", None)
    assert np.array_equal(bo.shapley_values(model, x), want)
    assert np.allclose(want.sum(1) + bo.expected_margin(model), model.margin(x))
