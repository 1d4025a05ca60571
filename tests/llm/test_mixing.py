import math
from collections import Counter

import numpy as np
import pytest
from ledgerhound.llm import mixing as op

from .cases import corpus, frame, labels


def test_totals_meet_targets_and_rates_against_brute_force(spark):
    rows = corpus(n=150)
    docs = frame(spark, rows)
    got, report = op.mix(docs, op.domains_of(docs, labels(spark, rows)), {"en": 0.3, "fr": 0.7})
    out = got.collect()
    assert Counter(r.doc_id for r in out) == Counter(i for i, _, _ in rows)
    assert report["domains"] == ["en", "fr"]
    for have, want in zip(report["totals"], report["targets"], strict=True):
        assert abs(have - want) <= 0.01 * want
    assert abs(report["targets"][1] / report["targets"][0] - 7 / 3) < 1e-9
    assert all(r.rate >= 0 for r in out)
    tokens = {i: len((t or "").split()) for i, t, _ in rows if i is not None and i != 7}
    assert all(r.tokens == tokens[r.doc_id] for r in out if r.doc_id in tokens)
    right = [r for r in out if r.doc_id is not None and r.doc_id < 150 and r.doc_id != 7]
    assert sum(r.domain == rows[r.doc_id][2] for r in right) >= 0.95 * len(right)


def optimum(members, target, scale, floor, steps=20_000):
    """Rates by many steps of plain projected gradient: tokens * posteriors over scales is the matrix."""
    t = np.array([m[3] for m in members])
    a = (t[:, None] * np.array([m[4:] for m in members])).T / np.array(scale)[:, None]
    r = np.maximum(floor, np.ones(len(t)))
    size = 1 / (a.T @ a).sum(1)  # a bound of the curvature along each rate
    for _ in range(steps):
        r = np.maximum(floor, r + size * (a.T @ (np.array(target) / scale - a @ r)))
    return r, a


@pytest.mark.parametrize("weights, floor", [({"a": 0.9, "b": 0.1}, 0.0), ({"a": 0.97, "b": 0.03}, 0.0), ({"a": 0.9, "b": 0.1}, 1.0), ({"a": 0.2, "b": 0.8}, 0.5)])
def test_projected_gradient_against_python(spark, weights, floor):
    members = [(k, 0, 1, float(5 + k % 9), *(lambda p: (p, 1 - p))(0.5 + 0.4 * math.sin(k))) for k in range(60)]
    df = spark.createDataFrame(members, "doc_id long, text_hash long, nth long, tokens double, p0 double, p1 double")
    fitted, report = op.fit_rates(df, ["a", "b"], weights, least=floor)
    rates = np.array([r.rate for r in sorted(fitted.collect(), key=lambda r: r.doc_id)])
    have = [sum(m[3] * m[4 + i] for m in members) for i in (0, 1)]
    total = max(have[0] / weights["a"], have[1] / weights["b"])
    target = [weights["a"] * total, weights["b"] * total]
    scale = [max(t, h) for t, h in zip(target, have, strict=True)]
    assert np.allclose(report["targets"], target)
    best, a = optimum(members, target, scale, floor)
    miss, want = target / np.array(scale) - a @ rates, target / np.array(scale) - a @ best
    assert rates.min() >= floor
    # Rates aren't unique, the least sum of squares is; plain steps come near it, slowly.
    assert miss @ miss <= want @ want + 1e-7
    assert report["met"] == (abs(miss).max() <= op.TOLERANCE) and np.allclose(list(report["misses"].values()), miss, atol=1e-9)


def test_posteriors_against_python(spark):
    rows = corpus(n=80)
    docs = frame(spark, rows)
    domains, model, priors = op.train(docs, op.domains_of(docs, labels(spark, rows)))
    got = op.posteriors(docs, domains, model, priors).collect()
    buckets = {r.w: r.b for r in spark.createDataFrame([(w,) for _, t, _ in rows for w in set((t or "").lower().split())], "w string").distinct()
               .selectExpr("w", f"cast(pmod(xxhash64(w), {op.BUCKETS}) as int) b").collect()}
    marked = {i for i in {r[0] for r in rows if r[0] is not None} if i % 2 == 0} | {1}
    lang = {}
    for i, _, x in rows:
        if i in marked and x is not None:
            lang[i] = min(x, lang.get(i, x))
    counts, sizes = {d: Counter() for d in domains}, Counter()
    for i, t, _ in rows:
        if i in lang:
            sizes[lang[i]] += 1
            counts[lang[i]].update(buckets[w] for w in (t or "").lower().split())
    assert domains == sorted(sizes)

    def want(text):
        ws = (text or "").lower().split()
        logit = [math.log(sizes[d] / sum(sizes.values())) + sum(math.log((counts[d][buckets[w]] + 1) / (sum(counts[d].values()) + op.BUCKETS)) for w in ws)
                 * (min(len(ws), op.EFFECTIVE_WORDS) / len(ws) if ws else 0) for d in domains]
        e = [math.exp(x - max(logit)) for x in logit]
        return (float(len(ws)), *[x / sum(e) for x in e])

    have = Counter((r.doc_id, *[round(x, 6) for x in r[3:]]) for r in got)
    assert have == Counter((i, *[round(x, 6) for x in want(t)]) for i, t, _ in rows)


def test_mixed_rows_repeat_as_often_as_their_copies(spark):
    rows = corpus()
    docs = frame(spark, rows)
    marks = op.domains_of(docs, labels(spark, rows))
    got, _ = op.mix(docs, marks, least=1.0)
    copies = sum(r.copies for r in got.collect())
    out = op.mixed_docs(docs, marks, least=1.0)
    assert out.columns == docs.columns and out.count() == copies
    assert {r.doc_id for r in out.collect()} == {i for i, _, _ in rows}


def test_no_labels_and_empty_table(spark):
    rows = corpus()
    docs = frame(spark, rows)
    got, _ = op.mix(docs, op.domains_of(docs, labels(spark, rows).limit(0)))
    assert {(r.domain, r.rate, r.copies) for r in got.collect()} == {("all", 1.0, 1)}
    assert op.mix(docs.limit(0), op.domains_of(docs, labels(spark, rows)))[0].collect() == []


def disjoint(spark, sizes):
    """Members of domains that share no document: ``sizes`` tokens in each, in two documents."""
    n = len(sizes)
    rows = [(10 * i + k, 0, 1, x / 2, *[float(i == j) for j in range(n)]) for i, x in enumerate(sizes) for k in (0, 1)]
    return spark.createDataFrame(rows, "doc_id long, text_hash long, nth long, tokens double, " + ", ".join(f"p{i} double" for i in range(n)))


def test_rare_domains_and_large_weights_are_met(spark, monkeypatch):
    for sizes, weights in (([1e9, 1e5, 1e4, 1e3], None), ([1e6, 1e6], {"d0": 1.0, "d1": 100.0}), ([1e6, 1e2], {"d0": 1.0, "d1": 1.0}),
                           ([1e6, 10.0], {"d0": 1.0, "d1": 1.0}), ([1e9, 1e2], {"d0": 1.0, "d1": 1.0})):
        domains, members = [f"d{i}" for i in range(len(sizes))], disjoint(spark, sizes)
        with monkeypatch.context() as m:  # the fit that the query and the pipeline get
            m.setattr(op, "train", lambda *a: (domains, members, []))
            m.setattr(op, "posteriors", lambda *a: members)
            _, report = op.mix(members, members, weights, least=op.LEAST_RATE)
        assert report["steps"] <= 10
        for have, want in zip(report["totals"], report["targets"], strict=True):
            assert abs(have - want) <= op.TOLERANCE * want


def test_unreachable_targets_return_their_misses_at_the_optimum(spark, caplog):
    # Half of every document is of a: b can't be more than half, whatever the rates.
    rows = [(k, 0, 1, 10.0, 0.5, 0.5) for k in range(5)] + [(9, 0, 1, 10.0, 1.0, 0.0)]
    df = spark.createDataFrame(rows, "doc_id long, text_hash long, nth long, tokens double, p0 double, p1 double")
    fitted, report = op.fit_rates(df, ["a", "b"], {"a": 0.2, "b": 0.8})
    assert not report["met"] and max(map(abs, report["misses"].values())) > 0.1 and "can't be met" in caplog.text
    rates = {r.doc_id: r.rate for r in fitted.collect()}
    # One number, the tokens of the shared documents, is free; the document of a alone only adds to its excess.
    a, b = report["targets"]
    sa, sb = max(a, 35.0), max(b, 25.0)
    half = (a / sa ** 2 + b / sb ** 2) / (1 / sa ** 2 + 1 / sb ** 2)
    assert rates[9] == 0.0 and all(abs(rates[k] - half / 25) < 1e-4 for k in range(5))


def test_floor_does_not_end_the_fit_early(spark):
    # a is at its target already and can only shrink below the floor; the documents shared with it must give way to those of b alone.
    rows = [(k, 0, 1, 100.0, 1.0, 0.0) for k in range(60)] + [(100 + k, 0, 1, 50.0, 0.005, 0.995) for k in range(20)] \
        + [(200 + k, 0, 1, 50.0, 0.0, 1.0) for k in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text_hash long, nth long, tokens double, p0 double, p1 double")
    fitted, report = op.fit_rates(df, ["a", "b"], None, least=1.0)
    assert report["met"] and max(map(abs, report["misses"].values())) <= 1e-4 and report["steps"] < 20
    assert min(r.rate for r in fitted.collect()) >= 1.0


def test_many_domains(spark):
    rows = [(k, f"word{k} common", f"l{k % 70:02d}") for k in range(140)]
    docs = frame(spark, rows)
    got, report = op.mix(docs, docs.selectExpr("doc_id", "lang domain"), least=1.0)
    assert len(report["domains"]) == 70 and got.count() == 140
