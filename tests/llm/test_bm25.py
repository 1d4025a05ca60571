import math
from collections import Counter

import pytest
from ledgerhound.llm import bm25 as op
from pyspark.sql import functions as F

from .cases import corpus, frame


def brute(rows, queries, top):
    docs = [(i, Counter(op.terms(t))) for i, t, _ in rows if i is not None]
    total, mean = len(docs), sum(sum(c.values()) for _, c in docs) / len(docs)
    df = Counter(w for _, c in docs for w in c)
    out = {}
    for q, text in queries:
        scored = []
        for i, c in docs:
            size = sum(c.values())
            s = sum(math.log(1 + (total - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * (op.K1 + 1) / (c[w] + op.K1 * (1 - op.B + op.B * size / mean))
                    for w in sorted(set(op.terms(text))) if w in c)
            if s:
                scored.append((-round(s, 6), i))
        out[q] = sorted(scored)[:top]
    return out


@pytest.mark.parametrize("per_shard, block", [(10_000, 64), (15, 4)])
def test_against_brute_force(spark, monkeypatch, per_shard, block):
    monkeypatch.setattr(op, "BLOCK_DOCS", block)
    monkeypatch.setattr(op, "FEW", 2)
    monkeypatch.setattr(op, "RARE", 0.5)
    rows = corpus(n=120)
    docs = frame(spark, rows)
    got = op.search(docs, docs.filter("doc_id % 10 = 0"), 5, per_shard).collect()
    want = brute(rows, [(i, t) for i, t, _ in rows if i is not None and i % 10 == 0], 5)
    found = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append((-r.score, r.doc_id))
    assert set(found) == {q for q, w in want.items() if w}
    for q, hits in found.items():
        assert [d for _, d in hits] == [d for _, d in want[q]]
        assert all(abs(a - b) < 1e-5 for (a, _), (b, _) in zip(hits, want[q], strict=True))


def test_search_stops_early():
    own = op.Builder()
    for k in range(6400):
        own.add(k, "common rare" if k == 7 else "common " + "filler " * (k % 5))
    index = op.Index(next(own.rows(0)).column("payload")[0].as_py(), 3.0)
    calls, real = [], op._spans
    op._spans = lambda first, size: calls.append(len(size)) or real(first, size)
    try:
        assert index.search(["rare"], op.np.array([5.0]), 1)[0][0] == 7
    finally:
        op._spans = real
    assert sum(calls) <= op.FEW  # of 100 blocks


def shards(n_docs=3000, n_shards=3, seed=4):
    """Indexes over texts with a few very common and many rare words, and the statistics."""
    rng = op.np.random.default_rng(seed)
    texts = [" ".join(f"w{int(x)}" for x in op.np.minimum(rng.zipf(1.25, rng.integers(5, 120)), 4000)) for _ in range(n_docs)]
    for k in range(0, n_docs, 50):
        texts[k] = texts[k // 50]  # equal texts, so equal scores
    builders = [op.Builder() for _ in range(n_shards)]
    for k, t in enumerate(texts):
        builders[k % n_shards].add(k, t)
    mean = sum(len(op.terms(t)) for t in texts) / n_docs
    df = Counter(w for t in texts for w in set(op.terms(t)))
    return texts, [op.Index(next(b.rows(0)).column("payload")[0].as_py(), mean) for b in builders], df


@pytest.mark.parametrize("few, common, rare", [(op.FEW, op.COMMON, op.RARE), (2, 1, 0.1), (3, 1000, 1)])
def test_carried_threshold_skips_postings_and_loses_nothing(monkeypatch, few, common, rare):
    for name, value in (("FEW", few), ("COMMON", common), ("RARE", rare)):
        monkeypatch.setattr(op, name, value)
    texts, own, df = shards()
    everything = touched = 0
    for q in range(0, len(texts), 60):
        words = sorted(set(op.terms(texts[q])))
        n = op.np.array([df[w] for w in words])
        idf = op.np.log(1 + (len(texts) - n + 0.5) / (n + 0.5))
        # All postings of all shards, for every document.
        want = []
        for index in own:
            at, weights = index.known(words, idf)
            dense = op.np.zeros(len(index.term))
            dense[at] = weights
            doc = op.np.repeat(op.np.arange(len(index.ids)), index.sizes)
            scores = op.np.bincount(doc, dense[index.words] * index.own, len(index.ids))
            want += [(-s, int(d)) for d, s in zip(index.ids, scores, strict=True) if s > 0]
            everything += int((dense[index.words] > 0).sum())
        before = sum(index.looked for index in own)
        first = own[0].search(words, idf, 10)
        found = list(first)
        for index in own[1:]:
            found += index.search(words, idf, 10, [s for _, s in first])
        touched += sum(index.looked for index in own) - before
        assert sorted((-s, d) for d, s in found)[:10] == sorted(want)[:10]
    if common > 1:
        assert touched < everything
    else:  # no list is in the matrix, all but the rarest have blocks
        index, k = own[1], 7
        words = ["w1", "w2", texts[k].split()[0]]
        idf = op.np.array([0.1, 0.2, 9.0])
        index.looked = 0
        index.search(words, idf, 10, [12.0] * 10)
        assert index.looked < 0.5 * index.df[index.known(words, idf)[0]].sum()


def test_numbers_sort_stably():
    rng = op.np.random.default_rng(0)
    a, b = rng.integers(0, 200_000, 5000), rng.integers(0, 40, 5000)
    assert op.by_number(a).tolist() == op.np.argsort(a, kind="stable").tolist()
    assert op.by_number(a, b).tolist() == op.np.lexsort((a, b)).tolist() and op.by_number(a[:0]).tolist() == []


def test_null_and_empty_queries_find_nothing(spark):
    rows = [(0, None, None), (100, "", None), (200, " -- ", None), (300, "word", None), (None, "word", None)]
    docs = frame(spark, rows)
    assert [(r.query_id, r.doc_id) for r in op.search(docs, docs.filter(op.query_set(F.col("doc_id")))).collect()] == [(300, 300)]
    assert op.search(docs.limit(0), docs.limit(0)).collect() == []
    assert op.search(docs, docs.limit(0)).collect() == []


def test_queries_of_one_home_travel_together_and_groups_lose_nothing(spark, monkeypatch):
    rows = corpus(n=120)
    docs = frame(spark, rows)
    asked, want = docs.filter("doc_id % 5 = 0"), brute(rows, [(i, t) for i, t, _ in rows if i is not None and i % 5 == 0], 3)
    sent, real = {}, op.materialize
    monkeypatch.setattr(op, "materialize", lambda df, name: sent.setdefault(name, real(df, name)))
    op.search(docs, asked, 3).collect()
    assert sent["bm25-queries"].count() == 1  # was one row for each query
    for name, value in (("GROUPS", 3), ("BUNDLE", 2), ("CHUNK_BYTES", 500), ("TILE_DOCS", 8), ("BLOCK_DOCS", 4), ("NEAR", 2), ("TOGETHER", 3), ("WAITING", 5)):
        monkeypatch.setattr(op, name, value)
    sent.clear()
    found = {}
    for r in op.search(docs, asked, 3, 10).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append(r.doc_id)
    assert sent["bm25-queries"].count() > 1
    assert found == {q: [d for _, d in hits] for q, hits in want.items() if hits}


def test_a_task_carries_the_threshold_from_shard_to_shard():
    texts, own, df = shards()
    ask = [(q, sorted((w, df[w]) for w in set(op.terms(texts[q])))) for q in range(0, len(texts), 100)]
    builders = [op.Builder() for _ in range(3)]
    for k, t in enumerate(texts):
        builders[k % 3].add(k, t)
    payloads = [next(b.rows(k)).column("payload")[0].as_py() for k, b in enumerate(builders)]
    mean = sum(len(op.terms(t)) for t in texts) / len(texts)
    columns = {"task": [0] * 4, "shard": [None, 0, 1, 2], "home": [7, None, None, None], "payload": [op.pack(ask), *payloads], "scores": [None] * 4}
    types = [op.pa.int64()] * 3 + [op.pa.binary(), op.pa.list_(op.pa.struct([("query_id", op.pa.int64()), ("scores", op.pa.list_(op.pa.float64()))]))]
    batch = op.pa.record_batch([op.pa.array(c, t) for c, t in zip(columns.values(), types, strict=True)], names=list(columns))
    got = {}
    for out in op._search(len(texts), mean, 5, False)([batch]):
        for q, d, s, n in zip(*[c.to_pylist() for c in out.columns], strict=True):
            got.setdefault(q, []).append((n, -s, d))
    for q, found in ask:
        idf = op.np.log(1 + (len(texts) - op.np.array([n for _, n in found]) + 0.5) / (op.np.array([n for _, n in found]) + 0.5))
        want = sorted((-s, d) for index in own for d, s in index.search([w for w, _ in found], idf, 5))[:5]
        assert [(s, d) for _, s, d in sorted(got[q])] == want  # no more rows than ``top``, though three shards were searched
