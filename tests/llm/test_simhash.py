import random
from collections import Counter

import numpy as np
import xxhash
from ledgerhound.llm import simhash as op

from .cases import corpus, frame


def slow_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lower = lower.replace(c, " ")
    toks = [w for w in lower.split(" ") if w]
    if not toks:
        return 0
    shingles = [" ".join(toks[k:k + 4]) for k in range(max(1, len(toks) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_of(fps, bits):
    """doc -> smallest doc reachable, by brute force over all pairs."""
    ids = list(fps)
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and (fps[a] ^ fps[b]).bit_count() <= bits:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: find(i) for i in ids}


def test_fingerprints_and_groups_against_brute_force(spark):
    rows = [r for r in corpus() if r[0] is not None and r[0] != 7]
    got = op.near_groups(frame(spark, rows)).collect()
    assert {(r.doc_id, r.fp % (1 << 64)) for r in got} == {(i, slow_fingerprint(t)) for i, t, _ in rows}
    want = groups_of({i: slow_fingerprint(t) for i, t, _ in rows}, 4)
    assert Counter((r.doc_id, r.component_id) for r in got) == Counter((i, want[i]) for i, _, _ in rows)


def test_links_find_every_pair_within_the_bound(spark):
    rng = random.Random(1)
    base = [rng.getrandbits(64) for _ in range(40)]
    fps = {}
    for k, b in enumerate(base):
        fps[k] = b
        for n in range(1, 7):
            x = b
            for bit in rng.sample(range(64), n):
                x ^= 1 << bit
            fps[100 + k * 10 + n] = x
    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in set(fps.values())], "fp long")
    for block in (4096, 2):  # with 2, cells are cut into pairs of blocks
        edges = [(r.a % (1 << 64), r.b % (1 << 64)) for r in op.links(df, 4, block).collect()]
        assert all((a ^ b).bit_count() <= 4 for a, b in edges)
        ids = sorted(set(fps.values()))
        want = groups_of(dict(zip(ids, ids, strict=True)), 4)
        parent = {i: i for i in ids}

        def find(x, parent=parent):
            while parent[x] != x:
                x = parent[x]
            return x
        for a, b in edges:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
        assert {i: find(i) for i in ids} == want


def test_embedding_is_a_lower_bound():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 1 << 63, 2000, dtype=np.uint64)
    b = a ^ (np.uint64(1) << rng.integers(0, 64, 2000).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 2000).astype(np.uint64))
    ea, eb = op.embed(a), op.embed(b)
    low = sum(np.abs(((ea >> np.uint64(2 * k)) & np.uint64(3)).astype(int) - ((eb >> np.uint64(2 * k)) & np.uint64(3)).astype(int)) for k in range(32))
    assert (low <= np.bitwise_count(a ^ b)).all()


def test_large_group_gives_a_forest_not_pairs():
    fps = np.unique(np.uint64(0xABCDEF) ^ (np.uint64(1) << np.arange(64, dtype=np.uint64)))
    assert len(op.spanning_edges(fps, 4)) == len(fps) - 1


def test_blank_texts_are_linked_and_nulls_named_last(spark):
    got = op.near_groups(frame(spark, [(5, None, None), (3, "", None), (None, " \n", None)])).collect()
    assert {r.component_id for r in got} == {3} and {r.fp for r in got} == {0}


def test_drop_near_copies(spark):
    docs = frame(spark, corpus())
    groups = {r.component_id for r in op.near_groups(docs).collect()}
    left = op.drop_near_copies(docs)
    assert left.columns == docs.columns and left.count() == len(groups)
    assert op.drop_near_copies(docs.limit(0)).collect() == []
