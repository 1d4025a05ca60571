import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from ledgerhound.llm import suffix_dedup as op

from .cases import corpus, frame


def brute(rows, length=50):
    low = {}
    for i, text, _ in rows:
        data = (text or "").encode()
        for k in range(len(data) - length + 1):
            if i is not None and low.get(data[k:k + length], i) >= i:
                low[data[k:k + length]] = i
    out = []
    for i, text, _ in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - length + 1):
            if i is not None and low[data[k:k + length]] < i:
                gone[k:k + length] = b"\1" * length
        runs = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        left = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        out.append((i, len(data), sum(gone), runs, hashlib.sha256(left).hexdigest()))
    return Counter(out)


def results(spark, rows):
    return Counter(tuple(r) for r in op.remove_repeats(frame(spark, rows)).collect())


@pytest.mark.parametrize("block, heavy", [(4 << 20, 60_000), (3000, 60_000), (3000, 3)])
def test_against_brute_force(spark, monkeypatch, block, heavy):
    monkeypatch.setattr(op, "BLOCK_BYTES", block)
    rows = corpus()
    assert results(spark, rows) == brute(rows)


def test_runs_of_one_byte_and_periods(spark):
    rng = random.Random(1)
    parts = ["a", "ab", "a" * 60, "b" * 49, "aab" * 20, "zyx", "\0", "\0" * 55, "é"]
    rows = [(rng.choice([i, i // 3, None]), "".join(rng.choice(parts) for _ in range(rng.randrange(20))), None) for i in range(150)]
    assert results(spark, rows) == brute(rows)


def test_suffix_order_against_sorted():
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randrange(50, 120))).encode() for _ in range(60)] + [b"a" * 90, b"b" * 70 + b"a" * 60]
    texts = list(dict.fromkeys(texts))
    data, ends = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts])
    starts, classes = op.sort_starts(data, ends)
    whole = [(int(e) - len(t) + k, t[k:k + 50]) for t, e in zip(texts, ends, strict=True) for k in range(len(t) - 49)]
    assert sorted(starts.tolist()) == sorted(s for s, _ in whole)
    strings, by_class = dict(whole), {}
    for s, c in zip(starts.tolist(), classes.tolist(), strict=True):
        by_class.setdefault(c, set()).add(strings[s])
    assert all(len(x) == 1 for x in by_class.values()) and len(by_class) == len({s for _, s in whole})


def test_empty_table_and_no_text(spark):
    assert op.remove_repeats(frame(spark, corpus()).limit(0)).collect() == []
    assert results(spark, [(1, None, None), (2, "", None)]) == brute([(1, None, None), (2, "", None)])


def test_an_anchor_of_few_blocks_is_heavy_by_its_real_count(monkeypatch):
    monkeypatch.setattr(op, "HEAVY", 600)
    text = "x" * 60 + "the same letters again and again %04d"  # one anchor in every document, a run each
    docs = [(text % k).encode() for k in range(400)]
    head = [np.array([len(docs)], "<i8"), np.arange(len(docs)), np.array([len(t) for t in docs], "<i8"), np.zeros(len(docs), np.uint8)]
    payload = op.squeeze(b"".join(a.tobytes() for a in head) + b"".join(docs))
    for blocks, state in ((1, 1), (2, 2)):  # 400 and 800 runs
        sent = list(op._anchors(1)(iter([op._message([(b, -1, len(payload), payload) for b in range(blocks)])])))
        (got,) = op._shared(iter(sent))
        states = np.frombuffer(op.expand(got.column("payload")[0].as_py()), np.uint8)
        assert states.max() == state
    count = np.array([1, 254, 255, 256, 70_000, 3], np.int64)
    assert op._unpack_counts(op._pack_counts(count), len(count)).tolist() == count.tolist()
