import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from ledgerhound.llm import decontaminate as op
from ledgerhound.llm import words

from .cases import corpus, frame

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOW))


def brute(rows, bench, window=10):
    wins = {}
    for item, text in bench:
        ws = split(text)
        n = min(window, len(ws))
        for i in range(len(ws) - n + 1) if n else ():
            wins.setdefault(tuple(ws[i:i + n]), set()).add(item)
    sizes = {len(w) for w in wins}
    out = []
    for i, text, _ in rows:
        ws, hit, items = split(text), set(), set()
        for n in sizes:
            for a in range(len(ws) - n + 1):
                found = wins.get(tuple(ws[a:a + n]))
                if found:
                    hit.update(range(a, a + n))
                    items |= found
        names = sorted(str(x) for x in items if x is not None)
        out.append((i, len(ws), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return out


def planted():
    rng = random.Random(4)
    rows = corpus()
    passage = "One two, three FOUR five six seven eight nine ten eleven twelve é13 日本 x"
    for k in range(40):
        ws = passage.split()
        a, b = sorted(rng.sample(range(len(ws) + 1), 2))
        rows.append((1000 + k, "lead in " + " ".join(ws[a:b]).lower().replace(" ", rng.choice([" ", "  -", "\n", "  "])) + " tail", "en"))
    bench = [(1, passage), (2, "short item here"), (3, rows[3][1]), (3, rows[4][1]), (4, None), (5, " ,; "), (6, "solo"), (7, passage.upper()), (None, rows[6][1]),
             (10, " ".join(rows[8][1].split()[:25])), (11, rows[7][1] + " " + passage)]
    rows += [(2000, "a short item here and solo", "en"), (2001, "solo", "en"), (2002, " ".join(["solo"] * 900), "en"), (2003, "short  ITEM", "en")]
    return rows, bench


@pytest.mark.parametrize("limit, segment, stretch", [(op.CHUNK_BYTES, 4096, 256), (4000, 12, 3)])
def test_against_brute_force(spark, monkeypatch, limit, segment, stretch):
    monkeypatch.setattr(op, "SEGMENT", segment)
    monkeypatch.setattr(op, "STRETCH", stretch)
    monkeypatch.setattr(op, "PAIRS", 64)
    rows, bench = planted()
    b = spark.createDataFrame([(i, t, "clash", 1) for i, t in bench], "item_id long, text string, doc_id string, chunk int")
    got = op.contamination(frame(spark, rows), b, limit=limit).collect()
    assert Counter(map(tuple, got)) == Counter(brute(rows, bench))
    marks = op.marked(frame(spark, rows), b, limit=limit).collect()
    bits = Counter((r.doc_id, r.n_words, int(np.unpackbits(np.frombuffer(r.hit or b"", np.uint8)).sum())) for r in marks)
    assert bits == Counter((x[0], x[1], x[2]) for x in brute(rows, bench))


def test_empty_tables(spark):
    rows, bench = planted()
    b = spark.createDataFrame(bench, "item_id long, text string")
    assert op.contamination(frame(spark, rows).limit(0), b).collect() == []
    got = op.contamination(frame(spark, rows), b.limit(0)).collect()
    assert len(got) == len(rows) and not any(r.n_hit or r.n_items or r.contaminated for r in got)


def test_most_words_of_a_clean_text_are_skipped():
    rng = np.random.default_rng(1)
    bench = [(str(k), " ".join(f"w{x}" for x in rng.integers(0, 5000, 40))) for k in range(50)]
    tables = op.Tables(bench, 10)
    text = " ".join(f"w{x}" for x in rng.integers(0, 5000, 20_000))
    data, start, end, first = op.words_of(pa.array([text]))
    places, looked = tables.sets[10].places(words.hashes(data, start, end, tables.seed))
    assert len(start) == 20_000 and looked < 0.3 * len(start) and len(places) < 200


def test_word_hashes_tell_words_apart():
    texts = ["a", "b", "ab", "ba", "a" * 63, "a" * 64, "a" * 65, "a" * 66, "é", "x" * 70 + "y", "x" * 70 + "z", *map(str, range(5000))]
    data, start, end, _ = op.words_of(pa.array([" ".join(texts), None, "", texts[10]]))
    h = words.hashes(data, start, end)
    assert len(set(h[:len(texts)].tolist())) == len(texts) and h[-1] == h[10]
    assert set(words.hashes(data, start, end, 1).tolist()).isdisjoint(h.tolist())
