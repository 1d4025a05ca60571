import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from ledgerhound.llm import collocations as op
from ledgerhound.llm import words

from .cases import corpus, frame

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, percent=50, top=2000):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOW)):
            ws = re.findall("[^ \t]+", piece)
            n[lang] += len(ws)
            for k in (1, 2, 3):
                f.update((lang, *ws[i:i + k]) for i in range(len(ws) - k + 1))
    cands = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    longer = Counter()
    for p, a in cands.items():
        if len(p) == 4:
            for q in ((p[0], *p[1:3]), (p[0], *p[2:4])):
                longer[q] = max(longer[q], a)
    found = {}
    for p, a in cands.items():
        if len(p) == 3 and 100 * longer[p] >= percent * a:
            continue
        cuts = [(1000000 * a * a // (f[p[:k + 1]] * f[(p[0], *p[k + 1:])]), k, f[p[:k + 1]], f[(p[0], *p[k + 1:])]) for k in range(1, len(p) - 1)]
        score, _, left, right = min(cuts)
        found.setdefault(p[0], []).append((-score, -a, " ".join(p[1:]).encode(), left, right))
    return {(lang, rank, p.decode(), -a, left, right, n[lang], -s) for lang, all_ in found.items()
            for rank, (s, a, p, left, right) in enumerate(sorted(all_)[:top], 1)}


def texts():
    rng = random.Random(9)
    rows = corpus()
    for k in range(150):
        lang = rng.choice(["en", "fr", None, "und"])
        parts = [rng.choice(["In the BEGINNING was", "new york city", "a a a a a a", "x\ty", "one, two. three", "é à é à é à", "Ps and qs", "as far as it goes on and on"]) for _ in range(rng.randrange(6))]
        rows.append((3000 + k, rng.choice([" ", "; ", "\n", "\x0b"]).join(parts), lang))
    rows.append((4000, " ".join(["chain1 chain2 chain3 chain4 chain5 chain6 chain7 chain8."] * 30), "xx"))
    rows.append((4001, " ".join(["ring1", "ring2", "ring3", "ring4"] * 40), "yy"))
    rows.append((4002, "y" * 300 + " " + "z" * 300 + " " + ("y" * 300 + " " + "z" * 299 + "w ") * 12, "zz"))
    return rows


@pytest.mark.parametrize("least, top, batch", [(10, 2000, 16 << 20), (2, 25, 500)])
def test_against_brute_force(spark, monkeypatch, least, top, batch):
    monkeypatch.setattr(op, "BATCH_BYTES", batch)
    rows = texts()
    got = op.collocations(frame(spark, rows), least, top=top).collect()
    assert len(got) == len({tuple(r) for r in got})
    assert {tuple(r) for r in got} == brute(rows, least, top=top)


def test_empty(spark):
    assert op.collocations(frame(spark, texts()).limit(0)).collect() == []
    assert op.collocations(frame(spark, [(1, None, None), (2, "", "en"), (3, ".,", "en")])).collect() == []


def test_paths_are_compacted(spark):
    rows = [(1, ". ".join(["a b c d e f g"] * 12 + ["q b c x"] * 11), "en")]
    flow = op.flows(frame(spark, rows), 10, 0)
    nodes, edges = flow.filter("kind = 2").select("a", "b", "n"), flow.filter("kind = 3").select("a", "b", "c", "n")
    got = op.paths(edges, nodes).collect()
    # (b, c) branches, (a, b) and (q, b) begin, (c, x) and (f, g) end: the inner nodes are (c, d), (d, e), (e, f)
    assert sorted((r.n, r.left) for r in got) == [(12, 0), (12, 1), (12, 2)] and len({(r.last_a, r.last_b) for r in got}) == 1


def test_shared_hashes_are_seen():
    part = pa.record_batch([pa.array(["en", "fr"]), pa.array(["aa bb aa cc", "aa bb"])], names=["lang", "text"])
    w = op.Words(part, 0)
    assert len(set(w.hash.tolist())) == 5
    same = np.arange(6)
    assert op._unlike(w, same, np.array([0, 1, 0, 1, 0, 5])).tolist() == [3, 4]


def test_words_that_share_a_hash_get_other_hashes(spark, monkeypatch):
    class Few(op.Words):
        """Under the first seed all words have one of a few hashes."""
        def __init__(self, part, seed):
            super().__init__(part, seed)
            if seed == 0:
                self.hash = self.hash % words.U64(5) + words.U64(1)

    monkeypatch.setattr(op, "Words", Few)
    rows = [(1, ". ".join(["new york city", "old york town", "see new york city now"] * 12), "en")]
    assert {tuple(r) for r in op.collocations(frame(spark, rows)).collect()} == brute(rows, 10)


def test_slices_cover_the_batch():
    batch = pa.record_batch([pa.array(["ab", None, "", "x" * 50, "cd", "e"])], names=["text"])
    assert [p.num_rows for p in words.slices(batch, "text", 4)] == [3, 1, 2]
