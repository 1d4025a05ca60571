import hashlib
from collections import Counter

import numpy as np
import pytest
from ledgerhound.llm import align as op

from .cases import corpus, frame


def library():
    """Both tokenizers as their libraries give them: ids, and the bytes of each id."""
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer
    one = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    one.encode_special_tokens = True
    letters = op.byte_letters()
    sp = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))

    def a(text):
        e = one.encode(" " + text, add_special_tokens=False)
        return e.ids, [bytes(letters[c] for c in t) for t in e.tokens]

    def b(text):
        ids = sp.encode(text)
        return ids, [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids, map(sp.id_to_piece, ids), strict=True)]
    return a, b


def brute(rows):
    a, b = library()
    docs, corpus_ = [], Counter()
    for i, text, _ in rows:
        groups, links = [], Counter()
        if text:
            (ia, ta), (ib, tb) = a(text), b(text)
            whole = b" " + text.encode()
            if b"".join(ta) == whole and b"".join(tb) == whole:
                ea, eb = np.cumsum([len(t) for t in ta]).tolist(), np.cumsum([len(t) for t in tb]).tolist()
                x = y = 0
                for end in sorted(set(ea) & set(eb)):
                    p, q = ea.index(end, x) + 1, eb.index(end, y) + 1
                    groups.append((ia[x:p], ib[y:q]))
                    x, y = p, q
                for ga, gb in groups:
                    links.update((u, v) for u in ga for v in gb)
        corpus_.update(links.keys())
        docs.append((i, groups, links))
    top = Counter()
    for (u, _), n in corpus_.items():
        top[u] = max(top[u], n)
    out = []
    for i, groups, links in docs:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((i, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), sum(links.values()),
                    sum(n for p, n in links.items() if corpus_[p] == top[p[0]]), sum(n * corpus_[p] for p, n in links.items()),
                    hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return out, corpus_


def texts():
    odd = ["a  b\n\n c\t<|endoftext|> <s> </s> <unk> 's", " lead", "x　y ﬁne ½   z", "▁a ▁", "\x00\x01 ctl", "日本語のテキスト。", "😀😀 émigré é", "=" * 700, " ", "\n", "▁"]
    return corpus(n=30) + [(900 + k, t, None) for k, t in enumerate(odd)]


@pytest.mark.parametrize("block, part, links", [(op.BLOCK_BYTES, op.PART_BYTES, op.LINKS), (400, 200, 50)])
def test_against_the_libraries(spark, monkeypatch, block, part, links):
    monkeypatch.setattr(op, "BLOCK_BYTES", block)
    monkeypatch.setattr(op, "PART_BYTES", part)
    monkeypatch.setattr(op, "LINKS", links)
    rows = texts()
    want, counts = brute(rows)
    got = op.alignment(frame(spark, rows), *op.tokenizers()).collect()
    assert Counter(map(tuple, got)) == Counter(want)
    if links == 50:
        pairs = op.pair_counts(frame(spark, rows), *op.tokenizers()).collect()
        assert {(r.a, r.b): r.n for r in pairs} == counts


def test_empty(spark):
    assert op.alignment(frame(spark, texts()).limit(0), *op.tokenizers()).collect() == []
    got = op.alignment(frame(spark, [(1, None, None), (2, "", None)]), *op.tokenizers()).collect()
    assert sorted(map(tuple, got)) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


@pytest.mark.parametrize("steps", [1, 2, 3, 7, 64, 1000])
def test_merge_path(steps):
    rng = np.random.default_rng(steps)
    for n, m in [(0, 0), (1, 1), (5, 50), (200, 180), (300, 3)]:
        top = 400
        a = np.sort(rng.choice(np.arange(1, top), max(0, n - 1), replace=False))
        b = np.sort(rng.choice(np.arange(1, top), max(0, m - 1), replace=False))
        if n:
            a, b = np.r_[a, top], np.r_[b, top]
        i, j, closes = op.merge(a, b, steps)
        want = [(x, y) for x in range(len(a)) for y in range(len(b)) if max(a[x - 1] if x else 0, b[y - 1] if y else 0) < min(a[x], b[y])]
        assert list(zip(i.tolist(), j.tolist(), strict=True)) == want
        assert a[i[closes]].tolist() == sorted(set(a.tolist()) & set(b.tolist()))


def test_ids_equal_the_library_for_every_character():
    import public_tokenizers as P
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    lib.encode_special_tokens = True
    one = op.tokenizers()[0]()
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    for at in range(0, len(chars), 50_000):
        part = [f"a{c}a1{c}1 {c}!{c} {c}{c} x" for c in chars[at:at + 50_000]]
        ids, counts = one.ids(part)
        want = [e.ids for e in lib.encode_batch([" " + t for t in part], add_special_tokens=False)]
        assert counts.tolist() == list(map(len, want)) and ids.tolist() == [x for w in want for x in w]
