import hashlib
from collections import Counter

import numpy as np
from ledgerhound.llm import bpe as op

from .cases import corpus, frame


def test_round_trip_and_ids_equal_the_library(spark, monkeypatch):
    monkeypatch.setattr(op, "BLOCK_CHARS", 2000)
    rows = corpus() + [(500, "a  b\n\n c 's <|endoftext|> 😀  x", None), (501, "z" * 5000 + "  \t", None)]
    enc = op.encoder(*op.vocabulary())
    got = op.encode(frame(spark, rows), *op.vocabulary()).collect()
    assert Counter((r.doc_id, tuple(r.ids), r.decoded) for r in got) == Counter((i, tuple(enc.encode_ordinary(t or "")), t or "") for i, t, _ in rows)


def test_digest(spark):
    rows = corpus()
    enc = op.encoder(*op.vocabulary())

    def want(text):
        ids = np.array(enc.encode_ordinary(text), "<u4")
        return len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()

    got = op.digest(frame(spark, rows), *op.vocabulary()).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == Counter((i, *want(t or "")) for i, t, _ in rows)
    assert op.digest(frame(spark, rows).limit(0), *op.vocabulary()).collect() == []


def test_packed_positions():
    values = np.array([0, 1, 127, 128, 16_383, 16_384, 2_000_000, 2 ** 31 - 1])
    assert op.unpack(op.pack(values)).tolist() == values.tolist() and len(op.unpack(op.pack(values[:0]))) == 0
