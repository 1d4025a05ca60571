"""Byte-level BPE encoding and decoding by a global shuffle of distinct words.

Texts are read in blocks. A block is pre-tokenised and its pre-tokens are exploded to (word, position): the distinct words of the
block are numbered, frequent ones first, and its positions hold numbers. The words go to buckets by their hash, so the rows of a
word meet and each distinct word of the corpus is encoded once; its ids go back to the blocks that asked, are joined to the
numbers, and put in order by position. Decoding joins every id with the token-byte table of the vocabulary (fixed, 50 thousand
rows) and concatenates the bytes by position.

Rows of the shuffles are compressed bundles: the words of one block and bucket, or a block's positions. A word costs a block
one entry, however often it occurs, so a very common word is no hot key: its bucket gets one entry a block.

Null text is empty; an empty text has no ids. A very long text is a block of its own. Repeated rows are separate
rows of a block. An empty table gives no rows. Special tokens have no meaning here: their strings are ordinary text.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, table, text_rows, width
from .registry import register

#: Larger blocks ask for fewer words in all; a task holds about 30 bytes a character.
BLOCK_CHARS = 24_000_000
#: Ids that are decoded at once.
DECODE_IDS = 1 << 20
LEVEL = 7
#: Buckets of words for each shuffle partition.
BUCKETS_PER_PARTITION = 1
#: A bundle: the words of a block and bucket, or their ids, or (bucket -1) the documents and positions of a block.
ROW = "block long, bucket long, payload binary"
SCHEMA = pa.schema([("block", pa.int64()), ("bucket", pa.int64()), ("payload", pa.binary())])
OUT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def bundle(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed string; each is stored with its type and length."""
    raw = b"".join(part for a in arrays for part in (a.dtype.str.encode().ljust(8), len(a).to_bytes(8, "little"), a.tobytes()))
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", compression_level=LEVEL).compress(raw, asbytes=True)


def unbundle(payload: bytes) -> list[np.ndarray]:
    raw = pa.decompress(payload[8:], int.from_bytes(payload[:8], "little"), codec="zstd", asbytes=True)
    out, at = [], 0
    while at < len(raw):
        a = np.frombuffer(raw, raw[at:at + 8].decode().strip(), int.from_bytes(raw[at + 8:at + 16], "little"), at + 16)
        out.append(a)
        at += 16 + a.nbytes
    return out


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), SCHEMA, strict=True)], schema=SCHEMA)


@lru_cache(maxsize=2)
def load_ranks(path: str) -> dict[bytes, int]:
    """The rank of each token's bytes; ``path``: a rank file on every machine (it comes with an installed package)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str):
    import tiktoken
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=load_ranks(path), special_tokens={})


def token_table(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, size, bytes): where each id's bytes are in the bytes of all tokens."""
    ranks = load_ranks(path)
    by_id = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        by_id[rank] = token
    size = np.fromiter(map(len, by_id), np.int64, len(by_id))
    return np.cumsum(size) - size, size, np.frombuffer(b"".join(by_id), np.uint8)


def pack(values: np.ndarray) -> np.ndarray:
    """Seven bits a byte; the last byte of a value has the high bit clear."""
    v = values.astype(np.uint64)
    n = 1 + sum((v >= np.uint64(1 << 7 * k)).astype(np.int64) for k in range(1, 5))
    ends = np.cumsum(n)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    for k in range(5):
        has = n > k
        more = (n[has] > k + 1).astype(np.uint8) << 7
        out[(ends - n)[has] + k] = ((v[has] >> np.uint64(7 * k)) & np.uint64(127)).astype(np.uint8) | more
    return out


def unpack(data: np.ndarray) -> np.ndarray:
    last = np.flatnonzero(data < 128)
    first = np.r_[0, last[:-1] + 1] if len(last) else last
    place = (np.arange(len(data)) - np.repeat(first, last - first + 1)).astype(np.uint64)
    parts = (data & np.uint8(127)).astype(np.uint64) << (place * np.uint64(7))
    return np.add.reduceat(parts, first).astype(np.int64) if len(first) else np.zeros(0, np.int64)


def _explode(pattern: str, buckets: int):
    """Blocks of texts -> their words by bucket, and the numbers of the words by position."""
    find = regex.compile(pattern).findall

    def block_rows(block: int, texts: list[tuple]) -> pa.RecordBatch:
        known: dict[str, int] = {}
        place = known.setdefault
        parts, counts = [], []
        for _, text in texts:
            words = find(text)
            parts.append(np.fromiter((place(w, len(known)) for w in words), np.int32, len(words)))
            counts.append(len(words))
        seen = np.concatenate(parts)
        often = np.argsort(-np.bincount(seen, minlength=len(known)), kind="stable")
        number = np.empty(len(known), np.int64)
        number[often] = np.arange(len(known))
        encoded = [w.encode() for w in known]
        words = [encoded[k] for k in often.tolist()]
        bucket = np.fromiter((zlib.crc32(w) % buckets for w in words), np.int32, len(words))
        ids = np.array([d if d is not None else 0 for d, _ in texts], np.int64)
        nulls = np.array([d is None for d, _ in texts], np.uint8)
        out = [(block, -1, bundle(ids, nulls, np.array(counts, np.int64), bucket, pack(number[seen])))]
        order = np.argsort(bucket, kind="stable")
        heads = np.flatnonzero(np.r_[True, np.diff(bucket[order]) != 0]) if len(order) else []
        for a, b in zip(heads, [*heads[1:], len(order)] if len(order) else [], strict=True):
            own = [words[k] for k in order[a:b].tolist()]
            out.append((block, int(bucket[order[a]]), bundle(np.array([len(w) for w in own], np.int32), np.frombuffer(b"".join(own), np.uint8))))
        return _rows(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        numbers = itertools.count(TaskContext.get().partitionId() << 32)
        texts: list[tuple] = []
        held = 0
        for doc_id, text in arrow_rows(batches, "doc_id", "text"):
            texts.append((doc_id, text or ""))
            held += len(texts[-1][1])
            if held >= BLOCK_CHARS:
                yield block_rows(next(numbers), texts)
                texts, held = [], 0
        if texts:
            yield block_rows(next(numbers), texts)
    return run


def _encode(path: str, pattern: str):
    """Rows sorted by bucket: each word of a bucket is encoded when it first comes up; the ids replace the words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, now = encoder(path, pattern)._encode_single_piece, None
        known: dict[bytes, list[int]] = {}
        for block, bucket, payload in arrow_rows(batches, "block", "bucket", "payload"):
            if bucket >= 0:
                if bucket != now:
                    known, now = {}, bucket
                sizes, data = unbundle(payload)
                raw, ids, counts = data.tobytes(), [], []
                ends = np.cumsum(sizes)
                for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True):
                    word = raw[a:b]
                    own = known.get(word)
                    if own is None:
                        own = known[word] = piece(word)
                    ids += own
                    counts.append(len(own))
                payload = bundle(np.array(counts, np.int32), np.array(ids, np.uint32))
            yield _rows([(block, bucket, payload)])
    return run


def assemble(positions: bytes, replies: list[bytes]) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(doc_ids, ids in each document, all ids in order) of a block; ``replies``: the words' ids, by bucket."""
    docs, nulls, counts, bucket, numbers = unbundle(positions)
    number = unpack(numbers)
    back = [unbundle(p) for p in replies]
    size, first = np.zeros(len(bucket), np.int64), np.zeros(len(bucket), np.int64)
    if back:
        sizes = np.concatenate([b[0] for b in back]).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        size[order], first[order] = sizes, np.cumsum(sizes) - sizes
    flat = np.concatenate([b[1] for b in back]) if back else np.zeros(0, np.uint32)
    return ([None if z else d for d, z in zip(docs.tolist(), nulls.tolist(), strict=True)], _sums(size[number], counts),
            flat[_spans(first[number], size[number])])


def _spans(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The indices first[0], first[0] + 1, ... of each span, one span after the other."""
    ends = np.cumsum(size)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(first - (ends - size), size)


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    total = np.r_[0, np.cumsum(values)]
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


def _reassemble(path: str, make, schema: pa.Schema):
    """Rows sorted by block, positions first -> what ``make`` returns for each document's (doc_id, ids, decoded bytes)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, size, token_bytes = token_table(path)

        def finished(payloads: list[bytes]) -> Iterator[pa.RecordBatch]:
            docs, counts, ids = assemble(payloads[0], payloads[1:])
            ends = np.cumsum(counts)
            a = 0
            while a < len(docs):  # whole documents, about DECODE_IDS at once
                b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + DECODE_IDS, side="right")))
                part = ids[(ends[a] - counts[a]):ends[b - 1]]
                decoded = token_bytes[_spans(start[part], size[part])]  # the join with the token-byte table
                n_bytes, at, byte_at, out = _sums(size[part], counts[a:b]), 0, 0, []
                for doc_id, n, m in zip(docs[a:b], counts[a:b].tolist(), n_bytes.tolist(), strict=True):
                    out.append(make(doc_id, part[at:at + n], decoded[byte_at:byte_at + m].tobytes()))
                    at, byte_at = at + n, byte_at + m
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
                a = b

        rows = arrow_rows(batches, "block", "payload")
        for _, group in itertools.groupby(rows, lambda r: r[0]):
            yield from finished([payload for _, payload in group])
    return run


def _met(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    n = width(docs.sparkSession)
    words = text_rows(docs).mapInArrow(_explode(pattern, n * BUCKETS_PER_PARTITION), ROW)
    # Positions only pass through here, dealt by their block.
    met = words.repartition(n, F.when(F.col("bucket") >= 0, F.col("bucket")).otherwise(F.col("block"))).sortWithinPartitions("bucket", "block")
    return met.mapInArrow(_encode(path, pattern), ROW).repartition(n, "block").sortWithinPartitions("block", "bucket")


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids, decoded) of every row: the real ids, and the text that they decode to."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])
    return _met(docs, path, pattern).mapInArrow(_reassemble(path, lambda d, ids, raw: (d, ids.astype(np.int32), raw.decode()), schema),
                                                "doc_id long, ids array<int>, decoded string")


def digest(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
    make = lambda d, ids, raw: (d, len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), hashlib.sha256(raw).hexdigest())
    return _met(docs, path, pattern).mapInArrow(_reassemble(path, make, schema), OUT)


def vocabulary() -> tuple[str, str]:
    """Path of the rank file and the pre-token pattern that the queries use."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@register("op4_bpe")
def op4_bpe(spark, sf_dir):
    return digest(table(spark, sf_dir, "documents"), *vocabulary())
