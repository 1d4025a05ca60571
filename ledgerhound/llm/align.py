"""Alignment of two tokenizers' tokens by a merge of their byte ends, and how often id pairs are linked in the corpus.

Texts are encoded in blocks. The ends of all tokens of a part of a block, for A and for B, are two sorted lists, which a merge path
divides: diagonals at equal distances are searched for the point where the merge crosses them, so each piece between two diagonals has the same number of
steps and can be merged by itself. All pieces advance in step, and each step gives the tokens that overlap there and whether both end. A group that
begins in one piece and ends in another is stitched from the counts of ends before each piece.

A block keeps each distinct group once. Its documents are sequences of group numbers, and the block sends one row for each id pair
that its groups link, with the number of its documents that hold it. These rows are added up over the corpus, compared with the highest
of their A id, and joined back to the blocks that sent them; a block then adds the counts of its distinct groups along its documents. A very common pair costs a
block one row, so no key is hot.

Null and empty texts, and those whose tokens don't give back a space and the text, have no tokens: all figures are zero and the digest is empty. Repeated
rows are separate documents. Ties for an A id's highest count all count as best. A very long text is a block of its own; memory follows the longest text and
the widest group (its distinct A ids times its distinct B ids). Only doc_id and text are read, so other columns can have any name. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import itertools
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import bundle, pack, unbundle, unpack
from .common import materialize, table, text_rows
from .registry import register
from .words import joined, slices, spans

#: Bytes of text in a block, and in a part that is encoded and merged at once.
BLOCK_BYTES = 24 << 20
PART_BYTES = 1 << 20
#: Steps of a piece of the merge.
STEPS = 256
#: Links that are looked at at once when a block counts its documents.
LINKS = 1 << 22
ROW = "block long, a int, b int, n long, payload binary"
SCHEMA = pa.schema([("block", pa.int64()), ("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64()), ("payload", pa.binary())])
OUT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
#: Ends of the A and of the B ids in a group's key; no id is so large.
BAR = 1 << 30


# Tokenizers.

class Side:
    """A tokenizer: ``encode`` gives the ids of each text; the bytes of every id."""

    def __init__(self, encode, token_bytes: list[bytes]) -> None:
        self.encode = encode
        self.size = np.fromiter(map(len, token_bytes), np.int64, len(token_bytes))
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(token_bytes), np.uint8)

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each text)."""
        got = self.encode(texts)
        counts = np.fromiter(map(len, got), np.int64, len(got))
        return np.fromiter(itertools.chain.from_iterable(got), np.int64, int(counts.sum())), counts

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        return self.data[spans(self.start[ids], self.size[ids])]


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: visible bytes stand for themselves, the others for letters from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


@lru_cache(maxsize=2)
def byte_level(path: str, pattern: str) -> Side:
    """A byte-level vocabulary file; a space goes before the text. Ids are ranks of merges there, so the rank encoder gives the same ids."""
    import tiktoken
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    letters = byte_letters()
    special = {t["id"] for t in spec["added_tokens"]}
    by_id = {i: token.encode() if i in special else bytes(map(letters.__getitem__, token)) for token, i in spec["model"]["vocab"].items()}
    table_ = [by_id.get(i, b"") for i in range(max([*by_id, *special]) + 1)]
    enc = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks={t: i for i, t in by_id.items() if i not in special}, special_tokens={})
    return Side(lambda texts: [enc.encode_ordinary(" " + t) for t in texts], table_)


@lru_cache(maxsize=2)
def pieces(path: str) -> Side:
    """A model of pieces with byte fallback; it puts the space before the text by itself."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    table_ = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in range(sp.get_piece_size())]
    return Side(lambda texts: sp.encode(texts, num_threads=1), table_)


# The merge.

def diagonals(ends_a: np.ndarray, ends_b: np.ndarray, steps: int) -> np.ndarray:
    """How many A ends come before each diagonal of the merge (A first where both end), by binary search on all diagonals at once."""
    at = np.arange(0, len(ends_a) + len(ends_b), steps)
    low, high = np.maximum(0, at - len(ends_b)), np.minimum(at, len(ends_a))
    while (low < high).any():
        mid = (low + high) // 2
        going = low < high
        m = np.where(going, mid, 0)
        taken = np.zeros(len(at), bool)
        taken[going] = ends_a[m[going]] <= ends_b[at[going] - m[going] - 1]  # then A end m is merged before B end d - m - 1
        low, high = np.where(going & taken, mid + 1, low), np.where(going & ~taken, mid, high)
    return low


def merge(ends_a: np.ndarray, ends_b: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(A token, B token, closes) of each overlap, in order; ``closes``: both tokens end there, so the group is whole.

    The pieces write their steps next to each other, and only a closing overlap ends a group: one that a diagonal cuts is stitched.
    """
    total = len(ends_a) + len(ends_b)
    taken_a = np.zeros(total, np.int64)  # A ends merged before each step
    far = np.iinfo(np.int64).max
    a, b = np.r_[ends_a, far], np.r_[ends_b, far]
    i = diagonals(ends_a, ends_b, steps)
    at = np.arange(0, total, steps)
    j = at - i
    for k in range(min(steps, total)):
        if at[-1] + k >= total:  # only the last piece is shorter
            i, j, at = i[:-1], j[:-1], at[:-1]
            if not len(at):
                break
        taken_a[at + k] = i
        first = a[i] <= b[j]
        i, j = i + first, j + ~first
    i = taken_a
    j = np.arange(total) - i
    overlap = (i == 0) | (a[i - 1] != b[j])  # else this step is the B end of a place where both end
    i, j = i[overlap], j[overlap]
    return i, j, a[i] == b[j]


# Blocks.

class Block:
    """Documents of a block, as numbers of its distinct groups."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids: list = []
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.digests: list[str] = []
        self.shown: list[bytes] = []
        self.held = 0

    def add(self, doc_ids: list, texts: pa.Array, one: Side, other: Side) -> None:
        data, stops = joined(texts)
        size = np.diff(np.r_[-1, stops]) - 1
        plain = ["" if t is None else t for t in texts.to_pylist()]
        a, n_a = one.ids(plain)
        b, n_b = other.ids(plain)
        ok = size > 0
        for ids, counts, side in ((a, n_a, one), (b, n_b, other)):
            ok &= _spell(side, ids, counts, data, stops, size)
        a, b = a[np.repeat(ok, n_a)], b[np.repeat(ok, n_b)]
        n_a, n_b = np.where(ok, n_a, 0), np.where(ok, n_b, 0)
        i, j, closes = merge(np.cumsum(one.size[a]), np.cumsum(other.size[b]))
        done_a, done_b = i[closes] + 1, j[closes] + 1
        size_a, size_b = np.diff(np.r_[0, done_a]), np.diff(np.r_[0, done_b])
        n_groups = np.diff(np.r_[0, np.searchsorted(done_a, np.cumsum(n_a), side="right")])
        number = self._number(a, b, size_a, size_b)
        links = np.r_[0, np.cumsum(size_a * size_b)]
        stop = np.cumsum(n_groups)
        self.ids += doc_ids
        self.parts.append((n_a, n_b, n_groups, links[stop] - links[stop - n_groups], number))
        self.held += len(data)
        shown, flat, first = self.texts(), number.tolist(), 0
        for n, good in zip(n_groups.tolist(), ok.tolist(), strict=True):
            self.digests.append(hashlib.sha256(b";".join(map(shown.__getitem__, flat[first:first + n]))).hexdigest() if good else "")
            first += n

    def _number(self, a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
        """The number of each group; a group's key: its A ids, BAR, its B ids."""
        n = len(size_a)
        start = np.cumsum(size_a + size_b + 1) - (size_a + size_b + 1)
        flat = np.full(len(a) + len(b) + n, BAR, np.int32)
        flat[spans(start, size_a)] = a
        flat[spans(start + size_a + 1, size_b)] = b
        raw, place = flat.tobytes(), self.known.setdefault
        first = (4 * start).tolist()
        return np.fromiter((place(raw[x:y], len(self.known)) for x, y in zip(first, [*first[1:], len(raw)] if n else [], strict=True)), np.int64, n)

    def texts(self) -> list[bytes]:
        """Each group as its digest has it."""
        for key in itertools.islice(self.known, len(self.shown), None):
            a, b = _sides(np.frombuffer(key, np.int32))
            self.shown.append(",".join(map(str, a.tolist())).encode() + b"|" + ",".join(map(str, b.tolist())).encode())
        return self.shown

    def rows(self, block: int) -> Iterator[pa.RecordBatch]:
        """The payload of the block, then a row for each id pair that its groups link."""
        n_a, n_b, n_groups, n_links, number = (np.concatenate(c) for c in zip(*self.parts, strict=True))
        group, pair, times, pairs = links([np.frombuffer(k, np.int32) for k in self.known])
        counts = np.zeros(len(pairs), np.int64)
        first = np.searchsorted(group, np.arange(len(self.known) + 1))
        stop = np.cumsum(n_groups)
        cost = np.r_[0, np.cumsum(np.diff(first)[number])]
        at = 0
        while at < len(n_groups):  # some documents at a time
            begin = stop[at] - n_groups[at]
            to = max(at + 1, int(np.searchsorted(cost[stop], cost[begin] + LINKS, side="right")))
            doc = np.repeat(np.arange(to - at), n_groups[at:to])
            own = np.unique(doc * len(self.known) + number[begin:stop[to - 1]])
            doc, own = own // max(1, len(self.known)), own % max(1, len(self.known))
            size = first[own + 1] - first[own]
            linked = np.unique(np.repeat(doc, size) * len(pairs) + pair[spans(first[own], size)])
            counts += np.bincount(linked % max(1, len(pairs)), minlength=len(pairs))
            at = to
        ids = np.array([0 if x is None else x for x in self.ids], np.int64)
        null = np.array([x is None for x in self.ids], np.uint8)
        often = np.argsort(-np.bincount(number, minlength=len(self.known)), kind="stable")
        rank = np.empty(len(often), np.int64)
        rank[often] = np.arange(len(often))
        payload = bundle(ids, null, n_a, n_b, n_groups, n_links, pack(rank[number]), pack(rank[group]), pack(pair), pack(times),
                         np.frombuffer("".join(self.digests).encode(), np.uint8), np.array([len(d) for d in self.digests], np.uint8))
        yield pa.record_batch([pa.array([block]), pa.array([-1], pa.int32()), pa.array([-1], pa.int32()), pa.array([0]), pa.array([payload], pa.binary())], schema=SCHEMA)
        if len(pairs):
            yield pa.record_batch([pa.array(np.full(len(pairs), block)), pa.array((pairs >> 32).astype(np.int32)), pa.array((pairs & 0xFFFFFFFF).astype(np.int32)), pa.array(counts),
                                   pa.nulls(len(pairs), pa.binary())], schema=SCHEMA)


def _sides(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    bar = int(np.argmax(key == BAR))
    return key[:bar], key[bar + 1:]


def _spell(side: Side, ids: np.ndarray, counts: np.ndarray, data: np.ndarray, stops: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the tokens of each text spell a space and the text."""
    total = np.r_[0, np.cumsum(side.size[ids])]
    stop = np.cumsum(counts)
    ok = total[stop] - total[stop - counts] == size + 1
    got = side.bytes_of(ids[np.repeat(ok, counts)])
    first = np.cumsum(np.where(ok, size + 1, 0)) - np.where(ok, size + 1, 0)
    want = np.full(len(got), 32, np.uint8)
    want[spans(first[ok] + 1, size[ok])] = data[spans((stops - size)[ok], size[ok])]
    wrong = np.r_[0, np.cumsum(got != want)]
    ok[ok] = wrong[first[ok] + size[ok] + 1] == wrong[first[ok]]
    return ok


def links(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(group, pair number, times) of the distinct id pairs that each group links, and the pairs: A id * 2**32 + B id, sorted."""
    sizes = np.array([len(k) for k in keys], np.int64)
    flat = np.concatenate(keys).astype(np.int64) if keys else np.zeros(0, np.int64)
    of = np.repeat(np.arange(len(keys)), sizes)
    bar = np.flatnonzero(flat == BAR)
    left = np.arange(len(flat)) < bar[of] if len(flat) else np.zeros(0, bool)
    right = ~left & (flat != BAR)
    (ga, a, ta), (gb, b, tb) = (_counted(of[x], flat[x]) for x in (left, right))
    first = np.searchsorted(gb, np.arange(len(keys) + 1))
    per = first[ga + 1] - first[ga]
    at = spans(first[ga], per)
    pairs, pair = np.unique(np.repeat(a, per) << 32 | b[at], return_inverse=True)
    return np.repeat(ga, per), pair, np.repeat(ta, per) * tb[at], pairs


def _counted(group: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    key, count = np.unique(group << 32 | ids, return_counts=True)
    return key >> 32, key & 0xFFFFFFFF, count


def _blocks(make_one, make_other):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        numbers = itertools.count(TaskContext.get().partitionId() << 32)
        one, other, block = make_one(), make_other(), Block()
        for batch in batches:
            for part in slices(batch, "text", PART_BYTES):
                block.add(part.column("doc_id").to_pylist(), part.column("text"), one, other)
                if block.held >= BLOCK_BYTES:
                    yield from block.rows(next(numbers))
                    block = Block()
            pa.default_memory_pool().release_unused()
        if block.ids:
            yield from block.rows(next(numbers))
    return run


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (block, a, b, n, best, payload) sorted by block, a and b: the payload first, then the corpus-wide counts of its pairs."""
    def finished(payload: bytes, counts: np.ndarray, best: np.ndarray) -> Iterator[pa.RecordBatch]:
        ids, null, n_a, n_b, n_groups, n_links, number, group, pair, times, digests, sizes = unbundle(payload)
        number, group, pair, times = unpack(number), unpack(group), unpack(pair), unpack(times)
        n = int(group.max()) + 1 if len(group) else 0
        sums, bests = np.zeros(n, np.int64), np.zeros(n, np.int64)
        np.add.at(sums, group, counts[pair] * times)
        np.add.at(bests, group, best[pair] * times)
        stop = np.cumsum(n_groups)
        along = [np.r_[0, np.cumsum(x[number])] for x in (bests, sums)]
        cut = np.cumsum(sizes.astype(np.int64)).tolist()
        text = digests.tobytes().decode()
        yield pa.record_batch([pa.array(ids, mask=null.astype(bool)), pa.array(n_a), pa.array(n_b), pa.array(n_groups), pa.array(n_links)] +
                              [pa.array(x[stop] - x[stop - n_groups]) for x in along] +
                              [pa.array([text[a:b] for a, b in zip([0, *cut[:-1]], cut, strict=True)], pa.string())],
                              names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    payload, counts, best = None, [], []
    for batch in batches:
        head = set(np.flatnonzero(batch.column("a").to_numpy(zero_copy_only=False) < 0).tolist())
        starts = sorted({0} | head)
        n, ok = batch.column("n").to_numpy(zero_copy_only=False), batch.column("best").to_numpy(zero_copy_only=False).astype(np.int64)
        for a, b in zip(starts, [*starts[1:], len(n)], strict=True):
            if a in head:
                if payload is not None:
                    yield from finished(payload, np.concatenate(counts), np.concatenate(best))
                payload, counts, best = batch.column("payload")[a].as_py(), [], []
                a += 1
            counts.append(n[a:b])
            best.append(ok[a:b])
    if payload is not None:
        yield from finished(payload, np.concatenate(counts), np.concatenate(best))


def _encoded(docs: DataFrame, make_one, make_other) -> DataFrame:
    return materialize(text_rows(docs).mapInArrow(_blocks(make_one, make_other), ROW), "align-blocks")


def _counts(blocks: DataFrame) -> DataFrame:
    counted = blocks.filter("a >= 0").groupBy("a", "b").agg(F.sum("n").alias("n"))
    counted = materialize(counted, "align-counts")
    top = counted.groupBy("a").agg(F.max("n").alias("most"))
    return counted.join(top, "a").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def pair_counts(docs: DataFrame, make_one, make_other) -> DataFrame:
    """(a, b, n, best) of every id pair that some document links: in how many documents, and whether no other B id is in more with this A id."""
    return _counts(_encoded(docs, make_one, make_other))


def alignment(docs: DataFrame, make_one, make_other) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row; the tokenizers are made where they run."""
    blocks = _encoded(docs, make_one, make_other)
    back = blocks.filter("a >= 0").select("block", "a", "b").join(_counts(blocks), ["a", "b"]).select("block", "a", "b", "n", "best", F.lit(None).cast("binary").alias("payload"))
    own = blocks.filter("a < 0").select("block", "a", "b", "n", F.lit(False).alias("best"), "payload")
    met = own.unionByName(back).repartition("block").sortWithinPartitions("block", "a", "b")
    return met.mapInArrow(_finish, OUT)


def tokenizers():
    """What makes the queries' tokenizers A and B."""
    import public_tokenizers as P
    one, pattern, other = P.path("byte_bpe_50k.json"), P.PATTERN, P.path("piece_bpe_32k.model")
    return lambda: byte_level(one, pattern), lambda: pieces(other)


@register("op11_alignment")
def op11_alignment(spark, sf_dir):
    return alignment(table(spark, sf_dir, "documents"), *tokenizers())
