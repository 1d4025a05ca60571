"""Removal of passages that repeat across documents, by two-stage suffix sorting.

A byte goes if it is covered by a ``LENGTH``-byte string that also starts in a document with a smaller id. The work is dealt so that
equal strings meet: of the hashes of its ``GRAM``-byte pieces every string has a smallest one, its anchor; equal strings have
equal anchors, and neighbouring strings of a text mostly share theirs, so a text falls into runs of starts with one anchor, and a
run travels as one context of bytes. Three passes over blocks of documents:

1. every block reports its anchors; anchors are counted across blocks, and each block learns which occur elsewhere;
2. for those, blocks send their distinct contexts to the anchor's bucket. A bucket sorts the suffixes of its contexts in two stages:
   only suffixes that are smaller than their successors are sorted directly, all others are induced from their successors by
   scanning the buckets of first bytes in order; adjacent suffixes with a common prefix of ``LENGTH`` or more form a class, whose
   smallest document owns the string. Each block learns the owners of its contexts' strings;
3. blocks drop the bytes of strings that a smaller document owns, and count and hash what is left.

Contexts shrink to distinct ones in each block before they are sent, so a group of copies costs a block one context, however large it is.
An anchor with over ``HEAVY`` runs in the corpus isn't kept together: its strings are sent one by one, dealt by their own hash.

Strings are judged on the input, and never span documents. Null text counts as empty; texts under ``LENGTH`` bytes keep all their
bytes. A null doc_id is not smaller than any, and none is smaller: such rows keep all bytes. Rows that share a doc_id don't
remove each other's bytes, so repeated rows get the same result each. A very long text is a block of its own and is hashed piece by piece. Only
doc_id and text are read, so other columns can have any name. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, materialize, table, text_rows
from .registry import register

LENGTH = 50
GRAM = 20
BLOCK_BYTES = 4 << 20
#: Bytes of a block that are hashed at once.
PIECE_BYTES = 1 << 20
#: Input bytes for each bucket of anchors, and of contexts.
ANCHOR_BUCKET = 32 << 20
CONTEXT_BUCKET = 8 << 20
#: Parts of a bucket of contexts, by anchor; a bucket's parts are sorted one after the other.
PARTS = 16
#: Runs of a block that are compared with their owners at once, and blocks of a task.
RUNS = 1 << 15
TASK_BLOCKS = 4
HEAVY = 60_000
#: Counts of a block's runs are sent in a byte each; those from MOST on follow in full.
MOST = 255
CODEC = "zstd"
U64 = np.uint64
P = U64(0x9E3779B97F4A7C15)
MSG = "block long, kind long, size long, payload binary"
MSG_SCHEMA = pa.schema([("block", pa.int64()), ("kind", pa.int64()), ("size", pa.int64()), ("payload", pa.binary())])
OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def squeeze(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + (pa.compress(raw, codec=CODEC, asbytes=True) if raw else b"")


def expand(data: bytes) -> bytes:
    size = int.from_bytes(data[:8], "little")
    return pa.decompress(data[8:], size, codec=CODEC, asbytes=True) if size else b""


def _message(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), MSG_SCHEMA, strict=True)], schema=MSG_SCHEMA)


# Blocks of documents.

def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext
    numbers = itertools.count(TaskContext.get().partitionId() << 32)
    ids: list = []
    texts: list[bytes] = []
    held = 0

    def packed() -> pa.RecordBatch:
        n = len(ids)
        head = [np.array([n], "<i8"), np.array([0 if x is None else x for x in ids], "<i8"), np.array([len(t) for t in texts], "<i8"),
                np.array([x is None for x in ids], np.uint8)]
        return _message([(next(numbers), -1, held, squeeze(b"".join(a.tobytes() for a in head) + b"".join(texts)))])

    for doc_id, text in arrow_rows(batches, "doc_id", "text"):
        ids.append(doc_id)
        texts.append((text or "").encode())
        held += len(texts[-1])
        if held >= BLOCK_BYTES:
            yield packed()
            ids, texts, held = [], [], 0
    if ids:
        yield packed()


class Block:
    """The documents of a block: ids, where each begins and ends, all bytes."""

    def __init__(self, payload: bytes) -> None:
        raw = expand(payload)
        n = int(np.frombuffer(raw, "<i8", 1)[0])
        self.ids = np.frombuffer(raw, "<i8", n, 8)
        size = np.frombuffer(raw, "<i8", n, 8 + 8 * n)
        self.null = np.frombuffer(raw, np.uint8, n, 8 + 16 * n).astype(bool)
        self.bytes = np.frombuffer(raw, np.uint8, -1, 8 + 17 * n)
        self.end = np.cumsum(size)
        self.start = self.end - size

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, first start, number of starts, document) of each run of starts with one anchor."""
        parts = []
        first = 0
        while first < len(self.ids):  # pieces of about PIECE_BYTES, so that a huge text needs no more memory
            last = max(first + 1, int(np.searchsorted(self.end, self.start[first] + PIECE_BYTES, side="right")))
            lo, hi = int(self.start[first]), int(self.end[last - 1])
            doc = np.repeat(np.arange(first, last, dtype=np.int32), (self.end - self.start)[first:last])
            for at in range(lo, hi, PIECE_BYTES):
                stop = min(hi, at + PIECE_BYTES + LENGTH - 1)
                if stop - at >= LENGTH:
                    parts.append(self._runs(at, stop, doc[at - lo:stop - lo]))
            first = last
        if not parts:
            empty = np.zeros(0, np.int64)
            return empty.astype(U64), empty, empty, empty
        return tuple(np.concatenate(c) for c in zip(*parts, strict=True))

    def _runs(self, at: int, stop: int, doc: np.ndarray) -> tuple[np.ndarray, ...]:
        low = window_min(gram_hashes(self.bytes[at:stop]))
        doc = doc[:len(low)]
        ok = (self.end[doc] - np.arange(at, at + len(low)) >= LENGTH) & ~self.null[doc]
        new = np.ones(len(low), bool)
        new[1:] = (low[1:] != low[:-1]) | (doc[1:] != doc[:-1]) | (ok[1:] != ok[:-1])
        head = np.flatnonzero(new)
        size = np.diff(np.r_[head, len(low)])
        keep = ok[head]
        head, size = head[keep], size[keep]
        return low[head], head + at, size, doc[head]


def _times(a: np.uint64, b: np.uint64) -> np.uint64:
    """The product of two scalars modulo 2 ** 64; numpy warns of their overflow, not of arrays'."""
    return U64(int(a) * int(b) % (1 << 64))


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the GRAM = 16 + 4 bytes from each position on, by doubling."""
    h = (data.astype(U64) + U64(1)) * P
    power, four = P, None
    for k in (1, 2, 4, 8):
        h = h[:-k] * power + h[k:]
        power = _times(power, power)
        if k == 2:
            four = h
    n = len(data) - GRAM + 1
    h = h[:n] * _times(_times(P, P), _times(P, P)) + four[16:16 + n]
    h ^= h >> U64(29)
    h *= U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(32)
    return h


def window_min(h: np.ndarray) -> np.ndarray:
    """The smallest of the LENGTH - GRAM + 1 = 31 hashes from each position on."""
    for k in (1, 2, 4, 8):
        h = np.minimum(h[:-k], h[k:])
    return np.minimum(h[:-15], h[15:])


def _by_bucket(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, indices of its keys in their order)."""
    bucket = (keys % U64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    heads = np.flatnonzero(np.r_[True, np.diff(bucket[order]) != 0]) if len(order) else []
    for a, b in zip(heads, [*heads[1:], len(order)] if len(order) else [], strict=True):
        yield int(bucket[order[a]]), order[a:b]


def _by_part(anchors: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(bucket, indices of its anchors by part, how many each part has)."""
    for b, at in _by_bucket(anchors, buckets):
        part = (anchors[at] // U64(buckets) % U64(PARTS)).astype(np.int64)
        yield b, at[np.argsort(part, kind="stable")], np.bincount(part, minlength=PARTS)


# Pass 1: anchors that occur more than once.

def _anchors(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, payload in arrow_rows(batches, "block", "payload"):
            anchors, count = np.unique(Block(payload).runs()[0], return_counts=True)
            out = [(block, b, len(at), anchors[at].tobytes() + _pack_counts(count[at])) for b, at in _by_bucket(anchors, buckets)]
            if out:
                yield _message(out)
    return run


def _pack_counts(count: np.ndarray) -> bytes:
    return np.minimum(count, MOST).astype(np.uint8).tobytes() + count[count >= MOST].astype("<i8").tobytes()


def _unpack_counts(raw: bytes, n: int) -> np.ndarray:
    count = np.frombuffer(raw, np.uint8, n).astype(np.int64)
    count[count == MOST] = np.frombuffer(raw, "<i8", -1, n) if len(raw) > n else []
    return count


def _grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, list[tuple]]]:
    """Rows (block, kind, size, payload) sorted by ``key``: the rows of each key."""
    rows = arrow_rows(batches, "block", "kind", "size", "payload")
    at = ("block", "kind").index(key)
    for k, group in itertools.groupby(rows, lambda r: r[at]):
        yield k, list(group)


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """To each block: 0, 1 or 2 for its anchors of this bucket: alone, shared, heavy."""
    for bucket, rows in _grouped(batches, "kind"):
        sizes = [r[2] for r in rows]
        anchors = np.frombuffer(b"".join(r[3][:8 * r[2]] for r in rows), U64)
        counts, at = np.empty(len(anchors), np.int64), 0
        for _, _, n, payload in rows:
            counts[at:at + n] = _unpack_counts(payload[8 * n:], n)
            at += n
        order = np.argsort(anchors, kind="stable")
        head = np.flatnonzero(np.r_[True, np.diff(anchors[order]) != 0])
        total = np.add.reduceat(counts[order], head)
        state = np.zeros(len(anchors), np.uint8)
        state[order] = np.repeat((total > 1).astype(np.uint8) + (total > HEAVY), np.diff(np.r_[head, len(order)]))
        out, at = [], 0
        for (block, _, size, _), n in zip(rows, sizes, strict=True):
            out.append((block, bucket, size, squeeze(state[at:at + n].tobytes())))
            at += n
        yield _message(out)


# Pass 2: owners of strings.

class Contexts:
    """The distinct contexts of a block's runs whose anchors are shared, and where each run's context is."""

    def __init__(self, block: Block, states: dict[int, bytes], anchor_buckets: int) -> None:
        anchor, first, size, doc = block.runs()
        anchors, place = np.unique(anchor, return_inverse=True)
        state = np.zeros(len(anchors), np.uint8)
        for b, at in _by_bucket(anchors, anchor_buckets):
            state[at] = np.frombuffer(expand(states[b]), np.uint8)
        state = state[place]
        heavy = np.flatnonzero(state == 2)
        if len(heavy):  # one context for each string
            at = spans(first[heavy], size[heavy])
            owner = np.repeat(doc[heavy], size[heavy])
            keep = state == 1
            first, size, doc = np.r_[first[keep], at], np.r_[size[keep], np.ones(len(at), np.int64)], np.r_[doc[keep], owner]
            anchor = np.r_[anchor[keep], string_hashes(block.bytes, at)]
        else:
            keep = state == 1
            anchor, first, size, doc = anchor[keep], first[keep], size[keep], doc[keep]
        raw, known = block.bytes.tobytes(), {}
        place = known.setdefault
        self.context = np.fromiter((place(raw[a:b], len(known)) for a, b in zip(first.tolist(), (first + size + LENGTH - 1).tolist(), strict=True)), np.int64, len(first))
        self.texts = list(known)
        self.first, self.size, self.doc = first, size, doc
        n = len(self.texts)
        self.anchor = np.zeros(n, U64)
        self.anchor[self.context] = anchor
        self.low = np.full(n, np.iinfo(np.int64).max)
        np.minimum.at(self.low, self.context, block.ids[doc])
        self.starts = np.array([len(t) - LENGTH + 1 for t in self.texts], np.int64)


def string_hashes(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A hash of the LENGTH bytes at each of ``at``."""
    h = np.zeros(len(at), U64)
    for k in range(LENGTH):
        h = h * P + data[at + k] + U64(1)
    h ^= h >> U64(31)
    return h * U64(0xBF58476D1CE4E5B9) >> U64(1)


def spans(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    ends = np.cumsum(size)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(first - (ends - size), size)


def _block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bytes, dict[int, bytes]]]:
    """(block, its documents, the replies by bucket) of rows sorted by block and kind."""
    for block, rows in _grouped(batches, "block"):
        yield block, rows[0][3], {r[1]: r[3] for r in rows[1:]}


def _contexts(anchor_buckets: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, payload, replies in _block_rows(batches):
            own = Contexts(Block(payload), replies, anchor_buckets)
            for b, at, parts in _by_part(own.anchor, buckets):
                texts = [own.texts[k] for k in at.tolist()]
                sizes = np.array([len(t) for t in texts], "<i4")
                yield _message([(block, b, len(texts), squeeze(parts.astype("<i4").tobytes() + sizes.tobytes() + own.low[at].astype("<i8").tobytes() + b"".join(texts)))])
    return run


def sort_starts(data: np.ndarray, ends: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(starts, class): all starts of strings of ``length`` in contexts that end at ``ends``, in suffix order, and which are equal.

    Only what decides the order of the strings is sorted: a suffix counts as smaller than its successor if its first step up
    or down is up. Where that step lies beyond the string, the string is sorted directly, so equal strings are always treated alike.
    """
    n = len(data)
    index = np.int32 if n < 1 << 30 else np.int64
    end = np.repeat(ends.astype(index), np.diff(np.r_[0, ends]))
    where = np.arange(n, dtype=index)
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(data[1:].astype(np.int16) - data[:-1])
    step[ends - 1] = 1
    turn = np.minimum.accumulate(np.where(step != 0, where, index(n))[::-1])[::-1]  # where the first step is
    rising = step[turn] > 0
    base = np.minimum.accumulate(np.where(rising, where, index(n))[::-1])[::-1]  # the suffix from which this one is induced
    is_start = end - where >= length
    direct = rising | (is_start & (turn[base] + 1 >= where + length))
    need = is_start.copy()
    last = ends - length  # the last start of each context; the suffixes after it up to its base are needed, too
    last = last[last >= np.r_[0, ends[:-1]]]
    last = last[~direct[last]]
    need[spans(last + 1, base[last] - last)] = True
    words = np.zeros(n + 8, U64)
    padded = np.r_[data, np.zeros(72, np.uint8)]
    for k in range(8):
        words = (words << U64(8)) | padded[k:n + 8 + k]
    words = np.r_[words, np.zeros(length, U64)]

    # Stage one: sort the rising suffixes by the bytes themselves.
    firsts = np.flatnonzero(need & direct)
    keys = [words[firsts + k] for k in range(0, length - 7, 8)]
    if length % 8:
        keys.append(words[firsts + length - 8])
    firsts = firsts[np.lexsort(keys[::-1])]

    # Stage two: scan the buckets of first bytes in order; a suffix stands where its successor's rank puts it.
    rank = np.zeros(n + 1, index)
    induced = np.flatnonzero(need & ~direct)
    induced = induced[np.lexsort((turn[induced] - induced, data[induced]))]  # by first byte, then by how often it repeats
    repeats = turn[induced] - induced
    first_bytes, induced_bytes = data[firsts], data[induced]
    order, done = [], 0
    for c in range(256):
        a, b = np.searchsorted(induced_bytes, [c, c + 1])
        while a < b:
            stop = a + int(np.searchsorted(repeats[a:b], repeats[a], side="right"))
            level = induced[a:stop]
            level = level[np.argsort(rank[level + 1], kind="stable")]
            rank[level] = np.arange(done, done + len(level))
            order.append(level)
            done += len(level)
            a = stop
        a, b = np.searchsorted(first_bytes, [c, c + 1])
        rank[firsts[a:b]] = np.arange(done, done + b - a)
        order.append(firsts[a:b])
        done += b - a
    suffixes = np.concatenate(order)
    suffixes = suffixes[is_start[suffixes]]

    # Adjacent common prefixes.
    same = np.ones(max(0, len(suffixes) - 1), bool)
    for k in [*range(0, length - 7, 8), length - 8]:
        same &= words[suffixes[1:] + k] == words[suffixes[:-1] + k]
    return suffixes, np.cumsum(np.r_[0, ~same]) if len(suffixes) else np.zeros(0, np.int64)


class Message:
    """The contexts of one block and bucket, by part."""

    def __init__(self, block: int, n: int, payload: bytes) -> None:
        self.block, self.n, self.raw = block, n, expand(payload)
        self.parts = np.cumsum(np.r_[0, np.frombuffer(self.raw, "<i4", PARTS)])
        self.sizes = np.frombuffer(self.raw, "<i4", n, 4 * PARTS)
        self.low = np.frombuffer(self.raw, "<i8", n, 4 * PARTS + 4 * n)
        self.ends = 4 * PARTS + 12 * n + np.cumsum(self.sizes, dtype=np.int64)
        self.owners: list[bytes] = []

    def texts(self, part: int) -> Iterator[bytes]:
        a, b = self.parts[part:part + 2].tolist()
        for end, size in zip(self.ends[a:b].tolist(), self.sizes[a:b].tolist(), strict=True):
            yield self.raw[end - size:end]


def _part_owners(messages: list[Message], part: int) -> None:
    """Gives each message, for every string of its contexts of this part, the smallest document that has it."""
    known: dict[bytes, int] = {}
    place = known.setdefault
    of_row = [np.fromiter((place(t, len(known)) for t in m.texts(part)), np.int64) for m in messages]
    if not known:
        return
    low = np.concatenate([m.low[m.parts[part]:m.parts[part + 1]] for m in messages])
    smallest = np.full(len(known), np.iinfo(np.int64).max)
    np.minimum.at(smallest, np.concatenate(of_row), low)
    sizes = np.fromiter(map(len, known), np.int64, len(known))
    ends = np.cumsum(sizes)
    data = np.frombuffer(b"".join(known), np.uint8)
    known.clear()
    suffixes, classes = sort_starts(data, ends)
    text = np.searchsorted(ends, suffixes, side="right")
    head = np.flatnonzero(np.r_[True, np.diff(classes) != 0])
    owner = np.zeros(int(ends[-1]), np.int64)
    owner[suffixes] = np.repeat(np.minimum.reduceat(smallest[text], head), np.diff(np.r_[head, len(classes)]))
    for m, own in zip(messages, of_row, strict=True):
        m.owners.append(owner[spans((ends - sizes)[own], sizes[own] - LENGTH + 1)].tobytes())


def _owners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """To each block: for every string of its contexts of this bucket the smallest document that has it."""
    for bucket, rows in _grouped(batches, "kind"):
        messages = [Message(block, n, payload) for block, _, n, payload in rows]
        rows.clear()
        for part in range(PARTS):
            _part_owners(messages, part)
        for m in messages:
            yield _message([(m.block, bucket, m.n, squeeze(b"".join(m.owners)))])


# Pass 3: what is left of each document.

def covered(block: Block, own: Contexts, replies: dict[int, bytes], buckets: int) -> np.ndarray:
    """Whether each byte of the block goes."""
    begin = np.zeros(len(own.texts), np.int64)
    parts, held = [], 0
    for b, at, _ in _by_part(own.anchor, buckets):
        parts.append(np.frombuffer(expand(replies.pop(b)), np.int64))
        ends = np.cumsum(own.starts[at])
        begin[at] = held + ends - own.starts[at]
        held += len(parts[-1])
    owner = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    del parts
    depth = np.zeros(len(block.bytes) + 1, np.int32)
    for at in range(0, len(own.first), RUNS):
        size = own.size[at:at + RUNS]
        start = spans(own.first[at:at + RUNS], size)
        mine = np.repeat(block.ids[own.doc[at:at + RUNS]], size)
        gone = start[owner[spans(begin[own.context[at:at + RUNS]], size)] < mine]
        np.add.at(depth, gone, 1)
        np.add.at(depth, gone + LENGTH, -1)
    return np.cumsum(depth[:-1], dtype=np.int32) > 0


def _finish(anchor_buckets: int, buckets: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, payload, replies in _block_rows(batches):
            block = Block(payload)
            own = Contexts(block, {k: v for k, v in replies.items() if k < anchor_buckets}, anchor_buckets)
            gone = covered(block, own, {k - anchor_buckets: v for k, v in replies.items() if k >= anchor_buckets}, buckets)
            out = []
            for doc_id, null, a, b in zip(block.ids.tolist(), block.null.tolist(), block.start.tolist(), block.end.tolist(), strict=True):
                cut = gone[a:b]
                removed = int(cut.sum())
                runs = int(cut[0]) + int((cut[1:] & ~cut[:-1]).sum()) if removed else 0
                left = block.bytes[a:b][~cut] if removed else block.bytes[a:b]
                out.append((None if null else doc_id, b - a, removed, runs, hashlib.sha256(left.tobytes()).hexdigest()))
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
    return run


def _met(rows: DataFrame, key: str, n: int) -> DataFrame:
    return rows.repartition(n, key).sortWithinPartitions(*(["kind", "block"] if key == "kind" else ["block", "kind"]))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    blocks = materialize(text_rows(docs).mapInArrow(_blocks, MSG), "suffix-blocks")
    total, n_blocks = blocks.agg(F.sum("size"), F.count(F.lit(1))).first()
    total = total or 0
    anchor_buckets, buckets = max(1, total // ANCHOR_BUCKET), max(1, total // CONTEXT_BUCKET)
    n = max(1, -(-n_blocks // TASK_BLOCKS))
    anchors = _met(blocks.mapInArrow(_anchors(anchor_buckets), MSG), "kind", anchor_buckets).mapInArrow(_shared, MSG)
    shared = materialize(anchors, "suffix-anchors")
    sent = _met(blocks.unionByName(shared), "block", n).mapInArrow(_contexts(anchor_buckets, buckets), MSG)
    owners = materialize(_met(sent, "kind", buckets).mapInArrow(_owners, MSG).withColumn("kind", F.col("kind") + anchor_buckets), "suffix-owners")
    return _met(blocks.unionByName(shared).unionByName(owners), "block", n).mapInArrow(_finish(anchor_buckets, buckets), OUT)


@register("op3_suffix_dedup")
def op3_suffix_dedup(spark, sf_dir):
    return remove_repeats(table(spark, sf_dir, "documents"))
