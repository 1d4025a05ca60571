"""Benchmark decontamination by Wu-Manber search for many test strings at once.

The test strings are the windows of the benchmark items: every ``WINDOW`` consecutive words, or all words of a shorter item. Strings of
one length are searched together. A table of shifts, indexed by the hash of a block of two words, says how far the window's end may move
without passing an occurrence: the distance of that block from the end of any string, or the whole string less one where no
string has it. Where the shift is zero, the strings with that last block (its bucket) are compared: first their first block, then all words
by hash, then by their bytes. Many stretches of a batch of texts are searched in step, each with its own place, so a step is
a few array operations, and most words of clean texts are never looked at. No occurrence crosses texts.

The test strings are shared with all tasks in chunks of at most about ``CHUNK_BYTES`` of benchmark text: the size is
counted first, and of a larger benchmark the chunks follow each other, each in a pass that adds to what is known of every document
(written in between). Long items are cut into overlapping segments. Documents are never shuffled, so no group of copies is hot.

Words are runs of ASCII letters and digits and of all characters beyond ASCII, with A-Z lower-cased. Null, empty or wordless documents have no
words and aren't contaminated; wordless items have no window. Rows that repeat are separate documents; items that share an item_id count as
one. An item with a null id marks words but isn't listed or counted. Very long texts are searched whole. Only doc_id, text and item_id are
read, so other columns can have any name. An empty documents table gives no rows; with an empty benchmark nothing is hit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, table, text_rows
from .registry import register
from .words import LOWER, U64, hashes, joined, mix, runs, slices, spans

WINDOW = 10
CHUNK_BYTES = 4 << 20
#: Words of a segment of a long item.
SEGMENT = 4096
#: Bytes of documents that are searched at once (a longer text is a batch of its own).
BATCH_BYTES = 4 << 20
#: Words of a stretch of text with a place of its own.
STRETCH = 256
#: Pairs of a place and a test string that are compared at once.
PAIRS = 1 << 19
WORD = np.zeros(256, bool)
WORD[48:58] = WORD[97:123] = WORD[128:] = True
STATE = "doc_id long, text string, n_words long, hit binary, items array<string>"
OUT = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def words_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, word starts, word ends, first word of each text and the number of all words)."""
    data, ends = joined(column)
    data = LOWER[data]
    start, end = runs(WORD[data])
    return data, start, end, np.searchsorted(start, np.r_[0, ends])


# The benchmark.

def _segments(window: int):
    """Items as segments: their words joined by spaces; neighbours share window - 1 words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", BATCH_BYTES):
                ids = part.column("item_id").to_pylist()
                data, start, end, first = words_of(part.column("text"))
                raw, out = data.tobytes(), []
                for k, item in enumerate(ids):
                    for a in range(int(first[k]), int(first[k + 1]), SEGMENT):
                        b = min(a + SEGMENT + window - 1, int(first[k + 1]))
                        if a > first[k] and b - a < window:
                            break  # its windows are in the segment before
                        out.append((item, b" ".join(raw[s:e] for s, e in zip(start[a:b].tolist(), end[a:b].tolist(), strict=True))))
                yield pa.record_batch([pa.array([x[0] for x in out], pa.string()), pa.array([x[1].decode() for x in out], pa.string())], names=["item_id", "words"])
    return run


def segments(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_segments(window), "item_id string, words string")


class Tables:
    """Shift tables and buckets of the test strings of some segments, one set for each number of words."""

    def __init__(self, rows: list[tuple[str | None, str]], window: int) -> None:
        vocab: dict[str, int] = {}
        place = vocab.setdefault
        by_size: dict[int, list[tuple[np.ndarray, int]]] = {}
        self.names = sorted({item for item, _ in rows if item is not None})
        number = {item: k for k, item in enumerate(self.names)}
        for item, text in rows:
            ids = np.array([place(w, len(vocab)) for w in text.split(" ")], np.int64)
            size = min(window, len(ids))
            windows = np.lib.stride_tricks.sliding_window_view(ids, size)
            by_size.setdefault(size, []).append((windows, number.get(item, -1)))
        encoded = [w.encode() for w in vocab]
        self.size = np.array([len(w) for w in encoded], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(encoded), np.uint8)
        seed = 0
        while True:  # until no two words of the benchmark share a hash
            self.seed, self.hash = seed, hashes(self.data, self.start, self.start + self.size, seed)
            if len(np.unique(self.hash)) == len(self.hash):
                break
            seed += 1
        self.sets = {size: Strings(self, size, parts) for size, parts in sorted(by_size.items())}


def block_hash(before: np.ndarray, last: np.ndarray) -> np.ndarray:
    return mix(before * U64(0x9E3779B97F4A7C15) + last)


class Strings:
    """The test strings of one number of words."""

    def __init__(self, tables: Tables, size: int, parts: list[tuple[np.ndarray, int]]) -> None:
        self.size, self.block = size, min(2, size)
        rows = np.concatenate([p for p, _ in parts])
        item = np.repeat([k for _, k in parts], [len(p) for p, _ in parts])
        order = np.lexsort(rows.T[::-1])
        rows, item = rows[order], item[order]
        new = np.r_[True, (rows[1:] != rows[:-1]).any(1)]
        self.words, which = rows[new], np.cumsum(new) - 1
        pairs = np.unique(np.stack([which, item], 1), axis=0)
        pairs = pairs[pairs[:, 1] >= 0]
        self.items, self.item_start = pairs[:, 1], np.searchsorted(pairs[:, 0], np.arange(len(self.words) + 1))
        h = tables.hash[self.words]
        blocks = h if self.block == 1 else block_hash(h[:, :-1], h[:, 1:])  # the block that ends at each word but the first
        self.bits = max(10, int(4 * blocks.size - 1).bit_length())
        slot = self.slot(blocks)
        longest = size - self.block + 1
        self.shift = np.full(1 << self.bits, min(longest, 255), np.uint8)
        for k in range(slot.shape[1]):  # from the first block on, so that the least shift stays
            self.shift[slot[:, k]] = np.minimum(self.shift[slot[:, k]], min(longest - 1 - k, 255))
        order = np.argsort(slot[:, -1], kind="stable")
        self.words, self.hash, self.prefix = self.words[order], h[order], blocks[order, 0]
        self.bucket = np.searchsorted(slot[order, -1], np.arange((1 << self.bits) + 1))
        sizes = np.diff(self.item_start)[order]
        self.items = self.items[spans(self.item_start[:-1][order], sizes)]
        self.item_start = np.r_[0, np.cumsum(sizes)]

    def slot(self, blocks: np.ndarray) -> np.ndarray:
        return (blocks >> U64(64 - self.bits)).astype(np.int64)

    def _last(self, h: np.ndarray, at: np.ndarray) -> np.ndarray:
        return h[at] if self.block == 1 else block_hash(h[at - 1], h[at])

    def places(self, h: np.ndarray) -> tuple[np.ndarray, int]:
        """(where a window ends whose last block is that of some string, blocks looked at)."""
        at = np.arange(self.size - 1, len(h), STRETCH)
        stop = np.minimum(at + STRETCH, len(h))
        found, looked = [np.zeros(0, np.int64)], 0
        while len(at):
            looked += len(at)
            step = self.shift[self.slot(self._last(h, at))]
            found.append(at[step == 0])
            at = at + np.maximum(step, 1)
            going = at < stop
            if not going.all():
                at, stop = at[going], stop[going]
        return np.sort(np.concatenate(found)), looked

    def candidates(self, h: np.ndarray, places: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(first word, string) of the pairs whose words have equal hashes."""
        slot = self.slot(self._last(h, places))
        count = self.bucket[slot + 1] - self.bucket[slot]
        total, a = np.r_[0, np.cumsum(count)], 0
        while a < len(places):
            b = max(a + 1, int(np.searchsorted(total, total[a] + PAIRS, side="right")) - 1)
            string = spans(self.bucket[slot[a:b]], count[a:b])
            first = np.repeat(places[a:b], count[a:b]) - self.size + 1
            like = self._last(h, first + self.block - 1) == self.prefix[string]
            for k in range(self.size):
                first, string = first[like], string[like]
                like = h[first + k] == self.hash[string, k]
            yield first[like], string[like]
            a = b


def occurrences(tables: Tables, data: np.ndarray, start: np.ndarray, end: np.ndarray, first: np.ndarray) -> Iterator[tuple[Strings, np.ndarray, np.ndarray]]:
    """(strings, first word, string) of all occurrences within texts."""
    h = hashes(data, start, end, tables.seed)
    for strings in tables.sets.values():
        if len(h) < strings.size:
            continue
        for at, which in strings.candidates(h, strings.places(h)[0]):
            text = np.searchsorted(first, at, side="right")
            ok = at + strings.size <= first[text]
            at, which = at[ok], which[ok]
            if not len(at):
                continue
            # Direct comparison, once for each word of the text: its hash names one word of the benchmark.
            word, pick = np.unique((at[:, None] + np.arange(strings.size)).ravel(), return_index=True)
            other = strings.words[which].ravel()[pick]
            same = end[word] - start[word] == tables.size[other]
            size = np.where(same, tables.size[other], 0)
            differs = data[spans(start[word], size)] != tables.data[spans(tables.start[other], size)]
            total = np.r_[0, np.cumsum(differs)]
            stop = np.cumsum(size)
            same &= total[stop] == total[stop - size]
            bad = word[~same]
            if len(bad):
                ok = np.searchsorted(bad, at) == np.searchsorted(bad, at + strings.size)
                at, which = at[ok], which[ok]
            yield strings, at, which


@lru_cache(maxsize=1)
def _tables(rows: tuple, window: int) -> Tables:
    return Tables(list(rows), window)


def _search(shared, window: int, first_chunk: bool, last_chunk: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _tables(shared.value, window)
        for batch in batches:
            for part in slices(batch, "text", BATCH_BYTES):
                yield searched(tables, part)
            pa.default_memory_pool().release_unused()

    def searched(tables: Tables, part: pa.RecordBatch) -> pa.RecordBatch:
        data, start, end, first = words_of(part.column("text"))
        n_words = np.diff(first)
        depth = np.zeros(len(start) + 1, np.int64)
        hit_items = []
        for strings, at, which in occurrences(tables, data, start, end, first):
            np.add.at(depth, at, 1)
            np.add.at(depth, at + strings.size, -1)
            text = np.searchsorted(first, at, side="right") - 1
            pairs = np.unique(text * len(strings.words) + which)
            text, which = pairs // len(strings.words), pairs % len(strings.words)
            count = strings.item_start[which + 1] - strings.item_start[which]
            hit_items.append(np.unique(np.repeat(text, count) * len(tables.names) + strings.items[spans(strings.item_start[which], count)]))
        hit = np.cumsum(depth[:-1]) > 0
        found = np.unique(np.concatenate(hit_items)) if hit_items else np.zeros(0, np.int64)
        names: dict[int, list[str]] = {}
        for key in found.tolist():
            names.setdefault(key // len(tables.names), []).append(tables.names[key % len(tables.names)])
        if not first_chunk:
            for k, (old, items) in enumerate(zip(part.column("hit").to_pylist(), part.column("items").to_pylist(), strict=True)):
                if old:
                    hit[first[k]:first[k + 1]] |= np.unpackbits(np.frombuffer(old, np.uint8), count=int(n_words[k])).astype(bool)
                if items:
                    names[k] = sorted({*items, *names.get(k, [])})
        total = np.r_[0, np.cumsum(hit)]
        n_hit = total[first[1:]] - total[first[:-1]]
        if last_chunk:
            none = hashlib.sha256(b"").hexdigest()
            digest = [hashlib.sha256(",".join(names[k]).encode()).hexdigest() if k in names else none for k in range(part.num_rows)]
            return pa.record_batch([part.column("doc_id"), pa.array(n_words), pa.array(n_hit), pa.array([len(names.get(k, ())) for k in range(part.num_rows)], pa.int64()),
                                    pa.array(digest, pa.string()), pa.array(n_hit > 0)],
                                   names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])
        marks = [np.packbits(hit[first[k]:first[k + 1]]).tobytes() if n_hit[k] else None for k in range(part.num_rows)]
        return pa.record_batch([part.column("doc_id"), part.column("text"), pa.array(n_words), pa.array(marks, pa.binary()),
                                pa.array([names.get(k) for k in range(part.num_rows)], pa.list_(pa.string()))],
                               names=["doc_id", "text", "n_words", "hit", "items"])
    return run


def chunks(benchmark: DataFrame, window: int, limit: int) -> Iterator[tuple]:
    """The segments, some of them (about ``limit`` bytes at most) at a time."""
    rows = materialize(segments(benchmark, window), "benchmark-segments")
    total = rows.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    n = max(1, -(-2 * total // limit)) if total > limit else 1
    dealt = rows.withColumn("chunk", F.pmod(F.xxhash64("item_id", "words"), F.lit(n)))
    for k in range(n):
        yield k == n - 1, tuple((r.item_id, r.words) for r in dealt.filter(F.col("chunk") == k).select("item_id", "words").distinct().collect())


def _passes(docs: DataFrame, benchmark: DataFrame, window: int, limit: int, end) -> DataFrame:
    spark, state, first = docs.sparkSession, text_rows(docs), True
    for last, rows in chunks(benchmark, window, limit):
        shared = spark.sparkContext.broadcast(rows)
        if last and end:
            return state.mapInArrow(_search(shared, window, first, True), OUT)
        state = state.mapInArrow(_search(shared, window, first, False), STATE)
        if not last:
            state = materialize(state, "decontaminate")
        first = False
    return state


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, limit: int = CHUNK_BYTES) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of every row."""
    return _passes(docs, benchmark, window, limit, True)


def marked(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, limit: int = CHUNK_BYTES) -> DataFrame:
    """(doc_id, text, n_words, hit, items) of every row: ``hit`` has a bit for each word (null: none is hit), ``items`` the sorted items (null: none)."""
    return _passes(docs, benchmark, window, limit, False)


SQL = r"""
WITH w AS (
  SELECT rowid AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM (SELECT row_number() OVER () AS rowid, doc_id, text FROM documents)),
b AS (
  SELECT item_id::VARCHAR AS item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(10, len(ws)) AS k, array_to_string(list_slice(ws, i, i + least(10, len(ws)) - 1), ' ') AS win
  FROM (SELECT item_id, ws, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS i FROM b WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT k FROM bw),
pos AS (SELECT r, k, unnest(range(1, len(ws) - k + 2)) AS i, ws FROM w, sizes WHERE len(ws) >= k),
occ AS (
  SELECT p.r, p.i, p.k, bw.item_id
  FROM (SELECT r, i, k, array_to_string(list_slice(ws, i, i + k - 1), ' ') AS win FROM pos) p JOIN bw ON p.k = bw.k AND p.win = bw.win),
hit AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS j FROM (SELECT DISTINCT r, i, k FROM occ)) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT r, item_id FROM occ WHERE item_id IS NOT NULL) GROUP BY r)
SELECT w.doc_id, coalesce(len(w.ws), 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""


@register("op13_decontamination", SQL)
def op13_decontamination(spark, sf_dir):
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
