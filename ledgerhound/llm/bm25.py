"""Exact top-k search: BM25 over an inverted index with block-max WAND, per shard, merged with global statistics.

Documents are dealt to shards of about ``DOCS_PER_SHARD`` by a hash of their id and numbered so that like documents are
neighbours. A shard's index holds, per term, the postings in document order and the highest impact in each block of ``BLOCK_DOCS`` documents. The statistics that scores need (number of documents,
mean length, document frequencies) are counted over all shards first, so scores are the same in every shard.

A query first goes to one shard, that of its own id, and its k best scores there travel with it to the others as its threshold. Those are dealt in
groups: a task has the queries once, takes its shards one after the other, and what it finds in one raises the threshold for the next. In a shard a query's
terms fall into three kinds by their number of postings. Where a term is common, in one of ``COMMON`` of a tile's documents or more, a cursor has nothing to skip: its impacts
there are a row of the tile's matrix, and one product gives what all rows add to the tile's documents, for many queries together; queries that share their
commonest term are neighbours, and rows that none of them has are left out. Of the postings outside the matrices, rare terms have less than a posting
or two in a block, so a posting is its block's maximum, and their cursors visit each. Between them are the terms that blocks are for: their block
maxima are added up first, a document is a candidate if what it has and the maxima of its block reach the threshold, and the cursors only move to blocks that hold
a candidate. The few documents that still reach the threshold are scored exactly, the best first, and raise it. The first shard has no threshold
until all its postings are added up. The shards' lists, each exact, merge by score, then doc_id. Scores
add up in the order of the terms everywhere, so equal documents have equal scores in any shard.

Words are runs of ``\\w`` characters in lower case; a query's terms count once each. Documents that share no term with a query aren't
returned, so null, empty and wordless texts neither find nor are found. Rows with a null doc_id aren't indexed under
an id and are left out. Repeated rows are documents of their own with the same id, and fill ranks of their own. Very long
texts are ordinary. Only doc_id and text are read, so other columns can have any name. An empty table or no query gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_rows, materialize, table, text_rows
from .registry import register

K1, B = 1.2, 0.75
TOP = 10
DOCS_PER_SHARD = 8_192
BYTES_PER_SHARD = 28 << 20
BLOCK_DOCS = 64
#: Documents of a tile; a multiple of a block's.
TILE_DOCS = 1024
#: A term is common in a tile from this part of its documents on (one in COMMON), and rare below this many postings outside the matrices for each block.
COMMON = 8
RARE = 2
#: Candidates that are scored exactly at once; queries that share a product; those whose postings are added up at once; queries that wait for others like them.
FEW = 16
TOGETHER = 64
NEAR = 4
WAITING = 512
#: Queries that travel together, about; groups of shards that tasks search, at most, for each chunk of so many bytes of queries.
BUNDLE = 128
GROUPS = 64
CHUNK_BYTES = 32 << 20
#: Two sums of one set of numbers differ by less than this factor.
SLACK = 1 + 1e-9
WORD = re.compile(r"\w+")
INDEX = "shard long, docs long, words long, term string, df long, payload binary"
SCHEMA = pa.schema([("shard", pa.int64()), ("docs", pa.int64()), ("words", pa.int64()), ("term", pa.string()), ("df", pa.int64()), ("payload", pa.binary())])


def terms(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def by_number(first: np.ndarray, second: np.ndarray | None = None) -> np.ndarray:
    """The stable order of non-negative ints by ``second``, then ``first`` within it, sixteen bits at a time."""
    order = np.arange(len(first))
    for column in (first, second):
        if column is not None:
            for shift in range(0, max(1, int(column.max()).bit_length()) if len(column) else 1, 16):
                order = order[np.argsort(((column[order] >> shift) & 0xFFFF).astype(np.uint16), kind="stable")]
    return order


class Builder:
    """Postings of one shard, gathered document by document."""

    def __init__(self) -> None:
        self.known: defaultdict[str, int] = defaultdict(count().__next__)  # numbers in the order of their first use
        self.ids, self.lengths, self.tops = [], [], []
        self.parts: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []

    def add(self, doc_id: int, text: str | None) -> None:
        words = terms(text)
        counts = Counter(words)
        at = np.fromiter(map(self.known.__getitem__, counts), np.int32, len(counts))
        n = np.fromiter(counts.values(), np.int32, len(counts))
        self.ids.append(doc_id)
        self.lengths.append(len(words))
        self.tops.append(int(at[n == n.max()].min()) if len(at) else -1)
        self.parts.append(at)
        self.counts.append(n)

    def rows(self, shard: int) -> Iterator[pa.RecordBatch]:
        """One row with the index, and one for each term with its document frequency here."""
        # Documents with one commonest word, and of like length, share blocks: their maxima then bound them closely.
        by = np.lexsort((self.lengths, self.tops)).tolist()
        self.ids, self.lengths = [self.ids[k] for k in by], [self.lengths[k] for k in by]
        words = sorted(self.known)
        number = np.empty(len(words), np.int32)
        number[np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))] = np.arange(len(words), dtype=np.int32)  # terms are numbered in their order, in every shard
        sizes = np.array([len(self.parts[k]) for k in by], np.int64)
        doc = np.repeat(np.arange(len(by), dtype=np.int32), sizes)
        term, tf = number[np.concatenate([self.parts[k] for k in by])], np.concatenate([self.counts[k] for k in by])
        order = by_number(term, doc)
        term, tf = term[order], tf[order]
        df = np.bincount(term, minlength=len(words))
        names = "\n".join(words).encode()
        head = np.array([len(self.ids), len(df), len(doc), len(names)], "<i8")
        parts = [head, np.array(self.ids, "<i8"), np.array(self.lengths, "<i4"), sizes.astype("<i4"), df.astype("<i4"), term.astype("<i4"), tf.astype("<i4")]
        self.parts, self.counts = [], []
        raw = b"".join([*[p.tobytes() for p in parts], names])
        payload = len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)
        yield pa.record_batch([pa.array([shard]), pa.array([len(self.ids)]), pa.array([sum(self.lengths)]), pa.nulls(1, pa.string()),
                               pa.nulls(1, pa.int64()), pa.array([payload], pa.binary())], schema=SCHEMA)
        for at in range(0, len(words), 20_000):
            part = words[at:at + 20_000]
            n = len(part)
            yield pa.record_batch([pa.array(np.full(n, shard)), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array(part, pa.string()),
                                   pa.array(df[at:at + n].astype(np.int64)), pa.nulls(n, pa.binary())], schema=SCHEMA)


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, own = None, None
    for shard, doc_id, text in arrow_rows(batches, "shard", "doc_id", "text"):
        if shard != now:
            if own is not None:
                yield from own.rows(now)
            now, own = shard, Builder()
        own.add(doc_id, text)
    if own is not None:
        yield from own.rows(now)


class Index:
    """A shard's index, ready to search under global statistics."""

    def __init__(self, payload: bytes, mean_words: float) -> None:
        payload = pa.decompress(payload[8:], int.from_bytes(payload[:8], "little"), codec="zstd", asbytes=True)
        n_docs, n_terms, n_post, n_names = np.frombuffer(payload, "<i8", 4).tolist()
        at = 32
        self.ids = np.frombuffer(payload, "<i8", n_docs, at)
        lengths = np.frombuffer(payload, "<i4", n_docs, at := at + 8 * n_docs)
        self.sizes = np.frombuffer(payload, "<i4", n_docs, at := at + 4 * n_docs).astype(np.int64)
        df = np.frombuffer(payload, "<i4", n_terms, at := at + 4 * n_docs).astype(np.int64)
        self.words = np.frombuffer(payload, "<i4", n_post, at := at + 4 * n_terms)  # of one document after the other
        tf = np.frombuffer(payload, "<i4", n_post, at := at + 4 * n_post)
        names = payload[at + 4 * n_post:].decode().split("\n") if n_names else []
        self.term = {w: k for k, w in enumerate(names)}
        self.offset = np.cumsum(self.sizes) - self.sizes
        doc = np.repeat(np.arange(n_docs, dtype=np.int32), self.sizes)
        norm = K1 * (1 - B + B * lengths / mean_words)
        self.own = tf * (K1 + 1) / (tf + norm[doc])
        order = by_number(self.words)
        self.doc, self.impact = doc[order], self.own[order]
        self.df = df
        self.blocks = -(-n_docs // BLOCK_DOCS)
        self.block_of = np.arange(n_docs) // BLOCK_DOCS
        term = np.repeat(np.arange(n_terms, dtype=np.int32), df)
        held = self._tile(term, n_docs)
        # The postings outside the matrices, and blocks of the terms between rare and common ones.
        self.doc, self.impact, term = self.doc[~held], self.impact[~held], term[~held]
        self.left = np.bincount(term, minlength=n_terms)
        self.begin = np.cumsum(self.left) - self.left
        self.blocked = self.left >= RARE * max(self.blocks, 1)
        some = np.flatnonzero(self.blocked)
        at = _spans(self.begin[some], self.left[some])
        term, block = term[at], self.block_of[self.doc[at]]
        head = _heads(term, block)
        self.start, self.block = at[head], block[head]
        self.size = np.diff(np.r_[head, len(at)])
        self.high = np.maximum.reduceat(self.impact[at], head) if len(at) else np.zeros(0)
        self.first = np.searchsorted(term[head], np.arange(n_terms))  # a term's first entry of the block table
        self.last = np.searchsorted(term[head], np.arange(n_terms), side="right")
        self.weight = np.zeros(n_terms)
        self.looked = 0  # postings that cursors and exact scores looked at

    def _tile(self, term: np.ndarray, n_docs: int) -> np.ndarray:
        """Fill ``tiles``, (terms, matrix) by tile, and ``row``, whether a term is in any; the postings that are in a matrix."""
        tile = self.doc // TILE_DOCS
        head = _heads(term, tile)
        size = np.diff(np.r_[head, len(term)])
        docs = np.minimum(n_docs - np.arange(-(-n_docs // TILE_DOCS)) * TILE_DOCS, TILE_DOCS)
        full = size * COMMON >= docs[tile[head]]
        held, self.row, self.tiles = np.repeat(full, size), np.zeros(len(self.df), bool), []
        head, size = head[full], size[full]
        self.row[term[head]] = True
        for k, n in enumerate(docs.tolist()):
            own = np.flatnonzero(tile[head] == k)
            at = _spans(head[own], size[own])
            matrix = np.zeros((len(own), n), np.float32)
            matrix[np.repeat(np.arange(len(own)), size[own]), self.doc[at] - k * TILE_DOCS] = self.impact[at]
            self.tiles.append((term[head[own]], matrix))
        return held

    def known(self, words: list[str], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of the words that the shard has, ascending, their weights)."""
        at = self.numbers(words)
        return at[at >= 0], idf[at >= 0]

    def numbers(self, words: list[str]) -> np.ndarray:
        """The words' numbers, -1 where the shard lacks one."""
        number = self.term.get
        return np.fromiter((number(w, -1) for w in words), np.int64, len(words))

    def commonest(self, at: np.ndarray) -> int:
        return int(at[self.df[at].argmax()])

    def common(self, queries: list[tuple]) -> np.ndarray:
        """(query, document): what the common terms add, in single precision."""
        who = np.repeat(np.arange(len(queries)), [len(q[0]) for q in queries])
        at, w = np.concatenate([q[0] for q in queries]), np.concatenate([q[1] for q in queries])
        use = self.row[at]
        have, column = np.unique(at[use], return_inverse=True)
        weights = np.zeros((len(queries), len(have)), np.float32)
        weights[who[use], column] = w[use]
        out = np.zeros((len(queries), len(self.ids)), np.float32)
        for k, (rows, matrix) in enumerate(self.tiles):
            at = np.searchsorted(have, rows)
            live = np.flatnonzero(have[np.minimum(at, len(have) - 1)] == rows) if len(have) else at[:0]
            if len(live):
                np.matmul(weights[:, at[live]], matrix[live], out=out[:, k * TILE_DOCS:k * TILE_DOCS + matrix.shape[1]])
        return out

    def search(self, words: list[str], idf: np.ndarray, top: int, scores: list[float] | None = None) -> list[tuple[int, float]]:
        """The ``top`` best (doc_id, score), best first; with ``scores``, the ``top`` best of other shards, only those that belong among both. ``words`` are sorted."""
        at, weights = self.known(words, idf)
        return self.answers([(at, weights, scores)], top)[0] if len(at) else []

    def answers(self, queries: list[tuple], top: int) -> list[list[tuple[int, float]]]:
        """``search`` for each of the (terms, weights, scores)."""
        n = len(queries)
        who = np.repeat(np.arange(n), [len(q[0]) for q in queries])
        at, w = np.concatenate([q[0] for q in queries]), np.concatenate([q[1] for q in queries])
        in_matrix, blocked = self.row[at], self.blocked[at]
        # Single precision and the order of sums make this much of a difference at most.
        slack = ((np.bincount(who[in_matrix], minlength=n) + 2) * 2.0 ** -22 * (K1 + 1) * np.bincount(who[in_matrix], w[in_matrix], n)
                 + 1e-9 * (K1 + 1) * np.bincount(who, w, n))
        known = [sorted(scores, reverse=True)[:top] if scores and len(scores) >= top else [] for _, _, scores in queries]
        need = np.array([best[-1] if best else -np.inf for best in known])
        low = np.maximum(need - slack, np.nextafter(0, 1))[:, None]
        score = self.common(queries).astype(float)
        rare = at[~blocked]
        self._add(score, who[~blocked], w[~blocked], self.begin[rare], self.left[rare])
        if blocked.any():
            some = at[blocked]
            entries = self.last[some] - self.first[some]
            entry, own, weight = _spans(self.first[some], entries), np.repeat(who[blocked], entries), np.repeat(w[blocked], entries)
            ahead = np.bincount(own * self.blocks + self.block[entry], weight * self.high[entry], n * self.blocks).reshape(n, -1)
            live = np.maximum.reduceat(score, np.arange(0, len(self.ids), BLOCK_DOCS), axis=1) + ahead >= low
            use = live[own, self.block[entry]]
            self._add(score, own[use], weight[use], self.start[entry[use]], self.size[entry[use]])
        row, doc = np.nonzero(score >= low)
        ends = np.searchsorted(row, np.arange(n + 1)).tolist()
        return [self._best(*queries[k][:2], doc[ends[k]:ends[k + 1]], score[k], known[k], slack[k], top) if ends[k] < ends[k + 1] else [] for k in range(n)]

    def _add(self, score: np.ndarray, who: np.ndarray, weight: np.ndarray, start: np.ndarray, size: np.ndarray) -> None:
        """Add to (query, document) what these postings do; ``who`` ascends. Some queries at a time, as numbers that stay in the cache are added faster."""
        ends = np.searchsorted(who, np.arange(0, len(score) + NEAR, NEAR)).tolist()
        for k, (a, b) in enumerate(zip(ends, ends[1:], strict=False)):
            if a < b:
                part = score[k * NEAR:(k + 1) * NEAR]
                span, n = _spans(start[a:b], size[a:b]), size[a:b]
                self.looked += len(span)
                cell = np.repeat((who[a:b] - k * NEAR) * score.shape[1], n) + self.doc[span]
                part += np.bincount(cell, np.repeat(weight[a:b], n) * self.impact[span], part.size).reshape(part.shape)

    def _best(self, at: np.ndarray, weights: np.ndarray, docs: np.ndarray, score: np.ndarray, known: list[float], slack: float, top: int) -> list[tuple[int, float]]:
        """The candidates ``docs``, scored exactly, the best first."""
        need = known[-1] if known else 0.0
        if not known and len(docs) > top:
            kth = np.partition(score[docs], len(docs) - top)[len(docs) - top]
            docs = docs[score[docs] >= kth - 2 * slack]
        docs = docs[np.argsort(-score[docs], kind="stable")]
        found: list[tuple[float, int, int]] = []
        self.weight[at] = weights
        for a in range(0, len(docs), FEW):
            few = docs[a:a + FEW]
            if score[few[0]] < need - slack:
                break
            span = _spans(self.offset[few], self.sizes[few])
            self.looked += len(span)
            exact = np.bincount(np.repeat(np.arange(len(few)), self.sizes[few]), self.weight[self.words[span]] * self.own[span], len(few))
            found = sorted(found + [(-float(x), int(self.ids[d]), int(d)) for d, x in zip(few, exact, strict=True) if x > 0 and x * SLACK >= need])[:top]
            both = sorted(known + [-x for x, _, _ in found], reverse=True)
            need = both[top - 1] if len(both) >= top else need
        self.weight[at] = 0.0
        return [(d, -x) for x, d, _ in found]


def _heads(*columns: np.ndarray) -> np.ndarray:
    """Where a run of equal rows begins."""
    if not len(columns[0]):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.r_[True, np.any([c[1:] != c[:-1] for c in columns], axis=0)])


def _spans(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    ends = np.cumsum(size)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(first - (ends - size), size)


def pack(queries: list[tuple[int, list[tuple[str, int]]]]) -> bytes:
    """(query_id, its (term, document frequency)) of some queries, each term's text once."""
    df = dict(t for _, found in queries for t in found)
    words = sorted(df)
    number = {w: k for k, w in enumerate(words)}
    sizes = [len(found) for _, found in queries]
    at = np.concatenate([np.sort(np.fromiter((number[t] for t, _ in found), "<i4", len(found))) for _, found in queries])
    parts = [np.array([len(queries), len(words), len(at)], "<i8"), np.array([q for q, _ in queries], "<i8"), np.array(sizes, "<i8"),
             np.array([df[w] for w in words], "<i8"), at.astype("<i4")]
    return zlib.compress(b"".join(p.tobytes() for p in parts) + "\n".join(words).encode(), 1)


def unpack(payload: bytes) -> tuple[list[str], np.ndarray, list[tuple[int, np.ndarray]]]:
    """(words, their document frequencies, (query_id, numbers of its words) of each query)."""
    raw = zlib.decompress(payload)
    n, n_words, size = np.frombuffer(raw, "<i8", 3).tolist()
    ids, ends = np.frombuffer(raw, "<i8", n, 24).tolist(), np.cumsum(np.frombuffer(raw, "<i8", n, 24 + 8 * n))
    at = 24 + 16 * n
    df, numbers = np.frombuffer(raw, "<i8", n_words, at), np.frombuffer(raw, "<i4", size, at + 8 * n_words)
    return raw[at + 8 * n_words + 4 * size:].decode().split("\n"), df, list(zip(ids, np.split(numbers, ends[:-1]), strict=True))


def _queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, words = [], []
        for doc_id, text in arrow_rows([batch], "doc_id", "text"):
            own = sorted(set(terms(text)))
            ids += [doc_id] * len(own)
            words += own
        yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(words, pa.string())], names=["query_id", "term"])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def batch() -> pa.RecordBatch:
        return pa.record_batch([pa.array([now], pa.int64()), pa.array([pack(held)], pa.binary())], names=["bundle", "payload"])

    now, held = None, []
    for bundle, query_id, found in arrow_rows(batches, "bundle", "query_id", "found"):
        if held and (bundle != now or len(held) == 4 * BUNDLE):
            yield batch()
            held = []
        now = bundle
        held.append((query_id, [(t["term"], t["df"]) for t in found]))
    if held:
        yield batch()


def _search(docs: int, mean_words: float, top: int, at_home: bool):
    """Searches for the queries at home in a shard, or for all others."""
    schema = pa.schema([("query_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.float64()), ("nth", pa.int32())])

    def search(index: Index, shard: int, bundles: list[tuple], found: dict[int, list[tuple[float, int]]]) -> None:
        waiting = []

        def answer() -> None:
            waiting.sort(key=lambda q: q[0])
            for a in range(0, len(waiting), TOGETHER):
                part = waiting[a:a + TOGETHER]
                for (_, query_id, *_), hits in zip(part, index.answers([q[2:] for q in part], top), strict=True):
                    if hits:
                        found[query_id] = sorted(found.get(query_id, []) + [(-s, d) for d, s in hits])[:top]
            waiting.clear()

        for home, payload, known in bundles:
            if (home == shard) != at_home:
                continue
            words, df, queries = unpack(payload)
            number, idf = index.numbers(words), np.log(1 + (docs - df + 0.5) / (df + 0.5))
            for query_id, at in queries:
                at = at[number[at] >= 0]
                if len(at):
                    scores = [*known.get(query_id, []), *[-s for s, _ in found.get(query_id, [])]]
                    waiting.append((index.commonest(number[at]), query_id, number[at], idf[at], scores))
            if len(waiting) >= WAITING:
                answer()
        if waiting:
            answer()

    def results(found: dict[int, list[tuple[float, int]]]) -> Iterator[pa.RecordBatch]:
        out = [(q, d, -s, n) for q, hits in found.items() for n, (s, d) in enumerate(hits)]
        for a in range(0, len(out), 10_000):
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out[a:a + 10_000], strict=True), schema, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, bundles, found = None, [], {}
        # A task's queries come before its shards.
        for now, shard, home, payload, scores in arrow_rows(batches, "task", "shard", "home", "payload", "scores"):
            if now != task:
                yield from results(found)
                task, bundles, found = now, [], {}
            if shard is None:
                bundles.append((home, payload, {s["query_id"]: s["scores"] for s in scores or []}))
            else:
                search(Index(payload, mean_words), shard, bundles, found)
        yield from results(found)
    return run


def shard_of(doc_id: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(shards)).cast("long")


def build(docs: DataFrame, docs_per_shard: int = DOCS_PER_SHARD) -> tuple[DataFrame, int]:
    """(index rows and term rows, number of shards)."""
    rows = text_rows(docs).filter("doc_id IS NOT NULL")
    n, size = rows.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    shards = max(1, -(-n // docs_per_shard), -(-(size or 0) // BYTES_PER_SHARD))
    dealt = rows.withColumn("shard", shard_of(F.col("doc_id"), shards))
    met = dealt.repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("shard", "doc_id")
    return materialize(met.mapInArrow(_build, INDEX), "bm25-index"), shards


def search(docs: DataFrame, queries: DataFrame, top: int = TOP, docs_per_shard: int = DOCS_PER_SHARD) -> DataFrame:
    """(query_id, rank, doc_id, score): the ``top`` documents of each query; ``queries``: (doc_id, text), one row for each id."""
    index, shards = build(docs, docs_per_shard)
    total, words = index.filter("payload IS NOT NULL").agg(F.sum("docs"), F.sum("words")).first()
    if not words:
        return docs.sparkSession.createDataFrame([], "query_id long, rank int, doc_id long, score double")
    texts = text_rows(queries).filter("doc_id IS NOT NULL")
    asked = texts.mapInArrow(_queries, "query_id long, term string").distinct()
    df = index.filter("term IS NOT NULL").groupBy(F.col("term").alias("t")).agg(F.sum("df").alias("df"))
    # The queries of a bundle have one home, so they take the same way.
    parts = max(1, -(-texts.count() // (shards * BUNDLE)))
    packed = (asked.join(df, F.col("term") == F.col("t")).groupBy("query_id").agg(F.collect_list(F.struct("term", "df")).alias("found"))
              .withColumn("bundle", shard_of(F.col("query_id"), shards * parts)).repartition("bundle").sortWithinPartitions("bundle", "query_id")
              .mapInArrow(_pack, "bundle long, payload binary"))
    packed = materialize(packed.withColumn("home", F.col("bundle") % shards), "bm25-queries")
    held = index.filter("payload IS NOT NULL").select("shard", F.lit(None).cast("long").alias("home"), "payload",
                                                      F.lit(None).cast("array<struct<query_id: long, scores: array<double>>>").alias("scores"))

    def searched(asked: DataFrame, held: DataFrame, tasks: int, at_home: bool) -> DataFrame:
        met = held.unionByName(asked).repartitionById(tasks, F.col("task").cast("int")).sortWithinPartitions("task", F.col("shard").asc_nulls_first())
        return met.mapInArrow(_search(total, words / total, top, at_home), "query_id long, doc_id long, score double, nth int")

    def numbers(n: int) -> Column:
        return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))

    bundles = packed.withColumn("shard", F.lit(None).cast("long"))
    first = bundles.select("shard", "home", "payload", F.col("home").alias("task"), F.lit(None).cast(held.schema["scores"].dataType).alias("scores"))
    first = materialize(searched(first, held.withColumn("task", F.col("shard")), shards, True), "bm25-first")
    if shards > 1:
        # Every other shard gets the queries with their best scores so far: a task has a chunk of the queries and a group of the shards.
        groups = min(shards, GROUPS)
        size = packed.agg(F.sum(F.octet_length("payload"))).first()[0] or 0
        chunks = max(1, -(-size // CHUNK_BYTES))
        best = (first.groupBy("query_id").agg(F.collect_list("score").alias("scores"))  # ``top`` at most
                .groupBy(shard_of(F.col("query_id"), shards * parts).alias("bundle")).agg(F.collect_list(F.struct("query_id", "scores")).alias("scores")))
        sent = (bundles.join(best, "bundle", "left").withColumn("group", F.explode(numbers(groups)))
                .select("shard", "home", "payload", "scores", (shard_of(F.col("bundle"), chunks) * groups + F.col("group")).alias("task")))
        shown = (held.withColumn("chunk", F.explode(numbers(chunks)))
                 .withColumn("task", F.col("chunk") * groups + F.col("shard") % groups).drop("chunk"))
        first = first.unionByName(searched(sent, shown, chunks * groups, False))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id"))
    return first.withColumn("rank", rank).filter(F.col("rank") <= top).select("query_id", "rank", "doc_id", F.round("score", 6).alias("score"))


def query_set(doc_id: Column) -> Column:
    return doc_id % 100 == 0


@register("op9_bm25")
def op9_bm25(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return search(docs, docs.filter(query_set(F.col("doc_id"))))
