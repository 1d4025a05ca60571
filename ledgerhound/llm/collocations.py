"""Phrase collocation mining on a weighted de Bruijn graph of words.

The longest grams are three words. Every word of a piece of text starts one, and the END mark fills what lies beyond the piece, so a gram
is an edge from node (first, second) to node (second, third), and the grams with END are the corrections for piece ends. Edges are
counted once: in each batch of texts, then across the corpus, dealt by their first word and a salt of the second, so that a hot word
is spread and the edges of a node still meet. Shorter counts aren't counted again: a two-word phrase occurs as often as edges flow out of its
node, END included, and a word as often as its nodes' edges do.

Edges and nodes below the least count can't be candidates and go. What stays is compacted: a node with one edge in and one out that both
carry its whole flow is inside a unary path. Pointer doubling links these nodes to the end of their path in as many rounds as the longest path has
binary digits. All grams along a path have one count, so its inner nodes are phrases that lie in a longer candidate of the same
count, and never stand by themselves; only nodes between paths are scored.

Words are 64-bit hashes (of language and word) until the end, when a second pass over the texts names those of the candidates. If
two words of that pass share a hash, all is done again with other hashes, so counts are exact. Scores are exact decimals.

Null languages count as ``und``, null texts as empty. Words may have any length, and very long texts are one batch each. Repeated rows count as often
as they come. Ties of the last rank are broken by the phrase. Only lang and text are read, so other columns can have any name. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, table
from .registry import register
from .words import LOWER, U64, hashes, joined, mix, runs, slices, spans

MIN_COUNT = 10
#: A candidate goes if a longer one that holds it has at least this percentage of its count.
PERCENT = 50
TOP = 2000
END = 0
#: Texts that are counted at once, in bytes.
BATCH_BYTES = 16 << 20
#: Parts of the edges of one first word, and of a language's phrases before the last ranking.
SALTS = 32
SPLIT = np.zeros(256, bool)
SPLIT[[*b".,;:!?", 10, 11, 12, 13]] = True
WORD = ~SPLIT
WORD[[32, 9]] = False
EDGE = "a long, b long, c long, n long"
FLOW = "kind int, a long, b long, c long, n long"


class Words:
    """The words of some texts: where they are, their hashes, and whether the next word follows in the same piece."""

    def __init__(self, part: pa.RecordBatch, seed: int) -> None:
        data, ends = joined(part.column("text"))
        self.data = LOWER[data]
        self.start, self.end = runs(WORD[self.data])
        langs = ["und" if x is None else x for x in part.column("lang").to_pylist()]
        number: dict[str, int] = {}
        own = np.array([number.setdefault(x, len(number)) for x in langs], np.int64)
        self.names = list(number)
        self.lang = np.repeat(own, np.diff(np.searchsorted(self.start, np.r_[0, ends])))
        salt = np.array([xxhash.xxh64_intdigest(x.encode(), seed) for x in self.names], U64)
        self.hash = mix(hashes(self.data, self.start, self.end, seed) ^ salt[self.lang])
        self.hash[self.hash == END] = 1
        piece = np.searchsorted(np.flatnonzero(SPLIT[self.data]), self.start)
        self.follows = np.zeros(len(self.start) + 1, bool)
        self.follows[:-2] = piece[1:] == piece[:-1]


def _distinct(first: np.ndarray, *more: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """(one index of each distinct row, its count) of columns of numbers below ``base``."""
    key, top = first.astype(np.int64), base
    for column in more:
        if top * base >= 1 << 63:
            key = np.unique(key, return_inverse=True)[1]
            top = len(key) + 1
        key, top = key * base + column, top * base
    _, index, count = np.unique(key, return_index=True, return_counts=True)
    return index, count


def _edges(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", BATCH_BYTES):
                yield counted(Words(part, seed))
            pa.default_memory_pool().release_unused()

    def counted(words: Words) -> pa.RecordBatch:
        known, number = np.unique(words.hash, return_inverse=True)
        number = np.r_[number + 1, 0, 0]  # 0 is END
        n = len(words.start)
        second = np.where(words.follows[:n], number[1:n + 1], 0)
        third = np.where(words.follows[:n] & words.follows[1:n + 1], number[2:n + 2], 0)
        index, count = _distinct(number[:n], second, third, base=len(known) + 1)
        named = np.r_[U64(END), known].view(np.int64)
        return pa.record_batch([pa.array(named[x[index]]) for x in (number[:n], second, third)] + [pa.array(count)], names=["a", "b", "c", "n"])
    return run


def _flows(least: int):
    """Edges sorted by (a, b, c) -> kind 3: edges, 2: nodes with all that flows out of them, both from ``least`` on; 1: this partition's share of each word."""
    schema = pa.schema([("kind", pa.int32())] + [(x, pa.int64()) for x in "abcn"])

    def rows(kind: int, a, b, c, n) -> pa.RecordBatch:
        zero = np.zeros(len(n), np.int64)
        return pa.record_batch([pa.array(np.full(len(n), kind, np.int32))] + [pa.array(zero if x is None else x) for x in (a, b, c, n)], schema=schema)

    def sums(keys: list[np.ndarray], n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        new = np.zeros(len(n), bool)
        new[:1] = True
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
        head = np.flatnonzero(new)
        return head, np.add.reduceat(n, head) if len(head) else n[:0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 4  # the edge, the node and the word that the next batch may go on with
        node, word = [np.zeros(0, np.int64)] * 3, [np.zeros(0, np.int64)] * 2

        def step(batch: list[np.ndarray], last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, node, word
            a, b, c, n = (np.r_[x, y] for x, y in zip(held, batch, strict=True))
            head, total = sums([a, b, c], n)
            a, b, c, n = a[head], b[head], c[head], total
            keep = len(n) - (not last and len(n) > 0)
            held = [x[keep:] for x in (a, b, c, n)]
            a, b, c, n = a[:keep], b[:keep], c[:keep], n[:keep]
            heavy = (n >= least) & (c != END)
            yield rows(3, a[heavy], b[heavy], c[heavy], n[heavy])
            a, b, n = np.r_[node[0], a], np.r_[node[1], b], np.r_[node[2], n]
            head, total = sums([a, b], n)
            a, b, n = a[head], b[head], total
            keep = len(n) - (not last and len(n) > 0)
            node = [x[keep:] for x in (a, b, n)]
            a, b, n = a[:keep], b[:keep], n[:keep]
            heavy = (n >= least) & (b != END)
            yield rows(2, a[heavy], b[heavy], None, n[heavy])
            a, n = np.r_[word[0], a], np.r_[word[1], n]
            head, total = sums([a], n)
            a, n = a[head], total
            keep = len(n) - (not last and len(n) > 0)
            word = [a[keep:], n[keep:]]
            yield rows(1, a[:keep], None, None, n[:keep])

        for batch in batches:
            yield from step([x.to_numpy(zero_copy_only=False) for x in batch.columns], False)
        yield from step([np.zeros(0, np.int64)] * 4, True)
    return run


def flows(docs: DataFrame, least: int, seed: int) -> DataFrame:
    edges = _texts(docs).mapInArrow(_edges(seed), EDGE)
    dealt = edges.repartition("a", F.pmod(F.xxhash64("b"), F.lit(SALTS))).sortWithinPartitions("a", "b", "c")
    return materialize(dealt.mapInArrow(_flows(least), FLOW), "phrase-flows")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))


# Unary paths.

def _outs(edges: DataFrame) -> DataFrame:
    return edges.groupBy("a", "b").agg(F.count(F.lit(1)).alias("outs"), F.max("n").alias("most_out"), F.max("c").alias("next"))


def _ins(edges: DataFrame) -> DataFrame:
    return (edges.groupBy(F.col("b").alias("a"), F.col("c").alias("b")).agg(F.count(F.lit(1)).alias("ins"), F.max("n").alias("most_in")))


def paths(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(a, b, n, last_a, last_b, left): every node inside a unary path, its flow, the path's last inner node and the steps to it.

    The nodes of a path without end (a cycle) stand for themselves.
    """
    inner = (nodes.join(_outs(edges).filter("outs = 1"), ["a", "b"]).join(_ins(edges).filter("ins = 1"), ["a", "b"])
             .filter("most_out = n AND most_in = n").select("a", "b", "n", "next"))
    inner = materialize(inner, "phrase-inner")
    to = inner.select(F.col("a").alias("b"), F.col("b").alias("next"))  # the nodes that a step can lead to
    now = (inner.join(to.withColumn("inside", F.lit(True)), ["b", "next"], "left")
           .select("a", "b", "n", F.when(F.col("inside"), F.col("b")).otherwise(F.col("a")).alias("last_a"),
                   F.when(F.col("inside"), F.col("next")).otherwise(F.col("b")).alias("last_b"), F.when(F.col("inside"), 1).otherwise(0).cast("long").alias("left")))
    now = materialize(now, "phrase-paths")
    size = 0  # rounds end when no pointer moves, or when only cycles are left: then all others have reached their end
    before = -1
    while True:
        ahead = now.select(F.col("a").alias("last_a"), F.col("b").alias("last_b"), F.col("last_a").alias("far_a"), F.col("last_b").alias("far_b"), F.col("left").alias("more"))
        now = materialize(now.join(ahead, ["last_a", "last_b"]).select("a", "b", "n", F.col("far_a").alias("last_a"), F.col("far_b").alias("last_b"),
                                                                       (F.col("left") + F.col("more")).alias("left")), "phrase-paths")
        ends = now.filter("left = 0").select(F.col("a").alias("last_a"), F.col("b").alias("last_b"))
        size = now.join(ends, ["last_a", "last_b"], "left_semi").count()
        if size == before:
            break
        before = size
    done = now.join(ends.withColumn("ended", F.lit(True)), ["last_a", "last_b"], "left")
    return done.select("a", "b", "n", F.when(F.col("ended"), F.col("last_a")).otherwise(F.col("a")).alias("last_a"),
                       F.when(F.col("ended"), F.col("last_b")).otherwise(F.col("b")).alias("last_b"), F.when(F.col("ended"), F.col("left")).otherwise(0).alias("left"))


# Scores.

def _score(count: str, left: str, right: str) -> Column:
    """floor(1000000 * count * count / (left * right)), in exact decimals."""
    d = lambda x: F.col(x).cast("decimal(15,0)")
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * d(count) * d(count), d(left) * d(right)).cast("long")


def phrases(flow: DataFrame, percent: int) -> DataFrame:
    """(x, y, z, a, l, r, score) of the candidates that stay; z is null for two words."""
    edges = flow.filter("kind = 3").select("a", "b", "c", "n")
    nodes = flow.filter("kind = 2").select("a", "b", "n")
    words = flow.filter("kind = 1").groupBy("a").agg(F.sum("n").alias("n"))
    first = words.select(F.col("a").alias("x"), F.col("n").alias("fx"))
    last = words.select(F.col("a").alias("w"), F.col("n").alias("fw"))
    inside = paths(edges, nodes).select("a", "b")
    alone = (nodes.join(inside, ["a", "b"], "left_anti").join(_outs(edges).select("a", "b", "most_out"), ["a", "b"], "left")
             .join(_ins(edges).select("a", "b", "most_in"), ["a", "b"], "left")
             .filter(100 * F.greatest(F.coalesce("most_out", F.lit(0)), F.coalesce("most_in", F.lit(0))) < percent * F.col("n")))
    two = (alone.select(F.col("a").alias("x"), F.col("b").alias("w"), F.col("n").alias("a")).join(first, "x").join(last, "w")
           .select("x", F.col("w").alias("y"), F.lit(None).cast("long").alias("z"), "a", F.col("fx").alias("l"), F.col("fw").alias("r"), _score("a", "fx", "fw").alias("score")))
    head = nodes.select(F.col("a").alias("x"), F.col("b").alias("y"), F.col("n").alias("fxy"))
    tail = nodes.select(F.col("a").alias("y"), F.col("b").alias("w"), F.col("n").alias("fyz"))
    three = (edges.select(F.col("a").alias("x"), F.col("b").alias("y"), F.col("c").alias("w"), F.col("n").alias("a"))
             .join(head, ["x", "y"]).join(tail, ["y", "w"]).join(first, "x").join(last, "w")
             .withColumn("one", _score("a", "fx", "fyz")).withColumn("two", _score("a", "fxy", "fw")))
    lower = F.col("one") <= F.col("two")
    three = three.select("x", "y", F.col("w").alias("z"), "a", F.when(lower, F.col("fx")).otherwise(F.col("fxy")).alias("l"),
                         F.when(lower, F.col("fyz")).otherwise(F.col("fw")).alias("r"), F.least("one", "two").alias("score"))
    return two.unionByName(three)


# Names.

def _unlike(words: Words, same: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The words of ``same`` whose language or bytes aren't those of the words ``other``."""
    size, like = words.end - words.start, words.lang[same] == words.lang[other]
    like &= size[same] == size[other]
    for at in range(0, len(same), 1 << 18):
        x, y, ok = same[at:at + (1 << 18)], other[at:at + (1 << 18)], like[at:at + (1 << 18)]
        n = np.where(ok, size[x], 0)
        total = np.r_[0, np.cumsum(words.data[spans(words.start[x], n)] != words.data[spans(words.start[y], n)])]
        stop = np.cumsum(n)
        ok &= total[stop] == total[stop - n]
    return same[~like]


def _names(seed: int):
    """The words behind the hashes, each once for a batch, and the number of words of each language."""
    schema = pa.schema([("h", pa.int64()), ("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", BATCH_BYTES):
                yield named(Words(part, seed))
            pa.default_memory_pool().release_unused()

    def named(words: Words) -> pa.RecordBatch:
        _, at, place = np.unique(words.hash, return_index=True, return_inverse=True)
        at = np.r_[at, _unlike(words, np.arange(len(place)), at[place])]
        raw = words.data
        total = np.bincount(words.lang, minlength=len(words.names))
        rows = len(words.names)
        h = np.r_[words.hash[at].view(np.int64), np.full(rows, END)]
        return pa.record_batch([pa.array(h), pa.array([words.names[k] for k in words.lang[at].tolist()] + words.names, pa.string()),
                                pa.array([raw[a:b].tobytes().decode() for a, b in zip(words.start[at].tolist(), words.end[at].tolist(), strict=True)] + [None] * rows, pa.string()),
                                pa.array(np.r_[np.zeros(len(at), np.int64), total])], schema=schema)
    return run


def names(docs: DataFrame, flow: DataFrame, seed: int) -> DataFrame:
    """(h, lang, word, n): the words of heavy nodes, several for one hash if they share it; with hash END: the number of words of each language."""
    nodes = flow.filter("kind = 2")
    ends = docs.sparkSession.createDataFrame([(END,)], "a long")
    wanted = nodes.select("a").unionByName(nodes.select(F.col("b").alias("a"))).unionByName(ends).distinct().select(F.col("a").alias("h"))
    rows = _texts(docs).mapInArrow(_names(seed), "h long, lang string, word string, n long").repartition("h")
    return materialize(rows.groupBy("h", "lang", "word").agg(F.sum("n").alias("n")).join(wanted, "h", "left_semi"), "phrase-names")


def _best(found: DataFrame, top: int) -> DataFrame:
    """``found`` with the column rank: the best ``top`` rows of each language. Parts of a language are ranked first, then groups of these,
    so the last task of a language gets a fixed number of rows at most."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    ranked = found.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int"))
    for parts in (SALTS, 4, 1):
        ranked = ranked.withColumn("part", F.col("part") % parts)
        ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= top)
    return ranked.drop("part")


def collocations(docs: DataFrame, least: int = MIN_COUNT, percent: int = PERCENT, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best ``top`` phrases of each language."""
    seed = 0
    while True:
        flow = flows(docs, least, seed)
        named = names(docs, flow, seed)
        words = named.filter(F.col("h") != END)
        if not words.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").take(1):
            break
        seed += 1
    words = words.select("h", "lang", "word")
    name = lambda x: words.select(F.col("h").alias(x), F.col("word").alias(f"word_{x}"))
    found = phrases(flow, percent).join(words.select(F.col("h").alias("x"), "lang", F.col("word").alias("word_x")), "x").join(name("y"), "y").join(name("z"), "z", "left")
    found = found.select("lang", F.concat_ws(" ", "word_x", "word_y", "word_z").alias("phrase"), "a", "l", "r", "score")
    ranked = _best(found, top)
    sizes = named.filter(F.col("h") == END).select("lang", "n")
    return ranked.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
g AS MATERIALIZED (SELECT lang, ws[i] AS x, ws[i + 1] AS y, ws[i + 2] AS z FROM (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w WHERE len(ws) > 0)),
f1 AS MATERIALIZED (SELECT lang, x, count(*)::HUGEINT AS f FROM g GROUP BY ALL),
f2 AS MATERIALIZED (SELECT lang, x, y, count(*)::HUGEINT AS f FROM g WHERE y IS NOT NULL GROUP BY ALL),
f3 AS MATERIALIZED (SELECT lang, x, y, z, count(*)::HUGEINT AS f FROM g WHERE z IS NOT NULL GROUP BY ALL),
h3 AS MATERIALIZED (SELECT * FROM f3 WHERE f >= 10),
longer AS (SELECT lang, x, y, max(f) AS most FROM (SELECT lang, x, y, f FROM f3 WHERE f >= 10 UNION ALL SELECT lang, y, z, f FROM f3 WHERE f >= 10) GROUP BY lang, x, y),
two AS (
  SELECT f2.lang, f2.x || ' ' || f2.y AS phrase, f2.f AS a, l.f AS l, r.f AS r, (1000000::HUGEINT * f2.f * f2.f) // (l.f * r.f) AS score
  FROM (SELECT * FROM f2 WHERE f >= 10) f2 LEFT JOIN f1 l ON l.lang = f2.lang AND l.x = f2.x LEFT JOIN f1 r ON r.lang = f2.lang AND r.x = f2.y
  LEFT JOIN longer o ON o.lang = f2.lang AND o.x = f2.x AND o.y = f2.y
  WHERE 100 * coalesce(o.most, 0) < 50 * f2.f),
cuts AS (
  SELECT f3.lang, f3.x || ' ' || f3.y || ' ' || f3.z AS phrase, f3.f AS a, 1 AS k, l.f AS l, r.f AS r, (1000000::HUGEINT * f3.f * f3.f) // (l.f * r.f) AS score
  FROM h3 f3 LEFT JOIN f1 l ON l.lang = f3.lang AND l.x = f3.x LEFT JOIN f2 r ON r.lang = f3.lang AND r.x = f3.y AND r.y = f3.z
  UNION ALL
  SELECT f3.lang, f3.x || ' ' || f3.y || ' ' || f3.z, f3.f, 2, l.f, r.f, (1000000::HUGEINT * f3.f * f3.f) // (l.f * r.f)
  FROM h3 f3 LEFT JOIN f2 l ON l.lang = f3.lang AND l.x = f3.x AND l.y = f3.y LEFT JOIN f1 r ON r.lang = f3.lang AND r.x = f3.z),
three AS (SELECT lang, phrase, a, l, r, score FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM (SELECT * FROM two UNION ALL SELECT * FROM three)),
sizes AS (SELECT lang, count(*) AS n FROM g GROUP BY lang)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
"""


@register("op12_collocations", SQL)
def op12_collocations(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents"))
