"""Language identification by cross-parsing entropy.

Each language has a suffix automaton of a bounded sample of its labelled text. A text is parsed against each automaton into
the longest phrases that occur in the sample (a new phrase starts where the next letter can't extend the match); the
language that needs the fewest phrases, normalised by the text length and the sample's log size (the cross entropy
estimate ``phrases * log2(sample length) / letters``), wins. Ties go to the language that sorts first.

The sample is bounded: ``SAMPLE_TEXTS`` distinct excerpts per language, the first ``EXCERPT_CHARS`` characters of labelled texts
(those of the smallest text hash; copies, and texts that begin alike, count once), ``SAMPLE_CHARS`` in all; languages with few
distinct excerpts give what they have. Predictions read whole texts. A text is parsed in segments of ``SEGMENT_CHARS`` letters, a phrase ends with its segment; this adds
at most one phrase a segment, for all languages alike, and lets one task parse thousands of segments side by side.

Null texts and texts without a letter give ``und`` with score 0, as do all texts where nothing is labelled. Very long
texts only have more segments. Repeated rows give repeated predictions; an empty table gives no rows.
"""

from __future__ import annotations

import sys
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_rows, fresh, table
from .registry import register

SAMPLE_TEXTS = 64
EXCERPT_CHARS = 400
SAMPLE_CHARS = 16_000
SEGMENT_CHARS = 1024
#: Letters that are parsed side by side in one step of a task.
CHUNK_CHARS = 3_000_000
#: The commonest letters have a column in the dense table; moves by the samples' other letters are looked up by key.
ALPHABET = 200
UNKNOWN = "und"
#: Classes: 0 a run of other characters than letters, 1 a letter that no sample has, from 2 on the samples' letters.
GAP, STRANGE, FIRST = 0, 1, 2


@dataclass
class Model:
    langs: list[str]
    classes: np.ndarray  # class of every code point
    table: np.ndarray  # (state, class) -> 2 * row of the next state + 1 if a phrase starts
    width: int  # classes in the table
    stop: int  # classes in all
    keys: np.ndarray  # sorted, state * (classes - width) + class - width of the moves by other classes
    moves: np.ndarray  # their targets, as in the table
    roots: np.ndarray  # 2 * row of each language's root
    bits: np.ndarray  # log2 of each sample's length


def suffix_automaton(seq: list[int]) -> tuple[list[dict[int, int]], int]:
    """Transitions of the automaton of all substrings of ``seq``; state 0 is the root."""
    nxt: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in seq:
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return nxt, len(nxt)


def letters(text: str, classes: np.ndarray) -> np.ndarray:
    """Classes of ``text``; each run of other characters than letters is one gap, none at the start."""
    c = classes[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
    if not len(c):
        return c
    keep = c != GAP
    keep[1:] |= keep[:-1]
    return c[keep] if c[0] or keep.any() else c[:0]


def fit(samples: dict[str, list[str]]) -> Model | None:
    """samples: the bounded texts of each language."""
    langs = sorted(x for x in samples if any(ch.isalpha() for t in samples[x] for ch in t))
    if not langs:
        return None
    seen = Counter(ch.lower()[:1] for x in langs for t in samples[x] for ch in t if ch.isalpha())
    known = {ch: k + FIRST for k, (ch, _) in enumerate(sorted(seen.items(), key=lambda kv: (-kv[1], kv[0])))}
    stop = len(known) + FIRST  # ends a sample text, never matches
    size = min(len(known), ALPHABET) + FIRST
    classes = np.fromiter((0 if 0xD800 <= cp < 0xE000 or unicodedata.category(chr(cp))[0] != "L" else known.get(chr(cp).lower()[:1], STRANGE)
                           for cp in range(sys.maxunicode + 1)), np.min_scalar_type(stop), sys.maxunicode + 1)
    parts, roots, bits, base = [], [], [], 0
    others: dict[int, int] = {}
    for x in langs:
        seq = [c for t in samples[x] for c in (*letters(t, classes).tolist(), stop)]
        nxt, n = suffix_automaton(seq)
        own = np.full((n, size), -1, np.int64)
        for s, moves in enumerate(nxt):
            for c, to in moves.items():
                if c == stop:
                    continue
                if c < size:
                    own[s, c] = to
                else:
                    others[(s + base) * (stop - size) + c - size] = (to + base) * size * 2 + (s == 0)
        root = np.where(own[0] >= 0, own[0], 0)  # a phrase starts anew with this letter, or is the strange letter alone
        starts = (own < 0) | (np.arange(n) == 0)[:, None]
        own = np.where(own >= 0, own, root[None, :])
        parts.append(((own + base) * size * 2 + starts).ravel())
        roots.append(base * size * 2)
        bits.append(np.log2(max(2, len(seq))))
        base += n
    flat = np.concatenate(parts)
    flat = flat.astype(np.int32) if flat.max() < 2 ** 31 else flat
    keys = np.array(sorted(others), np.int64)
    moves = np.array([others[k] for k in keys.tolist()], flat.dtype)
    return Model(langs, classes, flat, size, stop, keys, moves, np.array(roots, flat.dtype), np.array(bits))


def step(state: np.ndarray, c: np.ndarray, model: Model) -> np.ndarray:
    """The next states of (language, segment) ``state`` by the classes ``c`` of the segments."""
    other = np.flatnonzero(c >= model.width) if len(model.keys) else []
    if not len(other):
        return model.table[(state >> 1) + c]
    now = model.table[(state >> 1) + np.where(c < model.width, c, STRANGE)]  # a strange letter leads to the root
    span = model.stop - model.width
    letter = c[other].astype(np.int64) - model.width
    for k in range(len(state)):
        here = now[k, other]
        for row in (np.full(len(other), model.roots[k] >> 1, np.int64), (state[k, other] >> 1).astype(np.int64)):  # anew, or onward
            key = row // model.width * span + letter
            at = np.minimum(np.searchsorted(model.keys, key), len(model.keys) - 1)
            here = np.where(model.keys[at] == key, model.moves[at], here)
        now[k, other] = here
    return now


def phrases(seqs: list[np.ndarray], model: Model, segment: int = SEGMENT_CHARS) -> np.ndarray:
    """(text, language): the number of phrases of each sequence of classes."""
    sizes = np.array([len(x) for x in seqs], np.int64)
    pieces = -(-sizes // segment)
    owner = np.repeat(np.arange(len(seqs)), pieces)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    starts = np.repeat(np.cumsum(sizes) - sizes, pieces) + nth * segment
    lengths = np.minimum(sizes[owner] - nth * segment, segment)
    order = np.argsort(-lengths, kind="stable")
    owner, starts, lengths = owner[order], starts[order], lengths[order]
    text = np.concatenate(seqs) if seqs else np.zeros(0, np.uint8)
    active = np.searchsorted(-lengths, -np.arange(segment), side="left")  # segments longer than t
    state = np.repeat(model.roots.astype(model.table.dtype)[:, None], len(owner), 1)
    count = np.zeros(state.shape, np.int32)
    for t in range(int(lengths[0]) if len(lengths) else 0):
        n = active[t]
        now = step(state[:, :n], text[starts[:n] + t], model)
        state[:, :n] = now
        count[:, :n] += now & 1
    out = np.zeros((len(seqs), len(model.langs)), np.int64)
    np.add.at(out, owner, count.T)
    return out


def decide(seqs: list[np.ndarray], model: Model) -> list[tuple[str, float]]:
    """Language and score, 1 - best / second best, of each sequence of classes."""
    sizes = np.array([max(1, len(x)) for x in seqs], np.float64)
    cost = phrases(seqs, model) * model.bits[None, :] / sizes[:, None]
    best = cost.argmin(1)
    rows = np.arange(len(seqs))
    low = cost[rows, best]
    cost[rows, best] = np.inf
    second = cost.min(1) if len(model.langs) > 1 else np.full(len(seqs), np.inf)
    out = []
    for k, x in enumerate(seqs):
        if not (x != GAP).any():
            out.append((UNKNOWN, 0.0))
        else:
            out.append((model.langs[best[k]], float(1 - low[k] / second[k]) if np.isfinite(second[k]) else 1.0))
    return out


def labelled_sample(docs: DataFrame, lang: str, where: Column) -> dict[str, list[str]]:
    """The bounded sample of each language; only distinct excerpts leave the scan, and each task keeps its own smallest hashes."""
    rows = (docs.filter(where & F.col(lang).isNotNull() & F.col("text").isNotNull())
            .select(F.col(lang).cast("string").alias("lang"), F.xxhash64("text").alias("h"),
                    F.substring("text", 1, EXCERPT_CHARS).alias("excerpt")).filter(F.col("excerpt").rlike(r"\p{L}"))
            .groupBy("lang", "excerpt").agg(F.min("h").alias("h")))  # the bound counts distinct excerpts, whatever their copies
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("h", "excerpt"))
    out: dict[str, list[str]] = {}
    for r in rows.withColumn("nth", nth).filter(F.col("nth") <= SAMPLE_TEXTS).orderBy("lang", "nth").collect():
        own = out.setdefault(r.lang, [])
        left = SAMPLE_CHARS - sum(map(len, own))
        if left > 0:
            own.append(r.excerpt[:left])
    return out


def predict(docs: DataFrame, model: Model | None, *keep: str) -> DataFrame:
    """``keep`` columns and lang_pred, score of every whole text."""
    (whole,) = fresh(docs.select(*keep), "text")
    rows = docs.select(*keep, F.col("text").cast("string").alias(whole))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema) + ", lang_pred string, score double"
    if model is None:
        return rows.select(*keep, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = rows.sparkSession.sparkContext.broadcast(model)  # bounded by the sample's parameters

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            found: list[tuple[str, float]] = []
            seqs: list[np.ndarray] = []
            held = 0
            for (text,) in arrow_rows([batch], whole):
                seqs.append(letters(text or "", own.classes))
                held += len(seqs[-1])
                if held > CHUNK_CHARS:
                    found += decide(seqs, own)
                    seqs, held = [], 0
            found += decide(seqs, own)
            yield pa.record_batch([*[batch.column(n) for n in keep], pa.array([x[0] for x in found], pa.string()),
                                   pa.array([x[1] for x in found], pa.float64())], names=[*keep, "lang_pred", "score"])
    return rows.mapInArrow(run, schema)


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


@register("op1_langid")
def op1_langid(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)))
    model = fit(labelled_sample(docs, "lang", ~F.col("held_out")))
    return predict(docs, model, "doc_id", "held_out").select("doc_id", "held_out", "lang_pred", "score")
