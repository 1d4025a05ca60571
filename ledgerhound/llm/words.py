"""Words of many texts at once, as numpy arrays over UTF-8 bytes: where they are, and a 64-bit hash of each."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

U64 = np.uint64
#: Bytes that are hashed at once; longer words than ``LONG`` bytes are hashed one by one.
PIECE = 1 << 20
LONG = 64
MASK = (1 << 64) - 1
#: A-Z lower-cased, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Ends every text in ``joined``; no word holds it.
STOP = 10


def joined(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, ends): the texts one after the other, each followed by a ``STOP`` byte; ``ends``: where those are. Null is empty."""
    col = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(col.buffers()[1], np.int64, len(col) + 1, 8 * col.offset) if len(col) else np.zeros(1, np.int64)
    raw = col.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]] if raw is not None and offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    ends = offsets[1:] - offsets[0] + np.arange(len(col))
    out = np.full(len(data) + len(col), STOP, np.uint8)
    own = np.ones(len(out), bool)
    own[ends] = False
    out[own] = data
    return out, ends


def slices(batch: pa.RecordBatch, column: str, limit: int):
    """Parts of a batch with about ``limit`` bytes of text (a longer text is a part of its own)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    total, at = np.r_[0, np.cumsum(sizes)], 0
    while at < len(sizes):
        stop = max(at + 1, int(np.searchsorted(total, total[at] + limit, side="right")) - 1)
        yield batch.slice(at, stop - at)
        at = stop


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the runs of True."""
    turn = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        turn = np.r_[0, turn]
    if len(turn) % 2:
        turn = np.r_[turn, len(inside)]
    return turn[::2], turn[1::2]


def spans(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... for ``size[0]`` numbers, then those of the next span."""
    ends = np.cumsum(size)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(first - (ends - size), size)


@lru_cache(maxsize=4)
def _powers(seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of an odd number and those of its inverse modulo 2 ** 64."""
    base = (0x9E3779B97F4A7C15 + 2 * seed * 0xD1342543DE82EF95) & MASK | 1
    n = PIECE + LONG + 1
    out = []
    for x in (base, pow(base, -1, 1 << 64)):
        p = np.full(n, x, U64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U64(32))) * U64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> U64(29))) * U64(0xBF58476D1CE4E5B9)
    return h ^ (h >> U64(32))


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A hash of the bytes of each word: differences of running sums, brought to one base by powers of the inverse."""
    power, inverse = _powers(seed)
    out = np.zeros(len(starts), U64)
    size = ends - starts
    short = np.flatnonzero(size <= LONG)
    s, e, at = starts[short], ends[short], 0
    while at < len(s):
        base = int(s[at])
        stop = max(at + 1, int(np.searchsorted(e, base + PIECE, side="right")))
        part = data[base:int(e[stop - 1])].astype(U64)
        sums = np.zeros(len(part) + 1, U64)
        np.cumsum((part + U64(1)) * power[:len(part)], out=sums[1:])
        first = s[at:stop] - base
        own = (sums[e[at:stop] - base] - sums[first]) * inverse[first]
        out[short[at:stop]] = mix(own + (e[at:stop] - s[at:stop]).astype(U64) + U64(seed << 32))
        at = stop
    for k in np.flatnonzero(size > LONG).tolist():
        out[k] = xxhash.xxh3_64_intdigest(data[starts[k]:ends[k]].tobytes(), seed)
    return out
