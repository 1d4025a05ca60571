"""Splitters by histogram refinement: exact weights below candidate boundaries, counted across all partitions.

Every round lays probes over the key intervals that still hold an unmet target, counts the weight between neighbouring
probes in one aggregation (combined map-side; the result has at most targets * PROBES rows whatever the input), and keeps the
probe nearest each target or the interval that holds it. Only these counts reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PROBES = 512
#: Keys are 62-bit, so that differences of two keys fit a long.
LOW, HIGH = -(1 << 61), (1 << 61) - 1


def key62(col: Column) -> Column:
    return F.shiftright(col, 2)


@dataclass
class Cut:
    """Rows with a key below ``key`` weigh ``below``; ``rest``: what the target wants of the
    rows with just this key, which weigh ``weight``."""
    key: int
    below: int
    rest: int = 0
    weight: int = 0


def cuts(rows: DataFrame, key: str, weight: str, targets: list[int], tolerance: int) -> list[Cut]:
    """A cut for each target weight, within ``tolerance``, or at the one key that holds the target (then ``rest`` > 0)."""
    found: dict[int, Cut] = {}
    open_ = {i: (LOW, HIGH, 0) for i in range(len(targets))}  # target -> key interval, weight below it
    while open_:
        spans = sorted(set(open_.values()))
        step = {s: max(1, -(-(s[1] - s[0] + 1) // PROBES)) for s in spans}
        k, which, slot = F.col(key), F.lit(None).cast("int"), F.lit(None).cast("long")
        for n, s in reversed(list(enumerate(spans))):
            inside = k.between(s[0], s[1])
            which = F.when(inside, F.lit(n)).otherwise(which)
            slot = F.when(inside, F.expr(f"(`{key}` - ({s[0]}L)) DIV {step[s]}L")).otherwise(slot)
        counted = (rows.select(which.alias("w"), slot.cast("long").alias("s"), F.col(weight).alias("x")).filter("w IS NOT NULL")
                   .groupBy("w", "s").agg(F.sum("x").alias("x")).collect())
        bins: list[dict[int, int]] = [{} for _ in spans]
        for r in counted:
            bins[r.w][r.s] = int(r.x)
        nxt = {}
        for i, s in open_.items():
            below, own = s[2], bins[spans.index(s)]
            cut = None
            for slot_ in sorted(own):
                at = s[0] + slot_ * step[s]
                if below + own[slot_] < targets[i]:
                    below += own[slot_]
                    continue
                if targets[i] - below <= tolerance:
                    cut = Cut(at, below)
                elif below + own[slot_] - targets[i] <= tolerance:
                    cut = Cut(at + step[s], below + own[slot_])
                elif step[s] == 1:
                    cut = Cut(at, below, targets[i] - below, own[slot_])
                else:
                    nxt[i] = (at, min(s[1], at + step[s] - 1), below)
                break
            else:
                cut = Cut(s[1] + 1, below)
            if cut:
                found[i] = cut
        open_ = nxt
    return [found[i] for i in range(len(targets))]


def splitters(rows: DataFrame, key: str, tie: str, weight: str, targets: list[int], tolerance: int) -> list[tuple[int, int]]:
    """(key, tie) boundaries: the rows below each weigh its target, within ``tolerance`` where no repeated row prevents it.

    A boundary falls inside the rows of one key only if their weight leaves no other way; they are then split by ``tie``.
    """
    first = cuts(rows, key, weight, targets, tolerance)
    out: dict[int, tuple[int, int]] = {i: (c.key, LOW) for i, c in enumerate(first)}
    heavy: dict[int, list[int]] = {}
    for i, c in enumerate(first):
        if c.rest:
            heavy.setdefault(c.key, []).append(i)
    for at, members in heavy.items():
        inner = cuts(rows.filter(F.col(key) == F.lit(at)), tie, weight, [first[i].rest for i in members], tolerance)
        for i, c in zip(members, inner, strict=True):
            out[i] = (at, c.key + (2 * c.rest > c.weight))  # the rows of one tie (one row, or repeated ones) go to the nearer side
    return [out[i] for i in range(len(targets))]


def side(key: str, tie: str, cut: tuple[int, int]) -> Column:
    """Whether a row lies at or above the boundary."""
    return (F.col(key) > F.lit(cut[0])) | ((F.col(key) == F.lit(cut[0])) & (F.col(tie) >= F.lit(cut[1])))
