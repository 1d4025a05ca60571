"""SimHash near-duplicate groups by a segment-popcount embedding.

A 64-bit fingerprint is embedded as the bit counts of its 32 two-bit segments. One differing bit changes one count by
one, so the Manhattan distance of two embeddings is a lower bound of the Hamming distance. Candidates come from a grid
range join under that bound: the coordinates form two halves of 16, and of two points within ``2t + 1 >= 4`` one half
is within 2. Both points of such a pair reach a common grid cell within one step of each (radius 1 + 1), so every
distinct fingerprint is sent to its own cell and the neighbours one step away, per half. In a cell the full Manhattan
bound is tested first, then the exact Hamming distance. A cell gives only the edges of a spanning forest, never all pairs;
a cell with many members is cut into blocks, and each pair of blocks is a task of its own.

Distinct fingerprints are linked once, however many documents share them. Null, empty and blank texts have fingerprint
zero and are linked like any other. Repeated rows appear as often as they come. A null doc_id gets a component like any
other row, but is a component's name only if no other id is in it. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, keep_rows, materialize, row_hash, table, text_rows, width
from .components import components
from .registry import register

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
#: Members of a cell, or of a block of a large cell, that are compared in one task.
BLOCK = 4096
EVEN = np.uint64(0x5555555555555555)
ONE = np.uint64(1)
HALF = np.uint64(32)


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """Bytes A-Z are lower-cased, words end at [\\x20\\x09-\\x0D]; a bit is 1 if set in over half of the shingles' hashes."""
    toks = (text or "").encode().lower().split()
    if not toks:
        return 0
    if len(toks) <= words:
        return xxhash.xxh64_intdigest(b" ".join(toks), SEED)
    buf = b" ".join(toks)
    size = np.fromiter(map(len, toks), np.int64, len(toks))
    ends = np.cumsum(size + 1) - 1
    starts = (ends - size)[: len(toks) - words + 1].tolist()
    ends = ends[words - 1:].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(starts), 1 << 16):
        part = np.fromiter((digest(buf[a:b], SEED) for a, b in zip(starts[at:at + (1 << 16)], ends[at:at + (1 << 16)], strict=True)), "<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(starts), bitorder="little").view("<u8")[0])


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _fingerprints(words: int):
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [_signed(fingerprint(t, words)) for (t,) in arrow_rows([batch], "text")]
            yield pa.record_batch([batch.column("doc_id"), batch.column("text_hash"), pa.array(fps, pa.int64())], schema=schema)
    return run


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    rows = text_rows(docs).withColumn("text_hash", row_hash(F.col("text")))
    return rows.mapInArrow(_fingerprints(words), "doc_id long, text_hash long, fp long")


def embed(fp: np.ndarray) -> np.ndarray:
    """The bit counts (0 to 2) of the 32 two-bit segments, two bits each."""
    return (fp & EVEN) + ((fp >> ONE) & EVEN)


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cell, fp): per half its own grid cell and those one step away along one coordinate."""
    for batch in batches:
        fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for at in range(0, len(fp), 4096):
            part = fp[at:at + 4096]
            counts = embed(part)
            for half in (0, 1):
                own = (counts >> (HALF * np.uint64(half))) & np.uint64(0xFFFFFFFF)
                cells, members = [own], [part]
                for k in range(16):
                    step = np.uint64(1 << 2 * k)
                    field = (own >> np.uint64(2 * k)) & np.uint64(3)
                    for ok, moved in ((field < 2, own + step), (field > 0, own - step)):
                        cells.append(moved[ok])
                        members.append(part[ok])
                cell = np.concatenate(cells) | np.uint64(half << 32)
                yield pa.record_batch([pa.array(cell.view(np.int64)), pa.array(np.concatenate(members).view(np.int64))], names=["cell", "fp"])


def _near(one: np.ndarray, other: np.ndarray, bits: int) -> np.ndarray:
    """Manhattan distance of the embeddings first (a lower bound), then the exact Hamming distance of what is left."""
    diff = one ^ other
    up, down = one & diff, other & diff
    against = ((up & (down >> ONE)) | (down & (up >> ONE))) & EVEN  # one bit of the segment rises, the other falls
    bound = np.bitwise_count(diff).astype(np.int16) - 2 * np.bitwise_count(against).astype(np.int16)
    near = bound <= bits
    near[near] = np.bitwise_count(diff[near]) <= bits
    return near


def spanning_edges(fps: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links among distinct ``fps``: a search that compares only with what is still unseen."""
    out, unseen = [], fps
    while len(unseen) > 1:
        queue, unseen = [unseen[0]], unseen[1:]
        while queue and len(unseen):
            at = queue.pop()
            near = _near(np.full(len(unseen), at), unseen, bits)
            if near.any():
                found = unseen[near]
                out.extend((int(at), int(x)) for x in found)
                queue.extend(found)
                unseen = unseen[~near]
    return out


def _links(bits: int):
    def edges_of(groups: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """groups: sorted; whole groups only."""
        starts = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]])
        sizes = np.diff(np.r_[starts, len(groups)])
        left, right = [], []
        for size in np.unique(sizes[(sizes > 1) & (sizes <= 24)]):  # small cells of one size together
            members = fps[starts[sizes == size][:, None] + np.arange(size)]
            for i in range(size - 1):
                for j in range(i + 1, size):
                    near = _near(members[:, i], members[:, j], bits)
                    left.append(members[near, i])
                    right.append(members[near, j])
        for start, size in zip(starts[sizes > 24], sizes[sizes > 24], strict=True):
            found = spanning_edges(np.unique(fps[start:start + size]), bits)
            if found:
                a, b = np.array(found, np.uint64).T
                left.append(a)
                right.append(b)
        if not left:
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        pairs = np.unique(np.stack([np.concatenate(left), np.concatenate(right)], 1), axis=0)
        return pairs[:, 0], pairs[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_g, held_f = np.zeros(0, np.int64), np.zeros(0, np.uint64)

        def out(groups: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
            a, b = edges_of(groups, fps)
            return pa.record_batch([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            g = np.r_[held_g, batch.column(0).to_numpy(zero_copy_only=False)]
            f = np.r_[held_f, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)]
            if not len(g):
                continue
            cut = int(np.searchsorted(g, g[-1]))
            held_g, held_f = g[cut:], f[cut:]
            if cut:
                yield out(g[:cut], f[:cut])
        if len(held_g):
            yield out(held_g, held_f)
    return run


def links(fps: DataFrame, bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """(a, b): edges that connect exactly the distinct fingerprints joined by chains of links."""
    if not 0 <= bits <= 5:
        raise ValueError("the two halves with radius 1 + 1 find every pair of up to 5 differing bits")
    # Dealt out first: distinct fingerprints are small rows, but each of them becomes up to 66 cells.
    cells = fps.repartition(width(fps.sparkSession)).mapInArrow(_cells, "cell long, fp long")
    large = (cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > block)
             .select(F.col("cell").alias("large_cell"), F.ceil(F.col("n") / block).cast("int").alias("blocks")))
    # Few cells are large; both plans of this join (hash or sorted, chosen by measured size) split a hot cell.
    sized = cells.join(large, cells.cell == large.large_cell, "left").select("cell", "fp", "blocks")
    small = sized.filter("blocks IS NULL").select(F.col("cell").alias("grp"), "fp")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    other = F.col("other").cast("long")
    cut = (sized.filter("blocks IS NOT NULL").withColumn("own", own)
           .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
           .select(F.xxhash64("cell", F.least(F.col("own"), other), F.greatest(F.col("own"), other)).alias("grp"), "fp"))
    dealt = small.unionByName(cut).repartition(width(fps.sparkSession), "grp").sortWithinPartitions("grp", "fp")
    return dealt.mapInArrow(_links(bits), "a long, b long").distinct()


def near_groups(docs: DataFrame, words: int = SHINGLE_WORDS, bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, text_hash, fp, component_id) of every row; component_id: the smallest doc_id reachable over links."""
    rows = materialize(fingerprints(docs, words), "fingerprints")
    classes = rows.groupBy("fp").agg(F.min("doc_id").alias("low"))
    comp = components(links(classes.select("fp"), bits), "a", "b", "simhash-links")
    named = classes.join(comp, classes.fp == comp.node, "left").select("fp", "low", F.coalesce("component", "fp").alias("root"))
    lows = named.groupBy("root").agg(F.min("low").alias("component_id"))
    by_fp = named.select("fp", "root").join(lows, "root").select("fp", "component_id")
    return rows.join(by_fp, "fp").select("doc_id", "text_hash", "fp", "component_id")


def drop_near_copies(docs: DataFrame, words: int = SHINGLE_WORDS, bits: int = MAX_BITS) -> DataFrame:
    """One row of each group: that of the smallest doc_id (of several texts under it, the smallest text hash)."""
    groups = near_groups(docs, words, bits).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = groups.groupBy("doc_id").agg(F.min("text_hash").alias("text_hash"))
    return keep_rows(docs, kept)


@register("op8_simhash")
def op8_simhash(spark, sf_dir):
    got = near_groups(table(spark, sf_dir, "documents"))
    return got.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
