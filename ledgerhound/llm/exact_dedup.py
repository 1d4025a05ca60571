"""Exact deduplication by a tree merge of sorted digest runs.

Every document becomes a digest record. Each map partition sorts its records into one run per destination and
merges equal digests at once. Then runs are exchanged in rounds: with fan-in ``k`` and ``k**R`` leaves, round
``r`` sends a record to the leaf whose ``r``-th base-``k`` digit is replaced by that digit of the record's digest
(recursive halving of the digest space, ``k`` ways at a time). Each receiver merges the sorted runs it got and
keeps, per digest, the winner and the number of rows. After the last round a leaf holds the whole of one
digest range, so no task ever holds more than its share, and a group of copies shrinks by the fan-in in each
round before it meets in one place. Equality is verified at every level: a record's key is its SHA-256 together with
the normalised length and an independent 64-bit hash; two records with one SHA-256 but another key stay apart.

Null text counts as empty. Whitespace-only and empty texts are equal to each other. Of equal texts the row with
the most code points in the original text, then the smallest doc_id stays (a null doc_id comes after all others).
Repeated rows (one doc_id, equal texts of one length) all appear; one of them is kept. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, keep_rows, materialize, row_hash, table, text_rows
from .registry import register

#: The characters [\x20\x09-\x0D] are ASCII, so deleting their bytes from UTF-8 deletes exactly them.
BLANKS = b" \t\n\x0b\x0c\r"
FAN_IN = 8
ROWS_PER_LEAF = 500_000

DIGEST = "doc_id long, chars long, text_hash long, sha binary, norm_len long, check long"
RUN = "leaf long, src long, pos long, sha binary, norm_len long, check long, chars long, keep_id long, n long"
BATCH = 20_000


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("chars", pa.int64()), ("text_hash", pa.int64()), ("sha", pa.binary()),
                        ("norm_len", pa.int64()), ("check", pa.int64())])
    for batch in batches:
        out = []
        for doc_id, text, text_hash in arrow_rows([batch], "doc_id", "text", "text_hash"):
            text = text or ""
            norm = text.encode().translate(None, BLANKS)
            check = xxhash.xxh64_intdigest(norm, 0) - (1 << 63)
            out.append((doc_id, len(text), text_hash, hashlib.sha256(norm).digest(), len(norm), check))
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)]
                              if out else [pa.array([], f.type) for f in schema], schema=schema)


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, chars, text_hash, sha, norm_len, check) of every row; whole texts."""
    rows = text_rows(docs).withColumn("text_hash", row_hash(F.col("text")))
    return rows.mapInArrow(_digests, DIGEST)


def _merge(records: Iterator[tuple]) -> Iterator[tuple]:
    """Sorted (key, chars, keep_id, n) records -> one for each key: most code points, then the smallest id."""
    now = None
    for key, chars, keep, n in records:
        if now is not None and now[0] == key:
            keep_first = (-now[1], now[2] is None, now[2] or 0) <= (-chars, keep is None, keep or 0)
            now = (key, now[1], now[2], now[3] + n) if keep_first else (key, chars, keep, now[3] + n)
        else:
            if now is not None:
                yield now
            now = (key, chars, keep, n)
    if now is not None:
        yield now


def _digit(sha: bytes, place: int, fan: int) -> int:
    return int.from_bytes(sha[:8], "big") // fan ** place % fan


def _emit(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("leaf", pa.int64()), ("src", pa.int64()), ("pos", pa.int64()), ("sha", pa.binary()),
                        ("norm_len", pa.int64()), ("check", pa.int64()), ("chars", pa.int64()),
                        ("keep_id", pa.int64()), ("n", pa.int64())])
    out: list[tuple] = []

    def batch() -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    for row in rows:
        out.append(row)
        if len(out) == BATCH:
            yield batch()
            out.clear()
    if out:
        yield batch()


def _first_runs(leaves: int, fan: int):
    """Sort the records of a slice of this partition into a run, merged, addressed for round 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        src = TaskContext.get().partitionId()

        def rows() -> Iterator[tuple]:
            for batch in batches:
                recs = [((sha, norm_len, check), chars, doc_id, 1) for doc_id, chars, sha, norm_len, check
                        in arrow_rows([batch], "doc_id", "chars", "sha", "norm_len", "check")]
                recs.sort(key=lambda r: r[0])
                for pos, (key, chars, keep, n) in enumerate(_merge(iter(recs))):
                    leaf = src % leaves
                    yield (leaf - leaf % fan + _digit(key[0], 0, fan), src, pos, *key, chars, keep, n)
        yield from _emit(rows())
    return run


def _round(place: int | None, fan: int):
    """Merge the sorted runs that met at a leaf; address the result for round ``place`` (None: no more rounds)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def leaf_of(row: tuple) -> int:
            return row[0]

        def merged(leaf: int, records: Iterator[tuple]) -> Iterator[tuple]:
            for pos, (key, chars, keep, n) in enumerate(_merge(records)):
                to = leaf
                if place is not None:
                    step = fan ** place
                    to = leaf - leaf // step % fan * step + _digit(key[0], place, fan) * step
                yield (to, leaf, pos, *key, chars, keep, n)

        def rows() -> Iterator[tuple]:
            import itertools
            stream = arrow_rows(batches, "leaf", "sha", "norm_len", "check", "chars", "keep_id", "n")
            for leaf, group in itertools.groupby(stream, leaf_of):
                yield from merged(leaf, ((r[1:4], r[4], r[5], r[6]) for r in group))
        yield from _emit(rows())
    return run


def tree_merge(records: DataFrame, fan: int = FAN_IN, rows_per_leaf: int = ROWS_PER_LEAF) -> DataFrame:
    """(sha, norm_len, check, chars, keep_id, n): one row for each distinct key of ``records``.

    A leaf's incoming runs are brought into one order by Spark's spilling merge sort on (leaf, key), and the
    merge itself streams, so memory doesn't grow with the run lengths.
    """
    rounds = 1
    total = records.count()
    while fan ** rounds * rows_per_leaf < total or (rounds < 2 and total):
        rounds += 1
    leaves = fan ** rounds
    runs = records.select("doc_id", "chars", "sha", "norm_len", "check").mapInArrow(_first_runs(leaves, fan), RUN)
    for r in range(rounds):
        met = (runs.repartition(leaves, "leaf")
               .sortWithinPartitions("leaf", "sha", "norm_len", "check", F.desc("chars"), F.asc_nulls_last("keep_id")))
        runs = met.mapInArrow(_round(r + 1 if r + 1 < rounds else None, fan), RUN)
    return runs.select("sha", "norm_len", "check", "chars", "keep_id", "n")


def exact_dedup(docs: DataFrame, fan: int = FAN_IN, rows_per_leaf: int = ROWS_PER_LEAF) -> DataFrame:
    """One row for each input row: doc_id, keep_id, group_size, kept, text_sha256, text_hash (of the original text)."""
    recs = materialize(digests(docs), "digests")
    groups = materialize(tree_merge(recs, fan, rows_per_leaf), "digest-groups").withColumnRenamed("chars", "keep_chars")
    # Repeated rows (one doc_id, one text) collapse first; they come back with their count below.
    own = recs.groupBy("doc_id", "chars", "text_hash", "sha", "norm_len", "check").agg(F.count(F.lit(1)).alias("copies"))
    rows = own.join(groups, ["sha", "norm_len", "check"])
    wins = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("chars") == F.col("keep_chars"))
    # One doc_id can hold several equal texts of one length that differ in their blanks: the smallest hash stays.
    from pyspark.sql import Window
    first = F.row_number().over(Window.partitionBy("sha", "norm_len", "check", "doc_id", "chars").orderBy("text_hash"))
    ranked = rows.filter(wins).withColumn("nth", first).unionByName(rows.filter(~wins).withColumn("nth", F.lit(2)))
    return (ranked.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
            .select("doc_id", "keep_id", F.col("n").alias("group_size"),
                    ((F.col("nth") == 1) & (F.col("copy") == 1)).alias("kept"),
                    F.lower(F.hex("sha")).alias("text_sha256"), "text_hash"))


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with its columns."""
    return keep_rows(docs, exact_dedup(docs).filter("kept"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
r AS (
  SELECT *, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id
                      ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM r
"""


@register("op5_exact_dedup", ORACLE)
def op5_exact_dedup(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents")).drop("text_hash")
