"""Sharding by histogram sort: splitters are refined on exact byte counts until every shard is within tolerance of its
share, then the rows are exchanged once.

The order is (hash of the text, hash of the doc_id): equal texts are neighbours, so a group of copies stays in one shard
unless it is so heavy that no boundary outside it meets the tolerance; then the boundary splits the group by doc_id.
The law is ``bytes``. Slots number the rows of a shard from 0 without a gap: rows are ranked in buckets of about
``ROWS_PER_BUCKET`` rows and every bucket starts where the one before it ends, so no task ranks a whole shard.

Null text has no bytes and weighs 8, like an empty one. Repeated rows (one doc_id, one text) are equal in the order and
go to one shard, in slots of their own; a null doc_id is an id like others. Very long texts weigh what they weigh: a
single row over a shard's share can't be split. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, materialize, table, text_rows
from .histogram import key62, side, splitters
from .registry import register

SHARDS = 24
OVERHEAD_BYTES = 8
#: Of a shard's share, how far a boundary may be from its target.
TOLERANCE = 0.002
ROWS_PER_BUCKET = 200_000


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, k, tie): what sharding needs of each row; whole texts are read once."""
    text = F.coalesce("text", F.lit(""))
    return text_rows(docs).select("doc_id", (F.octet_length(text).cast("long") + OVERHEAD_BYTES).alias("size"),
                                  F.crc32(text.cast("binary")).alias("text_crc32"), key62(F.xxhash64(text)).alias("k"),
                                  key62(F.xxhash64("doc_id", F.octet_length(text))).alias("tie"))


def shard(docs: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every row of ``docs``."""
    rows = materialize(sized(docs), "shard-keys")
    total, n = rows.agg(F.sum("size"), F.count(F.lit(1))).first()
    total = total or 0
    targets = [round(total * i / shards) for i in range(1, shards)]
    cuts = splitters(rows, "k", "tie", "size", targets, int(tolerance * total / shards))
    place = sum((side("k", "tie", c).cast("int") for c in cuts), F.lit(0))
    per_shard = max(1, -(-n // (shards * ROWS_PER_BUCKET)))
    placed = rows.select("doc_id", "size", "text_crc32", "k", "tie", place.alias("shard"),
                         F.pmod("tie", F.lit(per_shard)).alias("bucket"))
    order = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (placed.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("rows"))
              .withColumn("start", F.coalesce(F.sum("rows").over(order), F.lit(0))).drop("rows"))
    nth = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("k", "tie", "doc_id"))
    ranked = placed.withColumn("nth", nth.cast("long"))
    return (ranked.join(starts, ["shard", "bucket"])
            .select("doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("nth") - 1).alias("slot")))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """The rows of ``docs`` with their shard, written as one folder a shard; the one exchange moves the whole rows."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = materialize(sized(docs), "shard-keys")
    total = rows.agg(F.sum("size")).first()[0] or 0
    cuts = splitters(rows, "k", "tie", "size", [round(total * i / shards) for i in range(1, shards)], int(TOLERANCE * total / shards))
    k, tie = fresh(docs, "shard_key", "shard_tie")
    keyed = docs.withColumns({k: key62(F.xxhash64(text)), tie: key62(F.xxhash64(F.col("doc_id").cast("long"), F.octet_length(text)))})
    place = sum((side(k, tie, c).cast("int") for c in cuts), F.lit(0))
    keyed.withColumn("shard", place).drop(k, tie).repartition("shard", F.rand(7)).write.partitionBy("shard").parquet(path)


@register("op7_shards")
def op7_shards(spark, sf_dir):
    got = shard(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
