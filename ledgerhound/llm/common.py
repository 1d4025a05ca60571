"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a private one only for a local master (tests)."""
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if root:
        return root.rstrip("/")
    made = spark.sparkContext.getCheckpointDir()
    if made:
        return made.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
    import tempfile
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="llm-ckpt-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_root(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def width(spark: SparkSession) -> int:
    """Partitions that the session uses for a shuffle."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` doesn't have yet, one for each of ``names``."""
    have = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in have:
            n = "_" + n
        have.add(n.lower())
        out.append(n)
    return out


def text_rows(docs: DataFrame, *more: str) -> DataFrame:
    """Only doc_id and text (and ``more``): columns with clashing names never reach an operator."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       *[F.col(c) for c in more])


def row_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")), text.isNull())


def keep_rows(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``kept`` (doc_id, text_hash) lists, one row each, with the columns of ``docs``.

    Rows of one doc_id that share their text are repeated rows; of each such set one row stays. Only the
    repeated ones are gathered, the others pass through a semi join.
    """
    h, n, k_id, k_hash = fresh(docs, "row_text_hash", "row_copies", "kept_id", "kept_hash")
    keyed = docs.withColumn(h, row_hash(F.col("text").cast("string")))
    times = keyed.groupBy(F.col("doc_id").cast("long").alias("doc_id"), F.col(h).alias("text_hash")).agg(F.count(F.lit(1)).alias("n"))
    want = (times.join(kept.select("doc_id", "text_hash").distinct(),
                       times.doc_id.eqNullSafe(kept.doc_id) & (times.text_hash == kept.text_hash), "left_semi")
            .select(F.col("doc_id").alias(k_id), F.col("text_hash").alias(k_hash), F.col("n").alias(n)))
    rows = keyed.join(want, F.col("doc_id").cast("long").eqNullSafe(F.col(k_id)) & (F.col(h) == F.col(k_hash)), "inner")
    single = rows.filter(F.col(n) == 1).select(*docs.columns)
    repeated = rows.filter(F.col(n) > 1).dropDuplicates([k_id, k_hash]).select(*docs.columns)
    return single.unionByName(repeated)


def arrow_rows(batches: Iterable[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """The rows of Arrow batches as tuples of Python values, a slice of rows at a time (bounded memory)."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            yield from zip(*[part.column(n).to_pylist() for n in names], strict=True)
        del batch
        pa.default_memory_pool().release_unused()  # workers live on after a stage, their batches shouldn't
