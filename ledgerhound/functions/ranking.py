"""Exact global positions, running totals and ranks without a one-task window.

``Window.orderBy(...)`` with no partition moves every row into one task. At
scale we instead:

1. range-partition the rows by the ordering key (Spark samples the bounds) and
   number the partitions: bucket ids in key order;
2. write that once (a reliable checkpoint), so the input is evaluated once and
   a lost executor can't shift the buckets between the next two steps;
3. aggregate the weights per bucket (one row per bucket) and turn them into
   offsets, a table as long as the number of partitions;
4. run the running total inside each bucket (``partitionBy(bucket)``).

The number of buckets is the session's shuffle width, like that of any other
shuffle of the data: no ceiling is built in.

Keys must be unique per row: callers collapse ties to one row per distinct
value first (with a count), which also bounds a hot value to a single row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_BUCKET = "_bucket"


def running_totals(df: DataFrame, keys: list[str], weights: dict[str, Column],
                   rows_per_bucket: int | None = None, min_buckets: int = 1) -> DataFrame:
    """Append, for every weight ``w``: ``before_<w>`` (sum of ``w`` over rows whose
    key is strictly smaller, ascending over ``keys``) and ``total_<w>``.

    ``keys`` must be unique per row and non-null. One action runs here (the
    checkpoint of the ranged rows); with ``rows_per_bucket`` a count as well.
    """
    order = [F.col(k).asc() for k in keys]
    if rows_per_bucket:
        buckets = max(min_buckets, math.ceil(df.count() / rows_per_bucket))
        ranged = df.repartitionByRange(buckets, *order)
    else:
        ranged = df.repartitionByRange(*order)
    keyed = ranged.withColumn(_BUCKET, F.spark_partition_id()).checkpoint(eager=True)
    wnames = list(weights)
    per_bucket = keyed.groupBy(_BUCKET).agg(*[F.sum(weights[w]).alias(f"_bw_{w}") for w in wnames])
    # per_bucket has one row per shuffle partition: a window without partition is fine here.
    before = Window.orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(
        _BUCKET,
        *[F.coalesce(F.sum(f"_bw_{w}").over(before), F.lit(0)).alias(f"_off_{w}") for w in wnames],
        *[F.sum(f"_bw_{w}").over(Window.partitionBy()).alias(f"total_{w}") for w in wnames])
    inner = Window.partitionBy(_BUCKET).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = keyed.join(F.broadcast(offsets), _BUCKET, "inner")
    return joined.select(
        *df.columns,
        *[(F.col(f"_off_{w}") + F.coalesce(F.sum(weights[w]).over(inner), F.lit(0))).alias(f"before_{w}")
          for w in wnames],
        *[F.col(f"total_{w}") for w in wnames])


def dense_sequence(df: DataFrame, key: str, name: str, **kw) -> DataFrame:
    """``ROW_NUMBER() OVER (ORDER BY key)`` for a unique key, computed in buckets."""
    rt = running_totals(df, [key], {"n": F.lit(1)}, **kw)
    return rt.withColumn(name, (F.col("before_n") + 1).cast("long")).drop("before_n", "total_n")


def value_ranks(df: DataFrame, value: str, label: str | None = None, **kw) -> DataFrame:
    """Collapse ``df`` to one row per distinct ``value`` with tie statistics.

    Output: value, cnt, pos (positives when ``label`` is given), less_n (rows
    with a strictly smaller value), less_pos, total_n, total_pos. Average ranks
    follow: ascending ``less_n + (cnt + 1) / 2``, descending
    ``total_n - less_n - cnt + (cnt + 1) / 2``.
    """
    aggs = [F.count(F.lit(1)).alias("cnt")]
    aggs.append(F.sum(F.col(label)).cast("long").alias("pos") if label else F.lit(0).cast("long").alias("pos"))
    distinct = df.groupBy(value).agg(*aggs)
    rt = running_totals(distinct, [value], {"n": F.col("cnt"), "p": F.col("pos")}, **kw)
    return rt.select(value, "cnt", "pos",
                     F.col("before_n").cast("long").alias("less_n"),
                     F.col("before_p").cast("long").alias("less_pos"),
                     F.col("total_n").cast("long").alias("total_n"),
                     F.col("total_p").cast("long").alias("total_pos"))
