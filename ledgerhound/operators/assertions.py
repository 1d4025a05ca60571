"""User-level assertions (O-113..O-117): each returns rows of (check_name, violations)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _row(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check_name"), "violations")


def assert_grain(df: DataFrame, keys: list[str], name: str = "grain") -> DataFrame:
    """O-113: key combinations that occur more than once."""
    return _row(df.groupBy(*keys).count().filter(F.col("count") > 1), name)


def assert_sign(fact: DataFrame) -> DataFrame:
    """O-114: signed amount disagrees with direction."""
    credit = F.col("direction") == "credit"
    bad = (credit & (F.col("signed_amount_cad") <= 0)) | (~credit & (F.col("signed_amount_cad") >= 0))
    return _row(fact.filter(bad), "signed_amount_sign")


def assert_fk(checks: list[tuple[str, DataFrame, str, DataFrame]]) -> DataFrame:
    """O-115: orphans for each (name, fact, key, dim) with anti joins."""
    rows = [_row(f.join(d.select(k).distinct(), k, "left_anti"), name) for name, f, k, d in checks]
    return reduce(lambda a, b: a.unionByName(b), rows)


def assert_same(a: DataFrame, b: DataFrame, name: str) -> DataFrame:
    """O-116 helper: rows present in one frame and not the other (both ways)."""
    return _row(a.exceptAll(b).unionByName(b.exceptAll(a)), name)


def assert_nested_windows(rolls: DataFrame, measures: tuple[str, ...] = ("n_txn", "vol_total")) -> DataFrame:
    """O-117: trailing sums must nest, 7d <= 30d <= 90d."""
    bad = None
    for m in measures:
        c = (F.col(f"{m}_7d") > F.col(f"{m}_30d")) | (F.col(f"{m}_30d") > F.col(f"{m}_90d"))
        bad = c if bad is None else bad | c
    return _row(rolls.filter(bad), "nested_windows")
