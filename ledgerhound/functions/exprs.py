"""Small column-expression helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def money(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(MONEY)


def as_double(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def safe_div(num: Column, den: Column) -> Column:
    """DAX ``DIVIDE`` / SQL ``x / NULLIF(y, 0)``: NULL instead of an error."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def zero_div(num: Column, den: Column, default: float = 0.0) -> Column:
    """Ratio that yields ``default`` when the denominator is 0 (pandas-side guards)."""
    return F.when(den == 0, F.lit(default)).otherwise(num.cast("double") / den.cast("double"))


def count_if(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("long")


def sum_if(cond: Column, value: Column) -> Column:
    return F.sum(F.when(cond, value).otherwise(F.lit(0)))


def real_text(d: Column) -> Column:
    """Text of a whole-number REAL as SQLite prints it (``12345.0``), built from
    a decimal so it never falls into scientific notation."""
    return F.concat(d.cast("decimal(38,0)").cast("string"), F.lit(".0"))
