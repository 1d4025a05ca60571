"""Registry of user-facing queries: name -> (Spark plan, oracle SQL).

Every query reads the driver tables at ``sf_dir`` (or data Spark derives from
them) and returns a DataFrame whose money columns are doubles and dates are
ISO strings, so results compare cell by cell with the DuckDB oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = lambda spark, sf_dir: report(fn(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def report(df: DataFrame) -> DataFrame:
    """Reporting types: decimals -> double, dates -> 'yyyy-MM-dd' strings."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            cols.append(F.col(f.name).cast("double").alias(f.name))
        elif isinstance(f.dataType, T.DateType):
            cols.append(F.date_format(f.name, "yyyy-MM-dd").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def _load_all() -> None:
    # Importing the query modules fills the registry.
    from . import q_warehouse, q_quality, q_features, q_scoring, q_analytics, q_marts, q_models, q_io  # noqa: F401


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(ORACLES)
