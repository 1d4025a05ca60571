"""Sinks: marts and analysis tables to CSV/parquet/JSON, models to folders (O-05..O-09).

Every write goes to a folder under the session's shared checkpoint/export
location (``spark.checkpoint.dir``), never to a machine-local path.
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir
from .feeds import CSV_OPTIONS


def export_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one export under the shared checkpoint location."""
    return os.path.join(ensure_checkpoint_dir(spark), "exports", f"{name}-{uuid.uuid4().hex[:12]}")


def write_csv(df: DataFrame, path: str) -> str:
    """Extract with a header (the report tool's format); one folder of part files."""
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)
    return path


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_json(df: DataFrame, path: str) -> str:
    """Metrics documents: one JSON object per row (nested structs allowed)."""
    df.write.mode("overwrite").json(path)
    return path


def publish(marts: dict[str, DataFrame], root: str, fmt: str = "csv") -> dict[str, str]:
    """O-05/O-06: write every named extract under ``root``."""
    out = {}
    for name, df in marts.items():
        path = os.path.join(root, name)
        out[name] = write_csv(df, path) if fmt == "csv" else write_parquet(df, path)
    return out


def save_model(model, path: str) -> str:
    """O-09: MLlib persistence (metadata + parquet data); a model that is a table is written as parquet."""
    if isinstance(model, DataFrame):
        return write_parquet(model, path)
    model.write().overwrite().save(path)
    return path


def save_artefact(spark: SparkSession, models: dict, notes: dict, path: str) -> str:
    """O-09: all that scoring needs: the fitted models by name, and ``notes`` (preparation, thresholds, columns) as JSON."""
    for name, model in models.items():
        save_model(model, f"{path}/{name}")
    spark.createDataFrame([(json.dumps(notes),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/notes")
    return path


def load_notes(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(f"{path}/notes").first()[0])
