"""Written tables for the star schema and other shared intermediates.

The conformed fact, the alert table and the feature frame are read by most
downstream operators (rules, controls, features, marts). They are written once
as parquet under the cluster's shared checkpoint folder and read back, which
both shares the work between queries and cuts lineage (a lost executor
re-reads parquet instead of replaying the whole build).

A table's place is named by everything it depends on: the input folder's files
(name, size, modification time, at any depth), the package's source, the
namespace and the parameters that its plan was given. Another parameter or a
changed input is another table, in memory as well as on disk.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir, shuffles_dropped

STORE_VERSION = "2"
NAMESPACE_CONF = "spark.ledgerhound.store.namespace"
_OPEN: dict[tuple, DataFrame] = {}


def _code_hash() -> str:
    """Tables are also keyed by this package's source, so a code change never
    reads a table written by older code."""
    h = hashlib.sha1()
    pkg = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for root, _, files in sorted(os.walk(pkg)):
        for f in sorted(files):
            if f.endswith(".py"):
                with open(os.path.join(root, f), "rb") as fh:
                    h.update(fh.read())
    return h.hexdigest()[:12]


_CODE = _code_hash()


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def fingerprint(spark: SparkSession, sf_dir: str) -> str:
    ns = spark.conf.get(NAMESPACE_CONF, "default")
    fs, path = _fs(spark, sf_dir)
    root = fs.makeQualified(path).toString()
    h = hashlib.sha1(f"{STORE_VERSION}|{_CODE}|{ns}|{root}".encode())
    files, found = fs.listFiles(path, True), []
    while files.hasNext():
        st = files.next()
        found.append(f"|{st.getPath().toString()}:{st.getLen()}:{st.getModificationTime()}")
    h.update("".join(sorted(found)).encode())
    return h.hexdigest()[:16]


def table_name(name: str, params: tuple = ()) -> str:
    """``name``, and a hash of the parameter objects that the plan was given."""
    return f"{name}-{hashlib.sha1(repr(params).encode()).hexdigest()[:10]}" if params else name


def stored(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame], params: tuple = ()) -> DataFrame:
    """Return table ``name`` for ``sf_dir`` and ``params``, building and writing it on first use.

    This writes when called, before any action on the result.
    """
    mark = fingerprint(spark, sf_dir)
    key = (spark.sparkContext.applicationId, mark, name, params)
    if key not in _OPEN:
        path = os.path.join(ensure_checkpoint_dir(spark), "tables", mark, table_name(name, params))
        _OPEN[key] = spark.read.parquet(_written(spark, path, build))
    return _OPEN[key]


def _written(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> str:
    """The folder of the committed table: ``path``, or the next free name where a writer left ``path`` unfinished.

    The table is written aside and renamed, so readers never see a part of it; of two sessions that build one
    table the first to rename wins, and the other reads that.
    """
    fs, _ = _fs(spark, path)
    place, n = path, 0
    while not _committed(spark, place):
        if fs.exists(_fs(spark, place)[1]):
            n += 1
            place = f"{path}.{n}"
            continue
        aside = f"{path}.{uuid.uuid4().hex}.writing"
        table = build()
        with shuffles_dropped(spark):
            table.write.parquet(aside)
        if not _committed(spark, place):
            fs.rename(_fs(spark, aside)[1], _fs(spark, place)[1])
    return place


def _committed(spark: SparkSession, path: str) -> bool:
    """True when the job that wrote ``path`` committed (its ``_SUCCESS`` marker exists)."""
    fs, marker = _fs(spark, f"{path}/_SUCCESS")
    return bool(fs.exists(marker))
