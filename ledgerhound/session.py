"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app_name: str = "ledgerhound", conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session configured for this engine.

    Master, memory and shuffle partitions are the cluster's (or the caller's, by ``conf``). AQE stays on: it coalesces
    small shuffle partitions, converts joins to broadcast when the *runtime* size of a side is under the threshold,
    and splits skewed sort-merge join partitions.
    """
    own = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    b = SparkSession.builder.appName(app_name)
    for k, v in (own | (conf or {})).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` must name a folder that the driver and all executors share. Only a local
    master (tests, one machine) gets a private folder where the setting is missing.
    """
    sc = spark.sparkContext
    path = spark.conf.get(CHECKPOINT_CONF, None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="ledgerhound-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Around a write: its shuffle files go as soon as it ends, since what is read again is the written table.

    Else they stay on the executors' disks until the driver happens to collect its garbage.
    """
    was = spark.conf.get(CLEANUP_CONF, None)
    spark.conf.set(CLEANUP_CONF, "true")
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(CLEANUP_CONF)
        else:
            spark.conf.set(CLEANUP_CONF, was)
