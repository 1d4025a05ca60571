"""Shared tables: built once, reused, and rebuilt when the writing job never committed."""

import os
import uuid

from conftest import SF_SMALL

from ledgerhound.plans import store
from ledgerhound.session import ensure_checkpoint_dir


def test_table_is_reused_and_uncommitted_output_is_rebuilt(spark):
    name = "probe_" + uuid.uuid4().hex[:8]
    builds = []

    def build():
        builds.append(1)
        return spark.range(10).withColumnRenamed("id", "x")

    assert store.stored(spark, SF_SMALL, name, build).count() == 10
    store._OPEN.clear()
    assert store.stored(spark, SF_SMALL, name, build).count() == 10
    assert len(builds) == 1

    # A folder of parquet files without the commit marker (a write that never
    # finished) must not be trusted.
    other = "probe_" + uuid.uuid4().hex[:8]
    root = os.path.join(ensure_checkpoint_dir(spark), "tables", store.fingerprint(spark, SF_SMALL), other)
    hconf = spark.sparkContext._jsc.hadoopConfiguration()
    hconf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        spark.range(3).withColumnRenamed("id", "x").write.parquet(root)
    finally:
        hconf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")
    assert not os.path.exists(os.path.join(root, "_SUCCESS"))
    store._OPEN.clear()
    assert store.stored(spark, SF_SMALL, other, build).count() == 10
    assert len(builds) == 2


def test_rewritten_input_is_seen_in_the_same_session(spark, tmp_path):
    name, folder = "probe_" + uuid.uuid4().hex[:8], str(tmp_path / "in")

    def build():
        return spark.read.parquet(f"{folder}/t.parquet")

    spark.range(3).write.parquet(f"{folder}/t.parquet")
    assert store.stored(spark, folder, name, build).count() == 3
    spark.range(7).write.mode("overwrite").parquet(f"{folder}/t.parquet")
    assert store.stored(spark, folder, name, build).count() == 7


def test_parameters_name_the_table(spark):
    name = "probe_" + uuid.uuid4().hex[:8]
    for n in (2, 5, 2):
        assert store.stored(spark, SF_SMALL, name, lambda n=n: spark.range(n), (n,)).count() == n


def test_default_and_fixture_thresholds_give_their_own_alerts(spark):
    from ledgerhound.params import FIXTURE_RULES, RuleParams
    from ledgerhound.plans.warehouse import Monitoring, run_rules

    seen = {}
    for p in (FIXTURE_RULES, RuleParams()):
        m = Monitoring(spark, SF_SMALL, p)
        direct = run_rules(m.fact, m.dim_country, p).select("alert_id").collect()
        seen[p] = sorted(r[0] for r in m.alerts.select("alert_id").collect())
        assert seen[p] == sorted(r[0] for r in direct)
    assert seen[FIXTURE_RULES] != seen[RuleParams()]


def test_no_private_folder_on_a_cluster(spark):
    from types import SimpleNamespace

    import pytest

    sc = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda *_: None)))
