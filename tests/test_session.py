"""Where files go and how large the pieces are."""

from __future__ import annotations

from types import SimpleNamespace

import pytest

from keytide import session


def fake(master: str, path: str | None):
    conf = SimpleNamespace(get=lambda name, default=None: path)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_shared_folder_is_the_clusters():
    assert session.shared_dir(fake("spark://host:7077", "hdfs://x/ck/")) == "hdfs://x/ck"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(fake("yarn", None))
    own = session.shared_dir(fake("local[4]", None))
    assert own and own == session.shared_dir(fake("local[4]", None))


def test_scratch_lies_in_the_shared_folder(spark):
    name = session.scratch_namespace(spark, "where")
    assert session.shared_dir(spark) in session.namespace_dir(spark, name)


def test_setting_is_restored(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with pytest.raises(ZeroDivisionError), session.setting(spark, "spark.sql.shuffle.partitions", "99"):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "99"
        1 / 0
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_cluster_conf_stays_sane_at_scale():
    small = session.cluster_conf(2**30, cores=8)
    large = session.cluster_conf(100 * 2**40, cores=4000)
    assert small["spark.sql.shuffle.partitions"] == "16"
    maps = 100 * 2**40 // int(large["spark.sql.files.maxPartitionBytes"])
    partitions = int(large["spark.sql.shuffle.partitions"])
    assert partitions <= 60_000 and maps * partitions <= 10**10
