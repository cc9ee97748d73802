"""Session settings, the shared folder and scratch namespaces."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import SparkSession

MIB = 1024 * 1024


def local_session(cores: int = 8, app: str = "keytide") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def cluster_conf(input_bytes: int, cores: int, shuffle_partition_bytes: int = 2048 * MIB) -> dict[str, str]:
    """Settings for a job over ``input_bytes`` on ``cores`` task slots.

    What reaches the upsert's shuffle is combined per key before, so it is taken
    to be no larger than the files.  Every task of the scan writes a block per
    shuffle partition, and the driver tracks them: at 100 TB, splits of 1 GB and
    partitions of 2 GB keep that to some 10^5 tasks and 5 * 10^4 partitions.
    """
    partitions = max(cores * 2, math.ceil(input_bytes / shuffle_partition_bytes))
    split = min(1024 * MIB, max(256 * MIB, math.ceil(input_bytes / 100_000)))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.session.timeZone": "UTC",
    }


@contextmanager
def setting(spark: SparkSession, name: str, value: str | None) -> Iterator[None]:
    """Run a block with a session setting changed; ``None`` leaves it as it is."""
    if value is None:
        yield
        return
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as ``spark.checkpoint.dir`` names it.

    Only a local session without that setting gets a folder of its own.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        path = _local_dir()
    return path.rstrip("/")


@cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="keytide-")


_scratch: list[str] = []


def scratch_namespace(spark: SparkSession, label: str) -> str:
    """An empty namespace under the shared folder, unique to this call."""
    from keytide.sources.tables import create_namespace

    name = f"keytide_{label}_{uuid.uuid4().hex[:12]}"
    create_namespace(spark, name, location=f"{shared_dir(spark)}/keytide/{name}")
    _scratch.append(name)
    return name


def namespace_dir(spark: SparkSession, namespace: str) -> str:
    return spark.catalog.getDatabase(namespace).locationUri.rstrip("/")


def drop_scratch(spark: SparkSession) -> None:
    """Drop this process's scratch namespaces once their results are consumed."""
    from keytide.sources.tables import drop_namespace

    while _scratch:
        drop_namespace(spark, _scratch.pop())
