"""Session set-up shared by jobs, tests and the benchmark."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings the operators rely on; safe on a session someone else built.

    Times are compared as UTC. AQE sizes shuffles, splits skewed join partitions and turns a join
    into a broadcast only when the measured side is small.
    """
    for name, value in {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    }.items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g", shared: str | None = None) -> SparkSession:
    """A session for tests and the benchmark with its folder for intermediate tables; cluster jobs bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("stratalake")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if shared:
        builder = builder.config("spark.checkpoint.dir", shared)
    return configure(builder.getOrCreate())


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of this machine: on a cluster the executors
    could not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = os.path.join(tempfile.gettempdir(), "stratalake-scratch")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"
