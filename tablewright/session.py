"""Session settings and shared working folders."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


# Runtime settings that suit wide projections. HotSpot never compiles a method above 8000 bytes
# of bytecode, so a fused stage beyond that size runs interpreted, several times slower than the
# same expressions in separate generated methods. A write into few folders keeps a file open in each
# instead of sorting its rows by folder, which spills; beyond that many folders Spark sorts the rest.
RECOMMENDED = {"spark.sql.codegen.hugeMethodLimit": "8000",
               "spark.sql.maxConcurrentOutputFileWriters": "8"}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the recommended runtime settings, except where the session sets them itself."""
    given = {key for key, _ in spark.sparkContext.getConf().getAll()}
    for key, value in RECOMMENDED.items():
        if key not in given:
            spark.conf.set(key, value)
    return spark


def local_session(app_name: str = "tablewright", cores: str = "*", **conf: str) -> SparkSession:
    """Local session for tests and the bench. On a cluster, use the cluster's own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh subfolder of the folder that every executor can reach.

    `spark.checkpoint.dir` names it. Only a local-mode session may fall back to a temporary
    folder of this machine; on a cluster that would lose data with its node, so it is refused.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="tablewright-")
    return os.path.join(root, f"{purpose}-{uuid.uuid4().hex[:12]}")
