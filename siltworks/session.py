"""Session settings and the shared folder used for written tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of this package assumes. They are Spark's own adaptive features:
# run-time broadcast decisions, partition coalescing and skew splitting.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    # Column call sites are only of use while debugging and make building a plan slow.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(app: str, cores: int | str = 8, extra: dict[str, str] | None = None) -> SparkSession:
    """Session for tests and the benchmark; a cluster supplies its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": str(cores),
        "spark.driver.memory": "8g",
        **(extra or {}),
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder visible to every executor, as named by ``spark.checkpoint.dir``.

    Only a local-mode session that names none gets a temporary folder; on a cluster a
    missing setting is an error, because a machine-local folder would lose data.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="siltworks-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses."""
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")
