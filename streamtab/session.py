"""Session construction and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(app: str = "streamtab", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is tuned for; a cluster's own master and sizes are kept."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.python.unix.domain.socket.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir`, or the checkpoint directory the session was given.

    Only a local session without either gets a temporary folder, once.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="streamtab-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


def ready_checkpoints(spark: SparkSession) -> None:
    """Make `DataFrame.checkpoint()` usable, keeping a directory the session already has."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
