"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app: str = "parcelle", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC dates.

    Partition counts are left to adaptive coalescing: callers pass
    ``spark.sql.shuffle.partitions`` for the size of their cluster.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.ui.showConsoleProgress": "false",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the cluster's shared checkpoint directory.

    The directory comes from ``spark.checkpoint.dir``. Only a local master may
    go without it, and then gets a temporary folder; a cluster must name one,
    because a folder on one machine is lost with that machine.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="parcelle-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
