"""Spark session helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(master: str | None = None, app: str = "monthend",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Session with the settings the library is tuned for.

    On a cluster the master and most sizing come from ``spark-submit``; only
    options that change plan shape are set here. ``master`` is honoured for
    local runs and tests.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and staged writes.

    Uses ``spark.checkpoint.dir`` (or the context's checkpoint dir) as set by
    the cluster. Only a local-mode session without one gets a private temp
    folder, as in tests; a cluster session without one is an error, because a
    machine-local folder does not survive the loss of an executor.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        d = tempfile.mkdtemp(prefix="monthend-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused sub-folder of the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df):
    """Compute ``df`` once into the shared checkpoint folder and cut its lineage.

    For small intermediate results that several branches of a plan read
    (update batches, glossaries): without it each branch would recompute
    them from the raw tables. A reliable checkpoint, so a lost executor does
    not lose it.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
