"""Session set-up and the shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "barframe", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings the operators rely on (UTC clock, AQE with skew handling)."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local master may fall back to a temporary folder, which goes when the process ends.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    named = tempfile.mkdtemp(prefix="barframe-")
    atexit.register(shutil.rmtree, named, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", named)
    return named


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df):
    """Checkpoint ``df`` reliably, so that later actions neither recompute it nor lose it with an executor."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()


def stored(df, name: str = "table"):
    """``df`` as a parquet table of the shared folder: computed once, then read by column.

    For a table that several branches of a plan read. It outlives executors, and each branch
    scans only the columns it needs.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
