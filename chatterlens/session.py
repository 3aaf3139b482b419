"""Session defaults and the durable cut points used by multi-pass operators."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("chatterlens")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def _checkpoint_dir(spark: SparkSession) -> str | None:
    """The folder the context was given by code instead of by configuration."""
    chosen = spark.sparkContext._jsc.sc().getCheckpointDir()
    return chosen.get() if chosen.isDefined() else None


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the session names it.

    Only a local master may fall back to a temporary folder: on a cluster a
    machine-local path would be lost with its machine, so there we refuse.
    """
    named = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF, None)
    if named:
        return named
    chosen = _checkpoint_dir(spark)
    if chosen:
        return chosen
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    fallback = tempfile.mkdtemp(prefix="chatterlens-")
    spark.conf.set(CHECKPOINT_CONF, fallback)
    return fallback


def durable(df: DataFrame) -> DataFrame:
    """Materialise a frame on reliable storage and cut its lineage.

    The partitions and their row order are kept, and survive the loss of any
    executor, so later passes over the frame all see the same rows.
    """
    if _checkpoint_dir(df.sparkSession) is None:
        df.sparkSession.sparkContext.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def staging_path(spark: SparkSession, name: str) -> str:
    """A new, unused folder below the shared one."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")
