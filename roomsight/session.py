"""Session settings, the shared folder, and cutting of long lineages."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable
from multiprocessing.pool import ThreadPool
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def session(app: str = "roomsight", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings the operators assume."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def sizing(shuffle_bytes: int, task_bytes: int = 128 * 2 ** 20) -> dict[str, str]:
    """Settings that keep a shuffle of the given size at ``task_bytes`` per task.

    For 100 TB that is 800,000 first partitions at 128 MB; adaptive execution merges those
    that turn out small.
    """
    partitions = max(200, -(-shuffle_bytes // task_bytes))
    return {"spark.sql.shuffle.partitions": str(partitions),
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(task_bytes)}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can see: ``spark.checkpoint.dir`` of the session.

    Where the setting is missing, a local session gets a scratch folder; on a cluster
    that would lose data with the machine, so there it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="roomsight-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def together(spark: SparkSession, *tasks: Callable[[], T]) -> list[T]:
    """Run independent fits at the same time; each submits jobs of its own."""
    with ThreadPool(len(tasks)) as pool:
        return pool.map(inheritable_thread_target(spark)(lambda task: task()), tasks)


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package where it is not installed for them: workers started from
    now on are told the folder it lies in (on a cluster that ships it, that is simply not there)."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written rows.

    Used where several jobs read the same derived rows. Parquet keeps column pruning and
    filter pushdown, and the rows outlive the executors that made them.
    """
    path = scratch_path(df.sparkSession, "cut")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
