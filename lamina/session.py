"""Session construction and the shared scratch folder.

Library code never builds its own session: every operator takes DataFrames or
an existing ``SparkSession``. ``build_session`` is for tests, the bench and
command-line runs only.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app: str = "lamina",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the settings the operators are designed for.

    * AQE on, with partition coalescing and skew-join splitting: shuffle sizes
      are decided from runtime statistics, not guessed.
    * ``autoBroadcastJoinThreshold`` stays at Spark's default; broadcasts are
      decided on estimated/observed sizes, never forced for growing tables.
    * UTC session time zone, so timestamps compare equal across engines.
    * UI off (no server is started).
    """
    cpus = os.cpu_count() or 8
    b = SparkSession.builder.appName(app).master(master or f"local[{cpus}]")
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(shuffle_partitions or cpus),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": "16g",
    }
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


class NoSharedFolder(RuntimeError):
    """The session names no folder that driver and executors share."""


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master (one machine, so any folder is shared) may leave it
    unset: a private folder is then created and registered. On a cluster the
    executors would each write to their own disk, so an unset folder raises.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        # getCheckpointDir appends a per-application uuid folder; use its parent
        return current.rstrip("/").rsplit("/", 1)[0]
    if not _one_machine(spark):
        raise NoSharedFolder(f"set spark.checkpoint.dir to a shared folder (master is {sc.master})")
    root = tempfile.mkdtemp(prefix="lamina-ckpt-")
    sc.setCheckpointDir(root)
    return root


def warehouse_root(spark: SparkSession) -> str:
    """The shared warehouse folder (``spark.sql.warehouse.dir``).

    Left unset, Spark uses a folder below the driver's working folder. A local
    master may do with that; on a cluster executors could not see it, so it raises.
    """
    root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    default = f"{spark._jvm.java.lang.System.getProperty('user.dir')}/spark-warehouse"
    if root.removeprefix("file:").replace("//", "/") == default and not _one_machine(spark):
        raise NoSharedFolder(f"set spark.sql.warehouse.dir to a shared folder (master is {spark.sparkContext.master})")
    return root


def tables_root(spark: SparkSession) -> str:
    """Where published tables lie: the warehouse, or a folder of ``checkpoint_root`` on a
    cluster that names no warehouse. Later sessions find tables there by the same setting."""
    try:
        return warehouse_root(spark)
    except NoSharedFolder:
        return f"{checkpoint_root(spark)}/lamina-warehouse"


def _one_machine(spark: SparkSession) -> bool:
    return re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) is not None


_RUN = "lamina.scratch.run"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the shared checkpoint root."""
    run = spark.conf.get(_RUN, None) or "lamina-scratch"
    return f"{checkpoint_root(spark)}/{run}/{uuid.uuid4().hex}/{name}"


@contextmanager
def run_scratch(spark: SparkSession) -> Iterator[str]:
    """Scratch folders made within belong to one run and are removed at its end.

    For jobs that publish what they make: nothing lazy may outlive the block.
    """
    run = f"lamina-run-{uuid.uuid4().hex}"
    outer = spark.conf.get(_RUN, None)
    spark.conf.set(_RUN, run)
    try:
        yield run
    finally:
        if outer is None:
            spark.conf.unset(_RUN)
        else:
            spark.conf.set(_RUN, outer)
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_root(spark)}/{run}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
