"""Session settings the operators rely on."""

from __future__ import annotations

import sys
import tempfile

from pyspark import cloudpickle
from pyspark.sql import SparkSession


def local_session(cores: str = "8", memory: str = "8g", partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("lanewise")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the time zone: calendar arithmetic must not depend on the host."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, for checkpoints and written tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session, where
    driver and executors are one process, may fall back to a temporary folder.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        if sc.getCheckpointDir() is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="lanewise-"))
        return sc.getCheckpointDir()
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured


def ship_with_tasks(module: str) -> None:
    """Send this module's code along with the tasks that use it.

    Executors then need no copy of the package.
    """
    cloudpickle.register_pickle_by_value(sys.modules[module])
