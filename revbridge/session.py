"""SparkSession defaults for the bridge.

Only sets what is unset: on a cluster the operator's own settings
(shuffle partitions, checkpoint dir, memory) win.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in DEFAULTS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    # IST bucketing relies on UTC wall-clock timestamps
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names in spark.checkpoint.dir (or that
    the application has set as its checkpoint folder)."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        raise ValueError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
    return path


class RunFolder:
    """The intermediate tables of one run, under the shared folder; `close` deletes them."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.path = f"{checkpoint_dir(spark).rstrip('/')}/revbridge-{uuid.uuid4().hex}"
        self._count = 0

    def next_path(self, name: str = "stage") -> str:
        self._count += 1
        return f"{self.path}/{self._count:03d}-{name}"

    def close(self) -> None:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, shared_dir: str | None = None) -> SparkSession:
    """A session of this machine; `shared_dir` becomes its spark.checkpoint.dir."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("revbridge")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("REVBRIDGE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # many short jobs: keep the driver's execution history small
        .config("spark.sql.ui.retainedExecutions", "20")
        .config("spark.ui.retainedJobs", "100")
        .config("spark.ui.retainedStages", "200")
    )
    if shared_dir:
        builder = builder.config("spark.checkpoint.dir", shared_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
