"""Spark session settings the model relies on.

The model only needs two things from the session: timestamps are read and
printed in UTC, and adaptive execution is on (runtime broadcast of small join
sides, skew-join splitting, partition coalescing). Everything else is left to
whoever owns the session; on a cluster that is the job's own configuration.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Runtime SQL settings the model assumes. They are session-scoped and can be
#: set on an existing session.
MODEL_SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the session settings the model depends on (idempotent)."""
    for key, value in MODEL_SQL_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this must be a shared file system (HDFS, object store).
    Library code never invents one; only :func:`local_session` (tests, bench)
    sets it when it is unset.
    """
    path = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not path:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; configure a shared folder for checkpoints"
        )
    spark.sparkContext.setCheckpointDir(path)
    return path


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, for intermediate results.

    That is ``spark.checkpoint.dir``, or the folder the context was given. Where
    neither is set, a session on one machine gets a scratch folder; on a cluster
    this raises, because no executor would see a folder of the driver's machine.
    """
    context = spark.sparkContext
    path = context.getConf().get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not path:
        if not re.match(r"local(\[|$)", context.master):
            return checkpoint_dir(spark)
        path = tempfile.mkdtemp(prefix="emporium-shared-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(path)
    return path.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Whatever reads the result sees the same rows, however often and in whichever
    plan, and neither a retry nor a lost executor runs ``df`` again.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_session(
    cores: int | str = "*",
    shuffle_partitions: int = 8,
    app_name: str = "emporium",
    driver_memory: str = "8g",
    warehouse_dir: str | None = None,
) -> SparkSession:
    """A local session for tests and the bench (not for cluster use)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.default.parallelism", str(shuffle_partitions))
        .config("spark.driver.memory", driver_memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if warehouse_dir:
        builder = builder.config("spark.sql.warehouse.dir", warehouse_dir)
    for key, value in MODEL_SQL_CONF.items():
        builder = builder.config(key, value)
    active = SparkSession.getActiveSession()
    if active is None or not active.sparkContext.getConf().get("spark.checkpoint.dir", None):
        # One machine only (tests, bench): where no folder is set, a scratch folder, new for each session.
        builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="emporium-ckpt-"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)
