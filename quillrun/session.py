"""Session settings the jobs rely on, and the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_SHARED: dict[str, str] = {}


def build_session(app_name: str = "quillrun", cores: int | str = "*",
                  shuffle_partitions: int = 8, driver_memory: str = "8g") -> SparkSession:
    """Local session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Written tables that cut lineage live here, so it must be reachable from every
    executor. Only a local session without the setting gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _LOCAL_SHARED:
        _LOCAL_SHARED[context.applicationId] = tempfile.mkdtemp(prefix="quillrun-")
    return _LOCAL_SHARED[context.applicationId]


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, never reused path below the shared folder."""
    return f"{shared_dir(spark)}/quillrun/{label}-{uuid.uuid4().hex}"


def materialise(df, label: str, partition_by: tuple[str, ...] = ()):
    """Write a table once below the shared folder and read it back.

    Used before a table with an expensive or non-repeatable plan (a Python map, a model
    call) feeds more than one branch.
    """
    path = fresh_dir(df.sparkSession, label)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.parquet(path)
