"""Session setup shared by every job."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

DELTA_CONF = {
    "spark.sql.extensions": "io.delta.sql.DeltaSparkSessionExtension",
    "spark.sql.catalog.spark_catalog": "org.apache.spark.sql.delta.catalog.DeltaCatalog",
}


def build_session(
    app_name: str = "adlake",
    *,
    delta: bool = False,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A UTC session with adaptive execution.

    ``shuffle_partitions`` is the number AQE starts from before it coalesces. On a large
    cluster give about one per 128 MB of the biggest shuffle; unset keeps the cluster's value.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled", "true")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    if delta:
        for key, value in DELTA_CONF.items():
            builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table_format(spark: SparkSession) -> str:
    """``delta`` when the session was built with the Delta extension, else ``parquet``."""
    return "delta" if "delta" in spark.conf.get("spark.sql.extensions", "").lower() else "parquet"


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged tables.

    On a cluster this is ``spark.checkpoint.dir``. Only where that is unset, and only in local
    mode (tests), a machine-local folder stands in for it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_scratch()


@cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="adlake-")


def staging_path(spark: SparkSession, name: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{scratch_dir(spark)}/adlake/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Write a small frame to the shared folder and go on from there.

    Later readers neither repeat the scans behind it nor lose it with an executor.
    """
    path = staging_path(df.sparkSession, "checkpoint")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staged(df: DataFrame) -> Iterator[DataFrame]:
    """Within, the frame as written to the shared folder; its files are deleted afterwards."""
    spark = df.sparkSession
    path = staging_path(spark, "staged")
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
