"""Session settings the plans rely on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings, safe to set on a session somebody else created.
# forceOptimizeSkewedJoin lets AQE split a hot join key even when the rows after
# the join would otherwise reuse its partitioning (join on station, group on station).
# hugeMethodLimit is the size above which the JVM refuses to compile a method: beyond
# it, separately generated operators are much faster than one interpreted method.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("skyledger")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder under the cluster's ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster the
    executors could not see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="skyledger-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/skyledger-{uuid.uuid4().hex}"


def staged(df: DataFrame, **options: str) -> DataFrame:
    """The rows written once to the shared folder, with the writer's ``options``, and read back.

    Later steps see a table of known size, so Spark itself decides whether to broadcast it.
    """
    path = shared_dir(df.sparkSession)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staged_for(df: DataFrame) -> Iterator[DataFrame]:
    """As ``staged``, for one block: the folder goes at its end."""
    spark, path = df.sparkSession, shared_dir(df.sparkSession)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove(spark, path)


def _file_system(spark: SparkSession, path: str):
    located = spark._jvm.org.apache.hadoop.fs.Path(path)
    return located.getFileSystem(spark._jsc.hadoopConfiguration()), located


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a file or folder, wherever Spark can reach it."""
    files, located = _file_system(spark, path)
    files.delete(located, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none when it is not there."""
    files, located = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(located)) if files.exists(located) else []


def move(spark: SparkSession, path: str, to: str) -> None:
    files, located = _file_system(spark, path)
    target = spark._jvm.org.apache.hadoop.fs.Path(to)
    files.mkdirs(target.getParent())
    if not files.exists(located) or not files.rename(located, target):
        raise OSError(f"could not move {path} to {to}")
