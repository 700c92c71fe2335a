"""Helpers the corpus operators share: staged tables, ranks, prefix sums, components."""

from __future__ import annotations

import ctypes
import gc
import inspect
import sys
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.session import remove, shared_dir

WORD = r"[^\x20\x09-\x0D]+"
ROWS_AT_ONCE = 500
BYTES_AT_ONCE = 4 << 20
NO_ID = -(1 << 63)  # stands for a null doc_id where rows pass through pandas
SAFE = "_llm_"  # prefix of helper columns, so that extra input columns cannot clash


def light(spark: SparkSession) -> None:
    """Hands texts to Python tasks a few hundred at a time: a Python worker then holds a few
    megabytes of a large table at once, however long its texts are on average."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_AT_ONCE))


def lighter(spark: SparkSession) -> None:
    """Also bounds what is handed over by its size: rows of whole batches of texts are large,
    and both sides hold a handed-over part as a whole."""
    light(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BYTES_AT_ONCE))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    light(spark)
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame) -> DataFrame:
    """The rows written once to the shared folder and read back: cuts lineage, survives
    lost executors, and later steps do not compute them again."""
    spark = df.sparkSession
    light(spark)
    path = shared_dir(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Removes the folder of a staged table that no later plan reads."""
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        remove(df.sparkSession, folder)


def let_go(spark: SparkSession) -> None:
    """Lets shuffle files of ended plans go now: Spark removes them when the driver's memory is
    tidied, which may be long after a stage that moves much has moved on."""
    gc.collect()
    spark._jvm.System.gc()


def whole_ids() -> Column:
    """``doc_id`` as a long that is never null: pandas turns a long column with nulls into
    doubles, which changes ids above 2^53."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id")


def own_ids(df: DataFrame) -> DataFrame:
    """``df`` with null again where ``whole_ids`` put a number."""
    return df.withColumn("doc_id", F.nullif("doc_id", F.lit(NO_ID)))


def gapless(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], out: str, buckets: int) -> DataFrame:
    """``out``: a gapless number from 0 within ``keys``.

    Two levels, so that a key with a third of all rows is never sorted in one task:
    rows are numbered within (keys, bucket), and each bucket starts where the buckets
    before it end. Only one row per (keys, bucket) meets in the second level.
    """
    bucket, first, place = f"{SAFE}bucket", f"{SAFE}first", f"{SAFE}place"
    spread = [c if isinstance(c, Column) else F.col(c) for c in order]
    df = df.withColumn(bucket, F.pmod(F.xxhash64(*spread), F.lit(buckets)).cast("int"))
    inner = Window.partitionBy(*keys, bucket).orderBy(*spread)
    df = df.withColumn(place, F.row_number().over(inner) - 1)
    counts = df.groupBy(*keys, bucket).agg(F.count(F.lit(1)).alias(f"{SAFE}n"))
    before = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        *[F.col(k).alias(f"{SAFE}k{i}") for i, k in enumerate(keys)],
        F.col(bucket).alias(f"{SAFE}b"),
        F.coalesce(F.sum(f"{SAFE}n").over(before), F.lit(0)).alias(first),
    )
    same = [df[k].eqNullSafe(F.col(f"{SAFE}k{i}")) for i, k in enumerate(keys)]
    joined = df.join(starts, on=[*same, df[bucket] == F.col(f"{SAFE}b")])
    return joined.withColumn(out, (F.col(first) + F.col(place)).cast("long")).drop(
        bucket, first, place, f"{SAFE}b", *[f"{SAFE}k{i}" for i, _ in enumerate(keys)]
    )


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``node``, ``root`` for every node of ``links`` (columns a, b): the smallest node reachable.

    Alternates "hand every larger neighbour to my smallest" with "hand every smaller
    neighbour to my smallest" until nothing changes, so long chains shrink fast and a hub's
    neighbours meet only in partial minima. Each round is a written table.
    """
    spark = links.sparkSession
    edges = staged(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    nodes = edges.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    if edges.isEmpty():
        return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    edges_mark = None
    for _ in range(rounds):
        # Large star: for each node, larger neighbours now point at its smallest neighbour.
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        # Small star: for each node, its smaller neighbours and itself point at the smallest.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        edges = staged(small.union(least.select("u", F.col("m").alias("v"))).distinct())
        mark = tuple(
            edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("u", "v").cast("long"))).first()
        )
        if mark == edges_mark:
            break
        edges_mark = mark
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = edges.groupBy("u").agg(F.min("v").alias("root"))
    return nodes.join(roots, nodes["node"] == roots["u"], "left").select(
        "node", F.coalesce("root", "node").alias("root")
    )


def tidy(function: Callable) -> Callable:
    """``function`` for a Python task, giving freed memory back to the system when it ends:
    workers live on, and what one stage's arrays left behind would add to the next one's."""

    def release() -> None:
        pa.default_memory_pool().release_unused()  # what was handed over stays there otherwise
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)

    def over_batches(parts):
        try:
            yield from function(parts)
        finally:
            release()

    def over_group(rows):
        try:
            return function(rows)
        finally:
            release()

    def over_pair(rows, others):
        try:
            return function(rows, others)
        finally:
            release()

    if inspect.isgeneratorfunction(function):
        return over_batches
    return over_group if len(inspect.signature(function).parameters) == 1 else over_pair


def per_process(name: str, make: Callable):
    """``make()``, called once in a Python process: functions of this package travel by value,
    and what they keep in globals would be built again for every task."""
    held = sys.__dict__.setdefault("_skyledger_llm", {})
    if name not in held:
        held[name] = make()
    return held[name]
