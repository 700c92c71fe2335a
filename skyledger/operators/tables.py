"""Loading, merging and laying out tables.

Catalog tables are addressed by name, lake tables by path (partitioned parquet).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skyledger.session import remove, shared_dir

# Database of each layer.
LAYERS = {"bronze": "bronze", "silver": "model_silver", "gold": "model_gold"}

# What missing fields become in the serving table of stations.
STATION_DEFAULTS = {"station_name": "", "country": "", "parname": "", "staid": 0, "souid": 0}


# ---- catalog ----------------------------------------------------------------


def table_name(layer: str, model: str) -> str:
    return f"{LAYERS[layer]}.{model}"


def ensure_layers(spark: SparkSession) -> None:
    for database in LAYERS.values():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")


def ensure_table(
    spark: SparkSession, name: str, schema: StructType, partition_by: Sequence[str] = ()
) -> None:
    if not spark.catalog.tableExists(name):
        spark.createDataFrame([], schema).write.partitionBy(*partition_by).saveAsTable(name)


def drop_and_create(df: DataFrame, name: str) -> None:
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
    df.write.saveAsTable(name)


def create_as(df: DataFrame, name: str, year_of: str | None = None) -> None:
    """A new table from a query, optionally partitioned by the year of a date column."""
    if year_of is None:
        df.write.saveAsTable(name)
    else:
        with_year(df, year_of).hint("rebalance", "year").write.partitionBy("year").saveAsTable(name)


def with_year(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn("year", F.year(column))


def publish_view(spark: SparkSession, name: str, query: str) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")


# ---- loads ------------------------------------------------------------------


def replace_if_any(df: DataFrame, name: str, known: bool = False) -> bool:
    """Truncate and load; with no input rows the old rows stay. ``known``: there are rows."""
    if not known and df.isEmpty():
        return False
    df.write.mode("overwrite").saveAsTable(name)
    return True


def overwrite_rows(df: DataFrame, name: str) -> None:
    df.write.insertInto(name, overwrite=True)


def append_counted(df: DataFrame, name: str) -> int:
    """Append and report how many rows were written, in the same pass."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("append").saveAsTable(name)
    return seen.get["rows"]


def stamped(df: DataFrame, clock: Column | None = None) -> DataFrame:
    return df.withColumn("_ingested_at", F.current_timestamp() if clock is None else clock)


def with_defaults(df: DataFrame, defaults: Mapping[str, object] = STATION_DEFAULTS) -> DataFrame:
    return df.na.fill({c: v for c, v in defaults.items() if c in df.columns})


def sorted_layout(df: DataFrame, keys: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Rows range-partitioned and sorted on the table key, so scans can skip row groups.

    The hash after the key lets one hot key spread over several ranges.
    """
    spread = F.xxhash64(*df.columns)
    ranges = [F.col(k) for k in keys] + [spread]
    ordered = df.repartitionByRange(*([partitions] if partitions else []), *ranges)
    return ordered.sortWithinPartitions(*keys)


def key_order(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row ``(files, rows, inversions, overlaps)`` on how a stored table lies on disk.

    ``inversions`` are rows whose key is less than that of the row before them in their file,
    ``overlaps`` files that start before the file ahead of them in key order ends.
    """
    key, meta = F.struct(*keys), F.col("_metadata")
    rows = table.select(key.alias("key"), meta["file_path"].alias("file"), meta["row_index"].alias("place"))
    ahead = F.lag("key").over(W.partitionBy("file").orderBy("place"))
    per_file = rows.withColumn("less", F.coalesce(F.col("key") < ahead, F.lit(False))).groupBy("file").agg(
        F.count("*").alias("rows"), F.count_if("less").alias("less"), F.min("key").alias("low"), F.max("key").alias("high")
    )
    # One row per file.
    before = F.lag("high").over(W.orderBy("low", "high"))
    marked = per_file.withColumn("over", F.coalesce(F.col("low") < before, F.lit(False)))
    return marked.agg(
        F.count("*").alias("files"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("less"), F.lit(0)).alias("inversions"),
        F.count_if("over").alias("overlaps"),
    )


def materialize(
    df: DataFrame,
    name: str,
    bucket_by: str | None = None,
    buckets: int = 8,
    sort_by: Sequence[str] = (),
    files: int | None = None,
) -> DataFrame:
    """Write a model as a table and read it back.

    A sorted model has as many ranges as Spark finds good, or ``files``. Bucketed models are hashed like the buckets first, so each bucket is one file
    and later joins on that key need no shuffle.
    """
    if bucket_by is None:
        (sorted_layout(df, sort_by, files) if sort_by else df).write.mode("overwrite").saveAsTable(name)
    else:
        writer = df.repartition(buckets, bucket_by).write.bucketBy(buckets, bucket_by)
        if sort_by:
            writer = writer.sortBy(*sort_by)
        writer.mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


# ---- keyed rows -------------------------------------------------------------


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order.

    A row number filtered to 1 becomes a group limit before the shuffle, so each
    task sends at most one row per key and a hot key cannot pile up.
    """
    ranked = df.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.filter("_rank = 1").drop("_rank")


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """One row per key; ties are broken by all other columns, so reruns agree."""
    rest = [F.col(c).desc_nulls_last() for c in df.columns if c not in keys]
    order = [*(order or []), *rest] or [F.col(keys[0])]
    return latest_per_key(df, keys, order)


def merge_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Matched rows take the source's values, other rows of both sides stay.

    The target loses the source's keys by an anti-join: while the source, of one row per key,
    is small, Spark sends its keys to the target's tasks and nothing else moves. The source is
    read twice, so it should be a staged table. Null keys match null keys.
    """
    replaced = source.select(*[F.col(k).alias(f"_new_{k}") for k in keys])
    same = [target[k].eqNullSafe(replaced[f"_new_{k}"]) for k in keys]
    return target.join(replaced, same, "left_anti").unionByName(source)


def touched_rows(target: DataFrame, values: DataFrame) -> DataFrame:
    """The target's rows in the partitions whose values are in ``values``, its one column.

    The values, however many, should be a staged table, one row per partition: Spark sees their
    size and sends them to the tasks that read the target. Joined by value instead, all rows of
    a partition would meet in one task.
    """
    (partition,) = values.columns
    return target.join(values, target[partition].eqNullSafe(values[partition]), "left_semi")


def lake_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame | None:
    """A lake table, or None when nothing was ever written there."""
    try:
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def write_lake(df: DataFrame, path: str, partition: str | None = None, mode: str = "overwrite") -> None:
    """Write a lake table; with a partition column only the partitions in ``df`` change.

    The rebalance splits hot partition values over several files and keeps the
    others from being scattered over many.
    """
    if partition is None:
        df.write.mode(mode).parquet(path)
        return
    (
        df.hint("rebalance", partition)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def upsert(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    partition: str | None = None,
    order: Sequence[Column] | None = None,
) -> str:
    """Create, fill or merge a lake table, by what is there. Returns which was done.

    The source is parsed once, into the shared folder; the merged partitions are
    completed there too before the target is touched. If the final copy is cut
    short, ``write_lake`` of the folder named in the error completes it. The staged
    folders go when the target is complete. ``versions.upsert`` is the same for catalog
    tables, all at once.
    """
    spark = df.sparkSession
    staging = shared_dir(spark)
    one_per_key(df, keys, order).write.parquet(f"{staging}/source")
    source = spark.read.schema(df.schema).parquet(f"{staging}/source")
    target = lake_table(spark, path)
    if target is None:
        write_lake(source, path, partition)
        remove(spark, staging)
        return "created"
    if target.isEmpty():
        write_lake(source, path, partition, mode="append")
        remove(spark, staging)
        return "filled"
    touched = target
    if partition is not None:
        values = source.select(partition).distinct()
        values.write.parquet(f"{staging}/values")
        touched = touched_rows(target, spark.read.schema(values.schema).parquet(f"{staging}/values"))
    merged = merge_rows(touched, source, keys)
    merged.write.parquet(f"{staging}/merged")
    try:
        write_lake(spark.read.schema(merged.schema).parquet(f"{staging}/merged"), path, partition)
    except Exception as error:
        raise RuntimeError(f"target not completed; its new rows are in {staging}/merged") from error
    remove(spark, staging)
    return "merged"


def incremental(df: DataFrame, path: str, unique_key: str) -> str:
    """Replace the rows whose key appears again, keep the rest."""
    return upsert(df, path, [unique_key])
