"""Tables whose new rows appear all at once, or not at all.

New rows are written to a folder of their own (``<root>/v-<id>``). When all of them are there,
the catalog is pointed at them: partition by partition, or the whole table where it has no
partitions. A write that fails leaves the table as it was; if a later pointer fails, those
already moved are moved back. Folders that nothing points at are removed at the end.

The rows of a merge are written once: the new folder is the target, no copy is made.
One writer at a time is assumed.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators.tables import merge_rows, one_per_key, touched_rows
from skyledger.session import children, remove, staged_for

MARK = "skyledger.versions"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def root_of(spark: SparkSession, name: str) -> str:
    """The folder of a versioned table, inside its database's folder."""
    database, table = name.split(".")
    return f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/{table}"


def is_versioned(spark: SparkSession, name: str) -> bool:
    if not spark.catalog.tableExists(name):
        return False
    return any(r["key"] == MARK for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect())


def drop(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    remove(spark, root_of(spark, name))


def ensure(df: DataFrame, name: str, partition: str | None) -> None:
    """An empty versioned table for the columns of ``df``; another table of the name goes."""
    spark = df.sparkSession
    if is_versioned(spark, name):
        return
    drop(spark, name)
    fields = [f for f in df.schema.fields if f.name != partition]
    fields += [f for f in df.schema.fields if f.name == partition]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    by = f"PARTITIONED BY (`{partition}`)" if partition else ""
    at = _quoted(f"{root_of(spark, name)}/{'' if partition else 'none'}")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {by} LOCATION {at} TBLPROPERTIES ('{MARK}' = 'true')")


def _spec(partition: str, value: str) -> str:
    return f"PARTITION (`{partition}` = {'null' if value == NULL_PARTITION else _quoted(value)})"


def _location(spark: SparkSession, name: str, spec: str = "") -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name} {spec}").collect()
    return [r["data_type"] for r in rows if r["col_name"] == "Location"][0]


def partition_values(spark: SparkSession, name: str) -> set[str]:
    return {unquote(r[0].split("=", 1)[1]) for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}


def point(spark: SparkSession, name: str, spec: str, location: str | None, known: bool = True) -> None:
    """Moves one pointer of the catalog; without a location the partition goes."""
    if location is None:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {spec}")
    elif known:
        spark.sql(f"ALTER TABLE {name} {spec} SET LOCATION {_quoted(location)}")
    else:
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {spec} LOCATION {_quoted(location)}")


def _repoint(spark: SparkSession, name: str, moves: Sequence[tuple[str, str | None]], known: set[str]) -> list[str]:
    """Makes all moves ``(spec, new location)`` or none; returns the folders left behind."""
    done: list[tuple[str, str | None]] = []
    try:
        for spec, location in moves:
            before = _location(spark, name, spec) if spec in known else None
            if location is None and before is None:
                continue
            done.append((spec, before))
            point(spark, name, spec, location, before is not None)
    except BaseException:
        for spec, before in reversed(done):
            point(spark, name, spec, before, spec in _specs(spark, name, spec))
        spark.catalog.refreshTable(name)
        raise
    spark.catalog.refreshTable(name)
    return [before for _, before in done if before]


def _specs(spark: SparkSession, name: str, like: str) -> set[str]:
    """The specs of the partitions a table has now; for a whole table the empty spec."""
    if not like:
        return {""}
    partition = like.split("`")[1]
    return {_spec(partition, v) for v in partition_values(spark, name)}


def publish(df: DataFrame, name: str, partition: str | None = None, gone: Iterable[str] = ()) -> list[str]:
    """Replaces the partitions that ``df`` has rows for, or the whole table, by those rows.

    ``gone`` are partition values to be dropped in the same step. Returns the values written.
    """
    spark = df.sparkSession
    ensure(df, name, partition)
    version = f"{root_of(spark, name)}/v-{uuid.uuid4().hex}"
    try:
        if partition is None:
            df.write.parquet(version)
            moves, written, known = [("", version)], [], {""}
        else:
            df.hint("rebalance", partition).write.partitionBy(partition).parquet(version)
            folders = [f for f in children(spark, version) if f.startswith(f"{partition}=")]
            written = [unquote(f.split("=", 1)[1]) for f in folders]
            moves = [(_spec(partition, v), f"{version}/{f}") for v, f in zip(written, folders)]
            moves += [(_spec(partition, v), None) for v in gone if v not in written]
            known = {_spec(partition, v) for v in partition_values(spark, name)}
        left = _repoint(spark, name, moves, known)
    except BaseException:
        remove(spark, version)
        raise
    for folder in left:
        remove(spark, folder)
    _sweep(spark, name)
    return written


def _sweep(spark: SparkSession, name: str) -> None:
    """Removes version folders that hold no partition any more."""
    root = root_of(spark, name)
    for version in children(spark, root):
        if version.startswith("v-") and not [f for f in children(spark, f"{root}/{version}") if not f.startswith(("_", "."))]:
            remove(spark, f"{root}/{version}")


def upsert(
    df: DataFrame,
    name: str,
    keys: Sequence[str],
    partition: str | None = None,
    order: Sequence[Column] | None = None,
) -> str:
    """Rows of ``df`` replace rows of the same keys, all others stay. Returns what was done.

    Of several rows of ``df`` with one key one is kept, the first in ``order``. Only
    partitions that ``df`` touches are read and written again. Old rows lose those keys by an
    anti-join with the new rows' keys, a staged table of known size, so the old rows are not
    shuffled while the load is small.
    """
    with staged_for(one_per_key(df, keys, order)) as source:
        return _upsert_staged(source, name, keys, partition)


def _upsert_staged(source: DataFrame, name: str, keys: Sequence[str], partition: str | None) -> str:
    spark = source.sparkSession
    fresh = not is_versioned(spark, name)
    done = "created" if fresh else "merged"
    if source.isEmpty():
        ensure(source, name, partition)
        return done
    if fresh:
        publish(source, name, partition)
        return done
    target = spark.table(name).select(source.columns)
    if partition is None:
        publish(merge_rows(target, source, keys), name)
        return done
    with staged_for(source.select(partition).distinct()) as values:
        publish(merge_rows(touched_rows(target, values), source, keys), name, partition)
    return done


def incremental(df: DataFrame, name: str, unique_key: str, partition: str | None = None) -> str:
    """Replace the rows whose key appears again, keep the rest."""
    return upsert(df, name, [unique_key], partition)
