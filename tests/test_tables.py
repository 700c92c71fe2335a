"""Loads, merges and layouts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from skyledger.operators import tables
from skyledger.schemas import SUNSHINE_DAILY
from skyledger.session import shared_dir

KEYS = ["staid", "souid", "date"]


def daily(spark, *rows):
    data = [(s, u, dt.date.fromisoformat(d), v, q) for s, u, d, v, q in rows]
    return tables.with_year(spark.createDataFrame(data, SUNSHINE_DAILY), "date")


def stored(spark, path):
    rows = spark.read.parquet(path).select("staid", "souid", "date", "ss_raw").orderBy(*KEYS)
    return [(r.staid, r.souid, str(r.date), r.ss_raw) for r in rows.collect()]


FIRST = [(1, 1, "2020-01-01", 5, 0), (1, 1, "2021-01-01", 6, 0), (2, 1, "2021-01-01", 7, 0)]
LATE = [(1, 1, "2021-01-01", 60, 0), (3, 1, "2022-01-01", 8, 0)]
BOTH = [(1, 1, "2020-01-01", 5), (1, 1, "2021-01-01", 60), (2, 1, "2021-01-01", 7), (3, 1, "2022-01-01", 8)]


@pytest.mark.parametrize("partition", ["year", None])
def test_upsert(spark, partition):
    path = shared_dir(spark)
    assert tables.upsert(daily(spark, *FIRST), path, KEYS, partition) == "created"
    assert tables.upsert(daily(spark, *LATE), path, KEYS, partition) == "merged"
    assert stored(spark, path) == BOTH
    tables.upsert(daily(spark, *LATE), path, KEYS, partition)
    assert stored(spark, path) == BOTH


def test_upsert_leaves_other_partitions_alone(spark):
    path = shared_dir(spark)
    tables.upsert(daily(spark, *FIRST), path, KEYS, "year")
    kept = lambda: {f for f in spark.read.parquet(path).inputFiles() if "year=2020" in f}
    before = kept()
    tables.upsert(daily(spark, *LATE), path, KEYS, "year")
    assert kept() == before != set()


def test_a_merge_does_not_bring_a_partition_together(spark, monkeypatch):
    path, plans, merge = shared_dir(spark), [], tables.merge_rows

    def seen(target, *rest):
        plans.append(target._jdf.queryExecution().executedPlan().toString())
        return merge(target, *rest)

    monkeypatch.setattr(tables, "merge_rows", seen)
    days = spark.range(40000).select(
        F.col("id").cast("int").alias("staid"), F.lit(1).alias("souid"), F.lit(dt.date(2021, 1, 1)).alias("date"),
        F.rand(1).alias("ss_raw"), (F.lit(2020) + F.col("id").cast("int") % 2).alias("year"),
    )
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4k")
    try:
        tables.upsert(days, path, KEYS, "year")
        tables.upsert(days.filter("year = 2021").withColumn("ss_raw", F.lit(7.0)), path, KEYS, "year")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert len(plans) == 1 and "SortMergeJoin" not in plans[0] and "hashpartitioning" not in plans[0]
    rows = spark.read.parquet(path)
    assert rows.count() == 40000 and rows.filter("ss_raw = 7").count() == 20000


def test_upsert_duplicate_source_and_order(spark):
    path = shared_dir(spark)
    twice = daily(spark, (1, 1, "2020-01-01", 5, 0), (1, 1, "2020-01-01", 9, 1))
    tables.upsert(twice, path, KEYS, "year", order=[F.asc("ss_raw")])
    assert stored(spark, path) == [(1, 1, "2020-01-01", 5)]


def test_upsert_fills_an_empty_table(spark):
    path = shared_dir(spark)
    empty = spark.createDataFrame([], daily(spark, *FIRST).schema)
    empty.write.parquet(path)
    assert tables.upsert(daily(spark, *FIRST), path, KEYS) == "filled"
    assert len(stored(spark, path)) == 3


def test_merge_by_partition(spark):
    path = shared_dir(spark)
    tables.upsert(daily(spark, *FIRST), path, KEYS, "year")
    tables.upsert(daily(spark, *LATE), path, KEYS, "year")
    assert stored(spark, path) == BOTH


def test_incremental_replaces_by_key(spark):
    path = shared_dir(spark)
    frame = lambda *rows: spark.createDataFrame(list(rows), "date_id string, v int")
    tables.incremental(frame(("202101", 1), ("202102", 2)), path, "date_id")
    tables.incremental(frame(("202102", 20), ("202103", 3)), path, "date_id")
    rows = spark.read.parquet(path).orderBy("date_id").collect()
    assert [tuple(r) for r in rows] == [("202101", 1), ("202102", 20), ("202103", 3)]


def test_latest_per_key_prunes_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 3, "b"), (2, 2, "c")], "k int, version int, v string")
    newest = tables.latest_per_key(df, ["k"], [F.desc("version")])
    assert sorted(tuple(r) for r in newest.collect()) == [(1, 3, "b"), (2, 2, "c")]
    plan = newest._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_loads_into_catalog_tables(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS loads")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    nothing = df.filter("id > 9")
    assert tables.replace_if_any(df, "loads.t") and not tables.replace_if_any(nothing, "loads.t")
    assert spark.table("loads.t").count() == 2
    assert tables.append_counted(df, "loads.t") == 2 and spark.table("loads.t").count() == 4
    tables.overwrite_rows(df, "loads.t")
    assert spark.table("loads.t").count() == 2
    tables.drop_and_create(df.limit(1), "loads.t")
    assert spark.table("loads.t").count() == 1
    tables.ensure_table(spark, "loads.t", df.schema)
    assert spark.table("loads.t").count() == 1
    tables.ensure_table(spark, "loads.fresh", df.schema)
    assert spark.table("loads.fresh").count() == 0
    tables.create_as(df, "loads.plain")
    tables.create_as(daily(spark, *FIRST).drop("year"), "loads.by_year", year_of="date")
    partitions = {r[0] for r in spark.sql("SHOW PARTITIONS loads.by_year").collect()}
    assert partitions == {"year=2020", "year=2021"}
    tables.publish_view(spark, "loads.v", "SELECT id FROM loads.plain")
    assert spark.table("loads.v").columns == ["id"]


def test_defaults_and_stamp(spark):
    df = spark.createDataFrame([(None, None, None)], "staid int, country string, lat double")
    row = tables.stamped(tables.with_defaults(df)).first()
    assert (row.staid, row.country, row.lat) == (0, "", None) and row._ingested_at is not None


def test_sorted_layout_spreads_a_hot_key(spark):
    df = spark.range(4000).select(F.lit(7).alias("k"), F.col("id"))
    sizes = tables.sorted_layout(df, ["k"], 4).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 2000


def test_bucketed_tables_join_without_a_shuffle(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS loads")
    df = spark.range(100).select(F.col("id").alias("medication_id"), F.col("id").alias("v"))
    a = tables.materialize(df, "loads.a", bucket_by="medication_id", buckets=4, sort_by=["v"])
    b = tables.materialize(df, "loads.b", bucket_by="medication_id", buckets=4)
    joined = a.hint("merge").join(b.withColumnRenamed("v", "w"), "medication_id")
    assert joined.count() == 100
    assert "Exchange" not in joined._jdf.queryExecution().sparkPlan().toString()
    assert "Exchange hashpartitioning" not in joined._jdf.queryExecution().executedPlan().toString()


def test_shared_dir_is_under_the_configured_folder(spark):
    assert shared_dir(spark).startswith(spark.conf.get("spark.checkpoint.dir"))


def test_key_order_sees_what_is_out_of_order(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS loads")
    df = spark.range(5000).select((F.col("id") * 7919 % 1000).alias("k"), F.col("id").alias("v")).repartition(4)
    report = lambda name: tables.key_order(spark.table(name), ["k"]).first()
    tables.materialize(df, "loads.in_order", sort_by=["k"], files=4)
    good = report("loads.in_order")
    assert (good["files"], good["rows"], good["inversions"], good["overlaps"]) == (4, 5000, 0, 0)
    df.write.mode("overwrite").saveAsTable("loads.as_it_came")
    bad = report("loads.as_it_came")
    assert bad["inversions"] > 1000 and bad["overlaps"] == bad["files"] - 1
    df.sortWithinPartitions("k").write.mode("overwrite").saveAsTable("loads.sorted_only")
    bad = report("loads.sorted_only")
    assert bad["inversions"] == 0 and bad["overlaps"] > 0


def test_key_order_with_a_hot_key_and_nothing(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS loads")
    hot = spark.range(4000).select(F.lit(7).alias("k"), F.col("id"))
    tables.materialize(hot, "loads.hot", sort_by=["k"], files=4)
    row = tables.key_order(spark.table("loads.hot"), ["k"]).first()
    assert row["files"] > 1 and (row["inversions"], row["overlaps"]) == (0, 0)
    tables.materialize(hot.limit(0), "loads.nothing")
    assert tuple(tables.key_order(spark.table("loads.nothing"), ["k"]).first()) == (0, 0, 0, 0)
