"""Tables published all at once, and models refreshed month by month."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from skyledger.functions import dates
from skyledger.operators import versions
from skyledger.plans import gold, refresh
from skyledger.session import children, staged


@pytest.fixture()
def database(spark):
    name = f"versions_{dt.datetime.now().strftime('%H%M%S%f')}"
    spark.sql(f"CREATE DATABASE {name}")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def rows(spark, *data):
    return spark.createDataFrame(list(data), "k int, v string, year int")


def stored(spark, name):
    return sorted((r.k, r.v, r.year) for r in spark.table(name).collect())


def folders(spark, name):
    """Version folders and the partitions in them."""
    root = versions.root_of(spark, name)
    return {v: [p for p in children(spark, f"{root}/{v}") if not p.startswith("_")] for v in children(spark, root)}


FIRST = [(1, "a", 2020), (2, "b", 2021), (3, "it's", None)]


@pytest.mark.parametrize("partition", ["year", None])
def test_upsert(spark, database, partition):
    name = f"{database}.t"
    assert versions.upsert(rows(spark, *FIRST), name, ["k"], partition) == "created"
    assert versions.upsert(rows(spark, (2, "B", 2021), (4, "d", 2022), (4, "c", 2022)), name, ["k"], partition) == "merged"
    expected = [(1, "a", 2020), (2, "B", 2021), (3, "it's", None), (4, "d", 2022)]
    assert sorted(stored(spark, name)) == expected
    versions.upsert(rows(spark, (2, "B", 2021)), name, ["k"], partition)
    assert stored(spark, name) == expected
    versions.upsert(rows(spark).limit(0), name, ["k"], partition)
    assert stored(spark, name) == expected


def test_a_merge_does_not_bring_a_partition_together(spark, database, monkeypatch):
    name, plans, merge = f"{database}.t", [], versions.merge_rows

    def seen(target, *rest):
        plans.append(target._jdf.queryExecution().executedPlan().toString())
        return merge(target, *rest)

    monkeypatch.setattr(versions, "merge_rows", seen)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4k")
    try:
        many = spark.range(40000).selectExpr("cast(id as int) k", "uuid() v", "cast(2020 + id % 2 as int) year")
        versions.upsert(many, name, ["k"], "year")
        versions.upsert(many.filter("year = 2021").withColumn("v", F.lit("new")), name, ["k"], "year")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert len(plans) == 1 and "SortMergeJoin" not in plans[0] and "hashpartitioning" not in plans[0]
    assert spark.table(name).count() == 40000 and spark.table(name).filter("v = 'new'").count() == 20000


def test_nothing_is_left_over_and_untouched_partitions_stay(spark, database):
    name = f"{database}.t"
    versions.upsert(rows(spark, *FIRST), name, ["k"], "year")
    (first,) = folders(spark, name)
    versions.upsert(rows(spark, (2, "B", 2021)), name, ["k"], "year")
    now = folders(spark, name)
    assert sorted(now.pop(first)) == ["year=2020", "year=__HIVE_DEFAULT_PARTITION__"]
    assert list(now.values()) == [["year=2021"]]
    versions.incremental(rows(spark, (9, "x", 1)), f"{database}.plain", "k")
    versions.incremental(rows(spark, (9, "y", 1)), f"{database}.plain", "k")
    assert len(folders(spark, f"{database}.plain")) == 1


def test_null_keys_are_keys(spark, database):
    name = f"{database}.t"
    versions.upsert(rows(spark, (None, "a", 2020), (1, "b", 2020)), name, ["k"], "year")
    versions.upsert(rows(spark, (None, "c", 2020)), name, ["k"], "year")
    assert {(r.k, r.v) for r in spark.table(name).collect()} == {(None, "c"), (1, "b")}


@pytest.mark.parametrize("partition", ["year", None])
def test_a_failed_write_changes_nothing(spark, database, partition):
    name = f"{database}.t"
    versions.upsert(rows(spark, *FIRST), name, ["k"], partition)
    before = folders(spark, name)
    broken = rows(spark, (2, "x", 2021), (5, "y", 2020)).withColumn("v", F.when(F.col("k") == 5, F.raise_error(F.lit("broken"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="broken"):
        versions.publish(broken, name, partition)
    assert stored(spark, name) == FIRST and folders(spark, name) == before


@pytest.mark.parametrize("fails_at", [1, 2, 3])
def test_a_failed_pointer_takes_the_others_back(spark, database, fails_at, monkeypatch):
    """New, changed and dropped partitions: whichever pointer fails, the old rows are read."""
    name = f"{database}.t"
    versions.upsert(rows(spark, *FIRST), name, ["k"], "year")
    before, real, calls = folders(spark, name), versions.point, []

    def point(*arguments):
        calls.append(arguments)
        if len(calls) == fails_at:
            raise OSError("catalog is gone")
        real(*arguments)

    monkeypatch.setattr(versions, "point", point)
    with pytest.raises(OSError):
        versions.publish(rows(spark, (2, "x", 2021), (7, "n", 2023)), name, "year", gone=["2020"])
    monkeypatch.undo()
    assert stored(spark, name) == FIRST and folders(spark, name) == before
    versions.publish(rows(spark, (2, "x", 2021), (7, "n", 2023)), name, "year", gone=["2020"])
    assert stored(spark, name) == [(2, "x", 2021), (3, "it's", None), (7, "n", 2023)]


def test_another_table_of_the_name_is_replaced(spark, database):
    name = f"{database}.t"
    rows(spark, (1, "old", 1)).write.saveAsTable(name)
    assert versions.upsert(rows(spark, (2, "new", 2)), name, ["k"], "year") == "created"
    assert stored(spark, name) == [(2, "new", 2)]
    versions.drop(spark, name)
    assert not spark.catalog.tableExists(name)


def test_the_old_rows_are_not_shuffled(spark, database):
    name = f"{database}.t"
    versions.upsert(spark.range(2000).selectExpr("cast(id as int) AS k", "'a' AS v", "2020 AS year"), name, ["k"], "year")
    target, new = spark.table(name), staged(rows(spark, (5, "x", 2020)).select(F.col("k").alias("_new_k")))
    kept = target.join(new, target["k"].eqNullSafe(new["_new_k"]), "left_anti")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


# ---- models by month --------------------------------------------------------


def days(spark, **temperature):
    """Two days of two stations in each month named ``m202101``."""
    data = [
        (s, dt.date(int(m[1:5]), int(m[5:]), d), float(t), 1.0, 2.0, 50.0)
        for m, t in temperature.items() for s in "AB" for d in (1, 2)
    ]
    names = "station string, date date, avg_temp_c double, total_precip_mm double, avg_wind_ms double, avg_humidity double"
    return spark.createDataFrame(data, names)


@pytest.fixture()
def model(database):
    def run(source, settings=""):
        return refresh.refresh(source, dates.date_id("date"), lambda d: gold.dim_weather(d, 2000), f"{database}.dim_weather", settings)

    return run, f"{database}.dim_weather"


def months(spark, name):
    return {r.date_id: r.avg_monthly_temp for r in spark.table(name).collect()}


def files(spark, name):
    return {r.date_id: r.file for r in spark.table(name).select("date_id", F.col("_metadata.file_path").alias("file")).collect()}


def test_only_changed_months_are_built_again(spark, model):
    run, name = model
    assert run(days(spark, m202101=1, m202102=2, m202103=3)) == ["202101", "202102", "202103"]
    first = files(spark, name)
    assert run(days(spark, m202101=1, m202102=2, m202103=3).repartition(3)) == []
    assert files(spark, name) == first
    assert run(days(spark, m202101=1, m202102=20, m202104=4)) == ["202102", "202103", "202104"]
    assert months(spark, name) == {"202101": 1.0, "202102": 20.0, "202104": 4.0}
    now = files(spark, name)
    assert now["202101"] == first["202101"] and now["202102"] != first["202102"]
    assert run(days(spark, m202101=1, m202102=20, m202104=4), settings="other") == ["202101", "202102", "202104"]


def test_repeated_rows_are_changes(spark, model):
    run, name = model
    run(days(spark, m202101=1, m202102=2))
    doubled = days(spark, m202101=1, m202102=2).unionByName(days(spark, m202102=2))
    assert run(doubled) == ["202102"]
    swapped = days(spark, m202101=1).unionByName(days(spark, m202102=7)).unionByName(days(spark, m202102=7))
    assert run(swapped) == ["202102"]
    assert months(spark, name) == {"202101": 1.0, "202102": 7.0}


def test_months_without_model_rows_leave(spark, model):
    run, name = model
    run(days(spark, m202101=1, m202102=2))
    gone = days(spark, m202101=1, m202102=2).withColumn("avg_temp_c", F.when(F.month("date") == 1, F.col("avg_temp_c")))
    assert run(gone) == ["202102"]
    assert months(spark, name) == {"202101": 1.0}
    assert run(days(spark).limit(0)) == ["202101", "202102"]
    assert months(spark, name) == {} and run(days(spark).limit(0)) == []


def test_a_failed_refresh_is_repeated(spark, model, monkeypatch):
    run, name = model
    run(days(spark, m202101=1, m202102=2))
    real = versions.publish

    def publish(df, at, *rest, **more):
        if at.endswith("_months"):
            raise OSError("no space")
        return real(df, at, *rest, **more)

    monkeypatch.setattr(versions, "publish", publish)
    with pytest.raises(OSError):
        run(days(spark, m202101=1, m202102=5))
    monkeypatch.undo()
    assert run(days(spark, m202101=1, m202102=5)) == ["202102"]
    assert months(spark, name) == {"202101": 1.0, "202102": 5.0}


def test_no_staging_is_left(spark, database, model):
    run, _ = model
    root = spark.conf.get("spark.checkpoint.dir")
    before = children(spark, root)
    versions.upsert(rows(spark, *FIRST), f"{database}.t", ["k"], "year")
    versions.upsert(rows(spark, (2, "B", 2021)), f"{database}.t", ["k"], "year")
    run(days(spark, m202101=1))
    assert children(spark, root) == before
