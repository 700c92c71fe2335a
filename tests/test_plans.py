"""Model rules on small frames, and the shape of the physical plans."""

import datetime as dt

import pytest
from conftest import SF
from pyspark.sql import functions as F

from skyledger import registry
from skyledger.operators import governance, joins, quality
from skyledger.plans import gold, reports, silver
from skyledger.plans.bindings import Warehouse
from skyledger.schemas import MEDICATIONS, SUNSHINE_DAILY, SUNSHINE_SOURCES, WEATHER


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def meds(spark, *rows):
    full = [(y, m, dt.date(y, m, 1), i, p, n, n, c, a, a, a, a, a) for y, m, i, p, n, c, a in rows]
    return spark.createDataFrame(full, MEDICATIONS)


def test_medications_cleaned(spark):
    bronze = meds(
        spark,
        (2024, 1, " n02 para x", "1 a", 2, 1.5, 10.005), (2024, 1, "N02 PARA X ", "1 a", 3, 1.0, 0.01),
        (1999, 1, "old", "1 a", 1, 1.0, 1.0), (2031, 1, "future", "1 a", 1, 1.0, 1.0),
        (2024, 1, "none", "1 a", None, 1.0, 1.0),
    )
    rows = silver.medications_cleaned(bronze, today=dt.date(2030, 6, 1)).collect()
    assert len(rows) == 1
    row = rows[0]
    assert (row.ingredient_name, row.total_packages, row.total_persons) == ("N02 PARA X", 3, 5)
    assert str(row.total_amount) == "10.02"  # each row's cents are rounded half up: 1000.5 and 1


def test_weather_drops_incomplete_hours(spark):
    nan, inf = float("nan"), float("inf")
    hour = lambda h, t, g=1.0, hum=50: ("A", dt.datetime(2024, 1, 1, h), t, t, t, 1, 1.0, g, 0.5, hum)
    bronze = spark.createDataFrame(
        [hour(0, 1.0), hour(1, 2.0), hour(2, 99.0, nan), hour(3, 99.0, inf), hour(4, 99.0, 1.0, None)], WEATHER
    )
    rows = silver.weather_cleaned(bronze).collect()
    assert [(str(r.avg_temp_c), str(r.max_temp_c), str(r.total_precip_mm)) for r in rows] == [("1.50", "2.00", "1.00")]


def test_sunshine_fans_out_per_source(spark):
    day = dt.date(2024, 1, 1)
    daily = spark.createDataFrame([(1, 1, day, 25, 0), (2, 1, day, 5, 1), (1, 1, day, 9, 9), (1, 1, day, 9, None)], SUNSHINE_DAILY)
    source = lambda staid, souid: (staid, souid, "S", "EE", None, None, None, None, None, None)
    sources = spark.createDataFrame([source(1, 1), source(1, 2)], SUNSHINE_SOURCES)
    rows = silver.sunshine_cleaned(daily, sources).collect()
    assert sorted((r.staid, r.sunshine_hours, r.station_name) for r in rows) == [
        (1, 2.5, "S"), (1, 2.5, "S"), (2, 0.5, None),
    ]
    assert silver.sunshine_cleaned(daily, sources, dedup=True).count() == 2


@pytest.fixture(scope="module")
def star(spark):
    w = Warehouse(spark, SF)
    return w


def test_fact_keeps_every_medication_row(star):
    assert star.fact.count() == star.dim_medications.count()
    filled = gold.fact_medication_sales(star.dim_medications, star.dim_weather, star.dim_sunshine, True)
    assert filled.filter("weather_id is null").count() == 0
    assert filled.filter("weather_id = 0").count() == star.fact.filter("weather_id is null").count() > 0


def test_regrouped_masks_keep_the_total(star):
    full = star.dim_medications.agg(F.sum("total_packages")).first()[0]
    masked = star.masked.groupBy("package_code_masked").agg(F.sum("total_packages").alias("p"))
    assert masked.agg(F.sum("p")).first()[0] == full
    assert masked.filter(~F.col("package_code_masked").rlike(r"^\d\d\*\*\*\d\d$")).count() == 0


def test_weather_types(spark):
    df = spark.createDataFrame([(-5.01,), (-5.0,), (21.0,), (21.01,)], "t double")
    got = [r[0] for r in df.select(reports.weather_type(F.col("t"))).collect()]
    assert got == ["extreme_cold", "normal", "normal", "extreme_heat"]


def test_roles(star):
    limited = governance.governed(star.dim_medications, "analyst_limited", "dim_medications")
    assert not {"package_code", "package_label", "copay_with_threshold"} & set(limited.columns)
    assert governance.governed(star.dim_date, "analyst_limited", "dim_date").columns == star.dim_date.columns
    with pytest.raises(PermissionError):
        governance.governed(star.dim_date, "nobody", "dim_date")


def test_quality_gate(spark):
    good = meds(spark, (2024, 1, "a", "b", 1, 1.0, 1.0))
    quality.enforce(quality.medication_checks(good))
    with pytest.raises(ValueError, match="invalid_rows=1"):
        quality.enforce(quality.medication_checks(good.withColumn("month", F.lit(13))))
    assert quality.sample(good).count() == 1


def test_wide_sums_keep_their_day(spark):
    hours = spark.range(41_000).select(
        F.lit("a").alias("station"), F.lit(dt.datetime(2021, 1, 1)).cast("timestamp_ntz").alias("ts"),
        *[F.lit(1.0).alias(c) for c in ("t_air_c", "t_min_c", "t_max_c", "wind_ms", "wind_gust_ms")],
        F.lit(2.45).alias("precip_mm"), F.lit(50).alias("humidity"),
    )
    assert float(silver.weather_cleaned(hours).first()["total_precip_mm"]) == 100_450.0
    assert gold.dim_weather(silver.weather_cleaned(hours), 1900).count() == 1


def test_month_keys_do_not_shuffle_the_fact(star):
    missing = joins.missing_parents(star.fact.select("date_id"), "date_id", star.dim_weather, "date_id", months=True)
    assert "BroadcastHashJoin" in executed(missing)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_no_slow_operators(spark, name):
    """No cross products, no Python workers, no driver-side rows in any plan."""
    plan = executed(registry.queries()[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups"):
        assert bad not in plan


def test_month_dimensions_do_not_shuffle_the_fact(star):
    plan = executed(reports.temp_vs_packages(star.fact, star.dim_date, star.dim_weather))
    assert plan.count("BroadcastHashJoin") >= 4 and "SortMergeJoin" not in plan


def test_top_k_and_pushdown(spark, star):
    plan = executed(reports.top_packages(star.dim_medications, 1998, 2))
    assert "TakeOrderedAndProject" in plan
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "l_shipdate" in line)
    assert "IsNotNull(l_shipdate)" in scan and "l_tax" not in scan and "l_discount" not in scan


def test_key_hash_stays_above_the_aggregation(star):
    """The null test of a join key must not drag the hash down to the raw rows."""
    plan = executed(reports.season_by_type(star.fact, star.dim_date, star.dim_medications))
    scan_side = [line for line in plan.splitlines() if "Filter" in line and "l_shipdate" in line]
    assert scan_side and not any("md5" in line for line in scan_side)


def test_amounts_are_exact_at_any_size(spark):
    rows = [(2024, 1, "n", "1 a", 1, 1, 1.0, v) for v in (1e16, 1e16, 3.25, 1.5e20)]
    bronze = spark.createDataFrame([(y, m, dt.date(y, m, 1), i, p, n, q, c, a, a, a, a, a) for y, m, i, p, n, q, c, a in rows], MEDICATIONS)
    (row,) = silver.medications_cleaned(bronze, today=dt.date(2030, 1, 1)).collect()
    assert str(row.total_amount) == "150020000000000000003.25"
    decimals = bronze.withColumn("total_amount", F.expr("cast('99999999999999999999999999999999.995' as decimal(38,6))"))
    totals = silver.medications_cleaned(decimals, today=dt.date(2030, 1, 1))
    assert str(totals.first().total_amount) == "4" + "0" * 32 + ".00"
    many = decimals.withColumn("total_amount", F.expr("cast('99999999999999999999999999999999' as decimal(38,6))")).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(20000))))
    overflown = silver.medications_cleaned(many.drop("n"), today=dt.date(2030, 1, 1))
    assert {r["check"]: r["violations"] for r in quality.total_checks(overflown, ["total_amount", "copay_with_threshold"]).collect()} == {
        "overflow_total_amount": 1, "overflow_copay_with_threshold": 0,
    }


def test_amounts_that_are_no_money_are_counted(spark):
    bronze = meds(spark, (2024, 1, "n", "1 a", 1, 1.0, float("inf")), (2024, 1, "n", "1 a", 1, 1.0, 1e37), (2024, 1, "n", "1 a", 1, 1.0, 5.0))
    found = {r["check"]: r["violations"] for r in quality.amount_checks(bronze).collect()}
    assert set(found.values()) == {2} and len(found) == 5


def test_exact_sheets(spark, tmp_path):
    from skyledger.sources import grids

    head = "Aasta,Kuu,Toimeaine,Pakend,Isikute arv,Retseptide arv,Pakendite arv,Retsepti kogusumma"
    (tmp_path / "m.csv").write_text(f'{head}\n2024,1,a,b,1,1,1,"90 100 000 000 000 000,25"\n')
    row = grids.read_medications(spark, str(tmp_path), exact=True).first()
    assert str(row.total_amount) == "90100000000000000.250000" and row.hk_amount is None
