"""Files in, tables and views out, questions asked in SQL."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from skyledger.operators import governance, quality, tables
from skyledger.plans import gold, reports, warehouse
from skyledger.session import shared_dir

SALES = "Aasta,Kuu,Toimeaine,Pakend,Isikute arv,Retseptide arv,Pakendite arv,Retsepti kogusumma,Üle piirhinna"
WEATHER = (
    "Aasta,Kuu,Päev,Kell (UTC),Õhutemperatuur °C,Tunni miinimum õhutemperatuur °C,Tunni maksimum õhutemperatuur °C,"
    "10 minuti keskmine tuule suund °,10 minuti keskmine tuule kiirus m/s,Tunni maksimum tuule kiirus m/s,"
    "Tunni sademete summa mm,Suhteline õhuniiskus %"
)


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    for name in ("medications", "weather", "sunshine"):
        (root / name).mkdir()
    sales = "".join(
        f"2024,{m},N0{i} DRUG{i} X,{10000 + i}{m} TAB {i}MG,{i},{i * 900},{i + m},\"{i},50\",1\n"
        for m in (1, 2, 3) for i in (1, 2, 3)
    )
    (root / "medications" / "a.csv").write_text(f"{SALES}\n{sales}")
    hours = "".join(f"2024,{m},{d},{h}:00,{t},{t - 1},{t + 1},90,2,3,0.1,80\n"
                    for m, t in ((1, -9), (2, 25)) for d in (1, 2) for h in (0, 12))
    (root / "weather" / "Tallinn-2024.csv").write_text(f"{WEATHER}\n{hours}")
    (root / "sunshine" / "sources.txt").write_text("STAID,SOUID,N,C,A,O,H,E,B,S,P,PARNAME\n1,10,Tallinn,EE,59,24,1,0,1,2,0,SS\n")
    (root / "sunshine" / "SS_SOUID10.txt").write_text(
        "STAID,SOUID,DATE,SS,Q_SS\n" + "".join(f"1,10,2024{m:02d}{d:02d},{m * 10},0\n" for m in (1, 2) for d in range(1, 11))
    )
    lake = shared_dir(spark)
    warehouse.ingest(spark, str(root), lake)
    warehouse.check_bronze(spark, dt.datetime(2024, 12, 31))
    warehouse.build(spark, warehouse.Settings(today=dt.date(2024, 12, 31), buckets=4))
    return root, lake


def table(spark, name):
    return spark.table(f"model_gold.{name}")


def test_tables(spark, built):
    assert table(spark, "dim_date").count() == 60
    assert table(spark, "dim_medications").count() == table(spark, "fact_medication_sales").count() == 9
    weather = {r.date_id: r.avg_monthly_temp for r in table(spark, "dim_weather").collect()}
    sunshine = {r.date_id: r.avg_station_monthly_hours for r in table(spark, "dim_sunshine").collect()}
    assert weather == {"202401": -9.0, "202402": 25.0} and sunshine == {"202401": 10.0, "202402": 20.0}


def test_extreme_months_of_the_stored_star(spark, built):
    report = reports.extreme_weather(
        table(spark, "fact_medication_sales"), table(spark, "dim_medications"), table(spark, "dim_weather")
    )
    # January is at -9 and February at 25 degrees; drug i has i * 900 prescriptions in each.
    expected = {(f"DRUG{i}", kind, 1, i * 900) for i in (1, 2, 3) for kind in ("extreme_cold", "extreme_heat")}
    assert {tuple(r)[:4] for r in report.collect()} == expected


def test_masked_view(spark, built):
    seen = spark.table("model_gold.v_medications_masked").filter("month = 2")
    got = {r.package_code_masked: (r.total_prescriptions_range, r.total_persons) for r in seen.collect()}
    assert got == {"10***12": ("0–999", 1), "10***22": ("1000–1999", 2), "10***32": ("2000–2999", 3)}
    assert spark.table("model_gold.v_weather_masked").count() == 2
    assert spark.table("model_gold.v_medications_full").count() == 9


def test_bucketed_fact_and_dimension_join_in_place(spark, built):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact, dim = table(spark, "fact_medication_sales"), table(spark, "dim_medications")
        plan = fact.join(dim, "medication_id")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_reload_merges_and_empty_input_changes_nothing(spark, built, tmp_path):
    root, lake = built
    (root / "sunshine" / "SS_SOUID10.txt").write_text("STAID,SOUID,DATE,SS,Q_SS\n1,10,20240101,99,0\n")
    assert warehouse.ingest_sunshine(spark, str(root / "sunshine"), lake) == "merged"
    rows = tables.lake_table(spark, f"{lake}/sunshine_daily")
    assert rows.count() == 20 and rows.filter("ss_raw = 99").count() == 1
    assert warehouse.ingest_sunshine(spark, str(tmp_path), lake) == "nothing"
    before = spark.table("bronze.weather_hourly").count()
    warehouse.ingest(spark, str(tmp_path), lake)
    assert spark.table("bronze.weather_hourly").count() == before == 8


REPORTS = {
    "season_by_type": lambda s: reports.season_by_type(s["fact_medication_sales"], s["dim_date"], s["dim_medications"]),
    "ingredient_month": lambda s: reports.ingredient_month(
        s["fact_medication_sales"], s["dim_medications"], s["dim_date"], s["dim_weather"]
    ),
    "extreme_weather": lambda s: reports.extreme_weather(s["fact_medication_sales"], s["dim_medications"], s["dim_weather"]),
    "supply_per_month": lambda s: reports.supply_per_month(s["fact_medication_sales"], s["dim_medications"], s["dim_date"]),
}


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_reports_join_the_stored_star_without_a_shuffle(spark, built, name):
    """However large both tables are: below the partial sums there is no exchange of the fact."""
    star = {n: table(spark, n) for n in ("fact_medication_sales", "dim_medications", "dim_weather", "dim_date")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        report = REPORTS[name](star)
        plan = report._jdf.queryExecution().executedPlan().toString()
        assert report.count() > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    below = plan[plan.rindex("partial_"):]  # what feeds the first partial aggregate
    assert "SortMergeJoin" in below or "ShuffledHashJoin" in below
    assert "Exchange hashpartitioning" not in below.replace("BroadcastExchange", "")


def test_stored_months_are_not_built_again(spark, built):
    _, lake = built
    files = lambda: set(table(spark, "dim_weather").inputFiles())
    before = files()
    warehouse.build_gold(spark, warehouse.Settings(today=dt.date(2024, 12, 31), buckets=4))
    assert files() == before != set()


def test_wide_keys_and_their_gate(spark, built):
    clean = spark.table("model_silver.medications_cleaned")
    wide = gold.dim_medications(clean, algo="wide")
    fact = gold.fact_medication_sales(wide, table(spark, "dim_weather"), table(spark, "dim_sunshine"))
    assert fact.schema["fact_id"].dataType.simpleString() == "binary" and fact.join(wide, "medication_id").count() == 9
    collided = wide.withColumn("medication_id", F.lit(b"same"))
    with pytest.raises(ValueError, match="unique_medication_id"):
        quality.enforce(quality.unique(collided, "medication_id"))


def test_the_key_gate_reads_buckets_without_a_shuffle(spark, built):
    plan = quality.unique(table(spark, "dim_medications"), "medication_id")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan


def test_role_views(spark, built):
    frames = {"dim_medications": table(spark, "dim_medications"), "dim_weather": table(spark, "dim_weather")}
    names = governance.role_views("analyst_limited", frames)
    seen = spark.table(names["dim_medications"])
    assert "package_code_masked" in seen.columns and "package_code" not in seen.columns
    assert spark.sql(f"SELECT * FROM {names['dim_weather']}").count() == 2
    with pytest.raises(PermissionError):
        governance.role_views("visitor", frames)
