"""Raw files to published tables and views, layer by layer.

Each layer ends in tables, so later layers and reports read what was written. The two
fact-length tables are bucketed on ``medication_id`` and join without a shuffle.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions import dates
from skyledger.operators import governance, quality, tables
from skyledger.operators.tables import table_name
from skyledger.plans import gold, refresh, silver
from skyledger.session import staged
from skyledger.sources import grids, lines

# Sort keys of the raw tables.
BRONZE_SORT = {
    "medications_monthly": ["ingredient", "package", "month_date"],
    "weather_hourly": ["station", "ts"],
    "sunshine_daily": ["souid", "date"],
    "sunshine_sources": ["staid", "souid"],
}
TOTALS = gold.MEDICATION_SUMS
SUNSHINE_KEYS, STATION_KEYS = ["staid", "souid", "date"], ["staid", "souid"]


@dataclass
class Settings:
    """What differs between installations: calendar, first years, bucket count, rules.

    ``key_algo`` is the kind of the product and fact keys: ``wide`` from some 10^8 rows on.
    """

    first_sales_year: int = silver.FIRST_SALES_YEAR
    today: dt.date | None = None
    calendar_start: dt.date = gold.CALENDAR_START
    calendar_months: int = gold.CALENDAR_MONTHS
    first_month_year: int = gold.FIRST_MONTH_YEAR
    default_fill: bool = False
    buckets: int = 8
    key_algo: str = "md5"


def ingest_sunshine(spark: SparkSession, folder: str, lake: str) -> str:
    """Station list and daily files into the lake; daily rows are merged by key."""
    stations = staged(lines.read_stations(spark, folder, placed=True))
    if not stations.isEmpty():
        # Of the lines with one key the last is the one that holds.
        tables.write_lake(lines.last_line(stations, STATION_KEYS), f"{lake}/sunshine_sources")
    daily = staged(lines.read_daily(spark, folder, placed=True))
    if daily.isEmpty():
        return "nothing"
    daily = lines.last_line(daily, SUNSHINE_KEYS)
    return tables.upsert(
        tables.with_year(daily, "date"), f"{lake}/sunshine_daily", SUNSHINE_KEYS, partition="year"
    )


def publish_sunshine(spark: SparkSession, lake: str) -> None:
    """Lake tables to serving tables; stations keep their last row per key."""
    daily = tables.lake_table(spark, f"{lake}/sunshine_daily")
    if daily is not None:
        load_bronze(daily.drop("year"), "sunshine_daily")
    stations = tables.lake_table(spark, f"{lake}/sunshine_sources")
    if stations is not None:
        load_bronze(serving_stations(stations), "sunshine_sources")


def load(df: DataFrame, name: str, sort_by: Sequence[str]) -> bool:
    """Replace a table, in key order, if there are rows at all. The input is parsed once."""
    rows = staged(df)
    if rows.isEmpty():
        return False
    return tables.replace_if_any(tables.sorted_layout(rows, sort_by), name, known=True)


def load_bronze(df: DataFrame, name: str) -> bool:
    return load(df, table_name("bronze", name), BRONZE_SORT[name])


def serving_stations(stations: DataFrame) -> DataFrame:
    """Stations as they are served: defaults for what is missing, a stamp, one row per key."""
    return tables.stamped(tables.one_per_key(tables.with_defaults(stations), STATION_KEYS))


def ingest(spark: SparkSession, folder: str, lake: str) -> None:
    """All raw folders (``medications``, ``weather``, ``sunshine``) into raw tables."""
    tables.ensure_layers(spark)
    load_bronze(grids.read_medications(spark, f"{folder}/medications", exact=True), "medications_monthly")
    load_bronze(grids.read_weather(spark, f"{folder}/weather"), "weather_hourly")
    ingest_sunshine(spark, f"{folder}/sunshine", lake)
    publish_sunshine(spark, lake)


def check_bronze(spark: SparkSession, now: dt.datetime | None = None) -> None:
    """The gates after loading; raises when one finds bad rows."""
    raw = {n: spark.table(table_name("bronze", n)) for n in BRONZE_SORT}
    quality.enforce(quality.medication_checks(raw["medications_monthly"]))
    quality.enforce(quality.amount_checks(raw["medications_monthly"]))
    quality.enforce(quality.weather_checks(raw["weather_hourly"], now))
    quality.enforce(quality.sunshine_checks(raw["sunshine_daily"], now.date() if now else None))


def build_silver(spark: SparkSession, settings: Settings) -> None:
    raw = {n: spark.table(table_name("bronze", n)) for n in BRONZE_SORT}
    models = {
        "medications_cleaned": silver.medications_cleaned(
            raw["medications_monthly"], settings.first_sales_year, settings.today
        ),
        "weather_cleaned": silver.weather_cleaned(raw["weather_hourly"]),
        "sunshine_cleaned": silver.sunshine_cleaned(raw["sunshine_daily"], raw["sunshine_sources"]),
    }
    for name, model in models.items():
        tables.materialize(model, table_name("silver", name))


def build_gold(spark: SparkSession, settings: Settings) -> None:
    clean = {
        n: spark.table(table_name("silver", n))
        for n in ("medications_cleaned", "weather_cleaned", "sunshine_cleaned")
    }
    calendar = gold.dim_date(spark, settings.calendar_start, settings.calendar_months)
    tables.materialize(calendar, table_name("gold", "dim_date"), sort_by=["date_id"])
    # Month models are computed again only for the months whose input changed.
    first = settings.first_month_year
    models = {
        "dim_weather": (clean["weather_cleaned"], lambda days: gold.dim_weather(days, first)),
        "dim_sunshine": (clean["sunshine_cleaned"], lambda days: gold.dim_sunshine(days, first)),
    }
    months = {}
    for name, (days, model) in models.items():
        refresh.refresh(days, dates.date_id("date"), model, table_name("gold", name), settings=str(first))
        months[name] = spark.table(table_name("gold", name))
    bucketed = {"bucket_by": "medication_id", "buckets": settings.buckets}
    quality.enforce(quality.total_checks(clean["medications_cleaned"], TOTALS))
    medications = tables.materialize(
        gold.dim_medications(clean["medications_cleaned"], algo=settings.key_algo),
        table_name("gold", "dim_medications"),
        sort_by=["year", "month"],
        **bucketed,
    )
    # Two products under one key would be joined to each other's sales. The table is bucketed
    # on the key, so the gate needs no shuffle.
    quality.enforce(quality.unique(medications, "medication_id"))
    fact = gold.fact_medication_sales(
        medications, months["dim_weather"], months["dim_sunshine"], settings.default_fill
    )
    tables.materialize(
        fact, table_name("gold", "fact_medication_sales"), sort_by=["date_id"], **bucketed
    )


def publish_views(spark: SparkSession) -> None:
    for name, query in governance.view_queries(tables.LAYERS["gold"]).items():
        tables.publish_view(spark, name, query)


def build(spark: SparkSession, settings: Settings | None = None) -> None:
    """Silver, gold and views from the raw tables."""
    settings = settings or Settings()
    tables.ensure_layers(spark)
    build_silver(spark, settings)
    build_gold(spark, settings)
    publish_views(spark)
