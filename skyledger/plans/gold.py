"""The monthly star schema: four dimensions and the sales fact."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from skyledger.functions import dates
from skyledger.functions.keys import surrogate_key
from skyledger.functions.numbers import settle
from skyledger.functions.text import word, words_from
from skyledger.operators.joins import fill_unmatched, month_side

# The calendar of the date dimension and the first month year of the others.
CALENDAR_START, CALENDAR_MONTHS = dt.date(2021, 1, 1), 60
FIRST_MONTH_YEAR = 2021

MEDICATION_KEYS = ["year", "month", "ingredient", "atc_code", "package_code", "package_label"]
MEDICATION_SUMS = [
    "total_packages",
    "total_amount",
    "health_insurance_amount",
    "copay_with_threshold",
    "copay_without_threshold",
    "amount_over_reference_price",
    "total_prescriptions",
    "total_persons",
]


def calendar(months: DataFrame) -> DataFrame:
    """Date dimension rows for a frame of month starts."""
    start = F.col("month_start")
    return months.select(
        dates.date_id(start).alias("date_id"),
        F.year(start).alias("year"),
        F.month(start).alias("month"),
        F.quarter(start).alias("quarter"),
        dates.month_name(start).alias("month_name"),
        dates.season(F.month(start)).alias("season"),
    )


def dim_date(
    spark: SparkSession, start: dt.date = CALENDAR_START, months: int = CALENDAR_MONTHS
) -> DataFrame:
    return calendar(dates.month_series(spark, start, months))


def dim_medications(
    silver: DataFrame, sep: str = "|", algo: str = "md5", product: Sequence[str] = ()
) -> DataFrame:
    """Sales per month and product, products split into code, name and label.

    ``product`` names columns of ``silver`` that the package code tells already: rows that lie
    together by them are summed where they are. They are left out of the result.
    """
    parts = silver.filter(F.col("ingredient_name").isNotNull()).select(
        "year",
        "month",
        word("ingredient_name", 2).alias("ingredient"),
        word("ingredient_name", 1).alias("atc_code"),
        word("package_name", 1).alias("package_code"),
        F.coalesce(words_from("package_name", 2), F.lit("")).alias("package_label"),
        *product,
        *MEDICATION_SUMS,
    )
    # A sum that outgrows its type is null and found by a gate, it does not end the build.
    summed = parts.groupBy(*MEDICATION_KEYS, *product).agg(*[F.try_sum(c).alias(c) for c in MEDICATION_SUMS])
    return summed.select(
        surrogate_key(*MEDICATION_KEYS, sep=sep, algo=algo, required=True).alias("medication_id"),
        *MEDICATION_KEYS,
        *MEDICATION_SUMS,
    )


def dim_weather(
    silver: DataFrame, first_year: int = FIRST_MONTH_YEAR, half_even: bool = False, sep: str = "|"
) -> DataFrame:
    """Weather per month. 'Precipitation' is the sum over all stations and days."""

    def mean(column: str) -> Column:
        return settle(F.avg(F.col(column).cast("double")), 2, half_even)

    monthly = (
        silver.filter(F.year("date") >= first_year)
        .na.drop(subset=["avg_temp_c", "total_precip_mm", "avg_wind_ms", "avg_humidity"])
        .groupBy(dates.month_start("date").alias("month_start"))
        .agg(
            mean("avg_temp_c").alias("avg_monthly_temp"),
            F.sum("total_precip_mm").cast("decimal(18,2)").alias("avg_monthly_precipitation"),
            mean("avg_wind_ms").alias("avg_monthly_wind_speed"),
            mean("avg_humidity").alias("avg_monthly_humidity"),
        )
    )
    measures = [
        "avg_monthly_temp",
        "avg_monthly_precipitation",
        "avg_monthly_wind_speed",
        "avg_monthly_humidity",
    ]
    # Measures enter the key as decimals: the text of a double differs between engines.
    spelled = [F.col(m).cast("decimal(18,2)") for m in measures]
    return monthly.select(
        surrogate_key("month_start", *spelled, sep=sep).alias("weather_id"),
        dates.date_id("month_start").alias("date_id"),
        *measures,
    )


def dim_sunshine(
    silver: DataFrame, first_year: int = FIRST_MONTH_YEAR, half_even: bool = False, sep: str = "|"
) -> DataFrame:
    """Mean over stations of their monthly sunshine hours."""
    per_station = (
        silver.filter(F.year("date") >= first_year)
        .groupBy(dates.month_start("date").alias("month_start"), "staid")
        .agg(F.sum("sunshine_hours").alias("hours"))
    )
    monthly = per_station.groupBy("month_start").agg(
        settle(F.avg("hours"), 2, half_even).alias("avg_station_monthly_hours")
    )
    spelled = F.col("avg_station_monthly_hours").cast("decimal(18,2)")
    return monthly.select(
        surrogate_key("month_start", spelled, sep=sep).alias("sunshine_id"),
        dates.date_id("month_start").alias("date_id"),
        "avg_station_monthly_hours",
    )


UNMATCHED = [
    "weather_id", "sunshine_id", "avg_temp", "humidity", "precipitation", "avg_sunshine_hours",
]


def fact_medication_sales(
    medications: DataFrame, weather: DataFrame, sunshine: DataFrame, default_fill: bool = False
) -> DataFrame:
    """One row per medication row, with the weather and sunshine of its month.

    Its own key is of the kind of ``medication_id``: a number, or binary where that is wide.

    Months without weather or sunshine keep their sales; the missing side is null,
    or zero with ``default_fill``. The month dimensions are broadcast, so the sales
    are never shuffled here.
    """
    sales = medications.select(
        dates.date_id_of("year", "month").alias("date_id"),
        "medication_id",
        "total_packages",
        "total_amount",
        "total_prescriptions",
        "total_persons",
    )
    wx = weather.select(
        "date_id",
        "weather_id",
        F.col("avg_monthly_temp").cast("double").alias("avg_temp"),
        F.col("avg_monthly_humidity").cast("double").alias("humidity"),
        F.col("avg_monthly_precipitation").cast("double").alias("precipitation"),
    )
    sun = sunshine.select(
        "date_id",
        "sunshine_id",
        F.col("avg_station_monthly_hours").cast("double").alias("avg_sunshine_hours"),
    )
    wide = isinstance(medications.schema["medication_id"].dataType, BinaryType)
    product = F.hex("medication_id") if wide else F.col("medication_id")
    fact_id = surrogate_key("date_id", product, algo="wide" if wide else "md5", required=True)
    joined = sales.join(month_side(wx), "date_id", "left").join(month_side(sun), "date_id", "left")
    fact = joined.select(
        fact_id.alias("fact_id"),
        "date_id",
        "medication_id",
        *UNMATCHED,
        "total_packages",
        "total_amount",
        "total_prescriptions",
        "total_persons",
    )
    return fill_unmatched(fact, UNMATCHED) if default_fill else fact
