"""Cleaned tables: typed, filtered and brought to their grain."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from skyledger.functions.numbers import LARGE_FROM, MONEY, cents, is_finite, large_amount, money, settle, settled_decimal
from skyledger.operators.tables import latest_per_key

# First year of sales kept, and the codes of usable sunshine.
FIRST_SALES_YEAR = 2000
USABLE_SUNSHINE = (0, 1)

MEDICATION_KEYS = ["year", "month", "ingredient_name", "package_name"]
AMOUNTS = ["total_amount", "hk_amount", "copay_with_trh", "copay_no_trh", "over_ref_price"]
WEATHER_MEASURES = [
    "t_air_c", "t_min_c", "t_max_c", "precip_mm", "wind_ms", "wind_gust_ms", "humidity",
]


def medications_cleaned(
    bronze: DataFrame,
    first_year: int = FIRST_SALES_YEAR,
    today: dt.date | None = None,
    product: Sequence[str] = (),
) -> DataFrame:
    """Sales per year, month, ingredient and package.

    ``product`` names columns of ``bronze`` that the package tells already, say the key by
    which it was joined. They are kept and split no group, but rows that were brought
    together by them are summed where they are, without another shuffle.

    Amounts may be doubles or decimals. Each row's amount is rounded to cents, halves up, and
    sums are exact: decimals as they are, doubles as whole cents while they are small. A total
    that no DECIMAL(38,2) can hold is null, which ``quality.amount_checks`` counts.
    """
    last_year = F.lit(today.year) if today else F.year(F.current_date())
    kept = bronze.filter(F.col("year").between(F.lit(first_year), last_year)).na.drop(
        subset=["total_amount", "prescriptions", "persons", "packages_count"]
    )
    exact = {f.name: isinstance(f.dataType, DecimalType) for f in bronze.schema.fields}

    def spelled(column: str) -> list[Column]:
        if exact[column]:
            return [F.round(column, 2).cast(MONEY).alias(column)]
        return [cents(column, LARGE_FROM).alias(column), large_amount(column).alias(f"{column}_large")]

    def amount(column: str) -> Column:
        nothing = F.count(column) == 0
        if exact[column]:
            return F.when(nothing, F.lit(0).cast(MONEY)).otherwise(F.try_sum(column))
        large = f"{column}_large"
        small = money(F.coalesce(F.sum(column), F.lit(0)))
        return F.when(F.count(large) == 0, small).otherwise(F.try_add(small, F.try_sum(large)).try_cast(MONEY))

    cleaned = kept.select(
        F.col("year").cast("int").alias("year"),
        F.col("month").cast("int").alias("month"),
        F.trim(F.upper("ingredient")).alias("ingredient_name"),
        F.trim("package").alias("package_name"),
        *product,
        F.col("packages_count").cast("double").alias("packages_count"),
        "prescriptions",
        "persons",
        *[c for name in AMOUNTS for c in spelled(name)],
    )
    return cleaned.groupBy(*MEDICATION_KEYS, *product).agg(
        settle(F.sum("packages_count"), 0).try_cast("bigint").alias("total_packages"),
        amount("total_amount").alias("total_amount"),
        amount("hk_amount").alias("health_insurance_amount"),
        amount("copay_with_trh").alias("copay_with_threshold"),
        amount("copay_no_trh").alias("copay_without_threshold"),
        amount("over_ref_price").alias("amount_over_reference_price"),
        F.sum("prescriptions").cast("bigint").alias("total_prescriptions"),
        F.sum("persons").cast("bigint").alias("total_persons"),
    )


def weather_cleaned(bronze: DataFrame, half_even: bool = False) -> DataFrame:
    """Weather per station and day, from hours with every measure present and finite.

    Decimals are wide: a sum that outgrew its type would be null, and its day would be lost.
    """
    complete = bronze
    for measure in WEATHER_MEASURES:
        complete = complete.filter(is_finite(F.col(measure).cast("double")))

    def decimal(value: Column, precision: int = 18) -> Column:
        return settled_decimal(value, precision, 2, half_even)

    return (
        complete.withColumn("date", F.to_date("ts"))
        .groupBy("station", "date")
        .agg(
            decimal(F.avg("t_air_c")).alias("avg_temp_c"),
            decimal(F.min("t_min_c")).alias("min_temp_c"),
            decimal(F.max("t_max_c")).alias("max_temp_c"),
            decimal(F.sum("precip_mm"), 30).alias("total_precip_mm"),
            decimal(F.avg("wind_ms")).alias("avg_wind_ms"),
            decimal(F.avg("wind_gust_ms")).alias("avg_wind_gust_ms"),
            decimal(F.avg(F.col("humidity").cast("double"))).alias("avg_humidity"),
        )
    )


def sunshine_cleaned(daily: DataFrame, sources: DataFrame, dedup: bool = False) -> DataFrame:
    """Usable daily sunshine hours with their station's attributes.

    A day is repeated for every source row of its station, as stations are joined
    on ``staid`` alone; ``dedup`` keeps one source (the lowest ``souid``) per station.
    Spark broadcasts the station list while its files are small, else AQE splits hot stations.
    """
    if dedup:
        sources = latest_per_key(sources, ["staid"], [F.col("souid").asc()])
    stations = sources.select("staid", "station_name", "country")
    usable = daily.filter(F.col("q_ss").isin(*USABLE_SUNSHINE))
    return usable.join(stations, "staid", "left").select(
        "staid",
        "date",
        (F.col("ss_raw") / F.lit(10.0)).alias("sunshine_hours"),
        F.col("q_ss").alias("valid_flag"),
        "station_name",
        "country",
    )
