"""The analytic questions asked of the star schema.

Month dimensions join by broadcast; the medication dimension is as long as the fact
and joins on its unique key, without a shuffle when both tables are bucketed on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions.numbers import settle
from skyledger.operators.joins import month_side, star_join

# Monthly mean temperatures called extreme.
COLD_BELOW, HEAT_ABOVE = -5, 21
TOP = 10


def weather_type(temperature: Column) -> Column:
    return (
        F.when(temperature < COLD_BELOW, "extreme_cold")
        .when(temperature > HEAT_ABOVE, "extreme_heat")
        .otherwise("normal")
    )


def _months(dim_date: DataFrame, *columns: str) -> tuple[DataFrame, str]:
    return month_side(dim_date).select("date_id", *columns), "date_id"


def _weather(dim_weather: DataFrame, *columns: Column | str) -> tuple[DataFrame, str]:
    return month_side(dim_weather).select("weather_id", *columns), "weather_id"


def _products(dim_medications: DataFrame, *columns: Column | str) -> tuple[DataFrame, str]:
    return dim_medications.select("medication_id", *columns), "medication_id"


def temp_vs_sales(fact: DataFrame, dim_date: DataFrame, dim_weather: DataFrame) -> DataFrame:
    """Units sold per month beside the month's temperature, read from the weather dimension."""
    temperature = F.col("avg_monthly_temp").alias("dim_temp")
    joined = star_join(
        fact, _months(dim_date, "year", "month"), _weather(dim_weather, temperature)
    )
    return (
        joined.groupBy("year", "month", F.col("dim_temp").alias("avg_temp"))
        .agg(F.sum("total_packages").alias("total_sold"))
        .orderBy("year", "month")
    )


def season_by_type(fact: DataFrame, dim_date: DataFrame, dim_medications: DataFrame) -> DataFrame:
    """Units sold per season and medication type, largest first."""
    joined = star_join(
        fact,
        _months(dim_date, "season"),
        _products(dim_medications, F.col("ingredient").alias("medication_type")),
    )
    return (
        joined.groupBy("season", "medication_type")
        .agg(F.sum("total_packages").alias("total_sold"))
        .orderBy(F.desc("total_sold"), "season", "medication_type")
    )


def temp_vs_packages(fact: DataFrame, dim_date: DataFrame, dim_weather: DataFrame) -> DataFrame:
    """Packages per month and temperature; months without weather drop out."""
    joined = star_join(fact, _months(dim_date, "year", "month"), _weather(dim_weather))
    return (
        joined.groupBy("year", "month", "avg_temp")
        .agg(F.sum("total_packages").alias("total_quantity"))
        .orderBy("year", "month")
    )


def ingredient_month(
    fact: DataFrame, dim_medications: DataFrame, dim_date: DataFrame, dim_weather: DataFrame
) -> DataFrame:
    """Packages and temperature per ingredient and month, largest first."""
    joined = star_join(
        fact,
        _months(dim_date, "year", "month"),
        _weather(dim_weather),
        _products(dim_medications, F.col("ingredient").alias("medication_type")),
    )
    return (
        joined.groupBy("medication_type", "year", "month")
        .agg(
            settle(F.avg("avg_temp"), 6).alias("avg_temp"),
            F.sum("total_packages").alias("total_quantity"),
        )
        .orderBy(F.desc("total_quantity"), "medication_type", "year", "month")
    )


def extreme_weather(fact: DataFrame, dim_medications: DataFrame, dim_weather: DataFrame) -> DataFrame:
    """Prescriptions per ingredient in cold, hot and normal months."""
    kind = weather_type(F.col("avg_monthly_temp")).alias("weather_type")
    joined = star_join(
        fact,
        _weather(dim_weather, F.col("date_id").alias("weather_month"), kind),
        _products(dim_medications, F.col("ingredient").alias("medication_name")),
    )
    prescriptions, months = F.sum("total_prescriptions"), F.countDistinct("weather_month")
    return (
        joined.groupBy("medication_name", "weather_type")
        .agg(
            months.alias("month_count"),
            prescriptions.alias("total_prescriptions"),
            settle(prescriptions / months, 2).alias("avg_prescriptions_per_month"),
        )
        .orderBy("medication_name", "weather_type")
    )


def month_trend(
    fact: DataFrame, dim_date: DataFrame, dim_weather: DataFrame, dim_sunshine: DataFrame
) -> DataFrame:
    """Temperature, sunshine, packages and prescriptions month by month."""
    joined = star_join(
        fact,
        _months(dim_date, "year", "month"),
        _weather(dim_weather, "avg_monthly_temp"),
        (month_side(dim_sunshine).select("sunshine_id", "avg_station_monthly_hours"), "sunshine_id"),
    )
    return (
        joined.groupBy("year", "month")
        .agg(
            settle(F.avg("avg_monthly_temp"), 2).alias("avg_temp_c"),
            settle(F.avg("avg_station_monthly_hours"), 2).alias("avg_sunshine_hours"),
            F.sum("total_packages").alias("total_packages_sold"),
            F.sum("total_prescriptions").alias("total_prescriptions"),
        )
        .orderBy("year", "month")
    )


def supply_per_month(fact: DataFrame, dim_medications: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Mean packages per calendar month and package label."""
    joined = star_join(
        fact, _months(dim_date, "month"), _products(dim_medications, "package_label")
    )
    return (
        joined.groupBy("month", "package_label")
        .agg(settle(F.avg("total_packages"), 6).alias("avg_packages_per_month"))
        .orderBy("month", "package_label")
    )


def _of_month(view: DataFrame, year: int, month: int) -> DataFrame:
    return view.filter((F.col("year") == year) & (F.col("month") == month))


def _top_packages(view: DataFrame, code: str, prescriptions: Column, name: str, k: int) -> DataFrame:
    return (
        view.groupBy("year", "month", F.col(code).alias("package_code"), "ingredient", prescriptions)
        .agg(F.sum("total_persons").alias("persons"))
        .orderBy("year", F.desc("persons"), "package_code", "ingredient", name)
        .limit(k)
    )


def top_packages(view: DataFrame, year: int, month: int, k: int = TOP) -> DataFrame:
    """Packages of a month with the most persons; remaining columns break ties."""
    name = "total_prescriptions"
    return _top_packages(_of_month(view, year, month), "package_code", F.col(name), name, k)


def top_packages_masked(view: DataFrame, year: int, month: int, k: int = TOP) -> DataFrame:
    """The same over masked codes: packages that share a masked code add up."""
    name = "total_prescription"
    ranges = F.col("total_prescriptions_range").alias(name)
    return _top_packages(_of_month(view, year, month), "package_code_masked", ranges, name, k)


def _sales_metrics(view: DataFrame, label: str) -> DataFrame:
    return view.groupBy("year", "month", F.col(label).alias("package_label")).agg(
        F.sum("total_packages").alias("packages"),
        F.sum("total_amount").alias("sales_amount"),
        F.sum("health_insurance_amount").alias("reimbursed_amount"),
        F.sum("amount_over_reference_price").alias("over_ref_amount"),
    )


def sales_metrics(view: DataFrame, year: int, month: int) -> DataFrame:
    """Sales metrics per package label of a month, most packages first."""
    metrics = _sales_metrics(_of_month(view, year, month), "package_label")
    return metrics.orderBy("year", "month", F.desc("packages"), "package_label")


def sales_metrics_masked(view: DataFrame, year: int, month: int) -> DataFrame:
    return _sales_metrics(_of_month(view, year, month), "package_label_masked")


def top_ingredients(view: DataFrame, year: int, month: int, k: int = TOP) -> DataFrame:
    """Ingredients of a month with the most packages; works on both views."""
    return (
        _of_month(view, year, month)
        .groupBy("year", "month", "ingredient")
        .agg(F.sum("total_packages").alias("packages"))
        .orderBy("year", F.desc("packages"), "ingredient")
        .limit(k)
    )
