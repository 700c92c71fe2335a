"""Data-quality checks that return violation counts, and a gate that raises."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from skyledger.functions.numbers import held
from skyledger.operators.aggregates import duplicate_keys
from skyledger.operators.joins import any_of, missing_parents
from skyledger.schemas import MONEY_COLUMNS

# Accepted ranges and codes of the raw tables.
SALES_YEARS = (2000, 2100)
SALES_MONTHS = (1, 12)
SUNSHINE_CODES = (0, 1, 9)
AIR_TEMPERATURES = (-70, 70)


def checks(df: DataFrame, bad_rows: Mapping[str, Column]) -> DataFrame:
    """``(check, violations)`` for any number of row conditions in one pass."""
    counted = df.agg(*[F.count_if(condition).alias(name) for name, condition in bad_rows.items()])
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("check"), F.col(name).alias("violations"))
            for name in bad_rows
        ]
    )
    return counted.select(F.inline(pairs))


def not_null(*columns: str) -> dict[str, Column]:
    return {f"not_null_{c}": F.col(c).isNull() for c in columns}


def unique(df: DataFrame, column: str) -> DataFrame:
    bad = duplicate_keys(df, column).agg(F.count("*").alias("violations"))
    return bad.select(F.lit(f"unique_{column}").alias("check"), "violations")


def relationship(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str, months: bool = False
) -> DataFrame:
    bad = missing_parents(child.select(column), column, parent, parent_column, months)
    return bad.agg(F.count("*").alias("violations")).select(
        F.lit(f"relationship_{column}").alias("check"), "violations"
    )


def medication_checks(
    bronze: DataFrame, years: tuple[int, int] = SALES_YEARS, months: tuple[int, int] = SALES_MONTHS
) -> DataFrame:
    bad = any_of(
        ~F.col("year").between(*years),
        ~F.col("month").between(*months),
        F.col("month_date").isNull(),
    )
    return checks(bronze, {"invalid_rows": bad})


def amount_checks(bronze: DataFrame, amounts: Iterable[str] = MONEY_COLUMNS) -> DataFrame:
    """Per amount column the rows whose amount cannot be money: not finite, or too large."""
    kinds = {f.name: isinstance(f.dataType, DecimalType) for f in bronze.schema.fields}
    return checks(bronze, {f"overflow_{c}": ~held(c, kinds[c]) for c in amounts})


def total_checks(model: DataFrame, totals: Iterable[str]) -> DataFrame:
    """Per column of sums the rows whose sum outgrew its type."""
    return checks(model, {f"overflow_{c}": F.col(c).isNull() for c in totals})


def sunshine_checks(daily: DataFrame, today: dt.date | None = None) -> DataFrame:
    """Bad codes and future dates."""
    now = F.lit(today) if today else F.current_date()
    return checks(
        daily,
        {
            "invalid_q": F.col("q_ss").isNotNull() & ~F.col("q_ss").isin(*SUNSHINE_CODES),
            "future_dates": F.col("date") > now,
        },
    )


def sunshine_summary(daily: DataFrame, today: dt.date | None = None) -> DataFrame:
    """The violations beside the number of rows they were looked for in."""
    rows = daily.agg(F.count("*").alias("violations")).select(F.lit("rows").alias("check"), "violations")
    return sunshine_checks(daily, today).unionByName(rows)


def weather_checks(hourly: DataFrame, now: dt.datetime | None = None) -> DataFrame:
    clock = F.lit(now) if now else F.current_timestamp()
    low, high = AIR_TEMPERATURES
    return checks(
        hourly,
        {
            "future": F.col("ts") > clock,
            "temp_out_of_range": (F.col("t_air_c") < low) | (F.col("t_air_c") > high),
        },
    )


def checks_with_unique(df: DataFrame, bad_rows: Mapping[str, Column], key: str) -> DataFrame:
    """Row conditions and the uniqueness of a key in one pass: counted per key, then added up."""
    per_key = df.groupBy(key).agg(
        F.count("*").alias("_rows"), *[F.count_if(condition).alias(name) for name, condition in bad_rows.items()]
    )
    repeated = F.count_if((F.col("_rows") > 1) & F.col(key).isNotNull())
    names = [*bad_rows, f"unique_{key}"]
    counted = per_key.agg(
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in bad_rows], repeated.alias(f"unique_{key}")
    )
    pairs = F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).alias("violations")) for n in names])
    return counted.select(F.inline(pairs))


def fact_checks(fact: DataFrame, medications: DataFrame) -> DataFrame:
    """The declared tests of the sales fact: one pass over it, and one to find its parents."""
    rows = checks_with_unique(
        fact,
        {
            **not_null(
                "fact_id", "date_id", "medication_id", "weather_id", "sunshine_id", "total_packages"
            ),
            "positive_total_packages": F.col("total_packages") <= 0,
        },
        "fact_id",
    )
    return rows.unionByName(relationship(fact, "medication_id", medications, "medication_id"))


def profile(df: DataFrame, distinct: Iterable[str] = ("year", "month")) -> DataFrame:
    """Row count and distinct counts of a loaded table, one row."""
    return df.agg(
        F.count("*").alias("total_count"),
        *[F.countDistinct(c).alias(f"distinct_{c}s") for c in distinct],
    )


def sample(df: DataFrame, rows: int = 5) -> DataFrame:
    """Any few rows, to look at."""
    return df.limit(rows)


def enforce(results: DataFrame) -> None:
    """Raise when a check found violations. One row per check reaches the driver."""
    failed = {r["check"]: r["violations"] for r in results.filter("violations > 0").collect()}
    if failed:
        found = ", ".join(f"{name}={count}" for name, count in sorted(failed.items()))
        raise ValueError(f"data quality failed: {found}")
