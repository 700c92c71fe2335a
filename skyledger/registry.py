"""Every runnable query by name: ``(spark, folder of given tables) -> DataFrame``."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampNTZType, TimestampType

from skyledger.functions import dates, numbers, text
from skyledger.functions.keys import surrogate_key
from skyledger.functions.masks import mask_code, mask_label, range_label
from skyledger.operators import aggregates, governance, joins, quality, tables, versions
from skyledger.operators.shape import conform, rename_headers
from skyledger.plans import gold, refresh, reports, samples, silver, warehouse
from skyledger.plans.bindings import FIRST_YEAR, MEDICATIONS, TODAY, WEATHER, Warehouse, projection
from skyledger.schemas import SUNSHINE_SOURCES
from skyledger.session import remove, shared_dir, staged, tune
from skyledger.sources import grids, lines

Query = Callable[[Warehouse], DataFrame]
_QUERIES: dict[str, Query] = {}

# Months asked for by the single-month reports, within the span of the given sales.
PACKAGES_MONTH, METRICS_MONTH, INGREDIENTS_MONTH = (1998, 2), (1998, 7), (1997, 10)
NOW = dt.datetime(2001, 6, 1)


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles and dates as text, so results compare across engines."""

    def plain(field):
        column = F.col(field.name)
        if isinstance(field.dataType, DecimalType):
            return column.cast("double").alias(field.name)
        if isinstance(field.dataType, DateType):
            return column.cast("string").alias(field.name)
        if isinstance(field.dataType, (TimestampType, TimestampNTZType)):
            return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(field.name)
        return column

    return df.select(*[plain(f) for f in df.schema.fields])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def runner(function: Query):
        return lambda spark, folder: comparable(function(Warehouse(tune(spark), folder)))

    return {name: runner(function) for name, function in _QUERIES.items()}


# ---- stored tables ----------------------------------------------------------


@contextmanager
def _scratch(w: Warehouse):
    """A database of its own in the shared folder, gone with all tables at the end."""
    folder = shared_dir(w.spark)
    name = f"scratch_{uuid.uuid4().hex[:12]}"
    w.spark.sql(f"CREATE DATABASE {name} LOCATION '{folder}'")
    try:
        yield name
    finally:
        w.spark.sql(f"DROP DATABASE {name} CASCADE")
        remove(w.spark, folder)


def _stored_star(w: Warehouse, database: str) -> dict[str, DataFrame]:
    """The star as a build leaves it: both long tables bucketed on the product key, the fact
    made from the stored products."""
    bucketed = {"bucket_by": "medication_id", "buckets": int(w.spark.conf.get("spark.sql.shuffle.partitions"))}
    star = {
        "weather": tables.materialize(w.dim_weather, f"{database}.dim_weather"),
        "medications": tables.materialize(w.dim_medications, f"{database}.dim_medications", **bucketed),
    }
    fact = gold.fact_medication_sales(star["medications"], star["weather"], w.dim_sunshine)
    return star | {"fact": tables.materialize(fact, f"{database}.fact", **bucketed)}


def _of_stored_star(w: Warehouse, report: Callable[[dict[str, DataFrame]], DataFrame]) -> DataFrame:
    """A report's rows, in its order, read from the stored star."""
    with _scratch(w) as database:
        rows = report(_stored_star(w, database))
        rows = staged(rows.withColumn("_order", F.monotonically_increasing_id()))
    return rows.orderBy("_order").drop("_order")


# ---- silver and gold models -------------------------------------------------


@query
def silver_medications(w):
    return w.medications_cleaned


@query
def silver_weather(w):
    return w.weather_cleaned


@query
def silver_weather_hourly(w):
    return silver.weather_cleaned(w.event_weather)


@query
def silver_sunshine(w):
    return w.sunshine_cleaned


@query
def silver_sunshine_one_source(w):
    return silver.sunshine_cleaned(w.sunshine, w.stations, dedup=True)


@query
def dim_date(w):
    """The calendar of the months that have sales."""
    return gold.calendar(dates.month_span(w.table("lineitem"), "l_shipdate"))


@query
def dim_medications(w):
    return w.dim_medications


@query
def dim_weather(w):
    return w.dim_weather


@query
def dim_sunshine(w):
    return w.dim_sunshine


@query
def fact_sales(w):
    return w.fact


@query
def fact_sales_default_fill(w):
    return gold.fact_medication_sales(w.dim_medications, w.dim_weather, w.dim_sunshine, True)


# ---- reports ----------------------------------------------------------------


@query
def temp_vs_sales(w):
    return reports.temp_vs_sales(w.fact, w.dim_date, w.dim_weather)


@query
def season_by_type(w):
    return _of_stored_star(w, lambda star: reports.season_by_type(star["fact"], w.dim_date, star["medications"]))


@query
def temp_vs_packages(w):
    return reports.temp_vs_packages(w.fact, w.dim_date, w.dim_weather)


@query
def ingredient_month(w):
    return _of_stored_star(
        w, lambda star: reports.ingredient_month(star["fact"], star["medications"], w.dim_date, star["weather"])
    )


@query
def extreme_weather(w):
    return _of_stored_star(
        w, lambda star: reports.extreme_weather(star["fact"], star["medications"], star["weather"])
    )


@query
def month_trend(w):
    return reports.month_trend(w.fact, w.dim_date, w.dim_weather, w.dim_sunshine)


@query
def supply_per_month(w):
    return _of_stored_star(w, lambda star: reports.supply_per_month(star["fact"], star["medications"], w.dim_date))


@query
def top_packages_full(w):
    return reports.top_packages(w.dim_medications, *PACKAGES_MONTH)


@query
def top_packages_masked(w):
    return reports.top_packages_masked(w.masked, *PACKAGES_MONTH)


@query
def sales_metrics_full(w):
    return reports.sales_metrics(w.dim_medications, *METRICS_MONTH)


@query
def sales_metrics_masked(w):
    return reports.sales_metrics_masked(w.masked, *METRICS_MONTH)


@query
def top_ingredients_full(w):
    return reports.top_ingredients(w.dim_medications, *INGREDIENTS_MONTH)


@query
def top_ingredients_masked(w):
    return reports.top_ingredients(w.masked, *INGREDIENTS_MONTH)


# ---- masking and governed views ---------------------------------------------


@query
def masked_view(w):
    return w.masked


@query
def governed_limited(w):
    """A limited role's packages and persons per month and masked code."""
    seen = governance.governed(w.dim_medications, "analyst_limited", "dim_medications")
    return seen.groupBy("year", "month", "package_code_masked").agg(
        F.sum("total_packages").alias("packages"), F.sum("total_persons").alias("persons")
    )


@query
def governed_full(w):
    return governance.governed(w.dim_weather, "analyst_full", "dim_weather")


@query
def code_mask(w):
    codes = w.table("part").selectExpr("p_partkey", "cast(p_partkey * 7 as string) AS code")
    return codes.select("p_partkey", mask_code("code").alias("masked"))


@query
def label_mask(w):
    return w.table("part").select("p_partkey", mask_label("p_name").alias("masked"))


@query
def prescription_ranges(w):
    return w.table("part").select("p_partkey", range_label("p_partkey").alias("label"))


@query
def surrogate_keys(w):
    part = w.table("part")
    return part.select(
        "p_partkey",
        surrogate_key("p_brand", "p_name", "p_size").alias("key"),
        surrogate_key("p_brand", "p_name", "p_size", sep="").alias("key_no_sep"),
    )


# ---- table maintenance ------------------------------------------------------


@query
def upsert_latest(w):
    """Late corrections replace earlier orders, other rows of both sides stay."""
    orders = w.table("orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    old = orders.filter("o_orderdate < timestamp_ntz '1999-01-01'")
    late = orders.filter("o_orderdate >= timestamp_ntz '1998-01-01'")
    source = late.withColumn("version", F.lit(1)).unionByName(
        late.withColumn("o_totalprice", F.col("o_totalprice") + 1).withColumn("version", F.lit(2))
    )
    newest = tables.one_per_key(source, ["o_orderkey"], [F.desc("version")]).drop("version")
    return tables.merge_rows(old, newest, ["o_orderkey"])


@query
def upsert_table(w):
    """Two overlapping loads of daily sunshine into a lake table partitioned by year."""
    path = f"{shared_dir(w.spark)}/sunshine_daily"
    keys = ["staid", "souid", "date"]
    for load in (
        w.sunshine.filter("date < date '1999-01-01'"),
        w.sunshine.filter("date >= date '1998-01-01'").withColumn("ss_raw", F.col("ss_raw") + 1),
    ):
        tables.upsert(tables.with_year(load, "date"), path, keys, partition="year")
    return tables.lake_table(w.spark, path).select(*keys, "ss_raw", "q_ss", "year")


@query
def incremental_replace(w):
    """Recomputed months replace the months of the same key, the others stay."""
    recent = w.dim_weather.filter(F.col("date_id") >= "200001").withColumn(
        "avg_monthly_temp", F.col("avg_monthly_temp") + 100
    )
    return tables.merge_rows(w.dim_weather, recent, ["date_id"])


@query
def dedup_latest(w):
    """The newest order of each customer."""
    orders = w.table("orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    newest = [F.desc("o_orderdate"), F.desc("o_orderkey")]
    return tables.latest_per_key(orders, ["o_custkey"], newest)


@query
def store_defaults(w):
    """Station attributes with missing text as '' and missing ids as 0."""
    sparse = w.stations.withColumn("country", F.when(F.col("staid") % 3 != 0, F.col("country")))
    return tables.with_defaults(conform(sparse, SUNSHINE_SOURCES)).select(
        "staid", "souid", "station_name", "country", "parname", "lat"
    )


@query
def year_partitions(w):
    """Rows per year folder of a lake table written by year and read back."""
    path = f"{shared_dir(w.spark)}/by_year"
    tables.write_lake(tables.with_year(w.sunshine, "date"), path, "year")
    folder = F.regexp_extract(F.input_file_name(), "/year=([0-9]+)/", 1).cast("int")
    stored = tables.lake_table(w.spark, path).select(folder.alias("year"))
    return stored.groupBy("year").agg(F.count("*").alias("rows"))


# ---- aggregates -------------------------------------------------------------


@query
def conditional_aggs(w):
    big = F.col("l_quantity") > 25
    cents = F.floor(F.col("l_extendedprice") * 100 + 0.5)
    return w.table("lineitem").groupBy("l_returnflag").agg(
        aggregates.sum_if(cents, big).alias("sum_if"),
        numbers.settle(aggregates.avg_if(F.col("l_quantity"), big), 4).alias("avg_if"),
        aggregates.min_if(F.col("l_extendedprice"), big).alias("min_if"),
        aggregates.max_if(F.col("l_extendedprice"), big).alias("max_if"),
    )


@query
def two_level_avg(w):
    """Mean over users of their monthly totals, per event type."""
    value = F.floor(F.col("value") * 100 + 0.5)
    sums = aggregates.mean_of_sums(w.table("events"), ["event_type"], ["user_id"], value)
    return sums.select("event_type", numbers.settle("mean_of_sums", 4).alias("mean_of_sums"))


@query
def ratio_of_aggs(w):
    total, buyers = F.sum("l_linenumber"), F.countDistinct("l_suppkey")
    return w.table("lineitem").groupBy("l_linestatus", "l_returnflag").agg(
        total.alias("total"), buyers.alias("stations"), numbers.settle(total / buyers, 2).alias("ratio")
    )


@query
def distinct_months(w):
    return w.table("lineitem").select(dates.month_start("l_shipdate").alias("month_start")).distinct()


@query
def group_by_measure(w):
    """Grouping on a floating-point measure."""
    return w.dim_weather.groupBy(F.round("avg_monthly_temp", 0).alias("temp")).agg(
        F.count("*").alias("months")
    )


@query
def duplicate_keys(w):
    return aggregates.duplicate_keys(w.sunshine, "staid", "souid", "date")


@query
def unmatched_months(w):
    """Sales months that have no weather."""
    sales = w.fact.select("date_id", "medication_id")
    missing = joins.missing_parents(sales, "date_id", w.dim_weather, "date_id", months=True)
    return missing.groupBy("date_id").agg(F.count("*").alias("rows"))


# ---- scalar functions -------------------------------------------------------


@query
def split_tokens(w):
    silver_rows = w.medications_cleaned
    return silver_rows.select(
        "year",
        "month",
        text.word("ingredient_name", 1).alias("atc_code"),
        text.word("ingredient_name", 2).alias("ingredient"),
        text.word("ingredient_name", 9).alias("none"),
        text.word("package_name", 1).alias("package_code"),
        text.words_from("package_name", 2).alias("package_label"),
    ).distinct()


@query
def calendar_parts(w):
    ordered = w.table("orders").select("o_orderdate", "o_orderkey")
    day = F.to_date("o_orderdate")
    return ordered.select(
        "o_orderkey",
        day.alias("day"),
        dates.month_start(day).alias("month_start"),
        F.add_months(dates.month_start(day), 1).alias("next_month"),
        dates.date_id(day).alias("date_id"),
        dates.date_id_of(F.year(day), F.month(day)).alias("date_id_of_parts"),
        dates.month_name(day).alias("month_name"),
        F.quarter(day).alias("quarter"),
        dates.season(F.month(day)).alias("season"),
    )


@query
def rounding_modes(w):
    half = (F.col("l_linenumber") + 0.5).cast("double")
    return w.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        numbers.settle(half, 0).alias("half_up"),
        numbers.settle(half, 0, half_even=True).alias("half_even"),
        numbers.settled_decimal(F.col("l_extendedprice") / 3, 18, 2).alias("third"),
    )


@query
def parse_month(w):
    spelled = w.table("lineitem").selectExpr("l_orderkey", "l_linenumber", f"{samples.MONTH_TEXT} AS raw")
    return spelled.select("l_orderkey", "l_linenumber", dates.month_number("raw").alias("month"))


@query
def month_dates(w):
    spelled = w.table("lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "year(l_shipdate) || '.0' AS y", f"{samples.MONTH_TEXT} AS raw"
    )
    return spelled.select("l_orderkey", "l_linenumber", dates.month_date("y", "raw").alias("month_date"))


@query
def parse_number(w):
    spelled = w.table("lineitem").selectExpr("l_orderkey", "l_linenumber", f"{samples.NUMBER_TEXT} AS raw")
    parsed = spelled.withColumn("amount", numbers.decimal_comma_number("raw"))
    return parsed.select("l_orderkey", "l_linenumber", numbers.cents("amount").alias("cents"))


def _large_sales(w: Warehouse) -> DataFrame:
    """Sales whose amounts are read from text of up to 26 digits."""
    part, items = w.table("part"), w.table("lineitem")
    joined = items.join(part, items["l_partkey"] == part["p_partkey"])
    sales = joined.selectExpr(*projection(MEDICATIONS), f"{samples.LARGE_TEXT} AS raw")
    return sales.withColumn("total_amount", numbers.exact_amount("raw"))


@query
def large_amounts(w):
    """Exact sums of amounts of 1e16, 1e20 and more, with their cents."""
    cleaned = silver.medications_cleaned(_large_sales(w), FIRST_YEAR, TODAY)
    keys = ["year", "month", "ingredient_name", "package_name"]
    return cleaned.select(*keys, F.col("total_amount").cast("string").alias("total_amount"))


@query
def dq_amounts(w):
    """Amounts that cannot be money, per column."""
    huge = w.medications.withColumn("hk_amount", F.when(F.col("persons") == 7, F.lit(1e40)).otherwise(F.col("hk_amount")))
    return quality.amount_checks(huge)


@query
def parse_count(w):
    spelled = w.table("lineitem").selectExpr("l_orderkey", "l_linenumber", f"{samples.COUNT_TEXT} AS raw")
    return spelled.select("l_orderkey", "l_linenumber", numbers.count_number("raw").alias("number"))


@query
def parse_whole(w):
    spelled = w.table("lineitem").selectExpr("l_orderkey", "l_linenumber", f"{samples.WHOLE_TEXT} AS raw")
    return spelled.select("l_orderkey", "l_linenumber", numbers.whole_or("raw", -1).alias("number"))


@query
def parse_hour(w):
    spelled = w.table("events").selectExpr("event_id", f"{samples.HOUR_TEXT} AS raw")
    return spelled.select("event_id", dates.hour_of_day("raw").alias("hour"))


@query
def build_timestamp(w):
    parts = w.table("events").selectExpr("event_id", *projection(samples.STAMP_PARTS))
    return parts.select("event_id", dates.hour_timestamp("y", "m", "d", "t").alias("ts"))


@query
def compact_dates(w):
    spelled = w.table("orders").selectExpr("o_orderkey", f"{samples.DATE_TEXT} AS raw")
    return spelled.select("o_orderkey", dates.compact_date("raw").alias("day"))


@query
def clamp_null(w):
    return w.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        numbers.whole_within((F.col("l_partkey") % 500) + 0.5, 0, 360).alias("wind_dir"),
        numbers.whole_within(F.col("l_quantity") * 3, 0, 100).alias("humidity"),
    )


@query
def sentinel_null(w):
    raw = F.when(F.col("l_tax") == 0, -9999).otherwise(F.col("l_linenumber"))
    code = F.when(F.col("l_returnflag") == "A", -9).otherwise(1)
    return w.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        numbers.null_if(raw, -9999).alias("ss_raw"),
        numbers.null_if(code, -9).alias("q_ss"),
    )


@query
def tidy_text(w):
    """Whole documents with white space collapsed, as length and digest."""
    tidy = text.normalized("text")
    return w.table("documents").select(
        "doc_id", F.length(tidy).alias("chars"), F.md5(tidy).alias("digest")
    )


@query
def accent_free_text(w):
    return w.table("documents").select("doc_id", F.md5(text.accent_free("text")).alias("digest"))


@query
def accent_free_all(w):
    """Every character that decomposes, ten at a time, in the midst of other text."""
    known = F.split(F.lit(samples.ALL_DECOMPOSED), "\x1f", -1)
    some = F.array_join(F.slice(known, F.expr(samples.DECOMPOSED_AT).cast("int") + 1, F.lit(10)), "")
    raw = F.concat(F.col("l_returnflag"), some, F.lit("é"))
    return w.table("lineitem").select("l_orderkey", "l_linenumber", F.md5(text.accent_free(raw)).alias("digest"))


@query
def blank_to_null(w):
    cell = F.when(F.col("turn") % 2 == 0, F.lit(samples.NBSP)).otherwise(F.col("text"))
    return w.table("conversations").select(
        "conv_id", "turn", F.length(text.text_or_null(cell)).alias("chars")
    )


@query
def country_default(w):
    raw = F.when(F.col("n_nationkey") % 2 == 0, "").otherwise(F.col("n_name"))
    country = text.country_code(raw).alias("country")
    joined = w.table("supplier").join(w.table("nation"), F.expr("s_nationkey = n_nationkey"))
    return joined.select("s_suppkey", country)


# ---- data quality -----------------------------------------------------------


@query
def dq_medications(w):
    return quality.medication_checks(w.medications, years=(1996, 2100), months=(2, 12))


@query
def dq_sunshine(w):
    return quality.sunshine_summary(w.sunshine.replace(9, 8, subset=["q_ss"]), NOW.date())


@query
def dq_weather(w):
    hotter = w.weather.withColumn("t_air_c", F.col("t_air_c") * 3)
    return quality.weather_checks(hotter, NOW)


@query
def dq_fact(w):
    """The declared tests of the sales fact, on the star as it is stored."""
    medications = staged(w.dim_medications)
    fact = staged(gold.fact_medication_sales(medications, w.dim_weather, w.dim_sunshine))
    return quality.fact_checks(fact, medications)


@query
def dq_not_null(w):
    return quality.checks(w.fact, quality.not_null("weather_id", "sunshine_id", "medication_id"))


@query
def dq_unique(w):
    return quality.unique(w.sunshine, "staid")


@query
def dq_relationship(w):
    """Sales whose month has no weather, as a foreign-key violation count."""
    return quality.relationship(w.fact, "date_id", w.dim_weather, "date_id", months=True)


@query
def dq_assert(w):
    return quality.checks(w.fact, {"positive_total_packages": F.col("total_packages") <= 0})


@query
def load_profile(w):
    return quality.profile(w.medications)


# ---- file-shaped input ------------------------------------------------------


@query
def preamble_daily(w):
    order = F.expr("staid * 0")
    return lines.daily_rows(samples.daily_lines(w.sunshine, order))


@query
def preamble_stations(w):
    return lines.station_rows(samples.station_lines(w.stations))


@query
def header_discovery(w):
    found = grids.find_headers(_weather_grid(w))
    return found.select(
        "file", "sheet", "header", *[F.col(f"columns.{c}").alias(c) for c in ("year", "day", "humidity")]
    )


@query
def role_inference(w):
    return grids.infer_roles(samples.unlabelled_grid(w.table("orders")))


@query
def weather_sheets(w):
    return grids.weather_rows(_weather_grid(w))


@query
def medication_sheets(w):
    return grids.medication_rows(samples.medication_grid(w.medications))


@query
def header_rename(w):
    """Given columns under raw headers, renamed and brought to the raw schema."""
    raw = {"staid": " STA  ID", "souid": "SOUID", "country": "CN"}
    sheet = w.stations.withColumnsRenamed(raw)
    named = rename_headers(sheet, {"STA ID": "staid", "SOUID": "souid", "CN": "country"})
    return conform(named, SUNSHINE_SOURCES).select("staid", "souid", "country", "lat")


@query
def roles_late_rows(w):
    """Roles told by all rows: in a file's first rows another column looks like the month."""
    orders = w.table("orders")
    early = F.col("o_orderkey") <= 100
    cells = F.array(
        F.when(early, "7").otherwise(F.col("o_totalprice").cast("string")),
        F.year("o_orderdate").cast("string"),
        F.month("o_orderdate").cast("string"),
        F.dayofmonth("o_orderdate").cast("string"),
        F.concat((F.col("o_orderkey") % 24).cast("string"), F.lit(":00")),
    )
    grid = orders.select(
        F.col("o_orderpriority").alias("file"), F.lit(0).alias("sheet"), F.col("o_orderkey").alias("place"), cells.alias("cells")
    )
    return grids.infer_roles(grid)


@query
def deep_header(w):
    """Headers found however far down: below a thousand rows of each file."""
    grid = _weather_grid(w)
    notes = w.table("orders").filter("o_orderkey <= 1000").select(
        F.concat("o_orderpriority", F.lit("-hourly.csv")).alias("file"),
        F.lit(0).alias("sheet"),
        (F.col("o_orderkey") - 5000).alias("place"),
        F.array(F.lit("note"), F.col("o_totalprice").cast("string")).alias("cells"),
    )
    return grids.weather_rows(grid.unionByName(notes))


@query
def skipped_files(w):
    """Files that give no rows, and rows with an open quote, with the reason."""
    orders = w.table("orders")
    file = F.concat("o_orderpriority", F.lit("-notes.csv"))
    notes = orders.select(file.alias("file"), F.lit(0).alias("sheet"), F.col("o_orderkey").alias("place"), F.array(F.lit("note")).alias("cells"))
    torn = orders.filter("o_orderkey % 7 = 0").select(
        F.concat("o_orderpriority", F.lit("-hourly.csv")).alias("file"), F.lit(0).alias("sheet"), F.col("o_orderkey").alias("place"), F.array(F.lit('"open')).alias("cells")
    )
    grid = _weather_grid(w).unionByName(notes).unionByName(torn)
    return grids.skipped(grid, grids.find_headers(grid))


@query
def last_line_wins(w):
    """Of several lines with one key the last of the file holds."""
    orders = w.table("orders").filter("o_orderkey <= 20000")
    text = F.concat_ws(",", F.lit("1"), F.col("o_custkey").cast("string"), F.lit("20200101"), (F.col("o_orderkey") % 1000).cast("string"), F.lit("0"))
    place = F.struct(F.lit(0).cast("bigint").alias("split"), F.col("o_orderkey").alias("line"))
    body = orders.select(F.lit("a.txt").alias("file"), place.alias("place"), text.alias("value"))
    top = orders.limit(1).select(
        F.lit("a.txt").alias("file"),
        F.struct(F.lit(0).cast("bigint").alias("split"), F.lit(-1).cast("bigint").alias("line")).alias("place"),
        F.lit("STAID,SOUID,DATE,SS,Q_SS").alias("value"),
    )
    rows = lines.daily_rows(top.unionByName(body), placed=True)
    return lines.last_line(rows, ["staid", "souid", "date"]).select("staid", "souid", "ss_raw")


@query
def weather_day_large_sums(w):
    """A station-day with very many hours keeps its sum."""
    items = w.table("lineitem")
    hours = items.select(
        F.lit("all").alias("station"),
        F.lit(dt.datetime(2000, 1, 1)).cast("timestamp_ntz").alias("ts"),
        *[F.lit(1.0).alias(c) for c in ("t_air_c", "t_min_c", "t_max_c", "wind_ms", "wind_gust_ms")],
        (F.col("l_quantity") * 10).alias("precip_mm"),
        F.lit(50).alias("humidity"),
    )
    return gold.dim_weather(silver.weather_cleaned(hours), 1900).select("date_id", "avg_monthly_precipitation")


def _stored(w: Warehouse, name: str) -> str:
    """A fresh table name in the session's catalog."""
    tables.ensure_layers(w.spark)
    full = tables.table_name("bronze", f"{name}_{uuid.uuid4().hex[:8]}")
    w.spark.sql(f"DROP TABLE IF EXISTS {full}")
    return full


def _read_back(w: Warehouse, name: str) -> DataFrame:
    """The table's rows, staged, so that the table itself can go."""
    rows = staged(w.spark.table(name))
    w.spark.sql(f"DROP TABLE {name}")
    return rows


@query
def table_reload(w):
    """Create, truncate and load, keep the old rows on empty input, append with a count."""
    name = _stored(w, "reload")
    rows = w.table("nation").select("n_nationkey", "n_name")
    tables.create_as(rows, name)
    kept = tables.replace_if_any(rows.filter("false"), name)
    tables.replace_if_any(rows.filter("n_nationkey < 20"), name)
    added = tables.append_counted(rows.filter("n_nationkey >= 23"), name)
    return _read_back(w, name).select("*", F.lit(kept).alias("replaced_by_nothing"), F.lit(added).cast("int").alias("added"))


@query
def table_overwrite(w):
    """Rows overwritten in place; the table was dropped and made anew before."""
    name = _stored(w, "overwrite")
    rows = w.table("region")
    tables.create_as(rows, name)
    tables.drop_and_create(rows.limit(0), name)
    tables.overwrite_rows(rows, name)
    return _read_back(w, name)


@query
def table_by_year(w):
    """A table made from a query, partitioned by the year of a date."""
    name = _stored(w, "by_year")
    tables.create_as(w.sunshine.select("staid", "date"), name, year_of="date")
    return _read_back(w, name).groupBy("year").agg(F.count("*").alias("rows"), F.count_distinct("date").alias("days"))


@query
def sorted_table(w):
    """A model stored in key order: rows, and key runs per file."""
    name = _stored(w, "sorted")
    tables.materialize(w.table("part").select("p_brand", "p_partkey"), name, sort_by=["p_brand"])
    return _read_back(w, name).groupBy("p_brand").agg(F.count("*").alias("rows"))


@query
def bucketed_join(w):
    """The stored fact joined to its stored dimension, both bucketed on the key."""
    fact, dim = _stored(w, "fact"), _stored(w, "dim")
    bucketed = {"bucket_by": "medication_id", "buckets": 8}
    medications = tables.materialize(w.dim_medications, dim, **bucketed)
    whole = gold.fact_medication_sales(medications, w.dim_weather, w.dim_sunshine)
    sales = tables.materialize(whole.select("medication_id", "total_persons"), fact, **bucketed)
    joined = sales.join(medications.select("medication_id", "ingredient"), "medication_id")
    result = staged(joined.groupBy("ingredient").agg(F.sum("total_persons").alias("persons")))
    for name in (fact, dim):
        w.spark.sql(f"DROP TABLE {name}")
    return result


@query
def incremental_table(w):
    """Months recomputed into a stored dimension by its key."""
    path = f"{shared_dir(w.spark)}/months"
    months = w.dim_weather.select("date_id", "avg_monthly_humidity")
    tables.incremental(months, path, "date_id")
    tables.incremental(months.filter("date_id >= '200001'").withColumn("avg_monthly_humidity", F.col("avg_monthly_humidity") + 100), path, "date_id")
    return tables.lake_table(w.spark, path)


@query
def upsert_published(w):
    """Overlapping loads of daily sunshine into a table that shows each load all at once."""
    keys = ["staid", "souid", "date"]
    with _scratch(w) as database:
        name = f"{database}.sunshine_daily"
        for load in (
            w.sunshine.filter("date < date '1999-01-01'"),
            w.sunshine.filter("date >= date '1998-01-01'").withColumn("ss_raw", F.col("ss_raw") + 1),
        ):
            versions.upsert(tables.with_year(load, "date"), name, keys, partition="year")
        return staged(w.spark.table(name).select(*keys, "ss_raw", "q_ss", "year"))


@query
def incremental_months(w):
    """A model brought up to date: only months whose input changed are computed again, and
    months without input leave it."""
    days, month = w.weather_cleaned, dates.date_id("date")
    raised = (F.col("avg_temp_c") + 1).cast("decimal(18,2)")
    warmer = F.when(F.col("date") >= "2000-01-01", raised).otherwise(F.col("avg_temp_c"))
    later = days.withColumn("avg_temp_c", warmer).filter(F.year("date") != 1997)
    with _scratch(w) as database:
        name = f"{database}.dim_weather"
        stored = []
        for input_ in (staged(days), later):
            refresh.refresh(input_, month, lambda rows: gold.dim_weather(rows, FIRST_YEAR), name)
            file = F.col("_metadata.file_path").alias("file")
            stored.append(staged(w.spark.table(name).select("date_id", "avg_monthly_temp", file)))
    before = stored[0].select("date_id", F.col("file").alias("old"))
    joined = stored[1].join(before, "date_id", "left")
    return joined.select("date_id", "avg_monthly_temp", (~F.col("file").eqNullSafe(F.col("old"))).alias("rebuilt"))


@query
def dim_date_model(w):
    """The calendar model as the build makes it."""
    return gold.dim_date(w.spark, dt.date(1995, 1, 1), 84).join(
        w.table("orders").select(F.date_format("o_orderdate", "yyyyMM").alias("date_id")).distinct(), "date_id"
    )


@query
def stored_order(w):
    """How a table stored in key order lies on disk: several files, each in order, none
    reaching into the next."""
    keys = ["o_custkey", "o_orderdate"]
    with _scratch(w) as database:
        orders = w.table("orders").select(*keys, "o_orderkey")
        stored = tables.materialize(orders, f"{database}.orders", sort_by=keys, files=6)
        found = staged(tables.key_order(stored, keys))
    return found.select((F.col("files") > 1).alias("several_files"), "rows", "inversions", "overlaps")


@query
def masked_view_sql(w):
    """The published view of the masked products, made and read by its name."""
    dims = {"medications": w.dim_medications, "weather": w.dim_weather, "sunshine": w.dim_sunshine, "date": w.dim_date}
    with _scratch(w) as database:
        for subject, dim in dims.items():
            tables.materialize(dim, f"{database}.dim_{subject}")
        for name, sql in governance.view_queries(database).items():
            tables.publish_view(w.spark, name, sql)
        return staged(w.spark.table(f"{database}.v_medications_masked"))


@query
def role_views_sql(w):
    """A role's temporary views, asked in SQL: packages per masked code and month's warmth."""
    names = governance.role_views("analyst_limited", {"dim_medications": w.dim_medications, "dim_weather": w.dim_weather})
    found = w.spark.sql(
        f"""SELECT m.package_code_masked, t.avg_monthly_temp > 10 AS warm, sum(m.total_packages) AS packages
        FROM {names["dim_medications"]} m JOIN {names["dim_weather"]} t
        ON t.date_id = cast(m.year * 100 + m.month AS string) GROUP BY ALL"""
    )
    return staged(found)


@query
def surrogate_keys_wide(w):
    """Keys that hold the whole digest."""
    part = w.table("part")
    return part.select("p_partkey", F.lower(F.hex(surrogate_key("p_brand", "p_name", "p_size", algo="wide"))).alias("key"))


@query
def fact_wide_keys(w):
    """The fact and its products under wide keys, joined by them."""
    medications = staged(w.products("wide"))
    fact = gold.fact_medication_sales(medications, w.dim_weather, w.dim_sunshine)
    names = medications.select("medication_id", "ingredient", "package_code")
    return fact.join(names, "medication_id").select(
        F.lower(F.hex("fact_id")).alias("fact_id"),
        F.lower(F.hex("medication_id")).alias("medication_id"),
        "date_id",
        "ingredient",
        "package_code",
        "total_packages",
    )


@query
def lake_reload(w):
    """Lake tables loaded into serving tables: daily rows in key order, stations with defaults,
    a stamp, and one row per key."""
    lake = shared_dir(w.spark)
    tables.write_lake(tables.with_year(w.sunshine, "date"), f"{lake}/daily", "year")
    sparse = w.stations.withColumn("country", F.when(F.col("staid") % 3 != 0, F.col("country")))
    tables.write_lake(sparse.unionByName(sparse.filter("staid % 2 = 0")), f"{lake}/stations")
    with _scratch(w) as database:
        daily, stations = f"{database}.sunshine_daily", f"{database}.sunshine_sources"
        warehouse.load(tables.lake_table(w.spark, f"{lake}/daily").drop("year"), daily, ["souid", "date"])
        warehouse.load(warehouse.serving_stations(tables.lake_table(w.spark, f"{lake}/stations")), stations, ["staid", "souid"])
        # A reload without rows leaves the old ones.
        warehouse.load(w.sunshine.filter("false"), daily, ["souid", "date"])
        days = w.spark.table(daily).groupBy("staid").agg(F.count("*").alias("days"), F.sum("ss_raw").alias("ss_raw"))
        joined = w.spark.table(stations).join(days, "staid", "left")
        return staged(joined.select("staid", "souid", "country", "days", "ss_raw", F.col("_ingested_at").isNotNull().alias("stamped")))


@query
def ensured_table(w):
    """A table made from a schema when it is missing, and left alone when it is there."""
    orders = w.table("orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"))
    with _scratch(w) as database:
        name = f"{database}.orders"
        tables.ensure_table(w.spark, name, orders.schema, ["year"])
        tables.overwrite_rows(orders, name)
        tables.ensure_table(w.spark, name, orders.schema, ["year"])
        return staged(w.spark.table(name).groupBy("year").agg(F.count("*").alias("rows"), F.max("o_orderkey").alias("last")))


@query
def table_reload_orders(w):
    """Create, truncate and load, keep the old rows on empty input, append with a count."""
    rows = w.table("orders").select("o_orderkey", "o_custkey")
    with _scratch(w) as database:
        name = f"{database}.orders"
        tables.create_as(rows, name)
        kept = tables.replace_if_any(rows.filter("false"), name)
        tables.replace_if_any(rows.filter("o_orderkey % 3 = 0"), name)
        added = tables.append_counted(rows.filter("o_orderkey % 3 = 1"), name)
        stored = staged(w.spark.table(name))
    return stored.select("*", F.lit(kept).alias("replaced_by_nothing"), F.lit(added).cast("bigint").alias("added"))


@query
def table_overwrite_part(w):
    """Rows overwritten in place; the table was dropped and made anew before."""
    rows = w.table("part").select("p_partkey", "p_brand", "p_size")
    with _scratch(w) as database:
        name = f"{database}.part"
        tables.create_as(rows.filter("p_size > 25"), name)
        tables.drop_and_create(rows.limit(0), name)
        tables.overwrite_rows(rows, name)
        return staged(w.spark.table(name))


@query
def sample_rows(w):
    """A few rows to look at: how many, and how many of them the table does not have."""
    orders = w.table("orders")
    few = staged(quality.sample(orders.select("o_orderkey", "o_custkey"), 5))
    strangers = few.join(orders, ["o_orderkey", "o_custkey"], "left_anti")
    counts = few.agg(F.count("*").alias("rows"))
    return counts.select("rows", F.lit(strangers.count()).cast("bigint").alias("strangers"))


@query
def season_names(w):
    """Orders per season, seasons named by literal rows with a schema."""
    rows = [(month, season) for season, months in dates.SEASONS.items() for month in months]
    names = F.broadcast(w.spark.createDataFrame(rows, "month int, season string"))  # twelve rows
    months = w.table("orders").select(F.month("o_orderdate").alias("month"))
    return months.join(names, "month").groupBy("season").agg(F.count("*").alias("orders"))


@query
def last_line_of_all(w):
    """Of all lines with one key the last of the file holds."""
    orders = w.table("orders")
    fields = ("1", F.col("o_custkey").cast("string"), "20200101", (F.col("o_orderkey") % 1000).cast("string"), "0")
    text_ = F.concat_ws(",", *[F.lit(f) if isinstance(f, str) else f for f in fields])
    return _last_lines(orders, text_)


def _last_lines(orders: DataFrame, text_) -> DataFrame:
    def line(number):
        return F.struct(F.lit(0).cast("bigint").alias("split"), number.cast("bigint").alias("line")).alias("place")

    body = orders.select(F.lit("a.txt").alias("file"), line(F.col("o_orderkey")), text_.alias("value"))
    top = orders.limit(1).select(F.lit("a.txt").alias("file"), line(F.lit(-1)), F.lit("STAID,SOUID,DATE,SS,Q_SS").alias("value"))
    rows = lines.daily_rows(top.unionByName(body), placed=True)
    return lines.last_line(rows, ["staid", "souid", "date"]).select("staid", "souid", "ss_raw")


@query
def header_below_all(w):
    """Headers below as many rows of notes as the sheet has rows of data."""
    notes = w.table("orders").select(
        F.concat("o_orderpriority", F.lit("-hourly.csv")).alias("file"),
        F.lit(0).alias("sheet"),
        (F.col("o_orderkey") - F.lit(1 << 40)).alias("place"),
        F.array(F.lit("note"), F.col("o_totalprice").cast("string")).alias("cells"),
    )
    return grids.weather_rows(_weather_grid(w).unionByName(notes))


@query
def blank_cells(w):
    """Texts of all turns beside a blank copy of each."""
    turns = w.table("conversations")
    both = turns.select("conv_id", "turn", F.explode(F.array(F.lit(False), F.lit(True))).alias("blank"), "text")
    cell = F.when(F.col("blank"), F.lit(f" {samples.NBSP}{samples.THIN}")).otherwise(F.col("text"))
    return both.select("conv_id", "turn", "blank", F.length(text.text_or_null(cell)).alias("chars"))


@query
def dq_fact_sparse(w):
    """The declared tests of the sales fact on rows that lack keys, sums and parents."""
    medications = staged(w.dim_medications)
    fact = gold.fact_medication_sales(medications, w.dim_weather, w.dim_sunshine)
    key = F.col("medication_id")
    lacking = {"fact_id": 7, "date_id": 11, "total_packages": 13}
    sparse = fact.select(
        *[F.when(key % lacking[c] != 0, F.col(c)).alias(c) if c in lacking else F.col(c) for c in fact.columns if c != "medication_id"],
        F.when(key % 17 == 0, key + 1).when(key % 19 != 0, key).alias("medication_id"),
    )
    return quality.fact_checks(staged(sparse), medications)


def _shifted(orders: DataFrame, cells: list, place) -> DataFrame:
    """Rows of sheets in which every file has another number of columns before the known ones."""
    ahead = F.array_repeat(F.col("o_totalprice").cast("string"), F.substring("o_orderpriority", 1, 1).cast("int"))
    row = F.concat(ahead, F.array(*[c if not isinstance(c, str) else F.lit(c) for c in cells]))
    return orders.select(F.concat("o_orderpriority", F.lit("-hourly.csv")).alias("file"), F.lit(0).alias("sheet"), place.alias("place"), row.alias("cells"))


@query
def headers_by_file(w):
    """Headers at another depth and another column in every file."""
    orders = w.table("orders")
    tops = orders.groupBy("o_orderpriority").agg((F.max("o_orderkey") + 5).alias("place"), F.min("o_totalprice").alias("o_totalprice"))
    names = samples.spelled_weather(1)
    notes = _shifted(orders, ["note"], F.col("o_orderkey"))
    found = grids.find_headers(notes.unionByName(_shifted(tops, names, F.col("place"))))
    return found.select("file", "header", *[F.col(f"columns.{c}").alias(c) for c in ("year", "day", "humidity")])


@query
def roles_by_file(w):
    """Columns told by their values, in another place in every file."""
    day, hour = F.col("o_orderdate"), F.concat((F.col("o_orderkey") % 24).cast("string"), F.lit(":00"))
    parts = [F.year(day), F.month(day), F.dayofmonth(day)]
    cells = [*[p.cast("string") for p in parts], hour]
    return grids.infer_roles(_shifted(w.table("orders"), cells, F.col("o_orderkey")))


# ---- files ------------------------------------------------------------------


@contextmanager
def _small_splits(w: Warehouse):
    """Files are read in splits of a megabyte, so that records are cut."""
    name = "spark.sql.files.maxPartitionBytes"
    before = w.spark.conf.get(name)
    w.spark.conf.set(name, "1m")
    try:
        yield
    finally:
        w.spark.conf.set(name, before)


@query
def quoted_breaks(w):
    """Sales sheets whose cells hold line breaks, some of them cut by the end of a split."""
    folder = shared_dir(w.spark)
    samples.write_medications(w.medications, folder)
    with _small_splits(w):
        return staged(grids.read_medications(w.spark, folder, spent=True))


@query
def files_daily(w):
    """Daily text files from disk: preambles, undecodable bytes, a lock file to be passed over."""
    folder = shared_dir(w.spark)
    samples.write_daily(w.sunshine, folder)
    with _small_splits(w):
        return staged(lines.read_daily(w.spark, folder))


@query
def files_weather(w):
    """Hourly workbooks from disk, stations told by the file names."""
    folder = shared_dir(w.spark)
    samples.write_weather(w.weather, folder)
    return grids.read_weather(w.spark, folder)


@query
def files_none(w):
    """Daily rows per station of a folder, an empty folder and one that is not there."""
    folder = shared_dir(w.spark)
    samples.write_daily(w.sunshine, f"{folder}/full")
    w.sunshine.filter("false").select(F.lit("").alias("value")).write.text(f"{folder}/empty")
    rows = [lines.read_daily(w.spark, f"{folder}/{name}") for name in ("full", "empty", "missing")]
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).groupBy("staid").agg(F.count("*").alias("rows"))


@query
def second_sheet(w):
    """Workbooks whose header stands on their second sheet: the first fitting sheet counts."""
    folder = shared_dir(w.spark)
    samples.write_workbooks(w.weather, folder)
    return grids.read_weather(w.spark, folder)


def _weather_grid(w: Warehouse) -> DataFrame:
    orders = w.table("orders")
    rows = orders.selectExpr(*projection(WEATHER), "o_orderkey AS row")
    return samples.weather_grid(orders, rows)
