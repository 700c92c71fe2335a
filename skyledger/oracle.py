"""The same queries as plain SQL over the given tables, for an independent engine.

Written for DuckDB. The star schema is one chain of common table expressions; text
samples and raw projections are shared with the Spark side, answers are not.
"""

from __future__ import annotations

import unicodedata

from skyledger.functions.text import DECOMPOSED
from skyledger.plans import samples
from skyledger.plans.bindings import (
    EVENT_WEATHER,
    MEDICATIONS,
    STATIONS,
    SUNSHINE,
    WEATHER,
    projection,
)


def _fields(fields: dict[str, str]) -> str:
    return ", ".join(projection(fields))


def _settle(expression: str, digits: int) -> str:
    return f"cast(round(cast({expression} as decimal(38,8)), {digits}) as double)"


def _decimal(expression: str, precision: int, scale: int) -> str:
    return f"cast(round(cast({expression} as decimal(38,8)), {scale}) as decimal({precision},{scale}))"


def _spelled(*parts: str, sep: str = "|") -> str:
    glue = f" || '{sep}' || " if sep else " || "
    return glue.join(f"cast({p} as varchar)" for p in parts)


def _key(*parts: str, sep: str = "|") -> str:
    return f"cast('0x' || substr(md5({_spelled(*parts, sep=sep)}), 1, 15) as bigint)"


def _cents(column: str) -> str:
    amount = f"sum(cast(floor({column} * 100 + 0.5) as bigint))"
    return f"cast(coalesce({amount}, 0) as decimal(18,0)) * 0.01"


def _silver_weather(source: str) -> str:
    measures = ["t_air_c", "t_min_c", "t_max_c", "precip_mm", "wind_ms", "wind_gust_ms", "humidity"]
    finite = " AND ".join(f"{m} IS NOT NULL AND isfinite(cast({m} as double))" for m in measures)
    return f"""SELECT station, cast(ts as date) AS date,
        {_decimal('avg(t_air_c)', 18, 2)} AS avg_temp_c, {_decimal('min(t_min_c)', 18, 2)} AS min_temp_c,
        {_decimal('max(t_max_c)', 18, 2)} AS max_temp_c, {_decimal('sum(precip_mm)', 30, 2)} AS total_precip_mm,
        {_decimal('avg(wind_ms)', 18, 2)} AS avg_wind_ms, {_decimal('avg(wind_gust_ms)', 18, 2)} AS avg_wind_gust_ms,
        {_decimal('avg(humidity)', 18, 2)} AS avg_humidity
        FROM {source} WHERE {finite} GROUP BY 1, 2"""


_MEDICATION_SUMS = (
    "total_packages total_amount health_insurance_amount copay_with_threshold "
    "copay_without_threshold amount_over_reference_price total_prescriptions total_persons"
).split()
_MEDICATION_KEYS = "year month ingredient atc_code package_code package_label".split()
_AMOUNTS = [name for name in _MEDICATION_SUMS if "amount" in name or "copay" in name]

_SEASON = """CASE WHEN month IN (12, 1, 2) THEN 'Winter' WHEN month IN (3, 4, 5) THEN 'Spring'
    WHEN month IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END"""

_CALENDAR = f"""SELECT strftime(d, '%Y%m') AS date_id, year, month, quarter, month_name, {_SEASON} AS season
    FROM (SELECT d, cast(year(d) as int) AS year, cast(month(d) as int) AS month,
        cast(quarter(d) as int) AS quarter, strftime(d, '%B') AS month_name FROM {{months}})"""


def _dim_weather(days: str) -> str:
    return f"""SELECT {_key(
            "m", "avg_monthly_temp", "avg_monthly_precipitation", "avg_monthly_wind_speed",
            "avg_monthly_humidity",
        )} AS weather_id, strftime(m, '%Y%m') AS date_id,
        avg_monthly_temp, avg_monthly_precipitation, avg_monthly_wind_speed, avg_monthly_humidity
        FROM (SELECT cast(date_trunc('month', date) as date) AS m,
        {_decimal('avg(cast(avg_temp_c as double))', 18, 2)} AS avg_monthly_temp,
        cast(sum(total_precip_mm) as decimal(18,2)) AS avg_monthly_precipitation,
        {_decimal('avg(cast(avg_wind_ms as double))', 18, 2)} AS avg_monthly_wind_speed,
        {_decimal('avg(cast(avg_humidity as double))', 18, 2)} AS avg_monthly_humidity
        FROM {days} GROUP BY 1)"""


_CTES = {
    "meds": f"SELECT {_fields(MEDICATIONS)} FROM lineitem JOIN part ON l_partkey = p_partkey",
    "weather": f"SELECT {_fields(WEATHER)} FROM orders",
    "event_weather": f"SELECT {_fields(EVENT_WEATHER)} FROM events",
    "stations": f"""SELECT {_fields(STATIONS)} FROM supplier JOIN nation ON s_nationkey = n_nationkey
        JOIN (VALUES (0), (100)) AS e(extra) ON extra = 0 OR s_suppkey % 10 = 0""",
    "sunshine": f"SELECT {_fields(SUNSHINE)} FROM lineitem",
    "silver_meds": f"""SELECT year, month, trim(upper(ingredient), ' ') AS ingredient_name,
        trim(package, ' ') AS package_name,
        cast({_settle('sum(packages_count)', 0)} as bigint) AS total_packages,
        {_cents('total_amount')} AS total_amount, {_cents('hk_amount')} AS health_insurance_amount,
        {_cents('copay_with_trh')} AS copay_with_threshold,
        {_cents('copay_no_trh')} AS copay_without_threshold,
        {_cents('over_ref_price')} AS amount_over_reference_price,
        cast(sum(prescriptions) as bigint) AS total_prescriptions, cast(sum(persons) as bigint) AS total_persons
        FROM meds WHERE year BETWEEN 1995 AND 2001 AND total_amount IS NOT NULL AND prescriptions IS NOT NULL
        AND persons IS NOT NULL AND packages_count IS NOT NULL GROUP BY 1, 2, 3, 4""",
    "silver_wx": _silver_weather("weather"),
    "silver_sun": """SELECT d.staid, d.date, d.ss_raw / 10.0::double AS sunshine_hours, d.q_ss AS valid_flag,
        s.station_name, s.country FROM sunshine d LEFT JOIN stations s ON d.staid = s.staid
        WHERE d.q_ss IN (0, 1)""",
    "dim_date": _CALENDAR.format(
        months="(SELECT date '1995-01-01' + to_months(cast(n as int)) AS d FROM range(84) AS r(n))"
    ),
    "dim_med": f"""SELECT {_key(*_MEDICATION_KEYS)} AS medication_id, * FROM (
        SELECT year, month, string_split(ingredient_name, ' ')[2] AS ingredient,
        string_split(ingredient_name, ' ')[1] AS atc_code, string_split(package_name, ' ')[1] AS package_code,
        array_to_string(string_split(package_name, ' ')[2:], ' ') AS package_label,
        {", ".join(
            f"sum({c}) AS {c}" if c in _AMOUNTS else f"cast(sum({c}) as bigint) AS {c}"
            for c in _MEDICATION_SUMS
        )} FROM silver_meds GROUP BY 1, 2, 3, 4, 5, 6)""",
    "silver_wx_late": """SELECT * REPLACE (avg_temp_c + CASE WHEN date >= date '2000-01-01' THEN 1 ELSE 0 END
        AS avg_temp_c) FROM silver_wx WHERE year(date) != 1997""",
    "dim_wx": _dim_weather("silver_wx"),
    "dim_wx_late": _dim_weather("silver_wx_late"),
    "dim_sun": f"""SELECT {_key('m', 'hours')} AS sunshine_id, strftime(m, '%Y%m') AS date_id,
        hours AS avg_station_monthly_hours FROM (
        SELECT m, {_decimal('avg(total)', 18, 2)} AS hours FROM (
        SELECT cast(date_trunc('month', date) as date) AS m, staid, sum(sunshine_hours) AS total
        FROM silver_sun GROUP BY 1, 2) GROUP BY 1)""",
    "fact": f"""SELECT {_key('date_id', 'medication_id')} AS fact_id, f.date_id, medication_id,
        weather_id, sunshine_id, cast(avg_monthly_temp as double) AS avg_temp,
        cast(avg_monthly_humidity as double) AS humidity,
        cast(avg_monthly_precipitation as double) AS precipitation,
        cast(avg_station_monthly_hours as double) AS avg_sunshine_hours,
        total_packages, total_amount, total_prescriptions, total_persons
        FROM (SELECT cast(year * 100 + month as varchar) AS date_id, * FROM dim_med) f
        LEFT JOIN dim_wx USING (date_id) LEFT JOIN dim_sun USING (date_id)""",
    "fact_sparse": """SELECT * REPLACE (CASE WHEN medication_id % 7 != 0 THEN fact_id END AS fact_id,
        CASE WHEN medication_id % 11 != 0 THEN date_id END AS date_id,
        CASE WHEN medication_id % 13 != 0 THEN total_packages END AS total_packages,
        CASE WHEN medication_id % 17 = 0 THEN medication_id + 1 WHEN medication_id % 19 != 0 THEN medication_id END
        AS medication_id) FROM fact""",
    "masked": f"""SELECT medication_id, year, month, ingredient, atc_code,
        regexp_replace(package_code, '^([0-9]{{2}})[0-9]+([0-9]{{2}})$', '\\1***\\2') AS package_code_masked,
        {_key('package_label')} AS package_label_masked, total_packages, total_amount,
        health_insurance_amount, amount_over_reference_price,
        (total_prescriptions // 1000 * 1000) || '–' || (total_prescriptions // 1000 * 1000 + 999)
        AS total_prescriptions_range, total_persons FROM dim_med""",
    "orders_merged": """SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders
        WHERE o_orderdate < timestamp '1998-01-01'
        UNION ALL SELECT o_orderkey, o_custkey, o_totalprice + 1, o_orderdate FROM orders
        WHERE o_orderdate >= timestamp '1998-01-01'""",
    "sun_loads": """SELECT *, row_number() OVER (PARTITION BY staid, souid, date, load
            ORDER BY ss_raw DESC NULLS LAST, q_ss DESC) AS copy
        FROM (SELECT 1 AS load, * FROM sunshine WHERE date < date '1999-01-01'
        UNION ALL SELECT 2, * REPLACE (ss_raw + 1 AS ss_raw) FROM sunshine WHERE date >= date '1998-01-01')""",
}


def _with(final: str) -> str:
    """The final SELECT with the common table expressions it needs."""
    names = list(_CTES)
    needed: set[str] = set()
    pending = final
    while True:
        found = {n for n in names if n not in needed and _mentions(pending, n)}
        if not found:
            break
        needed |= found
        pending = " ".join(_CTES[n] for n in found)
    chain = ", ".join(f"{n} AS ({_CTES[n]})" for n in names if n in needed)
    return f"WITH {chain} {final}" if chain else final


def _mentions(sql: str, name: str) -> bool:
    padded = sql.replace("(", " ").replace(")", " ").replace(",", " ").split()
    return name in padded


def _doubles(columns: list[str]) -> str:
    return ", ".join(f"cast({c} as double) AS {c}" for c in columns)


_WEATHER_DAY = (
    "station, cast(date as varchar) AS date, "
    + _doubles(
        ["avg_temp_c", "min_temp_c", "max_temp_c", "total_precip_mm", "avg_wind_ms", "avg_wind_gust_ms",
         "avg_humidity"]
    )
)
_SUNSHINE_DAY = "staid, cast(date as varchar) AS date, sunshine_hours, valid_flag, station_name, country"
_DIM_WEATHER = "weather_id, date_id, " + _doubles(
    ["avg_monthly_temp", "avg_monthly_precipitation", "avg_monthly_wind_speed", "avg_monthly_humidity"]
)
_FACT = (
    "fact_id, date_id, medication_id, weather_id, sunshine_id, avg_temp, humidity, precipitation, "
    "avg_sunshine_hours, total_packages, cast(total_amount as double) AS total_amount, "
    "total_prescriptions, total_persons"
)
_STAR = """FROM fact f JOIN dim_date d ON f.date_id = d.date_id
    JOIN dim_wx w ON f.weather_id = w.weather_id"""
_METRICS = """cast(sum(total_packages) as bigint) AS packages,
    cast(sum(total_amount) as double) AS sales_amount,
    cast(sum(health_insurance_amount) as double) AS reimbursed_amount,
    cast(sum(amount_over_reference_price) as double) AS over_ref_amount"""
_TYPE = """CASE WHEN avg_monthly_temp < -5 THEN 'extreme_cold'
    WHEN avg_monthly_temp > 21 THEN 'extreme_heat' ELSE 'normal' END"""
_LINE = "l_orderkey, l_linenumber"
_SPACES = (
    r"[\t\n\x{0b}\f\r\x{1c}-\x{1f} \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)
_TIDY = f"trim(regexp_replace(text, '{_SPACES}', ' ', 'g'), ' ')"
_FINITE = "CASE WHEN isfinite({c}) THEN {c} END AS {c}"
# What each decomposing character becomes, worked out one by one.
_SPLIT = "\x1f"
_UNMARKED = _SPLIT.join(
    "".join(p for p in unicodedata.normalize("NFKD", c) if not unicodedata.combining(p)).replace("'", "''")
    for c in DECOMPOSED
)
_MASKED = f"""SELECT medication_id, year, month, ingredient, atc_code, package_code_masked,
            package_label_masked, total_packages,
            {_doubles(['total_amount', 'health_insurance_amount', 'amount_over_reference_price'])},
            total_prescriptions_range, total_persons FROM masked"""
_UPSERTED = """SELECT staid, souid, cast(date as varchar) AS date, ss_raw, q_ss,
            cast(year(date) as int) AS year FROM sun_loads s WHERE copy = 1 AND NOT (load = 1 AND EXISTS (
            SELECT 1 FROM sun_loads t WHERE t.load = 2 AND t.staid = s.staid AND t.souid = s.souid
            AND t.date = s.date))"""
_WEATHER_FILES = f"""SELECT left(station, strpos(station, '-') - 1) AS station,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, t_air_c, {_FINITE.format(c='t_min_c')}, t_max_c,
    wind_dir_deg, wind_ms, wind_gust_ms, precip_mm, humidity FROM weather"""


def statements() -> dict[str, str]:
    sql = {
        # silver and gold models
        "silver_medications": f"""SELECT year, month, ingredient_name, package_name, total_packages,
            {_doubles(_AMOUNTS)}, total_prescriptions, total_persons FROM silver_meds""",
        "silver_weather": f"SELECT {_WEATHER_DAY} FROM silver_wx",
        "silver_weather_hourly": f"SELECT {_WEATHER_DAY} FROM ({_silver_weather('event_weather')})",
        "silver_sunshine": f"SELECT {_SUNSHINE_DAY} FROM silver_sun",
        "silver_sunshine_one_source": """SELECT d.staid, cast(d.date as varchar) AS date,
            d.ss_raw / 10.0::double AS sunshine_hours, d.q_ss AS valid_flag, s.station_name, s.country
            FROM sunshine d LEFT JOIN (SELECT staid, min(station_name) AS station_name,
            min(country) AS country FROM stations GROUP BY staid) s ON d.staid = s.staid
            WHERE d.q_ss IN (0, 1)""",
        "dim_date": _CALENDAR.format(
            months="""(SELECT unnest(generate_series(date_trunc('month', min(l_shipdate)),
                date_trunc('month', max(l_shipdate)), interval 1 month)) AS d FROM lineitem)"""
        ),
        "dim_date_model": "SELECT * FROM dim_date WHERE date_id IN (SELECT strftime(o_orderdate, '%Y%m') FROM orders)",
        "dim_medications": f"""SELECT medication_id, {", ".join(_MEDICATION_KEYS)}, total_packages,
            {_doubles(_AMOUNTS)}, total_prescriptions, total_persons FROM dim_med""",
        "dim_weather": f"SELECT {_DIM_WEATHER} FROM dim_wx",
        "dim_sunshine": f"""SELECT sunshine_id, date_id, {_doubles(['avg_station_monthly_hours'])}
            FROM dim_sun""",
        "fact_sales": f"SELECT {_FACT} FROM fact",
        "fact_sales_default_fill": f"""SELECT {_FACT} FROM (SELECT * REPLACE (
            coalesce(weather_id, 0) AS weather_id, coalesce(sunshine_id, 0) AS sunshine_id,
            coalesce(avg_temp, 0) AS avg_temp, coalesce(humidity, 0) AS humidity,
            coalesce(precipitation, 0) AS precipitation,
            coalesce(avg_sunshine_hours, 0) AS avg_sunshine_hours) FROM fact )""",
        # reports
        "temp_vs_sales": f"""SELECT d.year, d.month, cast(w.avg_monthly_temp as double) AS avg_temp,
            cast(sum(f.total_packages) as bigint) AS total_sold {_STAR} GROUP BY 1, 2, 3 ORDER BY 1, 2""",
        "season_by_type": """SELECT d.season, m.ingredient AS medication_type,
            cast(sum(f.total_packages) as bigint) AS total_sold FROM fact f
            JOIN dim_date d ON f.date_id = d.date_id JOIN dim_med m ON f.medication_id = m.medication_id
            GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2""",
        "temp_vs_packages": f"""SELECT d.year, d.month, f.avg_temp,
            cast(sum(f.total_packages) as bigint) AS total_quantity {_STAR} GROUP BY 1, 2, 3 ORDER BY 1, 2""",
        "ingredient_month": f"""SELECT m.ingredient AS medication_type, d.year, d.month,
            {_settle('avg(f.avg_temp)', 6)} AS avg_temp,
            cast(sum(f.total_packages) as bigint) AS total_quantity {_STAR}
            JOIN dim_med m ON f.medication_id = m.medication_id GROUP BY 1, 2, 3 ORDER BY 5 DESC, 1, 2, 3""",
        "extreme_weather": f"""SELECT m.ingredient AS medication_name, {_TYPE} AS weather_type,
            count(DISTINCT w.date_id) AS month_count,
            cast(sum(f.total_prescriptions) as bigint) AS total_prescriptions,
            {_settle('cast(sum(f.total_prescriptions) as double) / count(DISTINCT w.date_id)', 2)}
            AS avg_prescriptions_per_month
            FROM fact f JOIN dim_med m ON f.medication_id = m.medication_id
            JOIN dim_wx w ON f.weather_id = w.weather_id GROUP BY 1, 2 ORDER BY 1, 2""",
        "month_trend": f"""SELECT d.year, d.month,
            {_settle('avg(cast(w.avg_monthly_temp as double))', 2)} AS avg_temp_c,
            {_settle('avg(cast(s.avg_station_monthly_hours as double))', 2)} AS avg_sunshine_hours,
            cast(sum(f.total_packages) as bigint) AS total_packages_sold,
            cast(sum(f.total_prescriptions) as bigint) AS total_prescriptions {_STAR}
            JOIN dim_sun s ON f.sunshine_id = s.sunshine_id GROUP BY 1, 2 ORDER BY 1, 2""",
        "supply_per_month": f"""SELECT d.month, m.package_label,
            {_settle('avg(f.total_packages)', 6)} AS avg_packages_per_month
            FROM fact f JOIN dim_med m ON f.medication_id = m.medication_id
            JOIN dim_date d ON f.date_id = d.date_id GROUP BY 1, 2 ORDER BY 1, 2""",
        "top_packages_full": """SELECT year, month, package_code, ingredient, total_prescriptions,
            cast(sum(total_persons) as bigint) AS persons FROM dim_med WHERE year = 1998 AND month = 2
            GROUP BY 1, 2, 3, 4, 5 ORDER BY year, persons DESC, 3, 4, 5 LIMIT 10""",
        "top_packages_masked": """SELECT year, month, package_code_masked AS package_code, ingredient,
            total_prescriptions_range AS total_prescription, cast(sum(total_persons) as bigint) AS persons
            FROM masked WHERE year = 1998 AND month = 2 GROUP BY 1, 2, 3, 4, 5
            ORDER BY year, persons DESC, 3, 4, 5 LIMIT 10""",
        "sales_metrics_full": f"""SELECT year, month, package_label, {_METRICS} FROM dim_med
            WHERE year = 1998 AND month = 7 GROUP BY 1, 2, 3 ORDER BY 1, 2, packages DESC, 3""",
        "sales_metrics_masked": f"""SELECT year, month, package_label_masked AS package_label, {_METRICS}
            FROM masked WHERE year = 1998 AND month = 7 GROUP BY 1, 2, 3""",
        "top_ingredients_full": """SELECT year, month, ingredient, cast(sum(total_packages) as bigint) AS packages
            FROM dim_med WHERE year = 1997 AND month = 10 GROUP BY 1, 2, 3
            ORDER BY year, packages DESC, ingredient LIMIT 10""",
        "top_ingredients_masked": """SELECT year, month, ingredient,
            cast(sum(total_packages) as bigint) AS packages FROM masked WHERE year = 1997 AND month = 10
            GROUP BY 1, 2, 3 ORDER BY year, packages DESC, ingredient LIMIT 10""",
        # masking and governed views
        "masked_view": _MASKED,
        "governed_limited": """SELECT year, month, package_code_masked,
            cast(sum(total_packages) as bigint) AS packages, cast(sum(total_persons) as bigint) AS persons
            FROM masked GROUP BY 1, 2, 3""",
        "governed_full": f"SELECT {_DIM_WEATHER} FROM dim_wx",
        "code_mask": r"""SELECT p_partkey, CASE WHEN p_partkey * 7 >= 10000
            THEN substr(code, 1, 2) || '***' || right(code, 2) ELSE code END AS masked
            FROM (SELECT p_partkey, cast(p_partkey * 7 as varchar) AS code FROM part)""",
        "label_mask": f"SELECT p_partkey, {_key('p_name')} AS masked FROM part",
        "prescription_ranges": """SELECT p_partkey, (p_partkey - p_partkey % 1000) || '–'
            || (p_partkey - p_partkey % 1000 + 999) AS label FROM part""",
        "surrogate_keys": f"""SELECT p_partkey, {_key('p_brand', 'p_name', 'p_size')} AS key,
            {_key('p_brand', 'p_name', 'p_size', sep='')} AS key_no_sep FROM part""",
        # table maintenance
        "upsert_latest": "SELECT * FROM orders_merged",
        "upsert_table": _UPSERTED,
        "incremental_replace": f"""SELECT {_DIM_WEATHER} FROM (SELECT * REPLACE (
            avg_monthly_temp + CASE WHEN date_id >= '200001' THEN 100 ELSE 0 END AS avg_monthly_temp)
            FROM dim_wx )""",
        "dedup_latest": """SELECT o_custkey, o_orderkey,
            strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_totalprice
            FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
            ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders) WHERE n = 1""",
        "store_defaults": """SELECT staid, souid, station_name,
            CASE WHEN staid % 3 != 0 THEN country ELSE '' END AS country, '' AS parname,
            cast(NULL as double) AS lat FROM stations""",
        "year_partitions": """SELECT cast(year(date) as int) AS year, count(*) AS rows
            FROM sunshine GROUP BY 1""",
        # aggregates
        "conditional_aggs": f"""SELECT l_returnflag,
            cast(sum(floor(l_extendedprice * 100 + 0.5)) FILTER (WHERE l_quantity > 25) as bigint) AS sum_if,
            {_settle('avg(l_quantity) FILTER (WHERE l_quantity > 25)', 4)} AS avg_if,
            min(l_extendedprice) FILTER (WHERE l_quantity > 25) AS min_if,
            max(l_extendedprice) FILTER (WHERE l_quantity > 25) AS max_if FROM lineitem GROUP BY 1""",
        "two_level_avg": f"""SELECT event_type, {_settle('avg(total)', 4)} AS mean_of_sums FROM (
            SELECT event_type, user_id, sum(floor(value * 100 + 0.5)) AS total FROM events GROUP BY 1, 2)
            GROUP BY 1""",
        "ratio_of_aggs": f"""SELECT l_linestatus, l_returnflag, cast(sum(l_linenumber) as bigint) AS total,
            count(DISTINCT l_suppkey) AS stations,
            {_settle('cast(sum(l_linenumber) as double) / count(DISTINCT l_suppkey)', 2)} AS ratio
            FROM lineitem GROUP BY 1, 2""",
        "distinct_months": """SELECT DISTINCT cast(cast(date_trunc('month', l_shipdate) as date) as varchar)
            AS month_start FROM lineitem""",
        "group_by_measure": """SELECT cast(round(avg_monthly_temp, 0) as double) AS temp, count(*) AS months
            FROM dim_wx GROUP BY 1""",
        "duplicate_keys": """SELECT staid, souid, cast(date as varchar) AS date, count(*) AS copies
            FROM sunshine GROUP BY 1, 2, 3 HAVING count(*) > 1""",
        "unmatched_months": """SELECT date_id, count(*) AS rows FROM fact
            WHERE date_id NOT IN (SELECT date_id FROM dim_wx ) GROUP BY 1""",
        # scalar functions
        "split_tokens": """SELECT DISTINCT year, month, split_part(ingredient_name, ' ', 1) AS atc_code,
            split_part(ingredient_name, ' ', 2) AS ingredient, split_part(ingredient_name, ' ', 9) AS none,
            split_part(package_name, ' ', 1) AS package_code,
            substr(package_name, strpos(package_name, ' ') + 1) AS package_label FROM silver_meds""",
        "calendar_parts": """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day,
            strftime(o_orderdate, '%Y-%m-01') AS month_start,
            strftime(date_trunc('month', o_orderdate) + interval 1 month, '%Y-%m-%d') AS next_month,
            strftime(o_orderdate, '%Y%m') AS date_id, strftime(o_orderdate, '%Y%m') AS date_id_of_parts,
            strftime(o_orderdate, '%B') AS month_name, cast(quarter(o_orderdate) as int) AS quarter,
            CASE month(o_orderdate) % 12 // 3 WHEN 0 THEN 'Winter' WHEN 1 THEN 'Spring'
            WHEN 2 THEN 'Summer' ELSE 'Autumn' END AS season FROM orders""",
        "rounding_modes": f"""SELECT {_LINE}, cast(l_linenumber + 1 as double) AS half_up,
            cast(l_linenumber + l_linenumber % 2 as double) AS half_even,
            {_settle('l_extendedprice / 3', 2)} AS third FROM lineitem""",
        "parse_month": f"SELECT {_LINE}, {samples.MONTH_ANSWER} AS month FROM lineitem",
        "month_dates": f"""SELECT {_LINE}, CASE WHEN l_linenumber != 7
            THEN strftime(l_shipdate, '%Y-%m-01') END AS month_date FROM lineitem""",
        "parse_number": f"SELECT {_LINE}, {samples.NUMBER_ANSWER} AS cents FROM lineitem",
        "parse_count": f"SELECT {_LINE}, {samples.COUNT_ANSWER} AS number FROM lineitem",
        "parse_whole": f"SELECT {_LINE}, {samples.WHOLE_ANSWER} AS number FROM lineitem",
        "parse_hour": f"SELECT event_id, {samples.HOUR_ANSWER} AS hour FROM events",
        "build_timestamp": f"SELECT event_id, {samples.STAMP_ANSWER} AS ts FROM events",
        "compact_dates": f"SELECT o_orderkey, {samples.DATE_ANSWER} AS day FROM orders",
        "clamp_null": f"""SELECT {_LINE}, CASE WHEN l_partkey % 500 + 0.5 <= 360
            THEN cast(l_partkey % 500 + l_partkey % 500 % 2 as int) END AS wind_dir,
            CASE WHEN l_quantity * 3 <= 100 THEN cast(l_quantity * 3 as int) END AS humidity FROM lineitem""",
        "sentinel_null": f"""SELECT {_LINE}, CASE WHEN l_tax != 0 THEN l_linenumber END AS ss_raw,
            CASE WHEN l_returnflag != 'A' THEN 1 END AS q_ss FROM lineitem""",
        "tidy_text": f"""SELECT doc_id, cast(length({_TIDY}) as int) AS chars, md5({_TIDY}) AS digest
            FROM documents""",
        "accent_free_text": "SELECT doc_id, md5(strip_accents(text)) AS digest FROM documents",
        "blank_to_null": """SELECT conv_id, turn, CASE WHEN turn % 2 = 1 AND trim(text) != ''
            THEN cast(length(text) as int) END AS chars FROM conversations""",
        "country_default": """SELECT s_suppkey, CASE WHEN n_nationkey % 2 = 0 THEN 'EE'
            ELSE left(n_name, 2) END AS country FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
        # data quality
        "dq_medications": """SELECT 'invalid_rows' AS "check", count(*) AS violations FROM meds
            WHERE year < 1996 OR month < 2""",
        "dq_sunshine": """SELECT 'invalid_q' AS "check", count(*) AS violations FROM sunshine WHERE q_ss = 9
            UNION ALL SELECT 'future_dates', count(*) FROM sunshine WHERE date > date '2001-06-01'
            UNION ALL SELECT 'rows', count(*) FROM sunshine""",
        "dq_weather": """SELECT 'future' AS "check", count(*) AS violations FROM weather
            WHERE ts > timestamp '2001-06-01'
            UNION ALL SELECT 'temp_out_of_range', count(*) FROM weather WHERE abs(t_air_c * 3) > 70""",
        "dq_fact": """SELECT 'not_null_' || c AS "check", n AS violations FROM (
            SELECT unnest(['fact_id', 'date_id', 'medication_id', 'weather_id', 'sunshine_id', 'total_packages'])
            AS c, unnest([0, 0, 0, (SELECT count(*) FROM fact WHERE weather_id IS NULL),
            (SELECT count(*) FROM fact WHERE sunshine_id IS NULL), 0]) AS n)
            UNION ALL SELECT 'positive_total_packages', count(*) FROM fact WHERE total_packages <= 0
            UNION ALL SELECT 'unique_fact_id', count(*) FROM (
            SELECT fact_id FROM fact GROUP BY 1 HAVING count(*) > 1)
            UNION ALL SELECT 'relationship_medication_id', count(*) FROM fact
            WHERE medication_id NOT IN (SELECT medication_id FROM dim_med )""",
        "dq_not_null": """SELECT 'not_null_weather_id' AS "check", count(*) - count(weather_id) AS violations
            FROM fact UNION ALL SELECT 'not_null_sunshine_id', count(*) - count(sunshine_id) FROM fact
            UNION ALL SELECT 'not_null_medication_id', count(*) - count(medication_id) FROM fact""",
        "dq_unique": """SELECT 'unique_staid' AS "check", count(*) AS violations FROM (
            SELECT staid FROM sunshine GROUP BY 1 HAVING count(*) > 1)""",
        "dq_relationship": """SELECT 'relationship_date_id' AS "check", count(*) AS violations FROM fact
            WHERE date_id NOT IN (SELECT date_id FROM dim_wx )""",
        "dq_assert": """SELECT 'positive_total_packages' AS "check", count(*) AS violations FROM fact
            WHERE total_packages <= 0""",
        "load_profile": """SELECT count(*) AS total_count, count(DISTINCT year) AS distinct_years,
            count(DISTINCT month) AS distinct_months FROM meds""",
        # file-shaped input
        "preamble_daily": """SELECT staid, souid, cast(date as varchar) AS date, ss_raw,
            CASE WHEN q_ss != 9 THEN q_ss END AS q_ss FROM sunshine""",
        "preamble_stations": """SELECT staid, souid, station_name,
            CASE WHEN staid % 4 = 0 THEN 'EE' ELSE left(country, 2) END AS country,
            cast('59.' || staid as double) AS lat, CASE WHEN staid % 3 != 0 THEN 24.5::double END AS lon,
            CASE WHEN staid % 5 != 0 THEN souid END AS elevation, 19500101 AS begin, 20231231 AS "end",
            CASE WHEN staid % 2 = 0 THEN 'Sunshine' END AS parname FROM stations""",
        "header_discovery": """SELECT DISTINCT o_orderpriority || '-hourly.csv' AS file, 0 AS sheet,
            cast(CASE left(o_orderpriority, 1) WHEN '1' THEN 5 WHEN '3' THEN 7 ELSE 2 END as bigint) AS header,
            0 AS year, CASE WHEN left(o_orderpriority, 1) != '3' THEN 2 END AS day, 11 AS humidity FROM orders""",
        "role_inference": """SELECT DISTINCT o_orderpriority AS file, 1 AS year, 2 AS month, 3 AS day,
            4 AS time_utc FROM orders""",
        "weather_sheets": f"""SELECT left(station, strpos(station, '-') - 1) AS station,
            strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, t_air_c, {_FINITE.format(c='t_min_c')}, t_max_c,
            wind_dir_deg, wind_ms, wind_gust_ms, precip_mm, humidity FROM weather""",
        "medication_sheets": """SELECT year, month, cast(month_date as varchar) AS month_date, ingredient,
            CASE WHEN persons != 6 THEN package END AS package, persons, prescriptions, packages_count,
            total_amount, hk_amount, over_ref_price, copay_no_trh, copay_with_trh FROM meds
            WHERE persons != 7""",
        "header_rename": """SELECT staid, souid, country, cast(NULL as double) AS lat FROM stations""",
        "roles_late_rows": """SELECT DISTINCT o_orderpriority AS file, 1 AS year, 2 AS month, 3 AS day,
            4 AS time_utc FROM orders""",
        "deep_header": f"""SELECT left(station, strpos(station, '-') - 1) AS station,
            strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, t_air_c, {_FINITE.format(c='t_min_c')}, t_max_c,
            wind_dir_deg, wind_ms, wind_gust_ms, precip_mm, humidity FROM weather""",
        "skipped_files": """SELECT o_orderpriority || '-notes.csv' AS file, 'no header' AS reason,
            count(*) AS rows FROM orders GROUP BY 1
            UNION ALL SELECT o_orderpriority || '-hourly.csv', 'open quote', count(*) FROM orders
            WHERE o_orderkey % 7 = 0 GROUP BY 1""",
        "last_line_wins": """SELECT 1 AS staid, o_custkey AS souid, max_by(o_orderkey, o_orderkey) % 1000 AS ss_raw
            FROM orders WHERE o_orderkey <= 20000 GROUP BY o_custkey""",
        "weather_day_large_sums": """SELECT '200001' AS date_id, cast(sum(l_quantity * 10) as double)
            AS avg_monthly_precipitation FROM lineitem""",
        "table_reload": """SELECT n_nationkey, n_name, false AS replaced_by_nothing,
            (SELECT count(*) FROM nation WHERE n_nationkey >= 23) AS added
            FROM nation WHERE n_nationkey < 20 OR n_nationkey >= 23""",
        "table_overwrite": "SELECT * FROM region",
        "table_by_year": """SELECT cast(year(date) as int) AS year, count(*) AS rows, count(DISTINCT date) AS days
            FROM sunshine GROUP BY 1""",
        "sorted_table": "SELECT p_brand, count(*) AS rows FROM part GROUP BY 1",
        "bucketed_join": """SELECT m.ingredient, cast(sum(f.total_persons) as bigint) AS persons
            FROM fact f JOIN dim_med m ON f.medication_id = m.medication_id GROUP BY 1""",
        "upsert_published": _UPSERTED,
        "incremental_months": """SELECT date_id, cast(avg_monthly_temp as double) AS avg_monthly_temp,
            date_id >= '200001' AS rebuilt FROM dim_wx_late """,
        "large_amounts": f"""SELECT year, month, trim(upper(ingredient), ' ') AS ingredient_name,
            trim(package, ' ') AS package_name, cast(cast(sum(amount) as decimal(38,2)) as varchar) AS total_amount
            FROM (SELECT {_fields(MEDICATIONS)}, {samples.LARGE_ANSWER} AS amount
            FROM lineitem JOIN part ON l_partkey = p_partkey) WHERE amount IS NOT NULL AND year BETWEEN 1995 AND 2001
            GROUP BY 1, 2, 3, 4""",
        "dq_amounts": """SELECT 'overflow_' || c AS "check", CASE WHEN c = 'hk_amount'
            THEN (SELECT count(*) FROM meds WHERE persons = 7) ELSE 0 END AS violations
            FROM (SELECT unnest(['total_amount', 'hk_amount', 'over_ref_price', 'copay_no_trh', 'copay_with_trh']) AS c)""",
        "accent_free_all": f"""SELECT l_orderkey, l_linenumber, md5(l_returnflag || array_to_string(list_transform(
            range(10), lambda k: coalesce(u[i + 1 + k], '')), '') || 'e') AS digest
            FROM (SELECT *, cast({samples.DECOMPOSED_AT} as int) AS i FROM lineitem),
            (SELECT string_split('{_UNMARKED}', '{_SPLIT}') AS u)""",
        "stored_order": """SELECT true AS several_files, count(*) AS rows, 0 AS inversions, 0 AS overlaps
            FROM orders""",
        "masked_view_sql": _MASKED,
        "role_views_sql": """SELECT package_code_masked, w.avg_monthly_temp > 10 AS warm,
            cast(sum(total_packages) as bigint) AS packages FROM masked m
            JOIN dim_wx w ON w.date_id = cast(m.year * 100 + m.month as varchar) GROUP BY 1, 2""",
        "surrogate_keys_wide": """SELECT p_partkey,
            md5(p_brand || '|' || p_name || '|' || cast(p_size as varchar)) AS key FROM part""",
        "fact_wide_keys": f"""SELECT md5(date_id || '|' || upper(id)) AS fact_id, id AS medication_id, date_id,
            ingredient, package_code, total_packages FROM (
            SELECT cast(year * 100 + month as varchar) AS date_id, md5({_spelled(*_MEDICATION_KEYS)}) AS id, *
            FROM dim_med )""",
        "lake_reload": """SELECT s.staid, s.souid, CASE WHEN s.staid % 3 != 0 THEN s.country ELSE '' END AS country,
            days, ss_raw, true AS stamped FROM stations s LEFT JOIN (SELECT staid, count(*) AS days,
            cast(sum(ss_raw) as bigint) AS ss_raw FROM sunshine GROUP BY 1) d ON d.staid = s.staid""",
        "ensured_table": """SELECT cast(year(o_orderdate) as int) AS year, count(*) AS rows,
            max(o_orderkey) AS last FROM orders GROUP BY 1""",
        "table_reload_orders": """SELECT o_orderkey, o_custkey, false AS replaced_by_nothing,
            (SELECT count(*) FROM orders WHERE o_orderkey % 3 = 1) AS added FROM orders WHERE o_orderkey % 3 < 2""",
        "table_overwrite_part": "SELECT p_partkey, p_brand, p_size FROM part",
        "sample_rows": "SELECT least(5, count(*)) AS rows, 0 AS strangers FROM orders",
        "season_names": """SELECT CASE month(o_orderdate) % 12 // 3 WHEN 0 THEN 'Winter' WHEN 1 THEN 'Spring'
            WHEN 2 THEN 'Summer' ELSE 'Autumn' END AS season, count(*) AS orders FROM orders GROUP BY 1""",
        "last_line_of_all": """SELECT 1 AS staid, o_custkey AS souid, max(o_orderkey) % 1000 AS ss_raw
            FROM orders GROUP BY o_custkey""",
        "header_below_all": _WEATHER_FILES,
        "blank_cells": """SELECT conv_id, turn, blank, CASE WHEN NOT blank AND trim(text) != ''
            THEN cast(length(text) as int) END AS chars
            FROM conversations, (SELECT unnest([false, true]) AS blank)""",
        "dq_fact_sparse": """SELECT 'not_null_fact_id' AS "check", count(*) - count(fact_id) AS violations
            FROM fact_sparse UNION ALL SELECT 'not_null_date_id', count(*) - count(date_id) FROM fact_sparse
            UNION ALL SELECT 'not_null_medication_id', count(*) - count(medication_id) FROM fact_sparse
            UNION ALL SELECT 'not_null_weather_id', count(*) - count(weather_id) FROM fact_sparse
            UNION ALL SELECT 'not_null_sunshine_id', count(*) - count(sunshine_id) FROM fact_sparse
            UNION ALL SELECT 'not_null_total_packages', count(*) - count(total_packages) FROM fact_sparse
            UNION ALL SELECT 'positive_total_packages', count(*) FROM fact_sparse WHERE total_packages <= 0
            UNION ALL SELECT 'unique_fact_id', count(*) FROM (
            SELECT fact_id FROM fact_sparse WHERE fact_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
            UNION ALL SELECT 'relationship_medication_id', count(*) FROM fact_sparse
            WHERE medication_id NOT IN (SELECT medication_id FROM dim_med )""",
        "headers_by_file": """SELECT o_orderpriority || '-hourly.csv' AS file, max(o_orderkey) + 5 AS header,
            d AS year, d + 2 AS day, d + 11 AS humidity
            FROM (SELECT *, cast(left(o_orderpriority, 1) as int) AS d FROM orders) GROUP BY o_orderpriority, d""",
        "roles_by_file": """SELECT DISTINCT o_orderpriority || '-hourly.csv' AS file, d AS year, d + 1 AS month,
            d + 2 AS day, d + 3 AS time_utc
            FROM (SELECT *, cast(left(o_orderpriority, 1) as int) AS d FROM orders)""",
        # files
        "quoted_breaks": f"""SELECT year, month, cast(month_date as varchar) AS month_date, ingredient,
            {samples.TORN_PACKAGE} AS package, persons, prescriptions, packages_count,
            total_amount, hk_amount, over_ref_price, copay_no_trh, copay_with_trh FROM meds""",
        "files_daily": """SELECT staid, souid, cast(date as varchar) AS date, ss_raw,
            CASE WHEN q_ss != 9 THEN q_ss END AS q_ss FROM sunshine""",
        "files_weather": _WEATHER_FILES,
        "files_none": "SELECT staid, count(*) AS rows FROM sunshine GROUP BY 1",
        "second_sheet": _WEATHER_FILES,
        "incremental_table": """SELECT date_id, cast(avg_monthly_humidity as double)
            + CASE WHEN date_id >= '200001' THEN 100 ELSE 0 END AS avg_monthly_humidity
            FROM dim_wx""",
    }
    return {name: _with(text) for name, text in sql.items()}
