"""Fixed schemas of the raw tables. Key columns first; measures may be null."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


MEDICATIONS = _struct(
    year=IntegerType(),
    month=IntegerType(),
    month_date=DateType(),
    ingredient=StringType(),
    package=StringType(),
    persons=LongType(),
    prescriptions=LongType(),
    packages_count=DoubleType(),
    total_amount=DoubleType(),
    hk_amount=DoubleType(),
    over_ref_price=DoubleType(),
    copay_no_trh=DoubleType(),
    copay_with_trh=DoubleType(),
)

# The same with amounts that no double has rounded.
MONEY_COLUMNS = ("total_amount", "hk_amount", "over_ref_price", "copay_no_trh", "copay_with_trh")
EXACT_MEDICATIONS = StructType(
    [StructField(f.name, DecimalType(38, 6) if f.name in MONEY_COLUMNS else f.dataType) for f in MEDICATIONS.fields]
)

WEATHER = _struct(
    station=StringType(),
    ts=TimestampNTZType(),
    t_air_c=DoubleType(),
    t_min_c=DoubleType(),
    t_max_c=DoubleType(),
    wind_dir_deg=IntegerType(),
    wind_ms=DoubleType(),
    wind_gust_ms=DoubleType(),
    precip_mm=DoubleType(),
    humidity=IntegerType(),
)

SUNSHINE_SOURCES = _struct(
    staid=IntegerType(),
    souid=IntegerType(),
    station_name=StringType(),
    country=StringType(),
    lat=DoubleType(),
    lon=DoubleType(),
    elevation=IntegerType(),
    begin=IntegerType(),
    end=IntegerType(),
    parname=StringType(),
)

SUNSHINE_DAILY = _struct(
    staid=IntegerType(),
    souid=IntegerType(),
    date=DateType(),
    ss_raw=IntegerType(),
    q_ss=IntegerType(),
)
