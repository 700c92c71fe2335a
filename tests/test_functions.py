"""Column functions on edge values."""

import datetime as dt
import sys
import unicodedata

import pytest
from pyspark.sql import functions as F

from skyledger.functions import dates, keys, masks, numbers, text


def run(spark, function, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    rows = df.select("i", function(F.col("v")).alias("r")).orderBy("i").collect()
    return [r["r"] for r in rows]


@pytest.mark.parametrize(
    "raw, month",
    [
        ("1", 1), ("01", 1), ("1.0", 1), ("1.5", 2), ("IV.", 4), ("Märts", 3), ("DETS.", 12),
        ("2024-12", 12), ("2024-1", 1), ("2012", 12), ("0.4", 4), ("13", None), ("2024", None),
        ("nan", None), ("", None), (None, None), (" mai ", 5), ("x", 10), ("1e1", 10),
        ("-2147483648", None), ("1e999", None),
    ],
)
def test_month_number(spark, raw, month):
    assert run(spark, dates.month_number, [raw]) == [month]


def test_numbers(spark):
    raw = ["1 234,5", "1 234,5", "nan", "none", "null", "", "inf", "1e999", "12d", "-3", ".5", "1."]
    assert run(spark, numbers.decimal_comma_number, raw) == [
        1234.5, 1234.5, None, None, None, None, None, None, None, -3.0, 0.5, 1.0,
    ]
    assert run(spark, numbers.count_number, ["2.5", "3,5", "-1", "-0.4", "x", None, "1e999"]) == [
        2, 4, None, 0, None, None, None,
    ]
    assert run(spark, lambda c: numbers.whole_or(c, 7), [" 5 ", "+3", "5.0", "", None]) == [5, 3, 7, 7, 7]
    assert run(spark, numbers.number, ["1,5", " 2.5 ", "1 0", "0x1p3"]) == [None, 2.5, None, None]


def test_clamps(spark):
    assert run(spark, lambda c: numbers.whole_within(c, 0, 360), ["361", "360", "0.5", "-1", "x"]) == [
        None, 360, 0, None, None,
    ]
    assert run(spark, lambda c: numbers.null_if(c, -9999, -9), [-9999, -9, 3], "int") == [None, None, 3]


def test_hours(spark):
    raw = ["5", "05:30", "5:00:00", "24", "0.5", "23.0", "25:00", "noon", "", None, "5:0:0:0"]
    assert run(spark, dates.hour_of_day, raw) == [5, 5, 5, None, 0, 23, None, None, None, None, None]


def test_timestamps(spark):
    rows = [("2021", "2", "28", "5"), ("2021", "2", "30", "5"), ("1899", "1", "1", "5"), ("2021.9", "3.7", "1", "7:30")]
    df = spark.createDataFrame(rows, "y string, m string, d string, t string")
    got = [r[0] for r in df.select(dates.hour_timestamp("y", "m", "d", "t")).collect()]
    assert got == [dt.datetime(2021, 2, 28, 5), None, None, dt.datetime(2021, 3, 1, 7)]


def test_compact_dates(spark):
    raw = ["19000101", "18991231", "20210230", "20210228", "2021-02-01", "2021112", "", None]
    assert run(spark, dates.compact_date, raw) == [
        dt.date(1900, 1, 1), None, None, dt.date(2021, 2, 28), None, dt.date(2021, 11, 2), None, None,
    ]


def test_month_dates(spark):
    df = spark.createDataFrame([("2021.7", "II"), ("1800", "1"), ("2021", "13")], "y string, m string")
    got = [r[0] for r in df.select(dates.month_date("y", "m")).collect()]
    assert got == [dt.date(2021, 2, 1), None, None]


def test_seasons(spark):
    got = run(spark, dates.season, [1, 3, 8, 11, 12, 13], "int")
    assert got == ["Winter", "Spring", "Summer", "Autumn", "Winter", "Unknown"]


def test_calendar_has_sixty_months(spark):
    months = dates.month_series(spark, dt.date(2021, 1, 1), 60).agg(F.min("month_start"), F.max("month_start"), F.count("*"))
    assert tuple(months.first()) == (dt.date(2021, 1, 1), dt.date(2025, 12, 1), 60)


def test_text(spark):
    assert run(spark, text.normalized, [" a  b\t\nc ", None, "ab"]) == ["a b c", "", "ab"]
    assert run(spark, text.text_or_null, ["  ", " a ", None]) == [None, " a ", None]
    assert run(spark, text.accent_free, ["Õhtu märts šŽ", "é"]) == ["Ohtu marts sZ", "e"]
    assert run(spark, text.country_code, ["", None, "Estonia"]) == ["EE", "EE", "Es"]
    assert run(spark, lambda c: text.word(c, 2), ["N02BE01 PARACETAMOL X", "one"]) == ["PARACETAMOL", ""]
    assert run(spark, lambda c: text.words_from(c, 2), ["1234567 TAB 500MG N10", "1"]) == ["TAB 500MG N10", ""]


def test_masks(spark):
    df = spark.createDataFrame([("1234567",), ("12345",), ("1234",), ("AB123",)], "c string")
    assert [r[0] for r in df.select(masks.mask_code("c")).collect()] == ["12***67", "12***45", "1234", "AB123"]
    df = spark.createDataFrame([(0,), (999,), (1000,), (1999,)], "n bigint")
    labels = [r[0] for r in df.select(masks.range_label("n")).collect()]
    assert labels == ["0–999", "0–999", "1000–1999", "1000–1999"]


def test_keys(spark):
    df = spark.createDataFrame([("1", "1x"), ("11", "x"), (None, "x")], "a string, b string")
    plain = [r[0] for r in df.select(keys.surrogate_key("a", "b")).collect()]
    joined = [r[0] for r in df.select(keys.surrogate_key("a", "b", sep="")).collect()]
    needed = [r[0] for r in df.select(keys.surrogate_key("a", "b", required=True)).collect()]
    other = [r[0] for r in df.select(keys.surrogate_key("a", "b", algo="xxhash64")).collect()]
    assert plain[0] != plain[1] and plain[2] is None and min(plain[:2]) >= 0
    assert joined[0] == joined[1]
    assert needed[:2] == plain[:2] and needed[2] is not None
    assert len(set(other)) == 3 and other[2] is None and min(other[:2]) >= 0


def test_settle_ignores_summation_noise(spark):
    assert run(spark, lambda c: numbers.settle(c, 2), [12.345, 12.344999999999999, 12.345000000000002], "double") == [12.35] * 3
    assert run(spark, lambda c: numbers.settle(c, 0, half_even=True), [0.5, 1.5, 2.5], "double") == [0.0, 2.0, 2.0]


def test_money(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (1.005,), (None,), (float("nan"),)], "v double")
    total = df.agg(numbers.money(F.sum(numbers.cents("v")))).first()[0]
    assert str(total) == "1.30"


def test_accent_free_is_full_decomposition(spark):
    """Every code point, in mixed texts of 64."""
    codes = [c for c in range(1, sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF]
    raw = ["".join(map(chr, codes[i : i + 64])) for i in range(0, len(codes), 64)]
    expected = ["".join(p for p in unicodedata.normalize("NFKD", s) if not unicodedata.combining(p)) for s in raw]
    assert run(spark, text.accent_free, raw) == expected
    some = ["", None, "plain", "Pärnu ﬁn ½ Ⅳ", "가나", "é", "ﷺ", "ＭＡＹ"]
    assert run(spark, text.accent_free, some) == ["", None, "plain", "Parnu fin 1⁄2 IV", unicodedata.normalize("NFKD", "가나"), "e", unicodedata.normalize("NFKD", "ﷺ"), "MAY"]


def test_full_width_months(spark):
    assert run(spark, dates.month_number, ["ＭＡＹ", "１２"]) == [5, 12]


def test_exact_amounts(spark):
    raw = ["1 234,5", "90100000000000000,25", "1e3", "0,1234565", "-0,005", "nan", "inf", "", None, "1" + "0" * 32, "9" * 32 + ".99", "1.5e-7"]
    got = [None if v is None else str(v) for v in run(spark, numbers.exact_amount, raw)]
    assert got == [
        "1234.500000", "90100000000000000.250000", "1000.000000", "0.123457", "-0.005000", None, None, None, None,
        None, "9" * 32 + ".990000", "0.000000",
    ]


def test_large_double_amounts(spark):
    values = [1.0, 1e9, 123456789012.345, 1e15, 1e16, 1.5e20, -1e20, 1e36, float("inf"), float("nan"), None]
    assert [None if v is None else str(v) for v in run(spark, numbers.large_amount, values, "double")] == [
        None, "1000000000.00", "123456789012.35", "1000000000000000.00", "10000000000000000.00", "150000000000000000000.00",
        "-100000000000000000000.00", None, None, None, None,
    ]
    assert run(spark, lambda c: numbers.held(c, False), values, "double") == [True] * 7 + [False] * 3 + [None]
