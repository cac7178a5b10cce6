"""Scalar functions on hand-made frames (edge cases of P1-P16)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martforge import functions as fx


def one_col(spark, values, type_="string"):
    return spark.createDataFrame([(v,) for v in values], f"c {type_}")


def test_strip_all_blanks(spark):
    df = one_col(spark, ["  sao paulo ", "\tcampinas\n", " rio ", None, ""])
    got = [r[0] for r in df.select(fx.strip_blanks(F.col("c"))).collect()]
    assert got == ["sao paulo", "campinas", "rio", None, ""]


def test_strip_matches_python_strip(spark):
    samples = ["\u00a0x y\u2003", "\x1c\x1fz\x1e", "\u200bw\u200b", "\x85v\x0b", "\u3000u\t"]
    got = [r[0] for r in one_col(spark, samples).select(fx.strip_blanks(F.col("c"))).collect()]
    assert got == [t.strip() for t in samples]


def test_title_case_matches_python_title(spark):
    samples = ["são paulo", "d'oeste", "東京tokyo", "rio-2 grande", "ÉCOLE du nord", "x1y", "a_b c.d"]
    df = one_col(spark, samples)
    got = [r[0] for r in df.select(fx.title_case(F.col("c"))).collect()]
    assert got == [t.title() for t in samples]


def test_title_case_letter_runs(spark):
    df = one_col(spark, ["d'oeste", "mogi-mirim", "SÃO JOSÉ", "1st avenue", None, ""])
    got = [r[0] for r in df.select(fx.title_case(F.col("c"))).collect()]
    assert got == ["D'Oeste", "Mogi-Mirim", "São José", "1St Avenue", None, ""]


def test_zero_fill_never_truncates(spark):
    df = spark.createDataFrame([(1234,), (12345,), (123456,), (None,), (7,), (-12,)], "c bigint")
    got = [r[0] for r in df.select(fx.zero_fill(F.col("c"), 5)).collect()]
    assert got == ["01234", "12345", "123456", None, "00007", "-0012"]
    assert got[-1] == str(-12).zfill(5)


def test_parse_timestamp_lenient(spark):
    df = one_col(spark, ["2017-10-02 10:56:33", "not-a-date", "2017-10-02", "02/10/2017",
                         "2017-02-30 10:00:00", None])
    got = [r[0] for r in df.select(fx.parse_timestamp(F.col("c"))).collect()]
    assert got == [dt.datetime(2017, 10, 2, 10, 56, 33), None, None, None, None, None]


def test_parse_timestamp_ignores_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = one_col(spark, ["2017-03-12 02:30:00"])  # inside a DST gap in New York
        got = df.select(fx.parse_timestamp(F.col("c")).cast("string")).collect()[0][0]
        assert got == "2017-03-12 02:30:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_sunday_is_zero(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 7),), (dt.date(2024, 1, 13),)], "d date")
    parts = fx.date_parts(F.col("d"))
    got = df.select(*[v.alias(k) for k, v in parts.items()]).collect()
    assert got[0].day_of_week == 0 and got[1].day_of_week == 6
    assert (got[0].year, got[0].quarter, got[0].month, got[0].day) == (2024, 1, 1, 7)


def test_numeric_to_int_rounds_half_away(spark):
    df = spark.createDataFrame([(Decimal("2.5"),), (Decimal("-2.5"),), (Decimal("2.4"),)], "c decimal(20,6)")
    got = [r[0] for r in df.select(fx.numeric_to_int(F.col("c"))).collect()]
    assert got == [3, -3, 2]


def test_money_rounding_and_overflow(spark):
    df = spark.createDataFrame([(1.005,)], "c double")
    assert df.select(fx.to_money(fx.to_stage_decimal(F.col("c")))).collect()[0][0] == Decimal("1.01")
    big = spark.createDataFrame([(1.0e10,)], "c double")
    with pytest.raises(Exception):
        big.select(fx.to_money(fx.to_stage_decimal(F.col("c")))).collect()


def test_decimal_comma_repair(spark):
    df = one_col(spark, ["123,5", "7", None, "0,25"])
    got = [r[0] for r in df.select(fx.repair_decimal_comma(F.col("c"))).collect()]
    assert got == [Decimal("123.5"), Decimal("7"), None, Decimal("0.25")]


def test_nan_to_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.5,), (None,)], "c double")
    got = [r[0] for r in df.select(fx.nan_to_null(F.col("c"))).collect()]
    assert got == [None, 1.5, None]


def test_normalise_missing_tokens(spark):
    df = spark.createDataFrame([("NA", 1), ("null", 2), ("None", 3), ("n/a", 4), ("", 5), ("ok", 6)],
                               "s string, n int")
    got = [tuple(r) for r in fx.normalise_missing(df).collect()]
    assert got == [(None, 1), (None, 2), (None, 3), (None, 4), (None, 5), ("ok", 6)]


def test_text_to_int_raises_on_bad_text(spark):
    df = one_col(spark, ["01234", "x"])
    with pytest.raises(Exception):
        df.select(fx.text_to_int(F.col("c"))).collect()
    assert one_col(spark, ["01234"]).select(fx.text_to_int(F.col("c"))).collect()[0][0] == 1234
