import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from panelwright.functions import dates, formats, keys, ratios
from panelwright.sources.rows import inline_rows


def texts(spark, *values):
    return inline_rows(spark, "t string", [(v,) for v in values])


def one(df):
    return [r[0] for r in df.collect()]


def test_keys(spark):
    df = texts(spark, "  aBc ", None, " na")
    assert one(df.select(keys.norm("t"))) == ["ABC", None, "NA"]
    assert one(df.select(keys.clean_token("t"))) == ["ABC", None, None]
    hashed = one(df.select(keys.hash_key("t")))
    assert len(hashed[0]) == 64 and hashed[1] is None
    assert hashed[0] == one(texts(spark, "ABC").select(keys.hash_key("t")))[0]
    codes = inline_rows(spark, "c int", [(211,), (99,), (None,)])
    assert one(codes.select(keys.parent_code("c"))) == [2, 9, None]
    assert one(codes.select(keys.code_or_default("c"))) == [211, 99, 99]


def test_decide_first_rule_wins_and_nulls_fall_through(spark):
    df = inline_rows(spark, "a string, b string", [("x", "y"), ("x", None), (None, None)])
    rules = [({"a": "x", "b": "y"}, 2), ({"a": "x"}, 3)]
    assert one(df.select(keys.decide(rules))) == [2, 3, 99]


@pytest.mark.parametrize(
    "fmt,text,expected",
    [("yyyy-MM-dd", "2024-02-29", 20240229), ("dd/MM/yyyy", "31/12/2023", 20231231), ("MM/dd/yyyy", "12/31/2023", 20231231),
     ("yyyy-MM-dd", "2023-02-29", None), ("dd/MM/yyyy", "soon", None), ("MM/dd/yyyy", None, None)],
)
def test_date_text(spark, fmt, text, expected):
    assert one(texts(spark, text).select(dates.date_text_to_int("t", fmt))) == [expected]


def test_month_labels(spark):
    df = texts(spark, "jan24", "Fev 23", "DEZ22 ", "xyz24", "jan", None)
    assert one(df.select(dates.month_label_to_period("t"))) == ["202401", "202302", "202212", "202400", None, None]


def test_six_or_eight_digits(spark):
    df = texts(spark, "202402", "20240215", "2024", None)
    first, middle = dt.date(2024, 2, 1), dt.date(2024, 2, 15)
    assert one(df.select(dates.code_to_date("t"))) == [first, middle, None, None]
    assert one(df.select(dates.month_of_code("t"))) == ["202402", "202402", "2024", None]


def test_month_index_round_trip(spark):
    df = inline_rows(spark, "p int", [(202401,), (202312,), (199501,)])
    back = df.select("p", dates.period_of_pidx(dates.pidx_of_period("p")).alias("q"),
                     dates.year_of_pidx(dates.pidx_of_period("p")).alias("y"),
                     dates.month_of_pidx(dates.pidx_of_period("p")).alias("m"))
    for p, q, y, m in rows(back):
        assert p == q == y * 100 + m
        assert dates.from_pidx(dates.to_pidx(p)) == p
    with pytest.raises(ValueError):
        dates.to_pidx(202413)
    assert one(df.select(dates.period_label("p"))) == ["01/2024", "12/2023", "01/1995"]


def test_calendar_parts(spark):
    df = inline_rows(spark, "d date", [(dt.date(2021, 1, 3),), (dt.date(2024, 3, 31),), (dt.date(2024, 12, 31),)])
    got = rows(df.select(dates.iso_weekday("d"), dates.iso_week_label("d"), dates.is_month_end("d"),
                         dates.is_quarter_end("d"), dates.is_year_end("d"), dates.is_year_start("d")))
    assert got == [(7, "2020-W53", 0, 0, 0, 0), (7, "2024-W13", 1, 1, 0, 0), (2, "2025-W01", 1, 1, 1, 0)]
    ytd = df.select(dates.ytd_text("d", F.lit("2024-06-30").cast("date")), dates.period_text(F.year("d"), F.lit("x")))
    assert rows(ytd) == [("Fuera", "2021-x"), ("YTD", "2024-x"), ("Fuera", "2024-x")]


def test_ratios_follow_blank_and_zero_rules(spark):
    df = inline_rows(spark, "i int, a double, b double", [(1, 6.0, 3.0), (2, 6.0, 0.0), (3, 6.0, None), (4, None, 3.0)])
    got = rows(df.selectExpr("i", ratios.divide("a", "b"), ratios.share("a", "b"), ratios.pct_growth("a", "b"),
                             ratios.growth("a", "b")), "i")
    assert got == [(1, 2.0, 2.0, 1.0, 3.0), (2, None, 0.0, 0.0, 6.0), (3, None, 0.0, 0.0, 6.0), (4, None, None, -1.0, -3.0)]


def test_bps_without_prior_is_zero(spark):
    df = inline_rows(spark, "i int, c double, p double, h boolean", [(1, .5, .25, True), (2, .5, None, False), (3, None, .1, True)])
    got = rows(df.selectExpr("i", ratios.bps("c", "p", "h"), ratios.trend("c", "h"), ratios.trend_symbol("c - p", "h")), "i")
    assert got == [(1, 2500.0, "up", "▲"), (2, 0.0, "none", "○"), (3, -1000.0, "flat", "–")]


@pytest.mark.parametrize("v,texts", [
    (0.0, ["0", "0,00", "0,0 %", "0"]),
    (32857.0, ["32.857", "32.857,00", "3.285.700,0 %", "32,9 mil"]),
    (2.5, ["2", "2,50", "250,0 %", "2"]),
    (1234567.891, ["1.234.568", "1.234.567,89", "123.456.789,1 %", "1,2 mill."]),
    (-987654.3, ["-987.654", "-987.654,30", "-98.765.430,0 %", "-987,7 mil"]),
    (1500.0, ["1.500", "1.500,00", "150.000,0 %", "1,5 mil"]),
    (12.0, ["12", "12,00", "1.200,0 %", "12"]),
])
def test_number_text(spark, v, texts):
    df = inline_rows(spark, "v double", [(v,)])
    got = rows(df.selectExpr(formats.es_num("v"), formats.es_num("v", 2), formats.es_pct("v"), formats.es_scale("v")))[0]
    assert list(got) == texts


def test_significant_digits(spark):
    df = inline_rows(spark, "i int, v double", [(1, 0.0), (2, 0.005), (3, 12.34), (4, 1.26), (5, -0.000000001234)])
    got = [t for _, t in rows(df.selectExpr("i", formats.es_sig("v")), "i")]
    assert got == ["0", "0,0050", "12", "1,3", "-0,00000000"]


def test_single_selection(spark):
    df = inline_rows(spark, "k int, t string", [(1, "a"), (1, "a"), (2, "a"), (2, "b"), (3, None)])
    got = rows(df.groupBy("k").agg(keys.single_or_multiple("t")), "k")
    assert got == [(1, "a"), (2, "SELECCIÓN MULTIPLE"), (3, "SELECCIÓN MULTIPLE")]
