"""Edge values of the scalar expressions, with results written by hand."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from placelens.functions import dates, text, urls


def values(spark, expression, inputs, kind="string"):
    rows = spark.createDataFrame([(n, value) for n, value in enumerate(inputs)], f"n int, c {kind}")
    return [row[0] for row in rows.orderBy("n").select(expression(F.col("c"))).collect()]


def test_java_split(spark):
    cases = {
        "a": ["a"], "a,b": ["a", "b"], "a,,b": ["a", "", "b"], "a,": ["a"], "a,,": ["a"],
        ",a": ["", "a"], ",": [], ",,": [], "": [""], None: None, "a,\n": ["a", "\n"],
    }
    assert values(spark, lambda c: text.java_split(c, ","), cases) == list(cases.values())


@pytest.mark.parametrize("separator", ["\t", " ", ".", "|", "\\", "^", "*"])
def test_java_split_takes_separators_literally(spark, separator):
    line = separator.join(["", "x", "", "y", "", ""])
    assert values(spark, lambda c: text.java_split(c, separator), [line]) == [["", "x", "", "y"]]


def test_is_integer(spark):
    cases = {"12": True, "-12": True, "+1": True, "": True, "-": True, "+": True, "1.0": False, "12\n": False, "a": False, None: None}
    assert values(spark, text.is_integer, cases) == list(cases.values())


def test_is_clean_token(spark):
    cases = {"aZ09": True, "a|b-c_d": True, "": True, "a b": False, "a\n": False, "a?b": False, "é": False}
    assert values(spark, text.is_clean_token, cases) == list(cases.values())


def test_trim_date_suffix(spark):
    cases = {
        "abc180622": "abc", "180622": "180622", "a180622180621": "a180622", "abc181322": "abc181322",
        "abc180632": "abc180632", "abc180600": "abc180600", "x+10622": "x", "x-00622": "x", "x-10622": "x-10622",
        "x\n180622": "x\n", "abc180622\n": "abc180622\n", None: None, "": "",
    }
    assert values(spark, text.trim_date_suffix, cases) == list(cases.values())


def test_trim_date_suffix_repeated(spark):
    date = "180622"
    cases = {"a" + date: "a", "a" + date * 5: "a", "a" + date * 6: "a" + date, date * 3: date, date * 7: date * 2, "a": "a"}
    assert values(spark, lambda c: text.trim_date_suffix(c, 5), cases) == list(cases.values())


def test_trim_special(spark):
    cases = {"it's": "its", "a\\b": "ab", "\\'": "", "plain": "plain", None: None}
    assert values(spark, text.trim_special, cases) == list(cases.values())


def test_parse_double(spark):
    cases = {
        "1.5": 1.5, "1.5d": 1.5, " 1.5 ": 1.5, "0x1p3": 8.0, "abc": None, "": None, None: None, "Infinity": float("inf"),
        "-Infinity": float("-inf"), "1e999": float("inf"), "inf": None, "nan": None, "INFINITY": None,
    }
    assert values(spark, text.parse_double, cases) == list(cases.values())
    assert str(values(spark, text.parse_double, ["NaN"])[0]) == "nan"


def test_visitor_sentinels(spark):
    cases = {"v1": True, "null": False, "": False, None: False, "NULL": True}
    assert values(spark, text.is_present, cases) == list(cases.values())


def test_attributable(spark):
    rows = spark.createDataFrame(
        [("top", "http://a", True), ("http://p", "http://a", False), ("top", "ftp://a", False), (None, "http://a", None), ("top", None, None)],
        "f string, t string, expected boolean",
    )
    kept = rows.where(text.attributable(F.col("f"), F.col("t"))).collect()
    assert [row["expected"] for row in kept] == [True]


def test_null_default(spark):
    assert values(spark, lambda c: text.null_default(c, 7), [1, None], "bigint") == [1, 7]


URLS = {
    "https://m.example/a/160120110929839111.html": ("160120110929839111", "160120110929839111"),
    "https://m.example/a/a160120110929839.html?x=1": ("a160120110929839", "a160120110929839"),
    "https://m.example/ab123.html": ("b123", ""),
    "https://m.example/news?x=12": ("https://m.example/news", ""),
    "12.html": ("12", ""),
    "x": ("x", ""),
    "": ("", ""),
    None: (None, None),
}


def test_url_key_and_long_id(spark):
    assert values(spark, urls.url_key, URLS) == [key for key, _ in URLS.values()]
    assert values(spark, lambda c: urls.url_id(c, urls.SLOT_ID_DIGITS), URLS) == [long for _, long in URLS.values()]


def test_url_key_offset(spark):
    cases = {"https://m.example/7.html": "7", "12.html": "", "abc12.html": "c12", "1234.html": "34", "no id": "", "": "", None: ""}
    assert values(spark, urls.url_key_offset, cases) == list(cases.values())


def test_first_id_wins(spark):
    assert values(spark, urls.url_key, ["http://a/1.html/22.html", "http://a/1.htm/22.html"]) == ["1", "22"]


def test_dates(spark):
    moments = ["2024-03-01 00:09:59", "2023-12-31 23:50:00"]
    as_time = lambda f: lambda c: f(F.to_timestamp(c))
    assert values(spark, as_time(dates.day_tag), moments) == ["20240301", "20231231"]
    assert values(spark, as_time(dates.yesterday_tag), moments) == ["20240229", "20231230"]
    assert values(spark, as_time(lambda c: dates.to_text(dates.midnight(c))), moments) == ["2024-03-01 00:00:00", "2023-12-31 00:00:00"]
    assert values(spark, as_time(lambda c: dates.to_text(dates.floor_to_run(c))), moments) == ["2024-03-01 00:00:00", "2023-12-31 23:50:00"]
    assert values(spark, lambda c: dates.epoch_seconds(dates.from_text(c)), moments) == [1709251799, 1704066600]


def test_date_texts(spark):
    assert values(spark, dates.compact_to_text, ["20180409111111", "20180409", "x"]) == ["2018-04-09 11:11:11", None, None]
    assert values(spark, lambda c: dates.tag_days_before(c, 4), ["20180302", "20180101", "20181301"]) == ["20180226", "20171228", None]
    assert values(spark, lambda c: dates.to_text(dates.from_text(c)), ["2018-13-01 00:00:00"]) == [None]


def test_run_bounds():
    assert dates.run_bounds("20240115101959") == (1705276800, 1705313400, "20240115")
    assert dates.run_bounds("20240115000500") == (1705190400, 1705276800, "20240114")
    assert dates.day_tags("20240302", 4) == ["20240227", "20240228", "20240229", "20240301", "20240302"]


def test_lenient_dates(spark):
    cases = {
        "2024-02-30 00:00:00": "2024-03-01 00:00:00", "2023-02-29 00:00:00": "2023-03-01 00:00:00", "2024-13-01 00:00:00": "2025-01-01 00:00:00",
        "2024-0-10 00:00:00": "2023-12-10 00:00:00", "2024-1-0 0:0:0": "2023-12-31 00:00:00", "2024-01-01 25:61:61": "2024-01-02 02:02:01",
        "2024-12-31 23:59:60": "2025-01-01 00:00:00", "2024-1-1 1:2:3 and more": "2024-01-01 01:02:03", "2024-25-60 0:0:0": "2026-03-01 00:00:00",
        "2024-03-01 00:09:59": "2024-03-01 00:09:59", "2024-01-400 00:00:00": "2025-02-03 00:00:00", "2024-1-1 -1:0:0": "2023-12-31 23:00:00",
        " 2024-01-01 00:00:00": None, "2024-01-01": None, "2024-01-01 10:20": None, "": None, None: None, "x": None,
    }
    assert values(spark, lambda c: dates.to_text(dates.from_text_lenient(c)), cases) == list(cases.values())
    assert values(spark, dates.from_text, ["2024-02-30 00:00:00"]) == [None]  # the strict form stays as it is


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(1600, 2400), st.integers(-30, 40), st.integers(-80, 400), *(st.integers(-90, 200) for _ in range(3))), min_size=20, max_size=40))
def test_lenient_dates_by_calendar_arithmetic(spark, fields):
    import datetime as dt

    texts, expected = [], []
    for year, month, day, hour, minute, second in fields:
        texts.append(f"{year}-{month}-{day} {hour}:{minute}:{second}")
        months = year * 12 + month - 1
        moment = dt.datetime(months // 12, months % 12 + 1, 1) + dt.timedelta(days=day - 1, hours=hour, minutes=minute, seconds=second)
        expected.append(str(moment))
    assert values(spark, lambda c: dates.to_text(dates.from_text_lenient(c)), texts) == expected
