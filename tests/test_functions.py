from datetime import date

import pytest
from pyspark.sql import functions as F

from dimlathe.functions import coerce, text
from dimlathe.functions.calendar import calendar


def values(df, column):
    return [r[0] for r in df.orderBy("n").select(column).collect()]


@pytest.fixture
def texts(rows):
    def make(*cells):
        return rows("n int, c string", *enumerate(cells))

    return make


def test_missing_tokens_become_unknown(texts):
    df = texts(None, "None", "NaT", "nan", "", "<NA>", "\\N", "British")
    assert values(df, coerce.unknown_if_missing("c")) == ["unknown"] * 7 + ["British"]


def test_numbers(texts):
    df = texts("1.5", "abc", "nan", "1d", "1_0", None, " 7 ", "-2e3", "inf", ".5", "5.")
    expected = [1.5, None, None, None, None, None, 7.0, -2000.0, float("inf"), 0.5, 5.0]
    assert values(df, coerce.to_number("c")) == expected


def test_integers(texts):
    df = texts("5", "5.0", "5.5", "9007199254740993", "99999999999999999999", "x", None, "inf")
    assert values(df, coerce.to_integer("c")) == [5, 5, None, 9007199254740993, None, None, None, None]


def test_integer_or_zero_truncates(texts):
    assert values(texts("3.9", "-3.9", "x", None), coerce.to_integer_or_zero("c")) == [3, -3, 0, 0]


def test_seconds_round_half_to_even(rows):
    df = rows("n int, s double", (0, 22.5005), (1, 22.5015), (2, 0.0005), (3, 0.0015), (4, None))
    assert values(df, coerce.seconds_to_millis("s")) == [22500, 22502, 0, 2, None]


def test_pit_duration_with_minutes_is_not_a_number(texts):
    assert values(texts("1:02.1"), coerce.seconds_to_millis(coerce.to_number("c"))) == [None]


def test_duration_text(texts):
    df = texts("1:27.452", "1:02.026", "58.9", "1:02:03", "", "x:y", None, "0:59")
    assert values(df, coerce.duration_to_millis("c")) == [87452, 62025, 58900, None, None, None, None, 59000]
    assert values(df, coerce.duration_to_millis("c", exact=True))[:3] == [87452, 62026, 58900]


def test_duration_text_agrees_with_double_arithmetic_for_a_whole_minute(spark):
    df = spark.range(60_000).select(
        F.format_string("1:%02d.%03d", F.floor(F.col("id") / 1000), F.col("id") % 1000).alias("c"), "id"
    )
    got = df.select("id", coerce.duration_to_millis("c").alias("ms")).collect()
    assert all(r.ms == int((60 + float(f"{r.id // 1000}.{r.id % 1000:03d}")) * 1000) for r in got)


def test_dates(texts):
    df = texts("2024-02-30", "2024-02-29", "2024-2-9", "2024-02-29 10:00:00", "29/02/2024", None)
    got = values(df, coerce.to_date("c"))
    assert got == [None, date(2024, 2, 29), date(2024, 2, 9), date(2024, 2, 29), None, None]


def test_clock(texts):
    df = texts("13:05:00", "13:05:00Z", "25:00:00", "9:5:1", "13:05", "12:60:00", None)
    assert values(df, coerce.to_clock("c")) == ["13:05:00", "13:05:00", None, "09:05:01", None, None, None]


def test_calendar_attributes(spark):
    days = {str(r.full_date): r for r in calendar(spark).collect()}
    assert len(days) == 6940
    sunday, monday = days["2024-03-31"], days["2024-04-01"]
    assert (sunday.day_of_week, sunday.quarter, sunday.week_of_month, sunday.is_weekend) == (7, "Q1", 5, True)
    assert (monday.day_of_week, monday.quarter, monday.week_of_month, monday.is_weekday) == (1, "Q2", 1, True)
    assert (sunday.day_name, sunday.day_name_short, sunday.month_name) == ("Sunday", "Sun", "March")
    assert sorted(r.time_key for r in days.values()) == list(range(1, 6941))


def test_text_helpers(rows):
    df = rows("n int, a string, b string", (0, "Ann", "Lee"), (1, "Ann", None))
    assert values(df, text.full_name(F.col("a"), F.col("b"))) == ["Ann Lee", None]
    assert values(df, text.text_or(F.col("b"), "not held")) == ["Lee", "not held"]
    assert values(df, text.contains_ci(F.col("b"), "LE")) == [True, False]
    assert values(df, text.contains_ci(F.col("a"), "a.n")) == [False, False]
    assert values(df, text.composite_text(F.lit(2024), F.lit(7), pad_last=2)) == ["2024_07"] * 2
    assert values(df, text.composite_text(F.lit(2024), F.lit(123), pad_last=2)) == ["2024_123"] * 2


def test_strict_integer_names_the_column(texts):
    assert values(texts("5", " 7 "), coerce.strict_integer("c", "race_id")) == [5, 7]
    with pytest.raises(Exception, match="race_id must be an integer, found NULL"):
        values(texts("5", None), coerce.strict_integer("c", "race_id"))
