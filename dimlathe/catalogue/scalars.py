"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimlathe.catalogue.registry import Tables, query
from dimlathe.functions import coerce, text
from dimlathe.functions.calendar import expand_calendar


def _by(column: str, cases: dict, default) -> F.Column:
    chosen = None
    for value, result in cases.items():
        test = F.col(column) == value
        chosen = F.when(test, result) if chosen is None else chosen.when(test, result)
    return chosen.otherwise(default)


@query(
    "normalize_unknown",
    """
    SELECT c_custkey,
           CASE WHEN raw IS NULL OR raw IN ('None', 'NaT', 'nan', '', '<NA>', '\\N') THEN 'unknown' ELSE raw END
               AS segment
    FROM (SELECT c_custkey,
                 CASE c_nationkey WHEN 0 THEN NULL WHEN 1 THEN 'None' WHEN 2 THEN 'NaT' WHEN 3 THEN 'nan'
                      WHEN 4 THEN '' WHEN 5 THEN '<NA>' WHEN 6 THEN '\\N' ELSE c_mktsegment END AS raw
          FROM customer)
    """,
)
def normalize_unknown(t: Tables) -> DataFrame:
    raw = _by("c_nationkey", {0: F.lit(None)} | dict(enumerate(coerce.MISSING_TOKENS, 1)), F.col("c_mktsegment"))
    return t.customer.select("c_custkey", coerce.unknown_if_missing(raw).alias("segment"))


_NUMBER = r"'^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$'"


@query(
    "coerce_numeric",
    rf"""
    SELECT o_orderkey, number,
           CASE WHEN number = floor(number) THEN CAST(number AS BIGINT) END AS whole,
           CAST(trunc(coalesce(number, 0)) AS BIGINT) AS whole_or_zero
    FROM (SELECT o_orderkey,
                 CASE WHEN regexp_matches(raw, {_NUMBER}) THEN TRY_CAST(trim(raw) AS DOUBLE) END AS number
          FROM (SELECT o_orderkey,
                       CASE o_orderpriority
                           WHEN '1-URGENT' THEN CASE o_orderstatus WHEN 'F' THEN 'abc' WHEN 'O' THEN 'nan' ELSE '1d' END
                           WHEN '2-HIGH' THEN CASE o_orderstatus WHEN 'F' THEN '1_0' WHEN 'O' THEN NULL ELSE '' END
                           WHEN '3-MEDIUM' THEN ' ' || CAST(o_orderkey AS VARCHAR) || ' '
                           WHEN '4-NOT SPECIFIED' THEN '-' || CAST(o_orderkey AS VARCHAR) || '.75'
                           ELSE CAST(o_custkey AS VARCHAR) || '.0' END AS raw
                FROM orders))
    """,
)
def coerce_numeric(t: Tables) -> DataFrame:
    key = F.col("o_orderkey").cast("string")
    raw = _by(
        "o_orderpriority",
        {
            "1-URGENT": _by("o_orderstatus", {"F": F.lit("abc"), "O": F.lit("nan")}, F.lit("1d")),
            "2-HIGH": _by("o_orderstatus", {"F": F.lit("1_0"), "O": F.lit(None)}, F.lit("")),
            "3-MEDIUM": F.concat(F.lit(" "), key, F.lit(" ")),
            "4-NOT SPECIFIED": F.concat(F.lit("-"), key, F.lit(".75")),
        },
        F.concat(F.col("o_custkey").cast("string"), F.lit(".0")),
    )
    return t.orders.select("o_orderkey", raw.alias("raw")).select(
        "o_orderkey",
        coerce.to_number("raw").alias("number"),
        coerce.to_integer("raw").alias("whole"),
        coerce.to_integer_or_zero("raw").alias("whole_or_zero"),
    )


@query(
    "seconds_to_millis",
    """
    SELECT event_id, CAST(round_even(value * 1000, 0) AS BIGINT) AS millis,
           CAST(round_even((event_id + 0.5) / 1000 * 1000, 0) AS BIGINT) AS half_millis
    FROM events
    """,
)
def seconds_to_millis(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id",
        coerce.seconds_to_millis("value").alias("millis"),
        coerce.seconds_to_millis((F.col("event_id") + F.lit(0.5)) / 1000).alias("half_millis"),
    )


_DURATION_RAW = """
    SELECT event_id,
           CASE event_type WHEN 'signup' THEN '' WHEN 'error' THEN '1:02:' || CAST(value AS VARCHAR)
                WHEN 'view' THEN CAST(value AS VARCHAR) WHEN 'click' THEN 'x:' || CAST(value AS VARCHAR)
                ELSE CAST(user_id AS VARCHAR) || ':' || CAST(value AS VARCHAR) END AS raw,
           event_type, user_id, value
    FROM events
"""


@query(
    "duration_text_to_millis",
    f"""
    SELECT event_id, raw,
           CASE event_type WHEN 'view' THEN CAST(trunc(value * 1000) AS BIGINT)
                WHEN 'purchase' THEN CAST(trunc((user_id * 60 + value) * 1000) AS BIGINT) END AS millis,
           CASE event_type WHEN 'view' THEN CAST(CAST(value AS DECIMAL(18, 6)) * 1000 AS BIGINT)
                WHEN 'purchase' THEN CAST((user_id * 60 + CAST(value AS DECIMAL(18, 6))) * 1000 AS BIGINT) END
               AS exact_millis
    FROM ({_DURATION_RAW})
    """,
)
def duration_text_to_millis(t: Tables) -> DataFrame:
    value = F.col("value").cast("string")
    raw = _by(
        "event_type",
        {
            "signup": F.lit(""),
            "error": F.concat(F.lit("1:02:"), value),
            "view": value,
            "click": F.concat(F.lit("x:"), value),
        },
        F.concat(F.col("user_id").cast("string"), F.lit(":"), value),
    )
    return t.events.select("event_id", raw.alias("raw")).select(
        "event_id",
        "raw",
        coerce.duration_to_millis("raw").alias("millis"),
        coerce.duration_to_millis("raw", exact=True).alias("exact_millis"),
    )


@query(
    "parse_dates",
    """
    SELECT event_id,
           CASE event_type WHEN 'click' THEN NULL WHEN 'error' THEN NULL
                ELSE strftime(ts, '%Y-%m-%d') END AS day,
           CASE event_type WHEN 'click' THEN NULL WHEN 'error' THEN NULL WHEN 'view' THEN strftime(ts, '%Y-%m-%d 00:00:00')
                ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS moment
    FROM events
    """,
)
def parse_dates(t: Tables) -> DataFrame:
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    raw = _by(
        "event_type",
        {
            "click": F.concat(F.date_format("ts", "yyyy-MM"), F.lit("-32")),
            "error": F.concat(F.lit("day "), stamp),
            "view": F.date_format("ts", "yyyy-MM-dd"),
            "signup": F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"),
        },
        stamp,
    )
    return t.events.select("event_id", raw.alias("raw")).select(
        "event_id",
        coerce.to_date("raw").cast("string").alias("day"),
        F.date_format(coerce.to_timestamp("raw"), "yyyy-MM-dd HH:mm:ss").alias("moment"),
    )


@query(
    "parse_times",
    """
    SELECT event_id,
           CASE event_type WHEN 'click' THEN NULL WHEN 'error' THEN NULL
                ELSE strftime(ts, '%H:%M:%S') END AS clock
    FROM events
    """,
)
def parse_times(t: Tables) -> DataFrame:
    clock = F.date_format("ts", "HH:mm:ss")
    raw = _by(
        "event_type",
        {
            "click": F.concat(F.lit("25:"), F.date_format("ts", "mm:ss")),
            "error": F.date_format("ts", "HH:mm"),
            "view": F.concat(clock, F.lit("Z")),
            "signup": F.date_format("ts", "H:m:s"),
        },
        clock,
    )
    return t.events.select("event_id", coerce.to_clock(raw).alias("clock"))


@query(
    "composite_text_key",
    """
    SELECT o_orderkey,
           CAST(year(o_orderdate) AS VARCHAR) || '_' || CAST(month(o_orderdate) AS VARCHAR) AS plain,
           CAST(year(o_orderdate) AS VARCHAR) || '_' || lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') AS padded,
           CAST(year(o_orderdate) AS VARCHAR) || '_' ||
               CASE WHEN length(CAST(o_custkey AS VARCHAR)) < 3 THEN lpad(CAST(o_custkey AS VARCHAR), 3, '0')
                    ELSE CAST(o_custkey AS VARCHAR) END AS never_cut
    FROM orders
    """,
)
def composite_text_key(t: Tables) -> DataFrame:
    year, month = F.year("o_orderdate"), F.month("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        text.composite_text(year, month).alias("plain"),
        text.composite_text(year, month, pad_last=2).alias("padded"),
        text.composite_text(year, F.col("o_custkey"), pad_last=3).alias("never_cut"),
    )


@query(
    "filter_contains_ci",
    """
    SELECT p_partkey, p_name FROM part
    WHERE CASE WHEN p_type = 'SMALL' THEN NULL ELSE lower(p_name) END LIKE '%widget%'
    """,
)
def filter_contains_ci(t: Tables) -> DataFrame:
    name = F.when(F.col("p_type") != "SMALL", F.col("p_name"))
    return t.part.where(text.contains_ci(name, "WIDGET")).select("p_partkey", "p_name")


@query(
    "calendar_dimension",
    """
    WITH days AS (
        SELECT unnest(generate_series(CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE), INTERVAL 1 DAY))
                   AS d, CAST(min(o_orderdate) AS DATE) AS first_day FROM orders),
    used AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1)
    SELECT CAST(date_diff('day', first_day, days.d) + 1 AS BIGINT) AS time_key, strftime(days.d, '%Y-%m-%d') AS full_date,
           CAST(year(days.d) AS BIGINT) AS year, CAST(month(days.d) AS BIGINT) AS month,
           CAST(day(days.d) AS BIGINT) AS day_of_month,
           CAST(isodow(days.d) AS BIGINT) AS day_of_week, dayname(days.d) AS day_name,
           strftime(days.d, '%a') AS day_name_short, monthname(days.d) AS month_name,
           'Q' || CAST(quarter(days.d) AS VARCHAR) AS quarter,
           CAST((day(days.d) - 1) // 7 + 1 AS BIGINT) AS week_of_month,
           isodow(days.d) >= 6 AS is_weekend, isodow(days.d) < 6 AS is_weekday,
           CAST(coalesce(n, 0) AS BIGINT) AS orders
    FROM days LEFT JOIN used ON used.d = days.d
    """,
)
def calendar_dimension(t: Tables) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    bounds = t.orders.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))
    used = t.orders.groupBy(day.alias("full_date")).agg(F.count("*").alias("orders"))
    counted = expand_calendar(bounds).join(used, "full_date", "left")
    columns = [c for c in counted.columns if c not in ("full_date", "orders")]
    return counted.select(
        columns[0],
        F.col("full_date").cast("string").alias("full_date"),
        *columns[1:],
        F.coalesce("orders", F.lit(0)).cast("bigint").alias("orders"),
    )
