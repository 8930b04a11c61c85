"""Denormalising views over facts and dimensions, and table checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimlathe.catalogue.registry import Tables, query
from dimlathe.functions.calendar import calendar
from dimlathe.functions.text import full_name, text_or
from dimlathe.operators import quality
from dimlathe.plans.star import Hop, star


def _days(t: Tables, first: str, last: str) -> DataFrame:
    return calendar(t.spark, first, last).select("time_key", "full_date", "day_name", "quarter")


@query(
    "view_dim_pair",
    """
    SELECT o_orderkey, o_custkey, c_name,
           CASE WHEN o_orderstatus = 'P' THEN 'not held' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS ordered_on,
           CASE WHEN o_orderstatus = 'F' THEN CAST(c_nationkey AS VARCHAR) ELSE 'not held' END AS nation
    FROM orders JOIN customer ON c_custkey = o_custkey
    """,
)
def view_dim_pair(t: Tables) -> DataFrame:
    joined = star(t.orders, Hop(t.customer, {"o_custkey": "c_custkey"}))
    status = F.col("o_orderstatus")
    view = joined.select(
        "o_orderkey",
        "o_custkey",
        "c_name",
        text_or(F.when(status != "P", F.col("o_orderdate").cast("date")), "not held").alias("ordered_on"),
        text_or(F.when(status == "F", F.col("c_nationkey")), "not held").alias("nation"),
    )
    view.createOrReplaceTempView("orders_customers")
    return t.spark.table("orders_customers")


ORDER_LINES_SQL = """
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, c_name || ' ' || n_name AS customer_name,
           p_name, p_brand, CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) + 1 AS BIGINT) AS time_key,
           strftime(o_orderdate, '%Y-%m-%d') AS full_date, dayname(o_orderdate) AS day_name
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
         JOIN nation ON n_nationkey = c_nationkey JOIN part ON p_partkey = l_partkey
    WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1995-01-01' AND DATE '2001-12-31'
"""


def order_lines(t: Tables, segment: str | None = None) -> DataFrame:
    """Order lines with customer, nation, part and day; optionally of one market segment."""
    customer = t.customer if segment is None else t.customer.where(F.col("c_mktsegment") == segment)
    joined = star(
        t.lineitem,
        Hop(t.orders.withColumn("ordered_on", F.col("o_orderdate").cast("date")), {"l_orderkey": "o_orderkey"}),
        Hop(customer, {"o_custkey": "c_custkey"}),
        Hop(t.nation, {"c_nationkey": "n_nationkey"}),
        Hop(t.part, {"l_partkey": "p_partkey"}),
        Hop(_days(t, "1995-01-01", "2001-12-31"), {"ordered_on": "full_date"}),
    )
    return joined.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_quantity",
        "l_extendedprice",
        full_name(F.col("c_name"), F.col("n_name")).alias("customer_name"),
        "p_name",
        "p_brand",
        "time_key",
        F.col("full_date").cast("string").alias("full_date"),
        "day_name",
    )


@query("view_order_lines", ORDER_LINES_SQL)
def view_order_lines(t: Tables) -> DataFrame:
    return order_lines(t)


@query("view_order_lines_filtered", ORDER_LINES_SQL + " AND c_mktsegment = 'BUILDING'")
def view_order_lines_filtered(t: Tables) -> DataFrame:
    return order_lines(t, segment="BUILDING")


@query(
    "view_orders_star",
    """
    SELECT o_orderkey, o_totalprice, c_name, n_name || ' ' || r_name AS place,
           strftime(o_orderdate, '%Y-%m-%d') AS full_date, 'Q' || CAST(quarter(o_orderdate) AS VARCHAR) AS quarter
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
         JOIN region ON r_regionkey = n_regionkey
    WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1995-01-01' AND DATE '2001-12-31'
    """,
)
def view_orders_star(t: Tables) -> DataFrame:
    joined = star(
        t.orders.withColumn("ordered_on", F.col("o_orderdate").cast("date")),
        Hop(t.customer, {"o_custkey": "c_custkey"}),
        Hop(t.nation, {"c_nationkey": "n_nationkey"}),
        Hop(t.region, {"n_regionkey": "r_regionkey"}),
        Hop(_days(t, "1995-01-01", "2001-12-31"), {"ordered_on": "full_date"}),
    )
    place = full_name(F.col("n_name"), F.col("r_name")).alias("place")
    return joined.select(
        "o_orderkey", "o_totalprice", "c_name", place, F.col("full_date").cast("string").alias("full_date"), "quarter"
    )


@query(
    "view_events_star",
    """
    SELECT event_id, event_type, value, c_name || ' ' || n_name AS who, strftime(ts, '%Y-%m-%d') AS full_date,
           dayname(ts) AS day_name
    FROM events JOIN customer ON c_custkey = user_id JOIN nation ON n_nationkey = c_nationkey
    WHERE year(ts) = 2024
    """,
)
def view_events_star(t: Tables) -> DataFrame:
    joined = star(
        t.events.withColumn("day", F.col("ts").cast("date")),
        Hop(t.customer, {"user_id": "c_custkey"}),
        Hop(t.nation, {"c_nationkey": "n_nationkey"}),
        Hop(_days(t, "2024-01-01", "2024-12-31"), {"day": "full_date"}),
    )
    who = full_name(F.col("c_name"), F.col("n_name")).alias("who")
    return joined.select(
        "event_id", "event_type", "value", who, F.col("full_date").cast("string").alias("full_date"), "day_name"
    )


@query(
    "dup_key_check",
    """
    SELECT 'lineitem' AS table_name, l_orderkey, l_linenumber, count(*) AS count FROM lineitem
    GROUP BY ALL HAVING count(*) > 1
    UNION ALL SELECT 'customer', c_custkey, NULL, count(*) FROM customer GROUP BY ALL HAVING count(*) > 1
    UNION ALL SELECT 'orders', o_orderkey, NULL, count(*) FROM orders GROUP BY ALL HAVING count(*) > 1
    """,
)
def dup_key_check(t: Tables) -> DataFrame:
    lines = quality.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])
    checks = lines.select(F.lit("lineitem").alias("table_name"), "l_orderkey", "l_linenumber", "count")
    for name, key in (("customer", "c_custkey"), ("orders", "o_orderkey")):
        found = quality.duplicate_keys(getattr(t, name), [key])
        checks = checks.union(found.select(F.lit(name), key, F.lit(None).cast("int"), "count"))
    return checks


@query(
    "lineage_profile",
    "SELECT event_type, count(*) AS rows, min(event_id) AS min_id, max(event_id) AS max_id FROM events GROUP BY event_type",
)
def lineage_profile(t: Tables) -> DataFrame:
    return quality.lineage_profile(t.events, "event_type", "event_id")


@query(
    "distinct_counts",
    """
    SELECT (SELECT count(DISTINCT user_id) FROM events) AS users,
           (SELECT count(*) FROM (SELECT DISTINCT user_id, event_type FROM events)) AS pairs
    """,
)
def distinct_counts(t: Tables) -> DataFrame:
    return quality.distinct_counts(t.events, users=["user_id"], pairs=["user_id", "event_type"])


@query(
    "orphan_check",
    """
    SELECT 'l_orderkey' AS key, count(*) FILTER (WHERE o_orderkey IS NULL) AS orphans
    FROM lineitem LEFT JOIN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') ON o_orderkey = l_orderkey
    UNION ALL
    SELECT 'l_partkey', count(*) FILTER (WHERE p_partkey IS NULL) FROM lineitem LEFT JOIN part ON p_partkey = l_partkey
    """,
)
def orphan_check(t: Tables) -> DataFrame:
    held = t.orders.where("o_orderstatus <> 'P'")
    return quality.orphan_counts(
        t.lineitem, {"l_orderkey": (held, "o_orderkey"), "l_partkey": (t.part, "p_partkey")}
    )
