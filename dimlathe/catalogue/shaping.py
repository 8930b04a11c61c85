"""Selection, alignment, inference, deduplication, ordering and key generation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimlathe.catalogue.registry import LOAD_TS, Tables, query
from dimlathe.functions.calendar import calendar
from dimlathe.functions.coerce import strict_integer
from dimlathe.operators import keys, shape
from dimlathe.operators.lookup import lookup, lookup_time_key
from dimlathe.registry import TableSpec

CUSTOMER = TableSpec(
    name="customer",
    area="dimensions",
    columns={
        "customer_key": "bigint",
        "customer_id": "bigint",
        "customer_name": "string",
        "nation_id": "bigint",
        "segment": "string",
        "balance": "double",
        "created_at": "timestamp_ntz",
        "source": "string",
    },
    surrogate="customer_key",
    natural=("customer_id",),
    compare=("customer_name", "nation_id", "balance"),
    unknown_text=("segment",),
)

ORDER = TableSpec(
    name="orders",
    area="facts",
    columns={
        "order_key": "bigint",
        "order_id": "bigint",
        "customer_key": "bigint",
        "time_key": "bigint",
        "year": "bigint",
        "status": "string",
        "price": "double",
        "created_at": "timestamp_ntz",
        "source": "string",
    },
    surrogate="order_key",
    natural=("order_id",),
    compare=("status", "price"),
    partition="year",
    foreign=("customer_key", "time_key"),
)

# The calendar of the order facts.
CALENDAR = ("1995-01-01", "2000-12-31")


def customers(t: Tables) -> DataFrame:
    """Customer rows under dimension names, one per id."""
    named = shape.pick(
        t.customer,
        {
            "c_custkey": "customer_id",
            "c_name": "customer_name",
            "c_nationkey": "nation_id",
            "c_mktsegment": "segment",
            "c_acctbal": "balance",
        },
    ).withColumn("nation_id", F.col("nation_id").cast("bigint"))
    return keys.keep_first(named, ["customer_id"], ["customer_name", "nation_id", "segment", "balance"])


def customer_dimension(t: Tables) -> DataFrame:
    keyed = keys.dense_key(customers(t), "customer_key", ["customer_id"])
    return shape.stamp_lineage(keyed, "csv", LOAD_TS)


def order_fact(t: Tables, buyers: DataFrame | None = None) -> DataFrame:
    """Orders with surrogate foreign keys, year and own key."""
    buyers = customer_dimension(t) if buyers is None else buyers
    named = shape.pick(
        t.orders,
        {
            "o_orderkey": "order_id",
            "o_custkey": "customer_id",
            "o_orderdate": "ordered_at",
            "o_orderstatus": "status",
            "o_totalprice": "price",
        },
    ).withColumns(
        {"year": F.year("ordered_at").cast("bigint"), "order_id": strict_integer("order_id", "order_id")}
    )
    keyed = keys.dense_key(named, "order_key", ["ordered_at", "order_id"])
    keyed = lookup(keyed, buyers, {"customer_id": "customer_id"}, {"customer_key": "customer_key"})
    keyed = lookup_time_key(keyed, "ordered_at", calendar(t.spark, *CALENDAR))
    return shape.stamp_lineage(keyed, "csv", LOAD_TS).select(*ORDER.columns)


_CUSTOMER_SQL = """
    SELECT row_number() OVER (ORDER BY c_custkey) AS customer_key, c_custkey AS customer_id,
           c_name AS customer_name, CAST(c_nationkey AS BIGINT) AS nation_id, c_mktsegment AS segment,
           c_acctbal AS balance, 'csv' AS source
    FROM customer
"""

_ORDER_SQL = """
    SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS order_key, o_orderkey AS order_id, customer_key,
           CASE WHEN CAST(o_orderdate AS DATE) BETWEEN DATE '1995-01-01' AND DATE '2000-12-31'
                THEN CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) + 1 AS BIGINT) END AS time_key,
           CAST(year(o_orderdate) AS BIGINT) AS year, o_orderstatus AS status, o_totalprice AS price, 'csv' AS source
    FROM orders LEFT JOIN (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS customer_key FROM customer)
        ON c_custkey = o_custkey
"""


@query("build_dimension", _CUSTOMER_SQL)
def build_dimension(t: Tables) -> DataFrame:
    return customer_dimension(t).drop("created_at")


@query(
    "conform_dimension",
    f"""
    SELECT customer_key, customer_id, customer_name, nation_id,
           CASE WHEN segment = 'FURNITURE' THEN 'unknown' ELSE segment END AS segment,
           CASE WHEN segment <> 'BUILDING' THEN balance END AS balance,
           '2024-03-01 00:00:00' AS created_at, source
    FROM ({_CUSTOMER_SQL})
    """,
)
def conform_dimension(t: Tables) -> DataFrame:
    dirty = customer_dimension(t)
    as_text = dirty.select(*(F.col(c).cast("string").alias(c) for c in reversed(dirty.columns))).withColumns(
        {
            "balance": F.when(F.col("segment") == "BUILDING", "n/a").otherwise(F.col("balance")),
            "segment": F.when(F.col("segment") == "FURNITURE", "nan").otherwise(F.col("segment")),
        }
    )
    return shape.conform(as_text, CUSTOMER).withColumn("created_at", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss"))


@query("build_fact", _ORDER_SQL)
def build_fact(t: Tables) -> DataFrame:
    return order_fact(t).drop("created_at")


@query(
    "conform_fact",
    f"SELECT order_key, order_id, customer_key, time_key, year, status, price, '2024-03-01' AS created_at, source"
    f" FROM ({_ORDER_SQL})",
)
def conform_fact(t: Tables) -> DataFrame:
    fact = order_fact(t)
    as_text = fact.select(*(F.col(c).cast("string").alias(c) for c in fact.columns))
    return shape.conform(as_text, ORDER).withColumn("created_at", F.col("created_at").cast("date").cast("string"))


@query(
    "infer_numeric_majority",
    rf"""
    WITH cells AS (
        SELECT CAST(o_orderkey AS VARCHAR) AS key_text, o_orderpriority AS priority,
               CASE WHEN o_orderstatus IN ('F', 'O') THEN CAST(o_custkey AS VARCHAR) ELSE 'n/a' END AS mostly,
               CASE WHEN o_orderstatus = 'F' THEN CAST(o_custkey AS VARCHAR) END AS rarely FROM orders),
    long AS (UNPIVOT (SELECT coalesce(key_text, '') AS key_text, coalesce(priority, '') AS priority,
                             coalesce(mostly, '') AS mostly, coalesce(rarely, '') AS rarely FROM cells)
             ON key_text, priority, mostly, rarely INTO NAME column_name VALUE cell)
    SELECT column_name, avg(CASE WHEN regexp_matches(cell, '^[0-9.]+$') THEN 1 ELSE 0 END) AS share,
           avg(CASE WHEN regexp_matches(cell, '^[0-9.]+$') THEN 1 ELSE 0 END) > 0.5 AS is_numeric
    FROM long GROUP BY column_name
    """,
)
def infer_numeric_majority(t: Tables) -> DataFrame:
    customer = F.col("o_custkey").cast("string")
    cells = t.orders.select(
        F.col("o_orderkey").cast("string").alias("key_text"),
        F.col("o_orderpriority").alias("priority"),
        F.when(F.col("o_orderstatus").isin("F", "O"), customer).otherwise("n/a").alias("mostly"),
        F.when(F.col("o_orderstatus") == "F", customer).alias("rarely"),
    )
    shares = shape.numeric_share(cells, cells.columns)
    long = shares.unpivot([], cells.columns, "column_name", "share")
    return long.withColumn("is_numeric", F.col("share") > 0.5)


@query(
    "select_existing_columns",
    "SELECT s_suppkey, s_name, s_acctbal, s_acctbal AS rating FROM supplier",
)
def select_existing_columns(t: Tables) -> DataFrame:
    supplier = t.supplier
    kept = shape.select_existing(supplier, ["s_suppkey", "s_name", "s_segment", "s_acctbal", "s_phone"])
    return kept.withColumn("rating", shape.first_existing(kept, "s_rating", "s_acctbal")).drop("s_phone", "s_fax")


@query(
    "union_align_schemas",
    """
    SELECT s_suppkey AS party_id, s_name AS party_name, s_acctbal AS balance, CAST(NULL AS VARCHAR) AS segment,
           CAST(NULL AS BIGINT) AS altitude FROM supplier
    UNION ALL
    SELECT c_custkey, c_name, NULL, c_mktsegment, NULL FROM customer
    """,
)
def union_align_schemas(t: Tables) -> DataFrame:
    suppliers = shape.pick(t.supplier, {"s_suppkey": "party_id", "s_name": "party_name", "s_acctbal": "balance"})
    buyers = shape.pick(t.customer, {"c_custkey": "party_id", "c_mktsegment": "segment", "c_name": "party_name"})
    return shape.align(suppliers, buyers).withColumn("altitude", F.lit(None).cast("bigint"))


@query(
    "ensure_schema_empty",
    """
    SELECT 'complete' AS input, count(*) AS rows, count(segment) AS segments
    FROM (SELECT c_mktsegment AS segment FROM customer)
    UNION ALL SELECT 'missing column', 0, 0
    UNION ALL SELECT 'no rows', count(*), 0 FROM customer WHERE c_mktsegment = 'NONE'
    UNION ALL SELECT 'completed', count(*), 0 FROM supplier
    """,
)
def ensure_schema_empty(t: Tables) -> DataFrame:
    declared = T.StructType.fromDDL("id bigint, name string, segment string")
    required = ["id", "name"]
    buyers = shape.pick(t.customer, {"c_custkey": "id", "c_name": "name", "c_mktsegment": "segment"})
    sellers = shape.pick(t.supplier, {"s_suppkey": "id", "s_name": "name"})
    inputs = {
        "complete": buyers,
        "missing column": sellers.drop("name"),
        "no rows": buyers.where(F.col("segment") == "NONE"),
        "completed": sellers,
    }
    counted = None
    for name, df in inputs.items():
        whole = shape.guarded(df, required, declared, lambda x: x)
        row = whole.agg(F.count("*").alias("rows"), F.count("segment").alias("segments"))
        row = row.select(F.lit(name).alias("input"), "rows", "segments")
        counted = row if counted is None else counted.union(row)
    return counted


@query(
    "dedup_keep_first",
    """
    SELECT user_id, event_type, event_id, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1
    """,
)
def dedup_keep_first(t: Tables) -> DataFrame:
    first = keys.keep_first(t.events, ["user_id", "event_type"], ["ts", "event_id"])
    return first.select("user_id", "event_type", "event_id", "value")


@query("distinct_rows", "SELECT DISTINCT event_type, user_id FROM events")
def distinct_rows(t: Tables) -> DataFrame:
    return t.events.select("event_type", "user_id").distinct()


@query(
    "dense_surrogate_key",
    """
    SELECT o_orderkey, row_number() OVER (ORDER BY CASE WHEN o_totalprice >= 20000 THEN o_orderdate END NULLS LAST,
                                                   o_orderkey) AS order_key
    FROM orders
    """,
)
def dense_surrogate_key(t: Tables) -> DataFrame:
    dated = t.orders.select("o_orderkey", F.when(F.col("o_totalprice") >= 20000, F.col("o_orderdate")).alias("day"))
    return keys.dense_key(dated, "order_key", ["day", "o_orderkey"]).drop("day")


@query(
    "append_surrogate_keys",
    """
    SELECT o_orderkey, row_number() OVER (ORDER BY o_orderstatus <> 'F', o_orderdate, o_orderkey) AS order_key FROM orders
    """,
)
def append_surrogate_keys(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_orderdate", "o_orderstatus")
    old, new = orders.where("o_orderstatus = 'F'"), orders.where("o_orderstatus <> 'F'")
    keyed = keys.dense_key(old, "order_key", ["o_orderdate", "o_orderkey"])
    added = keys.append_keys(new, keyed, "order_key", ["o_orderdate", "o_orderkey"])
    return keyed.unionByName(added).select("o_orderkey", "order_key")


@query(
    "pseudo_id_range",
    """
    SELECT o_orderkey, 10000000 + row_number() OVER (ORDER BY year(o_orderdate), month(o_orderdate), o_totalprice,
                                                     o_orderkey) AS pseudo_id
    FROM orders
    """,
)
def pseudo_id_range(t: Tables) -> DataFrame:
    parts = t.orders.select(
        "o_orderkey", F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"), "o_totalprice"
    )
    ranked = keys.dense_key(parts, "pseudo_id", ["y", "m", "o_totalprice", "o_orderkey"], start=10_000_000)
    return ranked.select("o_orderkey", "pseudo_id")


@query(
    "next_id_with_fallback",
    """
    SELECT o_orderstatus, count(*) AS orders,
           (SELECT coalesce(max(o_orderkey), 10000) + 1 FROM orders WHERE o_orderstatus IS DISTINCT FROM 'F') AS next_id,
           10001 + (SELECT count(*) FROM orders WHERE o_orderstatus = 'none') AS next_fallback
    FROM orders GROUP BY o_orderstatus
    """,
)
def next_id_with_fallback(t: Tables) -> DataFrame:
    orders = t.orders
    largest = keys.max_id_outside(orders, "o_orderkey", "o_orderstatus", "F", 10_000)
    none_left = keys.max_id_outside(orders.where("o_orderstatus = 'F'"), "o_orderkey", "o_orderstatus", "F", 10_000)
    return orders.groupBy("o_orderstatus").agg(F.count("*").alias("orders")).select(
        "o_orderstatus", "orders", (largest + 1).alias("next_id"), (none_left + 1).alias("next_fallback")
    )


@query(
    "sort_numeric_text",
    """
    SELECT p_partkey, size_text,
           row_number() OVER (ORDER BY TRY_CAST(size_text AS BIGINT) NULLS LAST, p_partkey) AS numeric_rank,
           row_number() OVER (ORDER BY size_text NULLS LAST, p_partkey) AS text_rank
    FROM (SELECT p_partkey, CASE WHEN p_type = 'SMALL' THEN NULL ELSE CAST(p_size AS VARCHAR) END AS size_text FROM part)
    """,
)
def sort_numeric_text(t: Tables) -> DataFrame:
    sizes = t.part.select(
        "p_partkey", F.when(F.col("p_type") != "SMALL", F.col("p_size").cast("string")).alias("size_text")
    )
    by_number = keys.dense_key(sizes, "numeric_rank", [shape.numeric_text_order("size_text"), "p_partkey"])
    return keys.dense_key(by_number, "text_rank", ["size_text", "p_partkey"])
