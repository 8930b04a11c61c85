"""Key lookups and membership tests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimlathe.catalogue.registry import Tables, query
from dimlathe.catalogue.shaping import customer_dimension, order_fact
from dimlathe.functions.calendar import calendar
from dimlathe.operators import keys, lookup


@query(
    "lookup_surrogate_key",
    """
    SELECT o_orderkey, CASE c_mktsegment WHEN 'MACHINERY' THEN NULL WHEN 'BUILDING' THEN c_custkey + 1000000000
                            ELSE c_custkey END AS customer_key
    FROM orders LEFT JOIN customer ON c_custkey = o_custkey
    """,
)
def lookup_surrogate_key(t: Tables) -> DataFrame:
    known = t.customer.where("c_mktsegment <> 'MACHINERY'")
    first = known.select("c_custkey", F.lit(1).alias("version"), F.col("c_custkey").alias("customer_key"))
    second = known.where("c_mktsegment = 'BUILDING'").select(
        "c_custkey", F.lit(2).alias("version"), (F.col("c_custkey") + 1_000_000_000).alias("customer_key")
    )
    found = lookup.lookup(
        t.orders, second.unionByName(first), {"o_custkey": "c_custkey"}, {"customer_key": "customer_key"},
        last_by=["version"],
    )
    return found.select("o_orderkey", "customer_key")


@query(
    "lookup_composite_key",
    """
    WITH kinds AS (SELECT p_brand, p_type, row_number() OVER (ORDER BY p_brand, p_type) AS group_key
                   FROM (SELECT DISTINCT p_brand, p_type FROM part))
    SELECT group_key, count(*) AS lines, count(DISTINCT l_partkey) AS parts
    FROM lineitem LEFT JOIN part ON p_partkey = l_partkey LEFT JOIN kinds USING (p_brand, p_type) GROUP BY group_key
    """,
)
def lookup_composite_key(t: Tables) -> DataFrame:
    kinds = keys.dense_key(t.part.select("p_brand", "p_type").distinct(), "group_key", ["p_brand", "p_type"])
    lines = lookup.lookup(
        t.lineitem.select("l_partkey"), t.part, {"l_partkey": "p_partkey"}, {"p_brand": "brand", "p_type": "type"}
    )
    keyed = lookup.lookup(lines, kinds, {"brand": "p_brand", "type": "p_type"}, {"group_key": "group_key"})
    return keyed.groupBy("group_key").agg(
        F.count("*").alias("lines"), F.count_distinct("l_partkey").alias("parts")
    )


@query(
    "lookup_reverse_key",
    "SELECT o_orderkey AS order_id, c_custkey AS customer_id, c_name AS customer_name"
    " FROM orders LEFT JOIN customer ON c_custkey = o_custkey",
)
def lookup_reverse_key(t: Tables) -> DataFrame:
    buyers = customer_dimension(t)
    fact = order_fact(t, buyers).select("order_id", "customer_key")
    names = {"customer_id": "customer_id", "customer_name": "customer_name"}
    return lookup.lookup(fact, buyers, {"customer_key": "customer_key"}, names).drop("customer_key")


@query(
    "lookup_time_key",
    """
    SELECT time_key, count(*) AS lines, max(l_quantity) AS max_quantity
    FROM (SELECT l_quantity,
                 CASE WHEN CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'
                      THEN CAST(date_diff('day', DATE '1996-01-01', CAST(o_orderdate AS DATE)) + 1 AS BIGINT) END
                     AS time_key
          FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey)
    GROUP BY time_key
    """,
)
def lookup_time_key(t: Tables) -> DataFrame:
    days = calendar(t.spark, "1996-01-01", "2000-12-31")
    lines = t.lineitem.select("l_orderkey", "l_quantity")
    dated = lookup.lookup_by_date(lines, "l_orderkey", t.orders, "o_orderkey", "o_orderdate", days)
    return dated.groupBy("time_key").agg(F.count("*").alias("lines"), F.max("l_quantity").alias("max_quantity"))


@query(
    "lookup_via_bridge_fact",
    """
    WITH bridge AS (
        SELECT l_orderkey, l_partkey, l_suppkey FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY l_linenumber DESC, l_suppkey DESC) = 1)
    SELECT r.l_orderkey, r.l_partkey, r.l_linenumber, r.l_quantity, r.l_extendedprice, bridge.l_suppkey AS supplier_key
    FROM lineitem r LEFT JOIN bridge USING (l_orderkey, l_partkey) WHERE r.l_returnflag = 'R'
    """,
)
def lookup_via_bridge_fact(t: Tables) -> DataFrame:
    returned = t.lineitem.where("l_returnflag = 'R'").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice"
    )
    return lookup.lookup_via_bridge(
        returned, t.lineitem, ["l_orderkey", "l_partkey"], "l_suppkey", ["l_linenumber", "l_suppkey"], "supplier_key"
    )


@query(
    "anti_join_new_rows",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'F'",
)
def anti_join_new_rows(t: Tables) -> DataFrame:
    stored = t.orders.where("o_orderstatus = 'F'")
    return lookup.unseen(t.orders, stored, ["o_orderkey"]).select("o_orderkey", "o_totalprice")


@query(
    "anti_join_composite",
    """
    WITH b AS (SELECT l_orderkey, CASE WHEN l_quantity > 5 THEN l_partkey END AS part, l_linenumber, l_extendedprice,
                      l_returnflag FROM lineitem)
    SELECT l_orderkey, part, l_linenumber, l_extendedprice FROM b
    WHERE NOT EXISTS (SELECT 1 FROM b e WHERE e.l_returnflag = 'R' AND e.l_orderkey = b.l_orderkey
                      AND e.part IS NOT DISTINCT FROM b.part)
    """,
)
def anti_join_composite(t: Tables) -> DataFrame:
    lines = t.lineitem.select(
        "l_orderkey", F.when(F.col("l_quantity") > 5, F.col("l_partkey")).alias("part"), "l_linenumber",
        "l_extendedprice", "l_returnflag",
    )
    stored = lines.where("l_returnflag = 'R'")
    return lookup.unseen(lines, stored, ["l_orderkey", "part"], null_safe=True).drop("l_returnflag")


@query(
    "fk_miss_audit",
    """
    WITH f AS (SELECT o_custkey, c_custkey, CAST(o_orderdate AS DATE) <= DATE '2000-12-31' AS dated
               FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'MACHINERY') ON c_custkey = o_custkey)
    SELECT 'customer_key' AS key, count(*) FILTER (WHERE c_custkey IS NULL) AS rows,
           count(DISTINCT CASE WHEN c_custkey IS NULL THEN o_custkey END) AS distinct_values FROM f
    UNION ALL
    SELECT 'time_key', count(*) FILTER (WHERE NOT dated), NULL FROM f
    """,
)
def fk_miss_audit(t: Tables) -> DataFrame:
    known = t.customer.where("c_mktsegment <> 'MACHINERY'")
    fact = lookup.lookup(t.orders, known, {"o_custkey": "c_custkey"}, {"c_custkey": "customer_key"})
    fact = lookup.lookup_time_key(fact, "o_orderdate", calendar(t.spark, "1995-01-01", "2000-12-31"))
    names = ["customer_key", "time_key"]
    misses = lookup.miss_counts(fact, names).unpivot([], names, "key", "rows")
    lost = lookup.unresolved_values(fact, "customer_key", ["o_custkey"])
    listed = lost.agg(F.count("*").alias("distinct_values")).select(F.lit("customer_key").alias("key"), "distinct_values")
    return misses.join(listed, "key", "left")
