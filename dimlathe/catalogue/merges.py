"""Upserts, replacements and increments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimlathe.catalogue.registry import CATALOGUE, LOAD_TS, Tables, new_warehouse, query
from dimlathe.catalogue.shaping import CUSTOMER, customers
from dimlathe.operators import keys, merge, quality, shape
from dimlathe.registry import TableSpec
from dimlathe.session import scratch_path
from dimlathe.sources.lake import Lake

_STORED_SQL = """
    SELECT row_number() OVER (ORDER BY c_custkey) AS customer_key, c_custkey, c_name, c_nationkey, c_mktsegment, c_acctbal,
           CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'csv' WHEN 'FURNITURE' THEN 'api_incremental' ELSE 'api' END AS source
    FROM customer WHERE c_mktsegment <> 'BUILDING'
"""
_NEW_BALANCE_SQL = "CASE WHEN c_nationkey < 10 THEN c_acctbal + 100 WHEN c_nationkey > 22 THEN NULL ELSE c_acctbal END"


def _stored(t: Tables) -> DataFrame:
    """All customers but one segment, with lineage by segment."""
    kept = customers(t).where("segment <> 'BUILDING'")
    keyed = keys.dense_key(kept, "customer_key", ["customer_id"])
    lineage = (
        F.when(F.col("segment") == "AUTOMOBILE", "csv").when(F.col("segment") == "FURNITURE", "api_incremental")
        .otherwise("api")
    )
    return shape.stamp_lineage(keyed, "api", LOAD_TS).withColumn("source", lineage)


def _batch(t: Tables) -> DataFrame:
    """All customers again; balances changed for some nations, names and segments rewritten."""
    nation = F.col("nation_id")
    balance = F.when(nation < 10, F.col("balance") + 100).when(nation <= 22, F.col("balance"))
    changed = customers(t).withColumns({"balance": balance, "segment": F.lower("segment")})
    return shape.stamp_lineage(changed, "api", LOAD_TS)


def _upsert(t: Tables, stored: DataFrame, **options) -> DataFrame:
    merged = merge.upsert_table(
        stored, _batch(t), CUSTOMER, protected="csv", key_order=["customer_id"], load_ts=LOAD_TS, **options
    )
    return merged.select("customer_key", "customer_id", "customer_name", "segment", "balance", "source")


@query(
    "upsert_priority",
    f"""
    WITH stored AS ({_STORED_SQL}),
    merged AS (
        SELECT s.customer_key, s.c_custkey AS customer_id, s.c_name AS customer_name, s.c_mktsegment, s.c_acctbal, s.source,
               s.source <> 'csv' AND s.c_acctbal IS DISTINCT FROM b.balance AS changed, b.balance
        FROM stored s JOIN (SELECT c_custkey, {_NEW_BALANCE_SQL} AS balance FROM customer) b USING (c_custkey))
    SELECT customer_key, customer_id, customer_name,
           CASE WHEN changed THEN lower(c_mktsegment) ELSE c_mktsegment END AS segment,
           CASE WHEN changed THEN balance ELSE c_acctbal END AS balance, source FROM merged
    UNION ALL
    SELECT (SELECT max(customer_key) FROM stored) + row_number() OVER (ORDER BY c_custkey), c_custkey, c_name,
           lower(c_mktsegment), {_NEW_BALANCE_SQL}, 'api'
    FROM customer WHERE c_mktsegment = 'BUILDING'
    """,
)
def upsert_priority(t: Tables) -> DataFrame:
    return _upsert(t, _stored(t), first_existing_by=["customer_key"])


@query("upsert_indexed", CATALOGUE["upsert_priority"].sql)
def upsert_indexed(t: Tables) -> DataFrame:
    """The same merge with a stored table and a digest index that are both bucketed by the natural key."""
    house, schema = new_warehouse(t)
    house.replace(_stored(t), f"{schema}.customer", bucket=CUSTOMER.natural)
    stored = house.read(f"{schema}.customer")
    index = merge.digest_index(stored, CUSTOMER.natural, CUSTOMER.compare)
    house.replace(index, f"{schema}.customer_digests", bucket=CUSTOMER.natural)
    return _upsert(t, stored, index=house.read(f"{schema}.customer_digests"))


@query(
    "upsert_first_load",
    f"""
    SELECT 40 + row_number() OVER (ORDER BY c_custkey) AS customer_key, c_custkey AS customer_id, c_name AS customer_name,
           lower(c_mktsegment) AS segment, {_NEW_BALANCE_SQL} AS balance, 'api' AS source
    FROM customer
    """,
)
def upsert_first_load(t: Tables) -> DataFrame:
    return _upsert(t, t.spark.createDataFrame([], CUSTOMER.schema()), floor=40)


@query(
    "upsert_action_counts",
    f"""
    WITH stored AS ({_STORED_SQL}), batch AS (SELECT *, {_NEW_BALANCE_SQL} AS balance FROM customer)
    SELECT CASE WHEN b.c_nationkey = 15 THEN 'null_key' WHEN s.c_custkey IS NULL THEN 'add'
                WHEN s.source = 'csv' THEN 'skip_protected'
                WHEN s.c_acctbal IS NOT DISTINCT FROM b.balance THEN 'skip_equal' ELSE 'update' END AS action,
           count(*) AS rows
    FROM batch b LEFT JOIN stored s USING (c_custkey) GROUP BY 1
    """,
)
def upsert_action_counts(t: Tables) -> DataFrame:
    batch = _batch(t).withColumn("customer_id", F.when(F.col("nation_id") != 15, F.col("customer_id")))
    return merge.action_counts(_stored(t), batch, CUSTOMER.natural, CUSTOMER.compare, "csv")


def _loaded_orders(t: Tables) -> DataFrame:
    """Orders of two statuses, one protected and one not, with keys."""
    lineage = F.when(F.col("o_orderstatus") == "F", "csv").otherwise("api")
    stored = t.orders.where("o_orderstatus IN ('F', 'O')").withColumn("source", lineage)
    return keys.dense_key(stored, "order_key", ["o_orderkey"])


def _order_batch(t: Tables) -> DataFrame:
    urgent = t.orders.where("o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')")
    return urgent.withColumns({"o_totalprice": F.col("o_totalprice") + 1, "source": F.lit("api")})


@query(
    "replace_unprotected",
    """
    SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS order_key, o_orderkey, source, o_totalprice
    FROM (SELECT o_orderdate, o_orderkey, 'csv' AS source, o_totalprice FROM orders WHERE o_orderstatus = 'F'
          UNION ALL
          SELECT o_orderdate, o_orderkey, 'api', o_totalprice + 1 FROM orders
          WHERE o_orderstatus <> 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM'))
    """,
)
def replace_unprotected(t: Tables) -> DataFrame:
    merged = merge.replace_unprotected(
        _loaded_orders(t), _order_batch(t), keys=["o_orderkey"], protected=["csv"], surrogate="order_key",
        key_order=["o_orderdate", "o_orderkey"],
    )
    return merged.select("order_key", "o_orderkey", "source", "o_totalprice")


@query(
    "replace_unprotected_by_year",
    """
    SELECT row_number() OVER (ORDER BY year(o_orderdate), o_orderdate, o_orderkey) AS order_key, o_orderkey, source, o_totalprice
    FROM (SELECT o_orderdate, o_orderkey, 'csv' AS source, o_totalprice FROM orders WHERE o_orderstatus = 'F'
          UNION ALL
          SELECT o_orderdate, o_orderkey, 'api', o_totalprice FROM orders
          WHERE o_orderstatus = 'O' AND year(o_orderdate) NOT IN (1996, 1997)
          UNION ALL
          SELECT o_orderdate, o_orderkey, 'api', o_totalprice + 1 FROM orders WHERE o_orderstatus <> 'F'
          AND o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') AND year(o_orderdate) IN (1996, 1997))
    """,
)
def replace_unprotected_by_year(t: Tables) -> DataFrame:
    """Two years are replaced in a stored table that is numbered by year; the other years' files stay and their keys move."""
    names = ["order_key", "o_orderkey", "o_orderdate", "source", "o_totalprice", "year"]
    order = ["year", "o_orderdate", "o_orderkey"]
    with_year = F.year("o_orderdate").alias("year")
    stored = _loaded_orders(t).select("*", with_year)
    spec = TableSpec("orders", "facts", dict(stored.select(*names).dtypes), "order_key", ("o_orderkey",), partition="year")
    lake = Lake(t.spark, scratch_path(t.spark, "lake"))
    lake.rewrite_numbered(spec, keys.dense_key(stored.drop("order_key"), "order_key", order))
    batch = _order_batch(t).select("*", with_year).where("year IN (1996, 1997)")
    merged = merge.replace_unprotected(
        lake.read_touched(spec, batch), shape.select_existing(batch, names), keys=["o_orderkey"], protected=["csv"],
        surrogate="order_key", key_order=order, scope=["year"],
    )
    lake.rewrite_numbered(spec, merged)
    return lake.read(spec).select("order_key", "o_orderkey", "source", "o_totalprice")


@query(
    "replace_unprotected_stable",
    """
    WITH stored AS (SELECT row_number() OVER (ORDER BY o_orderkey) AS order_key, * FROM orders
                    WHERE o_orderstatus IN ('F', 'O'))
    SELECT order_key, o_orderkey, 'csv' AS source FROM stored WHERE o_orderstatus = 'F'
    UNION ALL
    SELECT order_key, o_orderkey, 'api' FROM stored
    WHERE o_orderstatus = 'O' AND o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
    UNION ALL
    SELECT (SELECT max(order_key) FROM stored) + row_number() OVER (ORDER BY o_orderdate, o_orderkey), o_orderkey, 'api'
    FROM orders WHERE o_orderstatus NOT IN ('F', 'O') AND o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
    """,
)
def replace_unprotected_stable(t: Tables) -> DataFrame:
    merged = merge.replace_unprotected(
        _loaded_orders(t), _order_batch(t), keys=["o_orderkey"], protected=["csv"], surrogate="order_key",
        key_order=["o_orderdate", "o_orderkey"], rekey=False,
    )
    return merged.select("order_key", "o_orderkey", "source")


def _increment(t: Tables, stored: DataFrame) -> DataFrame:
    batch = t.orders.select("o_orderkey", "o_orderdate", "o_totalprice")
    return merge.increment(
        stored, batch, keys=["o_orderkey"], surrogate="order_key", key_order=["o_orderdate", "o_orderkey"],
        source="api_incremental", load_ts=LOAD_TS, identity="order_id", identity_floor=10_000, protected="csv",
    )


def _stored_orders(t: Tables) -> DataFrame:
    stored = keys.dense_key(
        t.orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_orderdate", "o_totalprice"), "order_key",
        ["o_orderkey"],
    )
    return shape.stamp_lineage(stored.withColumn("order_id", F.col("o_orderkey")), "csv", LOAD_TS)


@query(
    "increment_insert_only",
    """
    SELECT row_number() OVER (ORDER BY o_orderkey) AS order_key, o_orderkey AS order_id, o_orderkey, 'csv' AS source
    FROM orders WHERE o_orderstatus = 'F'
    UNION ALL
    SELECT (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') + row_number() OVER (ORDER BY o_orderdate, o_orderkey),
           10000 + row_number() OVER (ORDER BY o_orderdate, o_orderkey), o_orderkey, 'api_incremental'
    FROM orders WHERE o_orderstatus <> 'F'
    """,
)
def increment_insert_only(t: Tables) -> DataFrame:
    stored = _stored_orders(t)
    grown = shape.align(stored, _increment(t, stored))
    return grown.select("order_key", "order_id", "o_orderkey", "source")


@query(
    "load_reconciliation",
    """
    SELECT (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS existing, (SELECT count(*) FROM orders) AS incoming,
           (SELECT count(*) FROM orders) AS final, (SELECT count(*) FROM orders WHERE o_orderstatus <> 'F') AS added
    """,
)
def load_reconciliation(t: Tables) -> DataFrame:
    stored = _stored_orders(t)
    return quality.load_report(stored, t.orders, shape.align(stored, _increment(t, stored)))
