"""Files, envelopes, topics, warehouse tables and streams. Every call writes to fresh scratch paths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimlathe.catalogue.registry import Tables, new_warehouse, query
from dimlathe.functions.coerce import to_date, to_integer, to_number
from dimlathe.registry import TableSpec
from dimlathe.session import scratch_path
from dimlathe.sources import envelopes, files, snapshots, topics
from dimlathe.streaming import consume


@query("csv_roundtrip_typed", "SELECT * FROM customer")
def csv_roundtrip_typed(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "csv")
    files.write_csv(t.customer, path)
    cells = files.read_csv_as_text(t.spark, path, t.customer.columns)
    return cells.select(
        to_integer("c_custkey").alias("c_custkey"),
        "c_name",
        to_integer("c_nationkey").cast("int").alias("c_nationkey"),
        to_number("c_acctbal").alias("c_acctbal"),
        "c_mktsegment",
    )


@query(
    "parquet_overwrite_roundtrip",
    """
    SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
    FROM orders
    """,
)
def parquet_overwrite_roundtrip(t: Tables) -> DataFrame:
    root = scratch_path(t.spark, "versions")
    first = files.overwrite_version(t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice"), root)
    price = F.col("o_totalprice") + F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)
    second = files.overwrite_version(t.spark.read.parquet(first).withColumn("o_totalprice", price), root)
    return t.spark.read.parquet(second)


def _orders_by_year(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice",
                           F.year("o_orderdate").alias("year"))


def _per_year(df: DataFrame) -> DataFrame:
    return df.groupBy(F.col("year").cast("bigint").alias("year")).agg(
        F.count("*").alias("rows"), F.max("o_totalprice").alias("max_price")
    )


@query(
    "partition_overwrite_dynamic",
    """
    SELECT CAST(year(o_orderdate) AS VARCHAR) AS part, count(*) AS rows FROM orders
    WHERE (year(o_orderdate) <> 1996 AND NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW'))
          OR (year(o_orderdate) = 1996 AND o_orderpriority IN ('1-URGENT', '2-HIGH'))
    GROUP BY 1
    UNION ALL
    SELECT 'dropped', count(*) FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '5-LOW'
    """,
)
def partition_overwrite_dynamic(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "partitions")
    undated = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW")
    rows = _orders_by_year(t).withColumn("year", F.when(~undated, F.col("year")))
    files.write_partitions(rows, path, "year")
    files.write_partitions(
        _orders_by_year(t).where("year = 1996 AND o_orderpriority IN ('1-URGENT', '2-HIGH')"), path, "year"
    )
    stored = files.read_partitions(t.spark, path, "year", schema=rows.schema)
    kept = stored.groupBy(F.col("year").cast("string").alias("part")).agg(F.count("*").alias("rows"))
    return kept.union(files.count_unplaced(rows, "year").select(F.lit("dropped"), "dropped"))


@query(
    "partition_range_scan",
    """
    SELECT CAST(year(o_orderdate) AS BIGINT) AS year, count(*) AS rows, max(o_totalprice) AS max_price FROM orders
    WHERE year(o_orderdate) BETWEEN 1998 AND 2015 GROUP BY 1
    """,
)
def partition_range_scan(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "partitions")
    rows = _orders_by_year(t)
    files.write_partitions(rows, path, "year")
    return _per_year(files.read_partitions(t.spark, path, "year", 1998, 2015, schema=rows.schema))


@query(
    "partition_append_touched",
    """
    SELECT CAST(year(o_orderdate) AS BIGINT) AS year, count(*) AS rows, max(o_totalprice) AS max_price FROM orders
    WHERE o_orderstatus <> 'P' OR year(o_orderdate) IN (1997, 2000) GROUP BY 1
    """,
)
def partition_append_touched(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "partitions")
    rows = _orders_by_year(t)
    files.write_partitions(rows.where("o_orderstatus <> 'P'"), path, "year")
    files.append_partitions(rows.where("o_orderstatus = 'P' AND year IN (1997, 2000)"), path, "year")
    return _per_year(files.read_partitions(t.spark, path, "year", schema=rows.schema))


@query(
    "snapshot_rewrite_years",
    """
    SELECT o_orderkey, CASE WHEN year(o_orderdate) IN (1995, 1997) THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
           CAST(year(o_orderdate) AS INTEGER) AS year, CAST(2 AS BIGINT) AS commits, CAST(0 AS BIGINT) AS lost
    FROM orders WHERE o_orderstatus <> 'P' OR year(o_orderdate) = 1998
    """,
)
def snapshot_rewrite_years(t: Tables) -> DataFrame:
    """Two years are rewritten and one is added to, each in one commit. ``lost`` counts files of the first load that are gone."""
    path = scratch_path(t.spark, "snapshots")
    rows = _orders_by_year(t)
    schema = rows.select("o_orderkey", "o_orderstatus", "o_totalprice", F.col("year").cast("int")).schema
    files.write_partitions(rows.where("o_orderstatus <> 'P'").select(*schema.fieldNames()), path, "year", whole=True)
    first = snapshots.current(t.spark, path, "year")
    years = snapshots.read(t.spark, path, "year", schema).where("year IN (1995, 1997)")
    snapshots.replace_partitions(years.withColumn("o_totalprice", F.col("o_totalprice") + 1), path, "year")
    at = snapshots.append(rows.where("o_orderstatus = 'P' AND year = 1998").select(*schema.fieldNames()), path, "year")
    lost = set(first.folders) - set(snapshots.current(t.spark, path, "year").folders)
    return snapshots.read(t.spark, path, "year", schema).select(
        "o_orderkey", "o_totalprice", "year", F.lit(at.number).cast("bigint").alias("commits"), F.lit(len(lost)).cast("bigint").alias("lost")
    )


_TEXT = T.StringType()


def _text_struct(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, _TEXT) for n in names])


@query(
    "json_envelope_flatten",
    """
    SELECT o_orderkey AS order_id, o_custkey AS customer_id,
           CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d') END AS ordered_on,
           CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS priority,
           CASE WHEN o_orderstatus = 'F' AND o_orderpriority <> '1-URGENT' THEN o_totalprice END AS price
    FROM orders
    """,
)
def json_envelope_flatten(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "json")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    text = lambda c: F.col(c).cast("string")
    record = F.struct(
        text("o_orderkey").alias("orderId"),
        F.struct(text("o_custkey").alias("customerId")).alias("Customer"),
        F.when(
            status != "P", F.struct(F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), priority.alias("priority"))
        ).alias("Session"),
        F.when(
            status == "F",
            F.struct(F.when(priority != "1-URGENT", F.struct(text("o_totalprice").alias("value"))).alias("Price")),
        ).alias("Detail"),
    )
    envelopes.land_pages(t.orders, path, "Data", "OrderTable", "Orders", record)
    shape = T.StructType(
        [
            T.StructField("orderId", _TEXT),
            T.StructField("Customer", _text_struct("customerId")),
            T.StructField("Session", _text_struct("date", "priority")),
            T.StructField("Detail", T.StructType([T.StructField("Price", _text_struct("value"))])),
        ]
    )
    pages = envelopes.read_envelopes(t.spark, path, envelopes.envelope_schema("Data", "OrderTable", "Orders", shape))
    flat = envelopes.records(
        pages,
        "Data.OrderTable.Orders",
        {
            "order_id": "orderId",
            "customer_id": "Customer.customerId",
            "ordered_on": "Session.date",
            "priority": "Session.priority",
            "price": "Detail.Price.value",
        },
    )
    return flat.select(
        to_integer("order_id").alias("order_id"),
        to_integer("customer_id").alias("customer_id"),
        to_date("ordered_on").cast("string").alias("ordered_on"),
        "priority",
        to_number("price").alias("price"),
    )


@query(
    "json_double_explode",
    """
    SELECT l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS line_number, l_partkey AS part_id, l_quantity AS quantity,
           l_extendedprice AS price
    FROM lineitem
    """,
)
def json_double_explode(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "json")
    text = lambda c, n: F.col(c).cast("string").alias(n)
    record = F.struct(
        text("l_linenumber", "number"), text("l_partkey", "part"), text("l_quantity", "quantity"),
        text("l_extendedprice", "price"),
    )
    envelopes.land_pages(
        t.lineitem, path, "Data", "OrderTable", "Orders", record, page_size=500, group=["l_orderkey"],
        parent=F.col("l_orderkey").cast("string").alias("orderId"),
    )
    order = T.StructType(
        [
            T.StructField("orderId", _TEXT),
            T.StructField("Lines", T.ArrayType(_text_struct("number", "part", "quantity", "price"))),
        ]
    )
    pages = envelopes.read_envelopes(t.spark, path, envelopes.envelope_schema("Data", "OrderTable", "Orders", order))
    lines = envelopes.nested_records(
        pages,
        [
            ("Data.OrderTable.Orders", {"order_id": "orderId"}),
            ("Lines", {"line_number": "number", "part_id": "part", "quantity": "quantity", "price": "price"}),
        ],
    )
    return lines.select(
        *(to_integer(c).alias(c) for c in ("order_id", "line_number", "part_id")),
        *(to_number(c).alias(c) for c in ("quantity", "price")),
    )


@query(
    "json_first_element",
    """
    SELECT o_orderkey AS order_id, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS first_tag FROM orders
    """,
)
def json_first_element(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "json")
    status = F.col("o_orderstatus")
    tags = F.when(status == "F", F.array("o_orderpriority", "o_orderstatus")).when(
        status == "O", F.array().cast("array<string>")
    )
    record = F.struct(F.col("o_orderkey").cast("string").alias("orderId"), tags.alias("Tags"))
    envelopes.land_pages(t.orders, path, "Data", "OrderTable", "Orders", record)
    order = T.StructType([T.StructField("orderId", _TEXT), T.StructField("Tags", T.ArrayType(_TEXT))])
    pages = envelopes.read_envelopes(t.spark, path, envelopes.envelope_schema("Data", "OrderTable", "Orders", order))
    flat = envelopes.records(pages, "Data.OrderTable.Orders")
    return flat.select(
        to_integer("orderId").alias("order_id"), envelopes.first_element(F.col("Tags")).alias("first_tag")
    )


@query(
    "page_assembly_check",
    "SELECT count(*) AS assembled, count(*) AS announced, true AS complete FROM part",
)
def page_assembly_check(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "json")
    record = F.struct(F.col("p_partkey").cast("string").alias("partId"), F.col("p_name").alias("name"))
    total = t.part.agg(F.count("*")).scalar()
    envelopes.land_pages(t.part, path, "Data", "PartTable", "Parts", record, announce=total)
    schema = envelopes.envelope_schema("Data", "PartTable", "Parts", _text_struct("partId", "name"))
    pages = envelopes.read_envelopes(t.spark, path, schema)
    return envelopes.page_completeness(pages, "Data", "Data.PartTable.Parts")


@query(
    "page_interval_gaps",
    """
    WITH placed AS (SELECT p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS place FROM part),
    sized AS (SELECT p_brand, count(*) AS announced FROM part GROUP BY 1),
    kept AS (SELECT * FROM placed WHERE NOT (p_brand = 'Brand#12' AND place >= 2 AND place < 4))
    SELECT p_brand AS request, announced, (SELECT count(*) FROM kept k WHERE k.p_brand = s.p_brand) AS records,
           CASE WHEN p_brand = 'Brand#12' AND announced > 2 THEN CAST(2 AS BIGINT) END AS missing_from,
           NOT (p_brand = 'Brand#12' AND announced > 2) AS complete
    FROM sized s
    """,
)
def page_interval_gaps(t: Tables) -> DataFrame:
    """Parts as pages of two per brand, of which one page of one brand never landed: the report names the gap."""
    path = scratch_path(t.spark, "json")
    per = W.partitionBy("p_brand").orderBy("p_partkey")
    total = F.count("*").over(W.partitionBy("p_brand")).cast("string")
    placed = t.part.withColumns({"at": F.row_number().over(per) - 1, "total": total})
    pages = placed.groupBy(F.col("p_brand").alias("url"), "total", (F.floor(F.col("at") / 2) * 2).cast("string").alias("offset")).agg(
        F.collect_list(F.struct(F.col("p_partkey").cast("string").alias("partId"))).alias("Parts")
    )
    landed = pages.where("NOT (url = 'Brand#12' AND offset = '2')")
    body = F.struct(F.struct("url", "total", "offset", F.struct("Parts").alias("PartTable")).alias("Data"))
    landed.select(F.to_json(body).alias("value")).write.text(path)
    schema = "Data struct<url: string, total: string, limit: string, offset: string, PartTable: struct<Parts: array<struct<partId: string>>>>"
    judged = envelopes.with_interval(envelopes.read_envelopes(t.spark, path, schema), "Data", ["Data.PartTable.Parts"])
    return envelopes.page_coverage(judged).select("request", "announced", "records", "missing_from", "complete")


@query(
    "publish_key_value",
    """
    SELECT CAST(user_id AS VARCHAR) AS key,
           CAST(json_object('event_id', event_id, 'ts', CAST(ts AS VARCHAR), 'user_id', user_id, 'event_type', event_type,
                            'value', CASE WHEN event_type <> 'error' THEN value END, 'props', props) AS VARCHAR) AS value
    FROM events
    """,
)
def publish_key_value(t: Tables) -> DataFrame:
    topic = scratch_path(t.spark, "topic")
    rows = t.events.withColumn("value", F.when(F.col("event_type") != "error", F.col("value")))
    topics.publish(topics.as_messages(rows, "user_id"), topic)
    return t.spark.read.schema(topics.MESSAGE).json(topic)


@query(
    "replay_lineage",
    """
    SELECT count(*) AS messages, count(*) FILTER (WHERE value < 5) AS null_keys FROM events WHERE event_type = 'purchase'
    """,
)
def replay_lineage(t: Tables) -> DataFrame:
    rows = t.events.withColumn("user_id", F.when(F.col("value") >= 5, F.col("user_id")))
    return topics.null_key_count(topics.replay(rows, "purchase", "user_id", lineage="event_type"))


@query("table_replace", "SELECT c_custkey, c_name, c_acctbal * 2 AS c_acctbal FROM customer WHERE c_mktsegment <> 'BUILDING'")
def table_replace(t: Tables) -> DataFrame:
    house, schema = new_warehouse(t)
    table = f"{schema}.customer"
    house.replace(t.customer, table)
    house.replace(house.read(table).where("c_mktsegment <> 'BUILDING'").drop("c_mktsegment", "c_nationkey"), table)
    house.replace(house.read(table).withColumn("c_acctbal", F.col("c_acctbal") * 2), table)
    return house.read(table)


@query("table_append", "SELECT o_orderkey, o_orderstatus FROM orders")
def table_append(t: Tables) -> DataFrame:
    house, schema = new_warehouse(t)
    orders = t.orders.select("o_orderkey", "o_orderstatus")
    house.append(orders.where("o_orderstatus = 'F'"), f"{schema}.orders")
    house.append(orders.where("o_orderstatus <> 'F'").select("o_orderstatus", "o_orderkey"), f"{schema}.orders")
    return house.read(f"{schema}.orders")


@query(
    "insert_unseen_by_key",
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE o_totalprice + 1 END AS o_totalprice,
           (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS first_load,
           (SELECT count(*) FROM orders WHERE o_orderstatus <> 'F') AS second_load,
           CAST(0 AS BIGINT) AS third_load
    FROM orders
    """,
)
def insert_unseen_by_key(t: Tables) -> DataFrame:
    house, schema = new_warehouse(t)
    table = f"{schema}.orders"
    orders = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    raised = orders.withColumn("o_totalprice", F.col("o_totalprice") + 1)
    loads = {
        "first_load": orders.where("o_orderstatus = 'F'"),
        "second_load": raised.union(raised),
        "third_load": orders,
    }
    counts = {n: house.insert_unseen(df.drop("o_orderstatus"), table, ["o_orderkey"]) for n, df in loads.items()}
    return house.read(table).select("*", *(F.lit(c).cast("bigint").alias(n) for n, c in counts.items()))


@query(
    "insert_unseen_bucketed",
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE o_totalprice + 1 END AS o_totalprice,
           (SELECT count(*) FROM orders WHERE o_orderstatus <> 'F') AS inserted
    FROM orders
    """,
)
def insert_unseen_bucketed(t: Tables) -> DataFrame:
    """The same on a table bucketed by its key, which no insert shuffles."""
    house, schema = new_warehouse(t)
    orders = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    house.replace(orders.where("o_orderstatus = 'F'").drop("o_orderstatus"), f"{schema}.orders", bucket=["o_orderkey"])
    raised = orders.withColumn("o_totalprice", F.col("o_totalprice") + 1).drop("o_orderstatus")
    inserted = house.insert_unseen(raised, f"{schema}.orders", ["o_orderkey"])
    house.compact(f"{schema}.orders")
    return house.read(f"{schema}.orders").select("*", F.lit(inserted).cast("bigint").alias("inserted"))


@query(
    "view_follows_table",
    "SELECT c_nationkey, count(*) AS customers, CAST(sum(c_custkey) AS BIGINT) AS ids FROM customer WHERE c_nationkey < 20 GROUP BY 1",
)
def view_follows_table(t: Tables) -> DataFrame:
    """A view made over the first load shows what the table holds after a replacement and an append."""
    house, schema = new_warehouse(t)
    table, rows = f"{schema}.customer", t.customer.select("c_custkey", "c_nationkey")
    house.replace(rows.where("c_nationkey < 5"), table)
    text = f"SELECT c_nationkey, count(*) AS customers, sum(c_custkey) AS ids FROM {table} GROUP BY 1"
    house.sql_view(f"{schema}.per_nation", text)
    house.replace(rows.where("c_nationkey < 10"), table)
    house.append(rows.where("c_nationkey >= 10 AND c_nationkey < 20"), table)
    return house.read(f"{schema}.per_nation")


EVENT = TableSpec(
    name="events",
    area="facts",
    columns={
        "event_id": "bigint",
        "ts": "timestamp_ntz",
        "user_id": "bigint",
        "event_type": "string",
        "value": "double",
        "props": "string",
    },
    surrogate="event_id",
    natural=("event_id",),
)


def _drops(t: Tables) -> list[DataFrame]:
    """The events as three overlapping deliveries in time order."""
    return [
        t.events.where("ts < timestamp_ntz'2024-01-12'"),
        t.events.where("ts BETWEEN timestamp_ntz'2024-01-08' AND timestamp_ntz'2024-01-22'"),
        t.events.where("ts >= timestamp_ntz'2024-01-18'"),
    ]


def _deliver(df: DataFrame, topic: str) -> None:
    topics.publish(topics.as_messages(df, "user_id"), topic)


def _shown(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), "user_id", "event_type", "value"
    )


_EVENTS_SQL = "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, user_id, event_type, value FROM events"


@query(
    "stream_incremental_read",
    """
    SELECT 'first' AS run, (SELECT count(*) FROM events WHERE ts <= TIMESTAMP '2024-01-22') AS inserted
    UNION ALL SELECT 'repeated', 0
    UNION ALL SELECT 'second', count(*) FROM events WHERE ts > TIMESTAMP '2024-01-22'
    """,
)
def stream_incremental_read(t: Tables) -> DataFrame:
    topic, target, position = (scratch_path(t.spark, n) for n in ("topic", "target", "position"))
    first, second, third = _drops(t)
    _deliver(first, topic)
    _deliver(second, topic)

    def run() -> int:
        rows = consume.parse_typed(topics.read_topic(t.spark, topic), EVENT)
        return consume.drain(rows, position, consume.folder_sink(target, ["event_id"], ["ts"]))

    before = run()
    repeated = run()
    _deliver(third, topic)
    run()
    stored = consume.rows_per_batch(t.spark, target, EVENT.schema())
    total = stored.agg(F.sum("rows").alias("n"))
    return total.select(
        F.explode(
            F.array(
                F.struct(F.lit("first").alias("run"), F.lit(before).cast("bigint").alias("inserted")),
                F.struct(F.lit("repeated").alias("run"), F.lit(repeated).cast("bigint").alias("inserted")),
                F.struct(F.lit("second").alias("run"), (F.col("n") - before).cast("bigint").alias("inserted")),
            )
        ).alias("r")
    ).select("r.*")


@query(
    "stream_parse_json",
    _EVENTS_SQL.replace("value FROM", "CASE WHEN event_type <> 'error' THEN value END AS value FROM"),
)
def stream_parse_json(t: Tables) -> DataFrame:
    topic, target, position = (scratch_path(t.spark, n) for n in ("topic", "target", "position"))
    value = F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("value").cast("string"))
    _deliver(t.events.withColumn("value", value), topic)
    rows = consume.parse_typed(topics.read_topic(t.spark, topic), EVENT)
    consume.drain(rows, position, consume.folder_sink(target, ["event_id"], ["ts"]))
    return _shown(consume.read_table(t.spark, target, EVENT.schema()))


@query("stream_idempotent_insert", _EVENTS_SQL)
def stream_idempotent_insert(t: Tables) -> DataFrame:
    topic, target = scratch_path(t.spark, "topic"), scratch_path(t.spark, "target")
    positions, lost_positions = scratch_path(t.spark, "positions"), scratch_path(t.spark, "positions")
    events = consume.Subscription(EVENT, topic, consume.folder_sink(target, ["event_id"], ["ts"]))
    for drop in _drops(t):
        _deliver(drop, topic)
        consume.consume_all(t.spark, [events], positions)
    # Without its position the stream delivers everything again; nothing new may be stored.
    consume.consume_all(t.spark, [events], lost_positions)
    return _shown(consume.read_table(t.spark, target, EVENT.schema()))


@query("stream_table_insert", _EVENTS_SQL)
def stream_table_insert(t: Tables) -> DataFrame:
    house, schema = new_warehouse(t)
    topic, positions = scratch_path(t.spark, "topic"), scratch_path(t.spark, "positions")
    first, second, _ = _drops(t)
    house.replace(first, f"{schema}.events")
    _deliver(second.unionByName(t.events), topic)
    sink = consume.table_sink(house, f"{schema}.events", ["event_id"], ["ts"])
    consume.consume_all(t.spark, [consume.Subscription(EVENT, topic, sink)], positions)
    return _shown(house.read(f"{schema}.events"))


@query(
    "stream_rejects",
    """
    SELECT CAST(count(*) FILTER (WHERE event_id % 10 > 2) AS BIGINT) AS stored,
           CAST(count(*) FILTER (WHERE event_id % 10 = 0) AS BIGINT) AS broken,
           CAST(count(*) FILTER (WHERE event_id % 10 = 1) AS BIGINT) AS empty,
           CAST(count(*) FILTER (WHERE event_id % 10 = 2) AS BIGINT) AS keyless, CAST(0 AS BIGINT) AS placeless
    FROM events
    """,
)
def stream_rejects(t: Tables) -> DataFrame:
    """A topic with truncated, empty and keyless messages: each is set aside with its place and reason, and none becomes a row."""
    topic, target, positions = (scratch_path(t.spark, n) for n in ("topic", "target", "positions"))
    kind = F.col("key").cast("bigint") % 10
    value = (
        F.when(kind == 0, F.substring("value", 1, 20))
        .when(kind == 2, F.regexp_replace("value", '"event_id":[0-9]+', '"event_id":null'))
        .when(kind != 1, F.col("value"))
    )
    topics.publish(topics.as_messages(t.events, "event_id").withColumn("value", value), topic)
    events = consume.Subscription(EVENT, topic, consume.folder_sink(target, ["event_id"], ["ts"]))
    stored = consume.consume_all(t.spark, [events], positions)[EVENT.qualified]
    lost = consume.read_rejects(t.spark, consume.rejects_of(positions, EVENT))
    reasons = {"broken": consume.NOT_AN_OBJECT, "empty": consume.NO_VALUE, "keyless": consume.NO_KEY}
    return lost.agg(
        *(F.count_if(F.col("reason") == r).alias(n) for n, r in reasons.items()), F.count_if(F.col("position").isNull()).alias("placeless")
    ).withColumn("stored", F.lit(stored).cast("bigint"))
