"""Topic to table: incremental, bounded, typed and idempotent."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimlathe.operators.lookup import new_rows
from dimlathe.operators.shape import conform
from dimlathe.registry import TableSpec
from dimlathe.session import path_exists
from dimlathe.sources.topics import read_topic
from dimlathe.sources.warehouse import Warehouse

BATCH = "load_batch"
Sink = Callable[[DataFrame, str], int]


_BROKEN = "__broken"
NO_VALUE, NOT_AN_OBJECT, NO_KEY = "no value", "not an object", "no key"


def _parsed(schema: T.StructType) -> Column:
    """A message's value as a struct; what does not parse is kept whole in a field of its own."""
    held = T.StructType([*schema, T.StructField(_BROKEN, T.StringType())])
    return F.from_json("value", held, {"columnNameOfCorruptRecord": _BROKEN})


def _reason(keys: Sequence[str] = ()) -> Column:
    """Why the parsed struct ``__row`` is no row of a table; NULL if it is one."""
    keyless = reduce(lambda x, y: x & y, (F.col(f"__row.`{k}`").isNull() for k in keys)) if keys else F.lit(False)
    return (
        F.when(F.col("value").isNull() | (F.trim("value") == ""), NO_VALUE)
        .when(F.col("__row").isNull() | F.col(f"__row.{_BROKEN}").isNotNull(), NOT_AN_OBJECT)
        .when(keyless, NO_KEY)
    )


def parse_values(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """Message values to columns, as text or as the given types. Messages without a readable object give no row."""
    rows = messages.withColumn("__row", _parsed(schema)).where(_reason().isNull())
    return rows.select(*(F.col(f"__row.`{f.name}`").alias(f.name) for f in schema))


def parse_typed(messages: DataFrame, spec: TableSpec) -> DataFrame:
    """Message values to a table's declared types; a bad cell is NULL, not a failed batch."""
    return conform(parse_values(messages, spec.text_schema()), spec, show_unknown=False)


def judged(messages: DataFrame, spec: TableSpec) -> DataFrame:
    """Messages parsed once: the table's fields as text, the reason why a message is no row of the table (else NULL) as ``__reason``, and
    as ``__lost`` the message as it came, where there is a reason. ``messages`` comes with positions."""
    schema = spec.text_schema()
    parsed = messages.withColumn("__row", _parsed(schema)).withColumn("__reason", _reason([spec.surrogate]))
    lost = F.when(F.col("__reason").isNotNull(), F.struct("position", "key", "value"))
    return parsed.select("__reason", lost.alias("__lost"), *(F.col(f"__row.`{f.name}`").alias(f.name) for f in schema))


def rejects(judged_messages: DataFrame) -> DataFrame:
    """What ``judged`` found to be no row: messages as they came, with the reason."""
    return judged_messages.where("__reason IS NOT NULL").select("__lost.*", F.col("__reason").alias("reason"))


def judged_sink(spec: TableSpec, sink: Sink, aside: str) -> Sink:
    """A sink for raw messages: rows go to ``sink``, rejected messages below ``aside``, both once per batch."""

    def store(batch: DataFrame, name: str) -> int:
        # Kept are parsed rows, and of messages only the rejected ones.
        batch = judged(batch, spec).persist()
        try:
            bad = rejects(batch).withColumn(BATCH, F.lit(name))
            # A batch that is run again replaces what it set aside.
            bad.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(aside)
            good = batch.where("__reason IS NULL").drop("__reason", "__lost")
            return sink(conform(good, spec, show_unknown=False), name)
        finally:
            batch.unpersist()

    return store


REJECTED = "position string, key string, value string, reason string"


def read_rejects(spark: SparkSession, aside: str) -> DataFrame:
    """All rejected messages with their batch."""
    return _stored(spark, aside, T.StructType.fromDDL(REJECTED))


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    full = T.StructType([*schema, T.StructField(BATCH, T.StringType())])
    if not path_exists(spark, path):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).parquet(path)


def insert_batch(
    batch: DataFrame, batch_name: str, path: str, key: Sequence[str], first_by: Sequence[str]
) -> int:
    """Store the rows of one micro-batch whose key no other batch stored; returns how many.

    The rows go to the partition ``load_batch=<name>`` by overwrite, and only other batches count as
    stored. A batch that is run again after a failure therefore replaces its own output.
    """
    spark = batch.sparkSession
    batch = batch.persist()
    try:
        others = _stored(spark, path, batch.schema).where(F.col(BATCH) != batch_name)
        new = new_rows(batch, others, key, first_by)
        counted = Observation()
        new = new.observe(counted, F.count(F.lit(1)).alias("rows"))
        writer = new.withColumn(BATCH, F.lit(batch_name)).write.mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(path)
        return counted.get["rows"]
    finally:
        batch.unpersist()


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The stored rows of all batches."""
    return _stored(spark, path, schema).drop(BATCH)


def rows_per_batch(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Inserted rows per micro-batch, read from the partition layout."""
    return _stored(spark, path, schema).groupBy(BATCH).agg(F.count("*").alias("rows"))


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark gives a stream for the life of its checkpoint; a new checkpoint has a new id, so
    its batch numbers, which start again at 0, do not collide with earlier ones."""
    return spark.read.schema("id string").json(f"{checkpoint}/metadata").first()["id"]


def folder_sink(path: str, key: Sequence[str], first_by: Sequence[str]) -> Sink:
    """Store batches with ``insert_batch``."""
    return lambda batch, name: insert_batch(batch, name, path, key, first_by)


def table_sink(warehouse: Warehouse, table: str, key: Sequence[str], first_by: Sequence[str] | None = None) -> Sink:
    """Insert unseen keys into a warehouse table. A batch that is run again finds its own keys stored."""

    def store(batch: DataFrame, name: str) -> int:
        batch = batch.persist()
        try:
            return warehouse.insert_unseen(batch, table, key, first_by)
        finally:
            batch.unpersist()

    return store


def drain(rows: DataFrame, checkpoint: str, sink: Sink, timeout: int | None = None) -> int:
    """Run a stream over everything not yet consumed, then stop; returns the inserted rows. No time limit unless one is given.

    The position is committed to ``checkpoint`` after the sink has stored the batch.
    """
    inserted: list[int] = []

    def store(batch: DataFrame, number: int) -> None:
        inserted.append(sink(batch, f"{_query_id(batch.sparkSession, checkpoint)}-{number}"))

    query = (
        rows.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"topic not drained within {timeout} s")
    return sum(inserted)


@dataclass(frozen=True)
class Subscription:
    """One table fed from one topic."""

    spec: TableSpec
    topic: str
    sink: Sink


def rejects_of(checkpoints: str, spec: TableSpec) -> str:
    """Where ``consume_all`` sets a table's rejected messages aside."""
    return f"{checkpoints}-rejects/{spec.qualified}"


def consume_all(
    spark: SparkSession, subscriptions: Iterable[Subscription], checkpoints: str, servers: str | None = None,
    timeout: int | None = None,
) -> dict[str, int]:
    """Drain dimensions, then facts; returns the inserted rows per table. Messages that are no row, because they do not parse
    or lack the surrogate key, are kept with their position and the reason (``read_rejects``)."""
    inserted = {}
    for sub in sorted(subscriptions, key=lambda s: s.spec.area != "dimensions"):
        messages = read_topic(spark, sub.topic, servers, positions=True)
        name = sub.spec.qualified
        sink = judged_sink(sub.spec, sub.sink, rejects_of(checkpoints, sub.spec))
        inserted[name] = drain(messages, f"{checkpoints}/{name}", sink, timeout)
    return inserted
