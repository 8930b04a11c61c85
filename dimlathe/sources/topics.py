"""Key/value topics: a broker where the connector is installed, else a folder of JSON lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimlathe.functions.coerce import nan_to_null

MESSAGE = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())])


def _json_value(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        c = c.cast("string")
    elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        c = nan_to_null(c)
    return c.alias(field.name)


def as_messages(df: DataFrame, key: str | None) -> DataFrame:
    """One message per row: the value is the whole row as JSON with NULL fields kept, the key is one
    column as text, or NULL where that column does not exist. Dates and times are text, NaN is null."""
    name = F.col(key).cast("string") if key and key in df.columns else F.lit(None).cast("string")
    body = F.to_json(F.struct(*(_json_value(f) for f in df.schema)), {"ignoreNullFields": "false"})
    return df.select(name.alias("key"), body.alias("value"))


def publish(messages: DataFrame, topic: str, servers: str | None = None) -> None:
    """Send messages to a broker topic, or append them to a topic folder when no servers are given.

    The key decides the broker partition, so messages of one entity keep their order.
    """
    if servers:
        writer = messages.write.format("kafka").option("kafka.bootstrap.servers", servers)
        writer.option("topic", topic).save()
    else:
        messages.write.mode("append").option("ignoreNullFields", False).json(topic)


def replay(table: DataFrame, source: str, key: str | None, lineage: str = "source") -> DataFrame:
    """The messages of one lineage's rows, for sending them again."""
    return as_messages(table.where(F.col(lineage) == source), key)


def null_key_count(messages: DataFrame) -> DataFrame:
    return messages.agg(F.count("*").alias("messages"), F.count_if(F.col("key").isNull()).alias("null_keys"))


def read_topic(spark: SparkSession, topic: str, servers: str | None = None, positions: bool = False) -> DataFrame:
    """The topic as a stream of text keys and values, from its beginning on a query's first run. ``positions`` adds where each
    message lies: partition and offset on a broker, else the file and the start of its block."""
    if servers:
        reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
        stream = reader.option("subscribe", topic).option("startingOffsets", "earliest").load()
        place = F.concat_ws(":", "topic", "partition", "offset")
        message = stream.select(F.col("key").cast("string"), F.col("value").cast("string"), place.alias("position"))
    else:
        place = F.concat_ws(":", "_metadata.file_path", "_metadata.file_block_start")
        message = spark.readStream.schema(MESSAGE).json(topic).select("key", "value", place.alias("position"))
    return message if positions else message.drop("position")
