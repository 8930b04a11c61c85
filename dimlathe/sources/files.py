"""CSV and Parquet tables: typed reads, versioned overwrite, partitioned writes and range reads."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


INGEST = "__ingest"


def with_ingest_order(rows: DataFrame) -> DataFrame:
    """Add each row's place in the files just read: file, split, row of the split."""
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row"))
    return rows.withColumn(INGEST, place)


def read_csv_as_text(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, ingest_order: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """CSV with a header, every cell as text. Types are applied afterwards, so a bad cell is a NULL and
    not a failed load. Without ``columns`` the names come from the header line.

    ``ingest_order`` adds each row's place for keep-first. Cells with
    line breaks need ``multi_line``, which reads each file in one task.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    if columns is not None:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    cells = reader.csv(path)
    return with_ingest_order(cells) if ingest_order else cells


def write_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).option("escape", '"').csv(path)


def overwrite_version(df: DataFrame, root: str) -> str:
    """Write a whole table into a new version folder below ``root`` and return its path.

    A table is never written over the files it is read from, so ``df`` may derive from the old version.
    """
    path = f"{root.rstrip('/')}/v-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path


def with_partition_value(df: DataFrame, partition: str) -> DataFrame:
    """Rows that can be placed in a partition; rows without a value have none."""
    return df.where(F.col(partition).isNotNull())


def count_unplaced(df: DataFrame, partition: str) -> DataFrame:
    """One row: how many rows a partitioned write leaves out."""
    return df.agg(F.count_if(F.col(partition).isNull()).alias("dropped"))


def _balanced(df: DataFrame, partition: str) -> DataFrame:
    """Few files per partition value. Rebalance, unlike repartition, lets Spark split a value that
    holds a large share of the rows over several tasks."""
    return with_partition_value(df, partition).hint("rebalance", F.col(partition))


def write_partitions(df: DataFrame, path: str, partition: str, whole: bool = False) -> None:
    """Replace exactly the partitions that ``df`` has rows for; the others stay. ``whole`` replaces all."""
    writer = _balanced(df, partition).write.mode("overwrite")
    mode = "static" if whole else "dynamic"
    writer.option("partitionOverwriteMode", mode).partitionBy(partition).parquet(path)


def append_partitions(df: DataFrame, path: str, partition: str) -> None:
    """Add rows to the partitions they belong to; no stored file is rewritten."""
    _balanced(df, partition).write.mode("append").partitionBy(partition).parquet(path)


def read_partitions(
    spark: SparkSession, path: str, partition: str, first: int | None = None, last: int | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """All partitions, or a range of them. Absent values in the range add nothing, and pruning keeps
    the others unread. Files of different age are aligned by column name: through ``schema`` where it is
    known, else by merging file footers."""
    reader = spark.read.schema(schema) if schema else spark.read.option("mergeSchema", True)
    df = reader.parquet(path)
    if first is not None:
        df = df.where(F.col(partition) >= first)
    if last is not None:
        df = df.where(F.col(partition) <= last)
    return df
