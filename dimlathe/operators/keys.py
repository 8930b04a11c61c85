"""Surrogate keys and one-row-per-key selection."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dimlathe.session import materialize

_POSITION = "__position"
# monotonically_increasing_id keeps the partition number above bit 33 and the row offset below it.
_OFFSET_BITS = 33


def ordering(columns: Sequence[str | Column]) -> list[Column]:
    """Column names sort ascending with NULLs last; Columns are taken as given."""
    return [F.col(f"`{c}`").asc_nulls_last() if isinstance(c, str) else c for c in columns]


def dense_key(
    df: DataFrame, key: str, order_by: Sequence[str | Column], start: int | Column = 0
) -> DataFrame:
    """Number the rows ``start+1 .. start+n`` in ``order_by`` order, as the first column ``key``.

    The order must be total. Rows are range-partitioned on the whole order tuple, so a leading value
    that holds a third of the table is split by the columns behind it, and no partition holds more
    than its share. Each row gets its offset within its sorted partition; the frame is written once
    to the shared folder, which fixes the assignment; then the row counts of the preceding
    partitions are added. One shuffle, no global window, no join.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ordering(order_by)
    placed = (
        df.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn(_POSITION, F.monotonically_increasing_id())
    )
    table = materialize(placed, f"dense-{key}")
    part = F.shiftright(_POSITION, _OFFSET_BITS).cast("int")
    # The only rows that reach the driver: one count per range partition, `parts` at most.
    counted = dict(table.groupBy(part.alias("part")).count().collect())
    before = accumulate((counted.get(p, 0) for p in range(parts)), initial=0)
    starts = F.expr(f"array({', '.join(f'{n}L' for n in before)})")
    first = F.lit(start) if isinstance(start, int) else start
    offset = F.col(_POSITION).bitwiseAND((1 << _OFFSET_BITS) - 1)
    return table.select(
        (first + F.get(starts, part) + offset + 1).cast("bigint").alias(key),
        *(F.col(f"`{c}`") for c in df.columns if c != key),
    )


def max_key(df: DataFrame, key: str, floor: int = 0) -> Column:
    """The largest key of the whole table as a scalar subquery, ``floor`` when there is none."""
    return df.agg(F.coalesce(F.max(key), F.lit(floor)).cast("bigint").alias("m")).scalar()


def max_id_outside(df: DataFrame, id_col: str, lineage: str, source: str, fallback: int) -> Column:
    """The largest id among rows not of ``source`` (NULL lineage counts), else ``fallback``."""
    other = ~F.col(lineage).eqNullSafe(source)
    return df.agg(
        F.coalesce(F.max(F.when(other, F.col(id_col))), F.lit(fallback)).cast("bigint").alias("m")
    ).scalar()


def append_keys(new: DataFrame, existing: DataFrame, key: str, order_by: Sequence[str | Column]) -> DataFrame:
    """Give new rows the keys after the existing maximum."""
    return dense_key(new, key, order_by, start=max_key(existing, key))


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """The first row per key in a declared order; NULL keys form one group.

    Filtering the rank inside the plan lets Spark cut every map task to one row per key before the
    shuffle, so a hot key costs one row per task.
    """
    window = W.partitionBy(*(F.col(f"`{k}`") for k in keys)).orderBy(*ordering(order_by))
    return df.withColumn("__rank", F.row_number().over(window)).where("__rank = 1").drop("__rank")


def complete_keys(df: DataFrame, keys: Sequence[str], complete: bool = True) -> DataFrame:
    """Rows whose key has no NULL part, or the others."""
    has_null = reduce(lambda x, y: x | y, (F.col(f"`{k}`").isNull() for k in keys))
    return df.where(~has_null if complete else has_null)


def latest_per_key(
    df: DataFrame, keys: Sequence[str], values: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """The values of the last row per key. Partial aggregation runs before the shuffle."""
    packed = F.struct(*(F.col(f"`{v}`") for v in values))
    rank = F.struct(*(F.col(f"`{c}`") for c in order_by))
    return (
        df.groupBy(*keys)
        .agg(F.max_by(packed, rank).alias("__last"))
        .select(*keys, *(F.col(f"__last.`{v}`").alias(v) for v in values))
    )


