"""Helpers shared by the training-data operators."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Just these columns. Further columns are left out, also those whose name differs only by case."""
    at = [df.columns.index(n) for n in names]
    return df.toDF(*(f"__{i}" for i in range(len(df.columns)))).select(
        *(F.col(f"__{i}").alias(n) for i, n in zip(at, names, strict=True))
    )


def whole_text(name: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(name), F.lit(""))


def shuffle_partitions(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def parts_for(spark, size: float, each: float) -> int:
    """Partitions of about ``each`` units for ``size`` units, no fewer than the session's number."""
    return max(shuffle_partitions(spark), math.ceil(size / each))


def running_sum(numbers: Column, chunk: int = 256) -> Column:
    """Sums of an array of longs up to and including each element.

    Folding with ``aggregate`` copies the array so far at each step, so it is done by chunks, then over
    the chunks' totals: the copies then cost about n * chunk / 2 instead of n * n / 2.
    """

    def fold(xs: Column) -> Column:
        return F.slice(
            F.aggregate(
                xs,
                F.array(F.lit(0).cast("long")),
                lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x.cast("long"))),
            ),
            2,
            F.greatest(F.size(xs), F.lit(1)),
        )

    count = F.ceil(F.size(numbers) / F.lit(chunk)).cast("int")
    starts = F.when(F.size(numbers) > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    sums = F.transform(starts, lambda c: fold(F.slice(numbers, c * chunk + 1, F.lit(chunk))))
    ends = fold(F.transform(sums, lambda s: F.element_at(s, -1)))
    return F.flatten(
        F.transform(
            F.arrays_zip(sums.alias("sums"), ends.alias("ends")),
            lambda z: F.transform(z["sums"], lambda x: x + z["ends"] - F.element_at(z["sums"], -1)),
        )
    )
