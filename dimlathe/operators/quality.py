"""Checks and load reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row. Counts are combined before the shuffle."""
    return df.groupBy(*keys).agg(F.count("*").alias("count")).where("count > 1")


def lineage_profile(df: DataFrame, lineage: str, id_col: str) -> DataFrame:
    """Row count and id range per lineage value."""
    return df.groupBy(lineage).agg(
        F.count("*").alias("rows"), F.min(id_col).alias("min_id"), F.max(id_col).alias("max_id")
    )


def distinct_counts(df: DataFrame, **groups: Sequence[str]) -> DataFrame:
    """Exact distinct counts of columns or column tuples, one result column per argument."""
    return df.agg(*(F.count_distinct(*(F.col(c) for c in cols)).alias(name) for name, cols in groups.items()))


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))


def orphan_counts(fact: DataFrame, dims: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Per foreign key, the fact rows that point to no dimension row.

    Keys are counted before the join, so a hot key is one row by then.
    """
    checks = []
    for key, (dim, dim_key) in dims.items():
        uses = fact.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("uses"))
        held = dim.select(F.col(dim_key).alias(key)).distinct()
        lost = uses.join(held, key, "left_anti")
        checks.append(
            lost.agg(F.coalesce(F.sum("uses"), F.lit(0)).alias("orphans")).select(F.lit(key).alias("key"), "orphans")
        )
    return reduce(DataFrame.union, checks)


def load_report(existing: DataFrame, incoming: DataFrame, final: DataFrame) -> DataFrame:
    """Existing, incoming, final and added row counts of one load."""
    sides = (("existing", existing), ("incoming", incoming), ("final", final))
    counted = reduce(
        DataFrame.union,
        (df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("side"), "rows") for name, df in sides),
    )
    pick = {name: F.max(F.when(F.col("side") == name, F.col("rows"))) for name, _ in sides}
    return counted.agg(
        *(c.alias(name) for name, c in pick.items()), (pick["final"] - pick["existing"]).alias("added")
    )
