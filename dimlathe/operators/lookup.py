"""Key lookups between facts and dimensions, and row-level membership tests.

No side is force-broadcast: Spark broadcasts a side when its statistics, or the size measured at run
time, are under ``spark.sql.autoBroadcastJoinThreshold``. Otherwise it sort-merges, and adaptive
execution splits hot keys of the fact side. It does so only where both inputs come straight from a
shuffle made for the join; an aggregated side would bring its own partitioning and prevent that.
Joins to aggregated sides here compare with ``<=>``, which asks for a new shuffle of that (small) side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimlathe.operators.keys import complete_keys, keep_first, latest_per_key


def _match(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], fresh: bool) -> Column:
    """Equality of column pairs; ``fresh`` keeps the join off the partitioning of an aggregated side.
    That form lets NULL match NULL, so callers drop NULL keys where it must not."""
    return reduce(lambda x, y: x & y, (left[a].eqNullSafe(right[b]) if fresh else left[a] == right[b] for a, b in pairs))


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    take: Mapping[str, str],
    last_by: Sequence[str] | None = None,
) -> DataFrame:
    """Left lookup: ``on`` maps fact column to dimension column, ``take`` dimension column to result.

    A miss gives NULL. ``last_by`` resolves repeated dimension keys to the last row in that order;
    without it the dimension's keys are declared unique, which saves an aggregation.
    """
    if last_by is not None:
        dim = latest_per_key(complete_keys(dim, list(on.values())), list(on.values()), list(take), last_by)
    side = dim.select(
        *(F.col(b).alias(f"__k{i}") for i, b in enumerate(on.values())),
        *(F.col(a).alias(b) for a, b in take.items()),
    )
    pairs = [(a, f"__k{i}") for i, a in enumerate(on)]
    return fact.join(side, _match(fact, side, pairs, fresh=last_by is not None), "left").drop(*(k for _, k in pairs))


def lookup_by_date(
    fact: DataFrame, key: str, dated: DataFrame, dated_key: str, date_col: str, calendar: DataFrame,
    out: str = "time_key",
) -> DataFrame:
    """Two hops: fact key to a date of another table, then date to calendar key."""
    hop = lookup(fact, dated.withColumn("__day", F.col(date_col).cast("date")), {key: dated_key}, {"__day": "__day"})
    return lookup(hop, calendar, {"__day": "full_date"}, {"time_key": out}).drop("__day")


def lookup_time_key(fact: DataFrame, date_col: str, calendar: DataFrame, out: str = "time_key") -> DataFrame:
    """The fact's own date (or timestamp) to calendar key."""
    dated = fact.withColumn("__day", F.col(date_col).cast("date"))
    return lookup(dated, calendar, {"__day": "full_date"}, {"time_key": out}).drop("__day")


def lookup_via_bridge(
    fact: DataFrame, bridge: DataFrame, on: Sequence[str], take: str, last_by: Sequence[str], out: str | None = None
) -> DataFrame:
    """An attribute the fact lacks, from another fact with the same keys; the last bridge row wins."""
    return lookup(fact, bridge, {k: k for k in on}, {take: out or take}, last_by=last_by)


def unseen(
    batch: DataFrame, existing: DataFrame, on: Sequence[str], null_safe: bool = False, bucketed: bool = False
) -> DataFrame:
    """Batch rows whose key the existing table does not hold. ``null_safe`` lets NULL equal NULL.

    The large table is first reduced to the batch's keys by a semi join: it is scanned for its key
    columns only, and not shuffled while the batch's keys fit under the broadcast threshold. A table ``bucketed`` by
    the key is not shuffled at all; a stored key then repeats at most as often as rows of it were inserted, so there is no hot
    key to split.
    """
    wanted = batch.select(*on) if null_safe else complete_keys(batch.select(*on), on)
    wanted = wanted.distinct().toDF(*(f"__w{i}" for i in range(len(on))))
    held = existing.select(*on)
    fresh = null_safe or not bucketed
    found = held.join(wanted, _match(held, wanted, [(k, f"__w{i}") for i, k in enumerate(on)], fresh=fresh), "left_semi")
    seen = found.distinct().toDF(*(f"__s{i}" for i in range(len(on))))
    return batch.join(seen, _match(batch, seen, [(k, f"__s{i}") for i, k in enumerate(on)], fresh=True), "left_anti")


def new_rows(
    batch: DataFrame, existing: DataFrame, on: Sequence[str], first_by: Sequence[str | Column], bucketed: bool = False
) -> DataFrame:
    """The batch rows to insert: unseen keys, each key once, at its first place in ``first_by``.

    A NULL key part equals a stored NULL. Rows with an incomplete key cannot be told apart, so all of
    them stay; they are compared only with the stored rows whose key is incomplete too.
    """
    whole = unseen(complete_keys(batch, on), existing, on, bucketed=bucketed)
    partial = unseen(
        complete_keys(batch, on, complete=False), complete_keys(existing, on, complete=False), on, null_safe=True
    )
    return keep_first(whole, on, first_by).unionByName(partial)


def miss_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many rows have each foreign key unresolved."""
    return df.agg(*(F.count_if(F.col(k).isNull()).alias(k) for k in keys))


def unresolved_values(df: DataFrame, key: str, natural: Sequence[str]) -> DataFrame:
    """Distinct natural keys that found no surrogate key, with their row counts."""
    return df.where(F.col(key).isNull()).groupBy(*natural).agg(F.count("*").alias("rows"))
