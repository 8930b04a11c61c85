"""Star and snowflake views: a fact inner-joined to dimensions on keys."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Hop:
    """One dimension: ``on`` maps a column already in the view to a column of the table."""

    table: DataFrame
    on: Mapping[str, str]
    kind: str = "inner"


def star(fact: DataFrame, *hops: Hop) -> DataFrame:
    """Join the hops in turn. A hop may start from a fact column or from an earlier dimension.

    Where a dimension repeats a column name of the view, the view keeps its own.
    """
    view = fact
    for hop in hops:
        clash = [c for c in hop.table.columns if c in view.columns]
        side = hop.table.withColumnsRenamed({c: f"__dim_{c}" for c in clash})
        renamed = {c: f"__dim_{c}" if c in clash else c for c in hop.table.columns}
        test = reduce(lambda x, y: x & y, (F.col(a) == F.col(renamed[b]) for a, b in hop.on.items()))
        view = view.join(side, test, hop.kind).drop(*(f"__dim_{c}" for c in clash))
    return view
