"""Partitioned Parquet tables as snapshots: a manifest names the folders of each partition value.

A table's first load lies in ``<root>/<partition>=<value>``. Every later change writes new folders
``<root>/_data/commit=<id>/<partition>=<value>`` and then one manifest ``<root>/_manifests/m-<n>``, whose rename is the
commit. So a change of three years writes three years, a change that dies midway leaves the table as it was, and a frame
that was read before keeps its files. Of two writers that start from the same manifest the second one fails.

A manifest has one entry per partition value. It may hold *relative* keys: a row's stored surrogate key is its place in
its partition, and readers add the number of rows of all smaller partition values. Then a changed year is numbered anew
without rewriting the years behind it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimlathe.session import file_system
from dimlathe.sources import files

_DATA, _MANIFESTS = "_data", "_manifests"


class Conflict(RuntimeError):
    """Another writer has committed since the snapshot was read."""


@dataclass(frozen=True)
class Snapshot:
    """The folders of each partition value, relative to the root; with relative keys also its rows."""

    number: int
    folders: Mapping[int, tuple[str, ...]]
    rows: Mapping[int, int] = field(default_factory=dict)
    relative_key: str | None = None

    def offsets(self) -> dict[int, int]:
        """Rows of all smaller partition values."""
        values = sorted(self.rows)
        before = accumulate((self.rows[v] for v in values), initial=0)
        return dict(zip(values, before, strict=False))


def _children(spark: SparkSession, path: str) -> list[str]:
    hadoop_path, fs = file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(hadoop_path)) if fs.exists(hadoop_path) else []


def current(spark: SparkSession, root: str, partition: str) -> Snapshot:
    """The newest committed snapshot; before the first commit, the folders of the first load."""
    numbers = [int(n.split("-")[1]) for n in _children(spark, f"{root}/{_MANIFESTS}") if n.startswith("m-")]
    if not numbers:
        found = [n for n in _children(spark, root) if n.startswith(f"{partition}=")]
        return Snapshot(0, {int(n.split("=", 1)[1]): (n,) for n in found})
    text = spark.read.text(f"{root}/{_MANIFESTS}/m-{max(numbers):08d}", wholetext=True).first()[0]
    held = json.loads(text)
    entries = {int(v): e for v, e in held["partitions"].items()}
    return Snapshot(
        max(numbers),
        {v: tuple(e["folders"]) for v, e in entries.items()},
        {v: e["rows"] for v, e in entries.items() if "rows" in e},
        held.get("relative_key"),
    )


def commit(spark: SparkSession, root: str, after: Snapshot) -> None:
    """Publish a snapshot by one rename; fails if its number is taken."""
    entries = {
        str(v): {"folders": list(f)} | ({"rows": after.rows[v]} if v in after.rows else {}) for v, f in sorted(after.folders.items())
    }
    text = json.dumps({"partitions": entries, "relative_key": after.relative_key})
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    folder = f"{root}/{_MANIFESTS}"
    aside, fs = file_system(spark, f"{folder}/.{uuid.uuid4().hex}")
    out = fs.create(aside, False)
    out.write(bytearray(text.encode()))
    out.close()
    target = path_of(f"{folder}/m-{after.number:08d}")
    if fs.exists(target) or not fs.rename(aside, target):
        fs.delete(aside, False)
        raise Conflict(f"{target.toString()} is taken")


def read(spark: SparkSession, root: str, partition: str, schema: T.StructType, at: Snapshot | None = None) -> DataFrame:
    """All rows of a snapshot, with partition pruning. The frame keeps its files whatever is committed later."""
    at = at or current(spark, root, partition)
    paths = [f for folders in at.folders.values() for f in folders]
    first = [f"{root}/{p}" for p in paths if not p.startswith(_DATA)]
    later = [f"{root}/{p}" for p in paths if p.startswith(_DATA)]
    columns = schema.fieldNames()
    parts = []
    # Both kinds lie at different depths, and Spark wants one depth in a read.
    for base, group in ((root, first), (f"{root}/{_DATA}", later)):
        if group:
            parts.append(spark.read.schema(schema).option("basePath", base).parquet(*group).select(*columns))
    if not parts:
        return spark.createDataFrame([], schema)
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    if at.relative_key:
        # One entry per partition value.
        offsets = F.create_map(*(F.lit(x) for pair in at.offsets().items() for x in pair))
        whole = (F.col(at.relative_key) + F.element_at(offsets, F.col(partition).cast("int"))).cast(schema[at.relative_key].dataType)
        rows = rows.withColumn(at.relative_key, whole)
    return rows


def _write(df: DataFrame, root: str, partition: str) -> dict[int, str]:
    """Write rows into folders of their own, which nobody reads yet."""
    name = f"{_DATA}/commit={uuid.uuid4().hex}"
    files.write_partitions(df, f"{root}/{name}", partition, whole=True)
    found = _children(df.sparkSession, f"{root}/{name}")
    return {int(n.split("=", 1)[1]): f"{name}/{n}" for n in found if n.startswith(f"{partition}=")}


def replace_partitions(df: DataFrame, root: str, partition: str, values: Iterable[int] = ()) -> Snapshot:
    """A snapshot in which the partitions that ``df`` has rows for, and those of ``values``, hold just its rows.

    ``df`` may derive from the table.
    """
    spark = df.sparkSession
    before = current(spark, root, partition)
    if before.relative_key:
        raise ValueError("rows of a table with relative keys are replaced by replace_numbered")
    new = _write(df, root, partition)
    kept = {v: f for v, f in before.folders.items() if v not in set(values) | set(new)}
    after = Snapshot(before.number + 1, kept | {v: (f,) for v, f in new.items()})
    commit(spark, root, after)
    return after


def append(df: DataFrame, root: str, partition: str) -> Snapshot:
    """A snapshot with more rows; no stored file is rewritten."""
    spark = df.sparkSession
    before = current(spark, root, partition)
    if before.relative_key:
        raise ValueError("rows of a table with relative keys are added by replace_numbered")
    new = _write(df, root, partition)
    after = Snapshot(
        before.number + 1, dict(before.folders) | {v: (*before.folders.get(v, ()), f) for v, f in new.items()}
    )
    commit(spark, root, after)
    return after


def replace_numbered(df: DataFrame, root: str, partition: str, key: str, whole: bool = False) -> Snapshot:
    """Replace the partitions that ``df`` has rows for, or all, and number the table anew by partition and ``key``.

    ``df`` is a stored frame whose ``key`` is dense within each of its partition values in the order wanted. Partitions that ``df`` has
    no rows for keep their files; their numbers move with the rows before them. The first call has to be ``whole``.
    """
    spark = df.sparkSession
    before = current(spark, root, partition)
    if not whole and before.relative_key != key:
        raise ValueError("the first numbered load replaces the whole table")
    # One row per partition value reaches the driver.
    spans = df.groupBy(F.col(partition).cast("int").alias("v")).agg(F.min(key).alias("low"), F.count("*").alias("n")).collect()
    lows = F.create_map(*(F.lit(x) for r in spans for x in (r["v"], r["low"]))) if spans else F.lit(None)
    local = (F.col(key) - F.element_at(lows, F.col(partition).cast("int")) + 1).cast(df.schema[key].dataType)
    new = _write(df.withColumn(key, local), root, partition) if spans else {}
    kept = {} if whole else {v: f for v, f in before.folders.items() if v not in new}
    rows = {v: before.rows[v] for v in kept} | {r["v"]: r["n"] for r in spans}
    after = Snapshot(before.number + 1, kept | {v: (f,) for v, f in new.items()}, rows, key)
    commit(spark, root, after)
    return after


def drop_unreferenced(spark: SparkSession, root: str, partition: str, keep: int = 1) -> Sequence[str]:
    """Delete the folders and manifests that none of the newest ``keep`` snapshots names; returns the folders.

    For use while nobody reads an older snapshot or writes a new one.
    """
    numbers = sorted(int(n.split("-")[1]) for n in _children(spark, f"{root}/{_MANIFESTS}") if n.startswith("m-"))
    if not numbers:
        return []
    held: set[str] = set()
    for n in numbers[-keep:]:
        text = spark.read.text(f"{root}/{_MANIFESTS}/m-{n:08d}", wholetext=True).first()[0]
        held |= {f for e in json.loads(text)["partitions"].values() for f in e["folders"]}
    stored = [n for n in _children(spark, root) if n.startswith(f"{partition}=")]
    for c in _children(spark, f"{root}/{_DATA}"):
        stored += [f"{_DATA}/{c}/{n}" for n in _children(spark, f"{root}/{_DATA}/{c}") if n.startswith(f"{partition}=")]
    lost = [f for f in stored if f not in held]
    for name in [*lost, *(f"{_MANIFESTS}/m-{n:08d}" for n in numbers[:-keep])]:
        hadoop_path, fs = file_system(spark, f"{root}/{name}")
        fs.delete(hadoop_path, True)
    return lost
