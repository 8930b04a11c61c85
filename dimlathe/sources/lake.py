"""Versioned Parquet tables without a catalog."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimlathe.operators import keys
from dimlathe.registry import TableSpec
from dimlathe.session import file_system, materialize
from dimlathe.sources import files, snapshots


class Lake:
    """Tables as folders ``<root>/<area>/<name>/v-<n>``; the newest completed version is the table.

    A version counts once Spark has written its success marker, so readers see whole tables only. Within
    a version, partitioned tables change by snapshots: a change of some years writes those years and one manifest.
    Each table has one writer at a time.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _versions(self, spec: TableSpec) -> list[str]:
        folder = f"{self.root}/{spec.area}/{spec.name}"
        hadoop_path, fs = file_system(self.spark, folder)
        if not fs.exists(hadoop_path):
            return []
        found = sorted(status.getPath().getName() for status in fs.listStatus(hadoop_path))
        path_of = self.spark._jvm.org.apache.hadoop.fs.Path
        return [f"{folder}/{v}" for v in found if fs.exists(path_of(f"{folder}/{v}/_SUCCESS"))]

    def exists(self, spec: TableSpec) -> bool:
        return bool(self._versions(spec))

    def read(self, spec: TableSpec, first: int | None = None, last: int | None = None) -> DataFrame:
        """The table, or a range of its partitions; a table never written is empty."""
        versions = self._versions(spec)
        if not versions:
            return self.spark.createDataFrame([], spec.schema())
        if spec.partition is None:
            return self.spark.read.schema(spec.schema()).parquet(versions[-1])
        rows = snapshots.read(self.spark, versions[-1], spec.partition, spec.schema())
        if first is not None:
            rows = rows.where(F.col(spec.partition) >= first)
        return rows if last is None else rows.where(F.col(spec.partition) <= last)

    def read_touched(self, spec: TableSpec, batch: DataFrame) -> DataFrame:
        """The partitions that ``batch`` has rows for. Their values, one per folder, go into the plan as
        literals, so all other partitions are pruned before the scan."""
        values = [r[0] for r in files.with_partition_value(batch, spec.partition).select(spec.partition).distinct().collect()]
        return self.read(spec).where(F.col(spec.partition).isin(values))

    def overwrite(self, spec: TableSpec, df: DataFrame) -> None:
        """Write a new version; ``df`` may derive from the present one."""
        versions = self._versions(spec)
        number = int(versions[-1].rsplit("-", 1)[1]) + 1 if versions else 1
        path = f"{self.root}/{spec.area}/{spec.name}/v-{number:08d}"
        df = df.select(*spec.columns)
        if spec.partition is None:
            df.write.mode("overwrite").parquet(path)
        else:
            files.write_partitions(df, path, spec.partition, whole=True)

    def rewrite_partitions(self, spec: TableSpec, df: DataFrame, values: Iterable[int] = ()) -> None:
        """Replace the partitions that ``df`` has rows for, and those of ``values``, in one commit. ``df`` may derive from the table."""
        versions = self._versions(spec)
        if versions:
            snapshots.replace_partitions(df.select(*spec.columns), versions[-1], spec.partition, values)
        else:
            self.overwrite(spec, df)

    def numbered(self, spec: TableSpec) -> bool:
        """Whether the table's surrogate keys are stored as places within partitions."""
        versions = self._versions(spec)
        return bool(versions) and snapshots.current(self.spark, versions[-1], spec.partition).relative_key is not None

    def rewrite_numbered(self, spec: TableSpec, df: DataFrame) -> None:
        """Replace the partitions that ``df`` has rows for and number the whole table anew, by partition and then by the
        order of ``df``'s surrogate keys. Only the first call on a table rewrites all partitions; it needs all rows."""
        rows = materialize(df.select(*spec.columns), spec.name)
        if not self._versions(spec):
            self.overwrite(spec, rows.where("false"))
        whole = not self.numbered(spec)
        snapshots.replace_numbered(rows, self._versions(spec)[-1], spec.partition, spec.surrogate, whole)

    def append(self, spec: TableSpec, df: DataFrame) -> None:
        """Add rows; ``df`` must not derive lazily from this table."""
        versions = self._versions(spec)
        if not versions:
            self.overwrite(spec, df)
        elif spec.partition is None:
            df.select(*spec.columns).write.mode("append").parquet(versions[-1])
        elif self.numbered(spec):
            self._append_numbered(spec, df)
        else:
            snapshots.append(df.select(*spec.columns), versions[-1], spec.partition)

    def _append_numbered(self, spec: TableSpec, df: DataFrame) -> None:
        """Rows of a numbered table go behind the stored ones of their partition."""
        stored = self.read_touched(spec, df)
        behind = df.select(*spec.columns).withColumn(spec.surrogate, F.col(spec.surrogate) + keys.max_key(self.read(spec), spec.surrogate))
        self.rewrite_numbered(spec, keys.dense_key(stored.unionByName(behind), spec.surrogate, [spec.partition, spec.surrogate]))

    def drop_old_versions(self, spec: TableSpec, keep: int = 1) -> None:
        """Delete all but the newest ``keep`` versions, once no reader uses them."""
        for path in self._versions(spec)[:-keep]:
            hadoop_path, fs = file_system(self.spark, path)
            fs.delete(hadoop_path, True)

    def set_aside(self, spec: TableSpec, df: DataFrame) -> None:
        """Keep rows that cannot be merged, for repair and a later load."""
        df.write.mode("append").parquet(f"{self.root}/quarantine/{spec.name}")

    def set_aside_unplaced(self, spec: TableSpec, df: DataFrame) -> None:
        """Keep rows without a partition value, which no partitioned write can place."""
        lost = df.where(F.col(spec.partition).isNull())
        lost.write.mode("append").parquet(f"{self.root}/quarantine/unplaced/{spec.name}")
