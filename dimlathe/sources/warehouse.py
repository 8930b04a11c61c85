"""Named warehouse tables: schemas, replace, append, existence-checked insert, JDBC."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimlathe.operators.lookup import new_rows
from dimlathe.sources import files


class Warehouse:
    """Tables under one root folder, registered in the session catalog.

    Each table is an external Parquet table that points at a version folder. Replacing it writes a new
    version and moves the pointer, so readers never see half a table and a table can be rebuilt from
    itself.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def recreate_schema(self, name: str) -> None:
        self.spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
        self.spark.sql(f"CREATE DATABASE {name} LOCATION '{self.root}/{name}'")

    def ensure_schema(self, name: str) -> None:
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{self.root}/{name}'")

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(table)

    def read(self, table: str) -> DataFrame:
        """The table with its present files; streams write from sessions of their own."""
        self.spark.catalog.refreshTable(table)
        return self.spark.table(table)

    def keys(self, table: str, key: Sequence[str], like: DataFrame) -> DataFrame:
        """The key columns of a table; a table that does not exist holds no keys."""
        if self.exists(table):
            return self.read(table).select(*key)
        return self.spark.createDataFrame([], like.select(*key).schema)

    def _point(self, table: str, path: str, schema: T.StructType, partition: str | None) -> None:
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        parted = f"PARTITIONED BY (`{partition}`)" if partition else ""
        self.spark.sql(f"CREATE TABLE {table} ({ddl}) USING PARQUET {parted} LOCATION '{path}'")
        if partition:
            self.spark.sql(f"MSCK REPAIR TABLE {table}")

    def replace(
        self, df: DataFrame, table: str, partition: str | None = None, bucket: Sequence[str] | None = None, buckets: int | None = None
    ) -> None:
        """Write a new version and point the table at it. With ``partition`` the table is partitioned by
        that column, which moves to the end, and queries on it read only the partitions they need. With ``bucket``, its natural
        key, it is bucketed and sorted by that: joins on the key do not shuffle it, whatever the size of the other side.
        ``buckets`` should not be fewer than the shuffle partitions, the default, and give files of a few hundred MB."""
        path = f"{self.root}/{table.replace('.', '/')}-{uuid.uuid4().hex}"
        if bucket:
            count = buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            aside = f"{table}_{uuid.uuid4().hex}"
            writer = df.repartition(count, *bucket).write.format("parquet").option("path", path)
            writer.bucketBy(count, *bucket).sortBy(*bucket).saveAsTable(aside)
            # The old version serves readers until the new one is whole.
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
            self.spark.sql(f"ALTER TABLE {aside} RENAME TO {table}")
            return
        if partition:
            files.write_partitions(df, path, partition, whole=True)
        else:
            df.write.parquet(path)
        shape = [(f.name, f.dataType) for f in df.schema]
        if self.exists(table):
            if partition is None and [(f.name, f.dataType) for f in self.read(table).schema] == shape:
                self.spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
                return
            self.spark.sql(f"DROP TABLE {table}")
        self._point(table, path, df.schema, partition)

    def bucketing(self, table: str) -> tuple[list[str], int]:
        """The columns a table is bucketed by and the number of buckets; none and 0 for other tables."""
        told = {r["col_name"]: r["data_type"] for r in self.spark.sql(f"DESCRIBE FORMATTED {table}").collect()}
        count = int(told.get("Num Buckets") or 0)
        return ([c.strip(" `") for c in told["Bucket Columns"].strip("[]").split(",")] if count else []), count

    def append(self, df: DataFrame, table: str) -> None:
        """Add rows. Rows for a bucketed table are dealt by its key first, so each bucket gains one file."""
        if not self.exists(table):
            self.replace(df, table)
            return
        rows = df.select(*self.read(table).columns)
        key, count = self.bucketing(table)
        rows = rows.repartition(count, *key) if key else rows
        rows.write.mode("append").insertInto(table)

    def compact(self, table: str) -> None:
        """Rewrite a bucketed table with one sorted file per bucket, after many appends."""
        key, count = self.bucketing(table)
        self.replace(self.read(table), table, bucket=key, buckets=count)

    def insert_unseen(
        self, df: DataFrame, table: str, key: Sequence[str], first_by: Sequence[str] | None = None
    ) -> int:
        """Append the rows whose key the table does not hold; a key repeated in ``df`` goes in once.

        Returns the number of inserted rows, counted while they are written.
        """
        order = first_by or [c for c in df.columns if c not in key] or list(key)
        bucketed = self.exists(table) and self.bucketing(table)[0] == list(key)
        new = new_rows(df, self.keys(table, key, df), key, order, bucketed)
        counted = Observation()
        self.append(new.observe(counted, F.count(F.lit(1)).alias("rows")), table)
        return counted.get["rows"]

    def view(self, df: DataFrame, name: str) -> None:
        df.createOrReplaceTempView(name)

    def sql_view(self, name: str, text: str) -> None:
        """A view in the catalog. It is planned anew at each use, so it follows its tables when they are replaced or added to."""
        self.spark.sql(f"CREATE OR REPLACE VIEW {name} AS {text}")


def write_jdbc(df: DataFrame, url: str, table: str, mode: str, batch: int = 1000, **options: str) -> None:
    """Write to a database that has a JDBC driver on the class path. ``truncate`` keeps its grants and indexes."""
    writer = df.write.format("jdbc").option("url", url).option("dbtable", table)
    writer.option("batchsize", batch).option("truncate", "true").options(**options).mode(mode).save()


def read_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """Read a database table; pass ``partitionColumn`` and bounds to read it in parallel."""
    return spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options).load()
