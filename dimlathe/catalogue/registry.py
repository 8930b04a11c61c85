"""Every query with the SQL that must give the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from dimlathe.session import scratch_path
from dimlathe.sources.warehouse import Warehouse

# Fixed load time of the catalogue's loads, so that reruns give the same rows.
LOAD_TS = datetime(2024, 3, 1)


@dataclass(frozen=True)
class Tables:
    """The given tables by name: ``Tables(spark, folder).orders``."""

    spark: SparkSession
    folder: str

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


@dataclass(frozen=True)
class Entry:
    run: Callable[[Tables], DataFrame]
    sql: str | None


CATALOGUE: dict[str, Entry] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name`` with its oracle SQL."""

    def register(run: Callable[[Tables], DataFrame]):
        CATALOGUE[name] = Entry(run, sql)
        return run

    return register


def new_warehouse(t: Tables) -> tuple[Warehouse, str]:
    """A warehouse in scratch space and the name of an empty schema in it."""
    house = Warehouse(t.spark, scratch_path(t.spark, "warehouse"))
    schema = f"dimlathe_{uuid.uuid4().hex}"
    house.recreate_schema(schema)
    return house, schema
