"""Snapshots of partitioned tables: whole commits, kept files, numbers by partition."""

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from dimlathe.operators import keys, merge
from dimlathe.registry import TableSpec
from dimlathe.sources import files, snapshots
from dimlathe.sources.lake import Lake

DDL = "k bigint, v string, source string, year bigint"
SPEC = TableSpec("t", "facts", {"k": "bigint", "v": "string", "source": "string", "year": "bigint"}, "k", ("v",), partition="year")


def stored(folder):
    """Data files with their change times."""
    return {str(p): p.stat().st_mtime_ns for p in Path(folder).rglob("*.parquet")}


def table(spark, root):
    return sorted(map(tuple, snapshots.read(spark, root, "year", SPEC.schema()).collect()))


@pytest.fixture
def root(rows, folder):
    path = f"{folder}/t"
    files.write_partitions(rows(DDL, (1, "a", "x", 2022), (2, "b", "x", 2023), (3, "c", "x", 2024)), path, "year", whole=True)
    return path


def test_a_change_writes_its_years_and_keeps_the_files_of_others(spark, rows, root):
    before = stored(root)
    held = snapshots.read(spark, root, "year", SPEC.schema())
    snapshots.replace_partitions(rows(DDL, (9, "z", "x", 2023), (10, "y", "x", 2025)), root, "year")
    snapshots.append(rows(DDL, (4, "d", "x", 2022)), root, "year")
    assert table(spark, root) == [(1, "a", "x", 2022), (3, "c", "x", 2024), (4, "d", "x", 2022), (9, "z", "x", 2023), (10, "y", "x", 2025)]
    assert sorted(r.k for r in held.collect()) == [1, 2, 3]  # a frame read before keeps its files
    assert before.items() <= stored(root).items()
    new = {p.split("/")[-2] for p in stored(root).keys() - before.keys()}
    assert new == {"year=2022", "year=2023", "year=2025"}
    one = snapshots.read(spark, root, "year", SPEC.schema()).where("year = 2023")
    assert [r.k for r in one.collect()] == [9]
    assert one._jdf.queryExecution().executedPlan().toString().count("PartitionFilters: [isnotnull(year") == 2


def test_emptied_partitions_go(spark, rows, root):
    snapshots.replace_partitions(rows(DDL), root, "year", [2023, 2024])
    assert table(spark, root) == [(1, "a", "x", 2022)]


def test_a_change_that_dies_midway_leaves_the_old_rows(spark, rows, root):
    boom = F.udf(lambda y: 1 // (2024 - y), "bigint")
    dying = rows(DDL, (7, "q", "x", 2022), (8, "r", "x", 2024)).withColumn("k", boom("year"))
    with pytest.raises(Exception, match="division"):
        snapshots.replace_partitions(dying, root, "year")
    assert [r[0] for r in table(spark, root)] == [1, 2, 3]
    # The files were written and the commit did not happen.
    snapshots._write(rows(DDL, (7, "q", "x", 2022)), root, "year")
    assert [r[0] for r in table(spark, root)] == [1, 2, 3]
    snapshots.replace_partitions(rows(DDL, (7, "q", "x", 2022)), root, "year")
    lost = snapshots.drop_unreferenced(spark, root, "year")
    assert len(lost) >= 2 and [r[0] for r in table(spark, root)] == [2, 3, 7]


def test_the_second_of_two_writers_fails(spark, rows, root):
    at = snapshots.current(spark, root, "year")
    snapshots.append(rows(DDL, (4, "d", "x", 2022)), root, "year")
    with pytest.raises(snapshots.Conflict):
        snapshots.commit(spark, root, snapshots.Snapshot(at.number + 1, at.folders))
    assert [r[0] for r in table(spark, root)] == [1, 2, 3, 4]


def test_numbers_follow_the_rows_before_them(spark, rows, folder):
    lake = Lake(spark, folder)
    first = rows("v string, source string, year bigint", *((f"{y}-{i}", "api", y) for y in (2021, 2022, 2023) for i in range(3)))
    lake.rewrite_numbered(SPEC, keys.dense_key(first, "k", ["year", "v"]).select(*SPEC.columns))
    assert lake.numbered(SPEC)
    before = stored(folder)
    middle = rows(DDL, *((i, f"2022-{i}", "api", 2022) for i in range(5)))
    merged = merge.replace_unprotected(
        lake.read_touched(SPEC, middle), middle, keys=["v"], protected=["csv"], surrogate="k", key_order=["year", "v"], scope=["year"]
    )
    lake.rewrite_numbered(SPEC, merged)
    got = sorted((r.k, r.v) for r in lake.read(SPEC).collect())
    assert got == list(enumerate(sorted([f"{y}-{i}" for y in (2021, 2023) for i in range(3)] + [f"2022-{i}" for i in range(5)]), 1))
    assert before.items() <= stored(folder).items()
    assert {p.split("/")[-2] for p in stored(folder).keys() - before.keys()} == {"year=2022"}
    lake.append(SPEC, rows(DDL, (1, "2021-9", "api", 2021)))
    assert sorted((r.k, r.v) for r in lake.read(SPEC).collect())[3] == (4, "2021-9")
    assert [r.k for r in lake.read(SPEC, 2023, 2023).orderBy("k").collect()] == [10, 11, 12]
    assert os.path.isdir(f"{folder}/facts/t/v-00000001/_manifests")


def test_a_missing_or_empty_table_is_empty(spark, rows, folder):
    assert table(spark, f"{folder}/none") == []
    lake = Lake(spark, folder)
    lake.rewrite_numbered(SPEC, rows(DDL))
    assert lake.read(SPEC).count() == 0
    lake.rewrite_numbered(SPEC, rows(DDL, (5, "a", "x", 2020)))
    assert [tuple(r) for r in lake.read(SPEC).collect()] == [(1, "a", "x", 2020)]
