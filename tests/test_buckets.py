"""Bucketed tables and the digest index: what joins shuffle and read."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from dimlathe.operators import lookup, merge
from dimlathe.sources.warehouse import Warehouse


@pytest.fixture
def house(spark, folder):
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if the batch were over the threshold
    made = Warehouse(spark, folder)
    made.recreate_schema("bucket_test")
    yield made
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)


def shuffled_scans(df, marker):
    """Whether an Exchange lies between the scan that shows ``marker`` and the first join above it."""
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].splitlines()
    at = next(i for i, line in enumerate(plan) if marker in line)
    depth = plan[at].index("FileScan")
    for line in reversed(plan[:at]):
        start = re.search(r"[A-Z]", line).start()
        if start < depth:
            depth = start
            if "Exchange" in line:
                return True
            if "Join" in line:
                return False
    return False


def test_inserts_do_not_shuffle_the_stored_side(spark, house):
    rows = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    house.replace(rows.where("k % 2 = 0"), "bucket_test.t", bucket=["k"], buckets=8)
    assert house.bucketing("bucket_test.t") == (["k"], 8)
    new = lookup.unseen(rows, house.read("bucket_test.t"), ["k"], bucketed=True)
    assert len(new.collect()) == 1000
    assert not shuffled_scans(new, "Bucketed: true")
    house.replace(rows.where("k % 2 = 0"), "bucket_test.plain")
    plain = lookup.unseen(rows, house.read("bucket_test.plain"), ["k"])
    assert len(plain.collect()) == 1000 and shuffled_scans(plain, "bucket_test.plain[")
    assert house.insert_unseen(rows, "bucket_test.t", ["k"]) == 1000
    assert house.insert_unseen(rows, "bucket_test.t", ["k"]) == 0
    house.compact("bucket_test.t")
    assert house.bucketing("bucket_test.t") == (["k"], 8)
    assert sorted(map(tuple, house.read("bucket_test.t").collect())) == [(k, 2 * k) for k in range(2000)]


STORED = "id bigint, k string, a double, b string, wide string, source string, created_at timestamp_ntz"


def test_the_index_finds_what_changed_without_wide_rows(spark, rows, house):
    old = datetime(2024, 1, 1)
    stored = rows(
        STORED, (1, "p", 1.0, "x", "w" * 50, "csv", old), (2, "q", 1.0, None, "w", "api", old), (3, "r", 0.0, "x", "w", "api", old),
        (4, "s", None, "x", "w", "api", old), (5, None, 1.0, "x", "w", "api", old),
    )
    house.replace(stored, "bucket_test.s", bucket=["k"], buckets=8)
    held = house.read("bucket_test.s")
    house.replace(merge.digest_index(held, ["k"], ["a", "b"]), "bucket_test.d", bucket=["k"], buckets=8)
    index = house.read("bucket_test.d")
    batch = rows(
        "k string, a double, b string, wide string", ("p", 9.0, "y", "n"), ("q", 1.0, None, "n"), ("r", -0.0, "x", "n"),
        ("s", 2.0, "x", "n"), ("t", 1.0, "x", "n"), (None, 1.0, "x", "n"),
    )
    changed = merge.changed_rows(index, batch, ["k"], ["a", "b"], "csv")
    assert sorted(r.k or "" for r in changed.collect()) == ["", "r", "s", "t"]  # -0.0 differs in its digest only
    plan = changed._jdf.queryExecution().executedPlan().toString()
    assert "bucket_test.d[" in plan and "bucket_test.s[" not in plan and not shuffled_scans(changed, "Bucketed: true")
    options = dict(
        keys=["k"], surrogate="id", compare=["a", "b"], preserve=["id", "source", "created_at"], protected="csv", key_order=["k"],
        load_ts=datetime(2024, 2, 1),
    )
    plain = merge.upsert(held, batch, **options)
    indexed = merge.upsert(held, batch, index=index, **options)
    assert sorted(map(str, indexed.collect())) == sorted(map(str, plain.collect()))
    written = indexed.where("k IN ('s', 't')")
    again = merge.refresh_index(index, written, ["k"], ["a", "b"])
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, merge.digest_index(indexed, ["k"], ["a", "b"]).collect()))
    assert [r.k for r in merge.changed_rows(again, batch.where("k <> 'r'"), ["k"], ["a", "b"], "csv").collect()] == []
