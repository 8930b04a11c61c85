"""A third of the rows under one key: results stay whole, and the hot partition is split."""

import pytest
from pyspark.sql import functions as F

from dimlathe.operators import keys, lookup, merge


@pytest.fixture
def no_broadcast(spark):
    """Make small data behave like large data: no broadcast, low skew thresholds."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def hot(spark):
    """60,000 facts over many map tasks; key 7 holds a third of them."""
    ids = spark.range(0, 60_000, 1, 16)
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000)
    return ids.select(key.cast("bigint").alias("k"), "id", F.sha2(F.col("id").cast("string"), 256).alias("pad"))


@pytest.fixture
def dim(spark):
    return spark.range(0, 5000, 1, 4).select(F.col("id").alias("ref"), (F.col("id") + 1).alias("key"), F.lit(1).alias("v"))


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    seen = df.collect()
    return seen, df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("last_by", [None, ["v"]])
def test_lookup_splits_a_hot_key(no_broadcast, hot, dim, last_by):
    got, plan = final_plan(lookup.lookup(hot, dim, {"k": "ref"}, {"key": "key"}, last_by=last_by))
    assert "skew=true" in plan, plan
    assert len(got) == 60_000 and all(r.key == r.k + 1 for r in got)


@pytest.mark.parametrize("null_safe", [False, True])
def test_unseen_splits_a_hot_key(no_broadcast, hot, dim, null_safe):
    stored = dim.where("ref <> 7").withColumnRenamed("ref", "k")
    got, plan = final_plan(lookup.unseen(hot, stored, ["k"], null_safe))
    assert "skew=true" in plan, plan
    assert {r.k for r in got} == {7} and len(got) == hot.where("k = 7").count()


def test_hot_stored_keys(no_broadcast, hot, spark):
    batch = spark.range(100).select(F.when(F.col("id") == 0, 99_999).otherwise(F.col("id")).alias("k"))
    got, _ = final_plan(lookup.unseen(batch, hot, ["k"]))
    assert [r.k for r in got] == [99_999]


def test_first_rows_of_a_hot_key(no_broadcast, hot):
    first = {r.k: r.id for r in keys.keep_first(hot, ["k"], ["id"]).collect()}
    expected = {}
    for r in hot.select("k", "id").collect():
        expected[r.k] = min(r.id, expected.get(r.k, r.id))
    assert first == expected


def test_increment_of_a_hot_batch(no_broadcast, hot, dim):
    from datetime import datetime

    stored = dim.where("ref < 4000").select("key", F.col("ref").alias("k")).withColumn("source", F.lit("csv"))
    new = merge.increment(
        stored, hot, keys=["k"], surrogate="key", key_order=["k", "id"], source="weekly", load_ts=datetime(2024, 1, 1),
    )
    rows = new.orderBy("key").collect()
    missing = sorted(r.k for r in hot.select("k").distinct().collect() if r.k >= 4000)
    assert [r.k for r in rows] == missing
    assert [r.key for r in rows] == list(range(4001, 4001 + len(missing)))
