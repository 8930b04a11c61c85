import random

import pytest
from pyspark.sql import functions as F

from dimlathe.operators import keys


def test_dense_key_is_the_global_row_number(rows):
    random.seed(3)
    # A third of the rows share one leading value; some leading values are NULL; the middle column ties.
    data = [
        (random.choice([7, 7, None, *range(20)]) if i % 3 else 7, random.choice("abc"), i) for i in range(3000)
    ]
    random.shuffle(data)
    keyed = keys.dense_key(rows("a int, b string, c int", *data), "k", ["a", "b", "c"])
    got = [(r.a, r.b, r.c) for r in keyed.orderBy("k").collect()]
    assert got == sorted(data, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2]))
    assert [r.k for r in keyed.orderBy("k").collect()] == list(range(1, 3001))
    assert keyed.columns[0] == "k"


def test_dense_key_spreads_a_hot_leading_value(spark):
    hot = spark.range(20_000).select(F.lit(1).alias("a"), "id")
    keyed = keys.dense_key(hot, "k", ["a", "id"])
    files = keyed.groupBy(F.input_file_name()).count().collect()
    assert len(files) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert max(f["count"] for f in files) < 2 * 20_000 / len(files)


def test_dense_key_of_nothing(rows):
    assert keys.dense_key(rows("a int"), "k", ["a"]).count() == 0


def test_dense_key_replaces_an_old_key(rows):
    keyed = keys.dense_key(rows("k bigint, a int", (9, 2), (8, 1)), "k", ["a"])
    assert sorted(map(tuple, keyed.collect())) == [(1, 1), (2, 2)]


def test_append_continues_after_the_maximum(rows):
    old = rows("k bigint, a int", (1, 1), (41, 2))
    new = keys.append_keys(rows("a int", (5,), (4,)), old, "k", ["a"])
    assert sorted(map(tuple, new.collect())) == [(42, 4), (43, 5)]
    first = keys.append_keys(rows("a int", (5,)), old.where("false"), "k", ["a"])
    assert [tuple(r) for r in first.collect()] == [(1, 5)]


def test_first_and_last_per_key(rows):
    df = rows("k int, at int, v string", (1, 2, "b"), (1, 1, "a"), (1, 3, "c"), (None, 2, "y"), (None, 1, "x"))
    assert sorted(r.v for r in keys.keep_first(df, ["k"], ["at"]).collect()) == ["a", "x"]
    last = keys.latest_per_key(df, ["k"], ["v"], ["at"]).collect()
    assert sorted(r.v for r in last) == ["c", "y"]


def test_keep_first_cuts_rows_before_the_shuffle(rows):
    df = keys.keep_first(rows("k int, at int", (1, 1)), ["k"], ["at"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2, plan


@pytest.mark.parametrize(
    "data, expected",
    [
        ([(5, "csv"), (9, "api"), (7, None)], 9),
        ([(5, "csv")], 100),
        ([(5, "csv"), (None, "api")], 100),
        ([], 100),
        ([(5, "csv"), (7, None)], 7),
    ],
)
def test_max_id_outside_a_lineage(rows, spark, data, expected):
    largest = keys.max_id_outside(rows("id bigint, source string", *data), "id", "source", "csv", 100)
    assert spark.range(1).select(largest).first()[0] == expected
