from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimlathe.operators import quality, shape
from dimlathe.registry import TableSpec

SPEC = TableSpec(
    "t", "dimensions",
    {"k": "bigint", "born": "date", "at": "time", "seen": "timestamp_ntz", "name": "string", "x": "double"},
    surrogate="k", natural=("name",), unknown_text=("name",),
)


def test_majority_inference_counts_nulls(rows):
    df = rows("a string, b string, c string", ("1", "1", "x"), ("2", "2", "7"), ("x", "3", "y"), (None, "x", None))
    inferred, numeric = shape.infer_numeric(df, always=("c",))
    assert numeric == ["b", "c"]
    assert [r.a for r in inferred.collect()] == ["1", "2", "x", None]
    assert [r.b for r in inferred.collect()] == [1.0, 2.0, 3.0, None]
    assert [r.c for r in inferred.collect()] == [None, 7.0, None, None]


def test_inference_of_an_empty_table(rows):
    assert shape.infer_numeric(rows("a string"))[1] == []


def test_conform_types_order_and_unknown(rows):
    df = rows(
        "x string, name string, seen string, at string, born string, k string, more string",
        ("1.5", "nan", "2024-01-01 10:00:00", "13:05:00Z", "1985-01-07", "5.0", "-"),
        ("bad", "Ann", "bad", "25:00:00", "1985-02-30", "x", "-"),
    )
    first, second = shape.conform(df, SPEC).collect()
    assert tuple(first) == (5, datetime(1985, 1, 7).date(), "13:05:00", datetime(2024, 1, 1, 10), "unknown", 1.5)
    assert tuple(second) == (None, None, None, None, "Ann", None)
    assert shape.conform(df, SPEC).columns == list(SPEC.columns)


def test_conform_needs_every_column(rows):
    with pytest.raises(AnalysisException):
        shape.conform(rows("k bigint", (1,)), SPEC)


def test_nan_is_null(rows):
    df = shape.null_nans(rows("n int, x double", (1, float("nan")), (2, 1.0)))
    assert [r.x for r in df.orderBy("n").collect()] == [None, 1.0]


def test_lenient_selection_and_fallback(rows):
    df = rows("a int, b int", (1, 2))
    assert shape.select_existing(df, ["b", "z", "a"]).columns == ["b", "a"]
    assert df.select(shape.first_existing(df, "z", "b").alias("v")).first().v == 2
    assert shape.missing_columns(df, ["a", "z"]) == ["z"]


def test_guarded_transform(rows, spark):
    schema = T.StructType.fromDDL("a int, b string")
    assert shape.guarded(rows("b string", ("x",)), ["a"], schema, lambda d: d).count() == 0
    assert [tuple(r) for r in shape.guarded(rows("a int", (1,)), ["a"], schema, lambda d: d).collect()] == [(1, None)]
    assert shape.ensure_schema(None, schema, spark).schema == schema


def test_align_adds_columns_on_both_sides(rows):
    got = shape.align(rows("a int, b int", (1, 2)), rows("c int, a int", (3, 4)))
    assert got.columns == ["a", "b", "c"]
    assert sorted(map(tuple, got.collect())) == [(1, 2, None), (4, None, 3)]


def test_numeric_text_sorts_by_value(rows):
    df = rows("c string", ("10",), ("2",), (None,), ("x",), ("1",))
    assert [r.c for r in df.orderBy(shape.numeric_text_order("c")).collect()][:3] == ["1", "2", "10"]


def test_checks_and_reports(rows):
    df = rows("k int, source string", (1, "a"), (1, "b"), (2, "b"), (None, "b"))
    assert [tuple(r) for r in quality.duplicate_keys(df, ["k"]).collect()] == [(1, 2)]
    profile = {r.source: (r.rows, r.min_id, r.max_id) for r in quality.lineage_profile(df, "source", "k").collect()}
    assert profile == {"a": (1, 1, 1), "b": (3, 1, 2)}
    assert tuple(quality.distinct_counts(df, one=["k"], two=["k", "source"]).first()) == (2, 3)
    assert tuple(quality.load_report(df.limit(1), df.where(F.col("k") == 2), df).first()) == (1, 1, 4, 3)
