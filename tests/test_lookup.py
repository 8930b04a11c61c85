from pyspark.sql import functions as F

from dimlathe.operators import lookup
from dimlathe.operators.quality import orphan_counts


def test_lookup_takes_the_last_duplicate_and_misses_give_null(rows):
    fact = rows("k int", (1,), (2,), (None,))
    dim = rows("ref int, at int, key int", (1, 1, 10), (1, 2, 11), (3, 1, 30))
    got = lookup.lookup(fact, dim, {"k": "ref"}, {"key": "dim_key"}, last_by=["at"])
    assert sorted(map(str, got.collect())) == sorted(
        ["Row(k=1, dim_key=11)", "Row(k=2, dim_key=None)", "Row(k=None, dim_key=None)"]
    )


def test_lookup_composite_and_same_names(rows):
    fact = rows("year int, round int, key string", (2024, 1, "x"), (2024, 2, "y"))
    races = rows("year int, round int, race_key int", (2024, 1, 7))
    got = lookup.lookup(fact, races, {"year": "year", "round": "round"}, {"race_key": "race_key"})
    assert sorted((r.key, r.race_key) for r in got.collect()) == [("x", 7), ("y", None)]
    assert got.columns == ["year", "round", "key", "race_key"]


def test_two_hops_to_the_calendar(rows):
    laps = rows("race int", (1,), (2,), (3,))
    races = rows("race_id int, day string", (1, "2024-03-02"), (2, None))
    calendar = rows("full_date string, time_key int", ("2024-03-02", 62)).withColumn("full_date", F.to_date("full_date"))
    got = lookup.lookup_by_date(laps, "race", races, "race_id", "day", calendar)
    assert sorted((r.race, r.time_key) for r in got.collect()) == [(1, 62), (2, None), (3, None)]


def test_bridge_takes_the_last_row(rows):
    laps = rows("race int, driver int, lap int", (1, 1, 1), (1, 2, 1))
    results = rows("race int, driver int, team int, result int", (1, 1, 5, 1), (1, 1, 6, 2))
    got = lookup.lookup_via_bridge(laps, results, ["race", "driver"], "team", ["result"])
    assert sorted((r.driver, r.team) for r in got.collect()) == [(1, 6), (2, None)]


def test_unseen_null_matching(rows):
    batch = rows("a int, b int", (1, None), (1, 2), (2, None))
    stored = rows("a int, b int", (1, None), (1, None), (3, 3))
    strict = lookup.unseen(batch, stored, ["a", "b"])
    assert sorted(strict.collect(), key=str) == sorted(batch.collect(), key=str)
    safe = lookup.unseen(batch, stored, ["a", "b"], null_safe=True)
    assert sorted(map(tuple, safe.collect()), key=str) == [(1, 2), (2, None)]


def test_unseen_keeps_repeated_batch_rows(rows):
    batch = rows("a int, v int", (1, 1), (2, 2), (2, 3))
    got = lookup.unseen(batch, rows("a int", (1,), (1,)), ["a"])
    assert sorted(map(tuple, got.collect())) == [(2, 2), (2, 3)]


def test_new_rows_take_each_known_key_once_and_all_incomplete_ones(rows):
    ddl = "a int, b int, v string"
    batch = rows(ddl, (1, 1, "seen"), (2, 1, "second"), (2, 1, "first"), (3, None, "x"), (3, None, "y"), (4, None, "z"))
    stored = rows("a int, b int", (1, 1), (4, None), (3, 3))
    got = lookup.new_rows(batch, stored, ["a", "b"], ["v"])
    assert sorted(r.v for r in got.collect()) == ["first", "x", "y"]


def test_misses_and_orphans(rows):
    fact = rows("k int, ref string", (1, "a"), (None, "b"), (None, "b"), (9, "c"))
    assert lookup.miss_counts(fact, ["k"]).first().k == 2
    assert [tuple(r) for r in lookup.unresolved_values(fact, "k", ["ref"]).collect()] == [("b", 2)]
    assert [tuple(r) for r in orphan_counts(fact, {"k": (rows("id int", (1,)), "id")}).collect()] == [("k", 1)]
