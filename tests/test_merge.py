from datetime import datetime

from dimlathe.operators import merge

NOW, BEFORE = datetime(2024, 3, 1), datetime(2020, 1, 1)
DDL = "key bigint, id bigint, ref string, name string, url string, source string, created_at timestamp_ntz"
BATCH = "id bigint, ref string, name string, url string, source string"


def stored(rows):
    return rows(
        DDL,
        (1, 101, "csv", "A", "u", "f1_data.csv", BEFORE),
        (2, 102, "same", "B", "u", "api", BEFORE),
        (3, 103, "changed", None, "u", "api_incremental", BEFORE),
        (4, 104, "url", "D", "u", "api", BEFORE),
        (9, 109, "absent", "E", "u", "api", BEFORE),
    )


def batch(rows):
    return rows(
        BATCH,
        (1, "csv", "Z", "v", "api"),
        (2, "same", "B", "u", "api"),
        (3, "changed", "C", "v", "api"),
        (4, "url", "D", "v", "api"),
        (5, "new", "N", "v", "api"),
        (6, None, "no key", "v", "api"),
    )


def run(rows, existing, incoming, **options):
    return merge.upsert(
        existing, incoming, keys=["ref"], surrogate="key", compare=["name"], preserve=["key", "id", "source", "created_at"],
        protected="f1_data.csv", key_order=["ref"], load_ts=NOW, **options,
    )


def shown(df):
    return {r.ref: (r.key, r.id, r.name, r.url, r.source, r.created_at) for r in df.collect()}


def test_priority_upsert(rows):
    got = shown(run(rows, stored(rows), batch(rows)))
    assert got == {
        "csv": (1, 101, "A", "u", "f1_data.csv", BEFORE),
        "same": (2, 102, "B", "u", "api", BEFORE),
        "changed": (3, 103, "C", "v", "api_incremental", BEFORE),
        "url": (4, 104, "D", "u", "api", BEFORE),
        "absent": (9, 109, "E", "u", "api", BEFORE),
        "new": (10, 5, "N", "v", "api", NOW),
    }


def test_upsert_twice_changes_nothing(rows):
    once = run(rows, stored(rows), batch(rows))
    assert shown(run(rows, once, batch(rows))) == shown(once)


def test_first_load_continues_a_given_maximum(rows):
    got = shown(run(rows, stored(rows).where("false"), batch(rows), floor=40))
    assert sorted(v[0] for v in got.values()) == [41, 42, 43, 44, 45]
    assert None not in got


def test_first_stored_and_last_incoming_row_decide(rows):
    existing = stored(rows).union(rows(DDL, (20, 120, "same", "other", "u", "f1_data.csv", BEFORE)))
    incoming = batch(rows).union(rows(BATCH, (7, "changed", "last", "w", "api")))
    merged = run(rows, existing, incoming, first_existing_by=["key"], last_batch_by=["id"])
    assert {2, 20} <= {r[0] for r in merged.collect()}  # no stored row is lost
    got = shown(merged.where("key <> 20"))
    assert got["same"][0] == 2 and got["changed"][2] == "last" and len(got) == 6


def test_action_counts(rows):
    counts = merge.action_counts(stored(rows), batch(rows), ["ref"], ["name"], "f1_data.csv")
    assert {r.action: r.rows for r in counts.collect()} == {
        "skip_protected": 1, "skip_equal": 2, "update": 1, "add": 1, "null_key": 1,
    }


def test_change_detection_is_null_safe(rows):
    for a, b, equal in ((None, None, True), (None, 1, False), (1, 1, True), (1, 2, False)):
        left, right = rows("k int, v int", (1, a)), rows("k int, w_v int", (1, b))
        joined = left.join(right, "k").select(merge.same_values(left, right, ["v"], prefix="w_"))
        assert joined.first()[0] is equal


LAPS = "key bigint, race int, lap int, source string, ms int"


def test_replace_unprotected(rows):
    existing = rows(LAPS, (1, 1, 1, "f1_data.csv", 10), (2, 1, 2, "api", 20), (7, 1, None, "f1_data.csv", 5))
    incoming = rows(LAPS[11:].strip(", "), (1, 1, "api", 99), (1, 3, "api", 30), (1, None, "api", 7))
    options = dict(keys=["race", "lap"], protected=["f1_data.csv"], surrogate="key", key_order=["race", "lap"])
    anew = merge.replace_unprotected(existing, incoming, **options)
    assert sorted(map(tuple, anew.collect())) == [
        (1, 1, 1, "f1_data.csv", 10), (2, 1, 3, "api", 30), (3, 1, None, "f1_data.csv", 5),
    ]
    stable = merge.replace_unprotected(existing, incoming, rekey=False, **options)
    assert sorted(r.key for r in stable.collect()) == [1, 7, 8]


def test_replacement_stays_in_its_scope_and_keeps_numbers(rows):
    existing = rows(LAPS, (1, 1, 1, "api", 10), (2, 2, 1, "api", 20), (3, 2, 2, "api", 25), (4, None, 1, "api", 5))
    incoming = rows(LAPS[11:].strip(", "), (2, 1, "api", 21), (2, 3, "api", 30))
    options = dict(keys=["race", "lap"], protected=["f1_data.csv"], surrogate="key", key_order=["race", "lap"])
    merged = merge.replace_unprotected(existing, incoming, rekey=False, scope=["race"], **options)
    assert {tuple(r) for r in merged.collect()} == {
        (1, 1, 1, "api", 10), (2, 2, 1, "api", 21), (4, None, 1, "api", 5), (5, 2, 3, "api", 30),
    }


def test_increment_inserts_once_and_never_changes(rows):
    existing = rows(
        "key bigint, id bigint, ref string, source string, created_at timestamp_ntz",
        (5, 50, "a", "f1_data.csv", BEFORE), (6, 10_004, "b", "api", BEFORE),
    )
    options = dict(
        keys=["ref"], surrogate="key", key_order=["ref", "n"], source="api_incremental", load_ts=NOW, identity="id",
        identity_floor=10_000, protected="f1_data.csv",
    )
    incoming = rows("ref string, n int", ("a", 1), ("d", 2), ("c", 1), ("d", 1))
    new = merge.increment(existing, incoming, **options)
    got = sorted((r.key, r.id, r.ref, r.source, r.created_at) for r in new.collect())
    assert got == [(7, 10_005, "c", "api_incremental", NOW), (8, 10_006, "d", "api_incremental", NOW)]
    again = merge.increment(existing.unionByName(new), incoming, **options)
    assert again.count() == 0
