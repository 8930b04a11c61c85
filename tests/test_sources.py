import json
import os
from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimlathe.registry import TableSpec
from dimlathe.sources import envelopes, files, topics
from dimlathe.sources.lake import Lake
from dimlathe.sources.warehouse import Warehouse
from dimlathe.streaming import consume


def test_csv_keeps_quotes_and_ingest_order(rows, spark, folder):
    df = rows("a int, b string", *[(i, f'x,"{i}"') for i in range(50)])
    files.write_csv(df.coalesce(1), f"{folder}/csv")
    back = files.read_csv_as_text(spark, f"{folder}/csv", ingest_order=True)
    got = [(r.a, r.b) for r in back.orderBy(files.INGEST).collect()]
    assert got == [(str(i), f'x,"{i}"') for i in range(50)]


def listing(path):
    return {d: sorted(os.listdir(f"{path}/{d}")) for d in os.listdir(path) if d.startswith("year=")}


def test_partitioned_writes_touch_only_their_partitions(rows, spark, folder):
    path = f"{folder}/facts"
    files.write_partitions(rows("year int, v int", (2023, 1), (2024, 2), (None, 3)), path, "year")
    before = listing(path)
    files.write_partitions(rows("year int, v int", (2024, 9)), path, "year")
    assert listing(path)["year=2023"] == before["year=2023"]
    files.append_partitions(rows("year int, v int, w int", (2024, 10, 1), (2025, 11, 1)), path, "year")
    assert listing(path)["year=2023"] == before["year=2023"]
    read = files.read_partitions(spark, path, "year")
    assert sorted((r.year, r.v, r.w) for r in read.collect()) == [
        (2023, 1, None), (2024, 9, None), (2024, 10, 1), (2025, 11, 1),
    ]
    some = files.read_partitions(spark, path, "year", 2024, 2099)
    assert sorted({r.year for r in some.collect()}) == [2024, 2025]
    assert "PartitionFilters: [isnotnull(year" in some._jdf.queryExecution().executedPlan().toString()
    assert files.count_unplaced(rows("year int", (None,), (1,)), "year").first().dropped == 1


SPEC = TableSpec("t", "facts", {"k": "bigint", "v": "bigint", "year": "bigint"}, surrogate="k", natural=("v",), partition="year")


def test_lake_versions(rows, spark, folder):
    lake = Lake(spark, folder)
    assert lake.read(SPEC).count() == 0
    lake.append(SPEC, rows("k bigint, v bigint, year bigint", (1, 1, 2023), (2, 2, 2024)))
    lake.overwrite(SPEC, lake.read(SPEC).withColumn("v", F.col("v") + 1))
    lake.rewrite_partitions(SPEC, lake.read(SPEC, 2024, 2024).withColumn("v", F.col("v") * 10))
    lake.append(SPEC, rows("k bigint, v bigint, year bigint", (3, 3, 2024)))
    assert sorted(map(tuple, lake.read(SPEC).collect())) == [(1, 2, 2023), (2, 30, 2024), (3, 3, 2024)]
    touched = lake.read_touched(SPEC, rows("year bigint", (2024,), (None,), (2024,)))
    assert {r.k for r in touched.collect()} == {2, 3}
    assert "PartitionFilters: [isnotnull(year" in touched._jdf.queryExecution().executedPlan().toString()
    os.makedirs(f"{folder}/facts/t/v-00000009")
    assert lake.read(SPEC).count() == 3
    lake.drop_old_versions(SPEC)
    assert sorted(os.listdir(f"{folder}/facts/t")) == ["v-00000002", "v-00000009"]
    assert lake.read(SPEC).count() == 3


def test_json_paths(spark, folder):
    page = {
        "MRData": {
            "total": "2",
            "T": {"Races": [
                {"round": "1", "Laps": [{"n": "1", "Times": [{"d": "a"}, {"d": "b"}]}, {"n": "2"}]},
                {"round": "2", "Laps": [{"n": "9", "Times": [{"d": "z"}]}]},
            ]},
        }
    }
    with open(f"{folder}/page.json", "w") as out:
        json.dump(page, out, indent=1)
    record = T.StructType.fromDDL(
        "round string, extra struct<x: string>, Laps array<struct<n: string, Times: array<struct<d: string>>>>"
    )
    schema = envelopes.envelope_schema("MRData", "T", "Races", record)
    pages = envelopes.read_envelopes(spark, folder, schema, one_per_line=False)
    levels = [("MRData.T.Races", {"round": "round"}), ("Laps", {"lap": "n"}), ("Times", {"driver": "d"})]
    every = envelopes.nested_records(pages, levels)
    assert sorted(map(tuple, every.collect())) == [("1", "1", "a"), ("1", "1", "b"), ("2", "9", "z")]
    first = envelopes.nested_records(pages, levels, first_only=True)
    assert sorted(map(tuple, first.collect())) == [("1", "1", "a"), ("1", "1", "b")]
    flat = envelopes.records(pages, "MRData.T.Races", {"round": "round", "x": "extra.x"}, position="at")
    assert [(r.round, r.x) for r in flat.orderBy("at").collect()] == [("1", None), ("2", None)]
    assert tuple(envelopes.page_completeness(pages, "MRData", "MRData.T.Races").first()) == (2, 2, True)


def test_record_order_over_pages_of_one_file(spark, folder):
    with open(f"{folder}/pages.json", "w") as out:
        for page in range(20):
            out.write(json.dumps({"M": {"T": {"Xs": [{"a": f"{page}-{i}"} for i in range(3)]}}}) + "\n")
    schema = envelopes.envelope_schema("M", "T", "Xs", T.StructType.fromDDL("a string"))
    found = envelopes.records(envelopes.read_envelopes(spark, folder, schema), "M.T.Xs", position="at")
    assert [r.a for r in found.orderBy("at").collect()] == [f"{page}-{i}" for page in range(20) for i in range(3)]


def test_incomplete_pages_are_noticed(spark, folder):
    with open(f"{folder}/page.json", "w") as out:
        out.write('{"MRData": {"total": "3", "T": {"Xs": [{"a": "1"}]}}}\n{"MRData": {"total": "3", "T": {}}}\n')
    schema = envelopes.envelope_schema("MRData", "T", "Xs", T.StructType.fromDDL("a string"))
    pages = envelopes.read_envelopes(spark, folder, schema)
    assert tuple(envelopes.page_completeness(pages, "MRData", "MRData.T.Xs").first()) == (1, 3, False)


def test_first_element(rows):
    df = rows("n int, a array<string>", (0, ["x", "y"]), (1, []), (2, None))
    got = df.orderBy("n").select(envelopes.first_element(F.col("a")).alias("v")).collect()
    assert [r.v for r in got] == ["x", None, None]


def test_messages(rows):
    df = rows(
        "id int, at timestamp_ntz, x double, s string",
        (1, datetime(2024, 1, 1), float("nan"), None), (None, None, 1.5, 'a"b'),
    )
    first, second = topics.as_messages(df, "id").collect()
    assert first.key == "1" and json.loads(first.value) == {"id": 1, "at": "2024-01-01 00:00:00", "x": None, "s": None}
    assert second.key is None and json.loads(second.value)["s"] == 'a"b'
    assert {r.key for r in topics.as_messages(df, "absent").collect()} == {None}


def test_warehouse(rows, spark, folder):
    house = Warehouse(spark, folder)
    house.recreate_schema("gold_test")
    table = "gold_test.t"
    df = rows("k bigint, v string", (1, "a"), (None, "n"))
    assert house.insert_unseen(df, table, ["k"], ["v"]) == 2
    more = rows("k bigint, v string", (1, "x"), (2, "c"), (2, "b"), (None, "m"))
    assert house.insert_unseen(more, table, ["k"], ["v"]) == 1
    assert house.insert_unseen(more, table, ["k"], ["v"]) == 0
    assert sorted(map(tuple, house.read(table).collect()), key=str) == [(1, "a"), (2, "b"), (None, "n")]
    house.replace(house.read(table).where("k = 1"), table)
    assert [tuple(r) for r in house.read(table).collect()] == [(1, "a")]
    house.replace(house.read(table).drop("v"), table)
    assert house.read(table).columns == ["k"]
    house.recreate_schema("gold_test")
    assert not house.exists(table)


def test_partitioned_warehouse_table(rows, spark, folder):
    house = Warehouse(spark, folder)
    house.recreate_schema("gold_parts")
    table = "gold_parts.t"
    ddl = "k bigint, year bigint, v string"
    house.replace(rows(ddl, (1, 2023, "a"), (2, 2024, "b")), table, "year")
    assert house.insert_unseen(rows(ddl, (2, 2024, "x"), (3, 2025, "c"), (4, 2024, "d")), table, ["k"]) == 2
    assert sorted((r.k, r.year, r.v) for r in house.read(table).collect()) == [
        (1, 2023, "a"), (2, 2024, "b"), (3, 2025, "c"), (4, 2024, "d"),
    ]
    one = house.read(table).where("year = 2024")
    assert sorted(r.k for r in one.collect()) == [2, 4]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    house.replace(house.read(table).where("year > 2023"), table, "year")
    assert sorted(r.k for r in house.read(table).collect()) == [2, 3, 4]


EVENTS = TableSpec("e", "facts", {"k": "bigint", "v": "double"}, surrogate="k", natural=("k",))


def publish(rows, topic, *data):
    topics.publish(topics.as_messages(rows("k bigint, v string", *data), "k"), topic)


def stored(spark, path):
    return sorted(map(tuple, consume.read_table(spark, path, EVENTS.schema()).collect()))


def test_stream_reads_each_message_once_and_inserts_each_key_once(rows, spark, folder):
    topic, target, position = (f"{folder}/{n}" for n in ("topic", "target", "position"))
    sink = consume.folder_sink(target, ["k"], ["v"])

    def run(where=position):
        return consume.drain(consume.parse_typed(topics.read_topic(spark, topic), EVENTS), where, sink)

    publish(rows, topic, (1, "1.5"), (2, "bad"), (1, "9"))
    assert run() == 2
    assert run() == 0
    publish(rows, topic, (2, "7"), (3, "3"))
    assert run() == 1
    assert stored(spark, target) == [(1, 1.5), (2, None), (3, 3.0)]
    assert run(f"{folder}/other") == 0
    assert stored(spark, target) == [(1, 1.5), (2, None), (3, 3.0)]


def test_a_batch_run_again_replaces_its_own_rows(rows, spark, folder):
    target = f"{folder}/target"
    batch = rows("k bigint, v double", (1, 1.0), (2, 2.0))
    for _ in range(2):
        assert consume.insert_batch(batch, "id-0", target, ["k"], ["v"]) == 2
    assert consume.insert_batch(batch, "id-1", target, ["k"], ["v"]) == 0
    assert stored(spark, target) == [(1, 1.0), (2, 2.0)]


def test_a_failed_sink_does_not_move_the_position(rows, spark, folder):
    topic, target, position = (f"{folder}/{n}" for n in ("topic", "target", "position"))
    publish(rows, topic, (1, "1"))
    messages = consume.parse_typed(topics.read_topic(spark, topic), EVENTS)

    def broken(batch, name):
        raise ValueError("sink is down")

    try:
        consume.drain(messages, position, broken)
        raise AssertionError("the failure was swallowed")
    except Exception as error:
        assert "sink is down" in str(error)
    assert consume.drain(messages, position, consume.folder_sink(target, ["k"], ["v"])) == 1
