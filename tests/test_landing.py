"""Pages that are missing, repeated or moving, and messages that are no rows."""

import json
import os

import pytest

from dimlathe.plans import flows
from dimlathe.registry import TableSpec
from dimlathe.sources import envelopes, topics
from dimlathe.sources.lake import Lake
from dimlathe.streaming import consume

SCHEMA = "D struct<url: string, total: string, limit: string, offset: string, T: struct<Xs: array<struct<Ys: array<struct<a: string>>>>>>"


def page(url, total, offset, *sizes):
    return {"D": {"url": url, "total": str(total), "offset": offset, "T": {"Xs": [{"Ys": [{"a": "1"}] * n} for n in sizes]}}}


def coverage(spark, folder, *pages):
    with open(f"{folder}/pages.json", "w") as out:
        out.writelines(json.dumps(p) + "\n" for p in pages)
    judged = envelopes.with_interval(envelopes.read_envelopes(spark, folder, SCHEMA), "D", ["D.T.Xs", "Ys"])
    return {r["request"]: r for r in envelopes.page_coverage(judged).collect()}


def test_gaps_overlaps_and_moving_totals(spark, folder):
    got = coverage(
        spark, folder,
        page("whole", 5, "0", 2, 1), page("whole", 5, "3", 2), page("whole", 5, "0", 2, 1),  # one page landed twice
        page("gap", 6, "0", 2), page("gap", 6, "4", 2),
        page("tail", 6, "0", 2), page("tail", 6, "2", 2),
        page("head", 4, "2", 2),
        page("over", 4, "0", 3), page("over", 4, "2", 2),
        page("moved", 4, "0", 2), page("moved", 5, "2", 2),
        page("none", 0, "0"), page("short", 3, "0"),
        page("untold", 9, None, 1), page("text", 9, "x", 1),
    )
    assert {k: (r["complete"], r["missing_from"], r["overlap"]) for k, r in got.items()} == {
        "whole": (True, None, 0), "gap": (False, 2, 0), "tail": (False, 4, 0), "head": (False, 0, 0), "over": (False, None, 1),
        "moved": (False, 4, 0), "none": (True, None, 0), "short": (False, 0, 0),
    }
    assert (got["whole"]["pages"], got["whole"]["records"]) == (2, 5)


def test_a_backfill_leaves_incomplete_requests_out(spark, folder):
    os.makedirs(f"{folder}/land/circuit")

    def circuits(url, total, offset, *refs):
        made = [{"circuitId": r, "circuitName": r, "url": "u", "Location": {"lat": "1", "long": "2"}} for r in refs]
        return {"MRData": {"url": url, "total": str(total), "limit": "2", "offset": str(offset), "CircuitTable": {"Circuits": made}}}

    with open(f"{folder}/land/circuit/pages.json", "w") as out:
        for p in (circuits("u1", 3, 0, "a", "b"), circuits("u1", 3, 2, "c"), circuits("u2", 4, 2, "d", "e")):
            out.write(json.dumps(p) + "\n")
    lake = Lake(spark, f"{folder}/lake")
    from datetime import datetime

    told = flows.backfill(lake, f"{folder}/land", datetime(2024, 1, 1), ["circuit"])
    assert [tuple(r) for r in told.collect()] == [("dimensions.circuit", 0, 3, 3, 3)]
    from dimlathe.plans import racing

    assert {r["circuit_references"] for r in lake.read(racing.CIRCUIT).collect()} == {"a", "b", "c"}
    lost = spark.read.parquet(f"{lake.root}/quarantine/pages/circuit").collect()
    assert [(r["request"], r["missing_from"]) for r in lost] == [("u2", 0)]


EVENT = TableSpec("e", "facts", {"k": "bigint", "v": "double"}, surrogate="k", natural=("k",))


@pytest.mark.parametrize("again", [False, True])
def test_broken_messages_are_set_aside_once(spark, rows, folder, again):
    values = ['{"k": 1, "v": 2.5}', '{"k": 2, "v": "bad"}', "{broken", None, "", "[1]", "null", '{"v": 1}', '"text"']
    topics.publish(rows("key string, value string", *((str(i), v) for i, v in enumerate(values))), f"{folder}/topic")
    sub = consume.Subscription(EVENT, f"{folder}/topic", consume.folder_sink(f"{folder}/t", ["k"], ["v"]))
    assert consume.consume_all(spark, [sub], f"{folder}/positions") == {"facts.e": 2}
    if again:
        assert consume.consume_all(spark, [sub], f"{folder}/positions") == {"facts.e": 0}
    assert sorted(map(tuple, consume.read_table(spark, f"{folder}/t", EVENT.schema()).collect())) == [(1, 2.5), (2, None)]
    lost = consume.read_rejects(spark, consume.rejects_of(f"{folder}/positions", EVENT)).collect()
    assert sorted((r["key"], r["reason"]) for r in lost) == [
        ("2", "not an object"), ("3", "no value"), ("4", "no value"), ("5", "not an object"), ("6", "not an object"), ("7", "no key"),
        ("8", "not an object"),
    ]
    assert all("/topic/" in r["position"] and r["value"] == values[int(r["key"])] for r in lost)


def test_parsing_gives_no_empty_rows(spark, rows):
    messages = rows("key string, value string", ("a", '{"k": 1}'), ("b", "{broken"), ("c", None))
    assert [tuple(r) for r in consume.parse_typed(messages, EVENT).collect()] == [(1, None)]


def test_messages_are_parsed_once_and_only_rejected_ones_are_kept(spark, folder):
    from dimlathe.catalogue.storage import EVENT

    good = '{"event_id":1,"ts":"2024-01-01 00:00:00","user_id":7,"event_type":"x","value":1.5}'
    rows = [("f:0", "7", good), ("f:0", "8", good.replace(":1,", ":null,", 1)), ("f:0", "9", good[:20]), ("f:0", None, None)]
    seen = []

    def sink(batch, name):
        plan = batch._jdf.queryExecution().withCachedData().toString()
        seen.append((plan[: plan.index("InMemoryRelation")], [r["event_id"] for r in batch.collect()]))
        return batch.count()

    aside = f"{folder}/aside-once"
    stored = consume.judged_sink(EVENT, sink, aside)(spark.createDataFrame(rows, "position string, key string, value string"), "b0")
    assert stored == 1 and seen[0][1] == [1]
    assert "from_json" not in seen[0][0]  # parsed below what is kept, not above
    lost = {(r["position"], r["key"], r["value"], r["reason"]) for r in consume.read_rejects(spark, aside).drop(consume.BATCH).collect()}
    assert lost == {("f:0", "8", rows[1][2], consume.NO_KEY), ("f:0", "9", rows[2][2], consume.NOT_AN_OBJECT), ("f:0", None, None, consume.NO_VALUE)}
