"""Archives against the standard gzip module, other runs and brute force."""

import base64
import gzip
import hashlib
import io
import json
import os
import random
from pathlib import Path

import pytest

from dimlathe.llm import entry, warc

SMALL = "/root/testdata/sf0.001"


def pages(seed=1):
    random.seed(seed)
    rows = [(i, f"http://x/{i}", random.choice(("", "<p>a</p>", "é" * 3000, f"<b>{i % 40}</b>" * (i % 50)))) for i in range(400)]
    rows += [(7, "http://x/7", "<p>a</p>"), (7, "http://x/7", "<p>a</p>"), (7, "http://y/7", "<p>a</p>"), (5, None, None), (None, "u", "<p>a</p>")]
    rows += [(None, None, None), (None, "u", "only here"), (-3, "a\r\nb", "x\r\n\r\ny"), (2**62, "big", "z" * 200_000)]
    return rows


def archives(folder):
    return {p.name: p.read_bytes() for p in Path(folder).iterdir() if p.is_file() and not p.name.startswith(".")}


def sha1(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_members_are_records_for_any_gzip_reader(spark, folder):
    frame = spark.createDataFrame(pages(), "page_id long, url string, html string")
    manifest = warc.write(frame, f"file://{folder}/w", roll=20_000, part_bytes=100_000).collect()
    held = archives(f"{folder}/w")
    assert len(manifest) > 5 and sum(m["records"] for m in manifest) == frame.count()
    listed = [json.loads(line) for name, data in held.items() if name.endswith(".jsonl") for line in data.decode().splitlines()]
    assert {m["file"] for m in listed} == {n for n in held if n.endswith(".gz")} == {m["file"] for m in manifest}
    for m in manifest:
        data = held[m["file"]]
        assert len(data) == m["bytes"]
        whole = gzip.decompress(data)
        assert whole.startswith(b"WARC/1.1\r\n") and whole.count(b"WARC/1.1\r\n") == m["records"]
        found = list(warc.members(io.BytesIO(data)))
        assert b"".join(found) == whole and len(found) == m["records"]
        assert all(f.startswith(b"WARC/1.1\r\n") and f.endswith(b"\r\n\r\n") for f in found)
    assert not os.path.exists(f"{folder}/w/_temporary")


def test_other_runs_write_the_same_bytes(spark, folder):
    frame = spark.createDataFrame(pages(), "page_id long, url string, html string")
    warc.write(frame.repartition(2), f"file://{folder}/a", roll=20_000, part_bytes=100_000)
    held = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    warc.write(frame.repartition(11, "url"), f"file://{folder}/b", roll=20_000, part_bytes=100_000)
    spark.conf.set("spark.sql.shuffle.partitions", held)
    assert archives(f"{folder}/a") == archives(f"{folder}/b")


@pytest.mark.parametrize("part_bytes", [50_000, 1 << 25])
def test_records_equal_brute_force_and_restore_the_pages(spark, folder, part_bytes):
    rows = pages(2)
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS part", "2 AS ident", "3 AS HTML2")
    warc.write(frame, f"file://{folder}", roll=20_000, part_bytes=part_bytes)
    got = warc.read(spark, f"file://{folder}")
    best, count = {}, {}
    for i, _, html in rows:
        key = html or ""
        count[key] = count.get(key, 0) + 1
        best[key] = max(best.get(key, -(2**63)), -(2**63) if i is None else i)
    found = got.collect()
    assert sorted((str(r["page_id"]), r["payload_bytes"], r["payload_digest"]) for r in found) == sorted(
        (str(i), len((h or "").encode()), sha1(h)) for i, _, h in rows
    )
    responses = {}
    for r in found:
        if r["record_type"] == "response":
            assert r["payload_digest"] not in responses
            responses[r["payload_digest"]] = r
    by_digest = {sha1(k): (b, count[k]) for k, b in best.items()}
    assert set(responses) == set(by_digest)
    for r in found:
        top = by_digest[r["payload_digest"]][0]
        want = None if top == -(2**63) else top
        assert r["page_id"] == want if r["record_type"] == "response" else r["refers_to"] == want
    ids = [r["record_id"] for r in found]
    assert len(set(ids)) == len(ids)
    restored = warc.restore(got).collect()
    assert sorted((str(r["page_id"]), r["html"] or "") for r in restored) == sorted((str(i), h or "") for i, _, h in rows)


def test_query_equals_brute_force(spark):
    given = [tuple(r) for r in spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "html").collect()]
    top = {}
    for i, h in given:
        top[h or ""] = max(top.get(h or "", i), i)
    want = {
        (i, len((h or "").encode()), sha1(h), "response" if top[h or ""] == i else "revisit", None if top[h or ""] == i else top[h or ""])
        for i, h in given
    }
    got = entry.queries()["op9_warc"](spark, SMALL).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert {tuple(r) for r in got} == want and len(got) == len(given)
