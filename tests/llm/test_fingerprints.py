"""Fingerprints against multisets of pieces."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from dimlathe.llm import fingerprints

SMALL = "/root/testdata/sf0.001"


def pieces_of(spark, texts: list[str]) -> list[Counter]:
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", fingerprints.paragraphs(F.col("t")).alias("p"))
    return [Counter(r["p"]) for r in sorted(frame.collect())]


def likeness(a: Counter, b: Counter) -> float:
    def weight(counts: Counter) -> int:
        return sum(n * ((d >> 20) & 255) for d, n in counts.items())

    total = weight(a) + weight(b)
    return 1 - (weight(a - b) + weight(b - a)) / total if total else 1.0


def compared(spark, texts: list[str]) -> None:
    got = {r["doc_id"]: r for r in fingerprints.compare(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    after = texts[1:] + texts[:1]
    changed = [t[: len(t) - len(t) // 4] + n[: len(t) // 4] for t, n in zip(texts, after, strict=True)]
    own, new = pieces_of(spark, texts), pieces_of(spark, changed)
    for i in range(len(texts)):
        assert got[i]["near_edited"] == pytest.approx(likeness(own[i], new[i]), abs=1e-12)
        assert got[i]["near_next"] == pytest.approx(likeness(own[i], own[(i + 1) % len(texts)]), abs=1e-12)


def test_likeness_is_that_of_the_pieces(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()
    compared(spark, [r["text"] or "" for r in rows])


def test_equal_lines_and_long_texts(spark):
    lines = "one and the same line of a text\n" * 20_000
    mixed = "".join(f"line number {i % 700} of a long text, told {i % 3} times\n" for i in range(9000))
    compared(spark, [lines, lines[: len(lines) // 2] + mixed, mixed, mixed + "end", ""])


def test_repeated_digests_are_told_apart(spark):
    frame = spark.createDataFrame([([7 << 40, 5 << 40, 7 << 40, 7 << 40],), ([],), ([3 << 40],), ([1 << 40] * 3000,)], "d array<long>")
    rows = [r[0] for r in frame.select(fingerprints.numbered("d").alias("d")).collect()]
    assert [len(set(r)) for r in rows] == [4, 0, 1, 3000] and {7 << 40, 5 << 40} <= set(rows[0])
    checks = frame.select(F.explode(fingerprints.numbered("d")).alias("x")).where("shiftrightunsigned(x, 20) & 255 <> 0")
    assert checks.count() == 0  # the length stays


def test_overfull_blocks_are_split(spark):
    digests = spark.range(6000).select(fingerprints.checked(F.xxhash64("id")).alias("d")).agg(F.collect_list("d").alias("p"))
    near = [r for r in digests.selectExpr("p", "slice(p, 1, 100) q").collect()]
    frame = spark.createDataFrame([(sorted(r["p"]), sorted(r["q"])) for r in near], "p array<long>, q array<long>")
    found = frame.select(F.expr(fingerprints.grown("p", "q")).alias("x"), "p", "q").first()
    assert sorted(found["x"]) == sorted(set(found["p"]) - set(found["q"]))


def test_sums_that_look_like_a_digest_are_not_told(spark):
    some = spark.range(5000).select(fingerprints.checked(F.xxhash64("id")).alias("a"))
    pairs = some.crossJoin(some.toDF("b")).where("a < b").where(
        "((a ^ b) & 1048575) = (xxhash64(11, shiftrightunsigned(a ^ b, 20)) & 1048575)"
    )
    arrays = pairs.selectExpr("array(a) a", "array(b) b").cache()
    found = [r for r in arrays.select("a", "b", F.expr(fingerprints.grown("a", "b")).alias("x")).collect()]
    assert len(found) > 3 and all(sorted(r["x"]) == sorted(r["a"] + r["b"]) for r in found)


def test_cells_are_looked_up(spark):
    digests = spark.range(40).select(fingerprints.checked(F.xxhash64("id")).alias("d"))
    plain = [0] * fingerprints.BLOCK * fingerprints.BLOCKS
    for d, h in digests.selectExpr("d", "xxhash64(0, d) h").collect():
        block = (((d >> 28) + (1 << 35)) * fingerprints.BLOCKS) >> 36
        for k in range(3):
            plain[block * fingerprints.BLOCK + 6 * k + ((h >> 21 * k) & 0xFFFFF) % 6] ^= d
    row = digests.agg(F.sort_array(F.collect_list("d")).alias("p")).select(F.flatten(F.expr(fingerprints.sketch("p"))).alias("cells")).first()
    assert row["cells"] == plain
    frame = spark.createDataFrame([([],)], "d array<long>").select(F.expr(fingerprints.block("d", "1")).alias("cells"))
    plan = frame._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "shiftright" not in plan and "from_json" not in plan  # what is done for each digest and cell is a look into a constant
