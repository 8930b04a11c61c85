"""What moves between tasks, and what stays in the workers."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from dimlathe.llm import byte_bpe, ngram_join

TEXTS = [(i, f"a text of its own {i} " + "and some words " * (i % 9 + 3)) for i in range(400)]


def test_texts_are_chosen_where_they_are_read(spark):
    frame = spark.createDataFrame([*TEXTS, (None, "no id"), (7, "a second text"), (8, None)], "doc_id long, text string")
    wanted = ngram_join.profiles(frame).where("doc_id % 50 = 7").groupBy("rep").agg(F.min("doc_id").alias("name"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = ngram_join.sets_of(frame, wanted)
        plan = found._jdf.queryExecution().executedPlan().toString()
        rows = {r["rep"]: r["set"] for r in found.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("SortMergeJoin") == 1  # of the sets; texts are not shuffled
    assert set(rows) == {r["rep"] for r in wanted.collect()} and len(rows) == 9
    assert ngram_join.shingles("a second text").view(np.int64).tolist() in rows.values()


def test_frequencies_take_one_worker_for_each_task(spark, monkeypatch):
    frame = spark.createDataFrame(TEXTS, "doc_id long, text string").repartition(8)
    calls, plain = [], type(frame).mapInPandas
    monkeypatch.setattr(type(frame), "mapInPandas", lambda self, *a, **b: calls.append(1) or plain(self, *a, **b))
    monkeypatch.setattr(ngram_join, "GATHERED", 3)
    found = ngram_join.frequencies(frame)
    assert len(calls) == 1
    counts = np.zeros(ngram_join.SLOTS, np.int64)
    for _, text in TEXTS:
        np.add.at(counts, (ngram_join.shingles(text) % np.uint64(ngram_join.SLOTS)).astype(np.int64), 1)
    assert (found == np.log2(counts + 1).astype(np.uint8)).all()


def test_workers_keep_no_pieces_of_a_task(spark):
    frame = spark.createDataFrame(TEXTS, "doc_id long, text string").repartition(8).cache()
    assert byte_bpe.encode(frame).where("size(ids) = n_tokens").count() == len(TEXTS)

    def held(batches):
        for _ in batches:
            yield pd.DataFrame({"n": [sum(len(b.known) for b in byte_bpe._LOADED.values())]})

    assert frame.mapInPandas(held, "n int").agg(F.max("n")).first()[0] == 0
    frame.unpersist()
