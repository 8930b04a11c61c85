"""The string-kernel machine against plain recursion, and its accuracy on rows held out."""

import random
import zlib
from itertools import combinations

import numpy as np
import pytest

from dimlathe.llm import entry, toxicity

INSULTS = ("grobnik", "vastolu", "pemdrak")


def brute_kernel(a, b):
    """All pairs of equal subsequences of three letters, each with its span."""

    def found(w):
        return [("".join(w[i] for i in at), toxicity.DECAY ** (at[-1] - at[0] + 1)) for at in combinations(range(len(w)), 3)]

    return sum(x * y for s, x in found(a) for t, y in found(b) if s == t)


def test_kernels_and_folded_decisions_equal_plain_sums():
    random.seed(1)
    words = ["".join(random.choice("abcé") for _ in range(n)) for n in (1, 2, 3, 3, 4, 5, 8, 12)] + ["aaaa", "zzz"]
    marks = ["abca", "ébc", "aabbcc", "cab", "ab"]
    want = np.array(
        [
            [brute_kernel(a, b) / (brute_kernel(a, a) * brute_kernel(b, b)) ** 0.5 if min(len(a), len(b)) > 2 else 0.0 for b in marks]
            for a in words
        ]
    )
    held = toxicity.Landmarks(marks)
    assert np.allclose(held.kernels(words), want)
    beta = np.array([1.5, -2.0, 0.25, 1.0, 9.0])
    assert np.allclose(held.machine(beta, -0.5).decisions(words), want @ beta - 0.5)
    assert held.machine(beta, -0.5).decisions([]).shape == (0,)


def test_units_are_whole_texts_words_and_spelt_out_runs():
    assert toxicity.units("You i.d.i.o.t, you I_D; s c u m!") == {"you", "idiot", "id", "s", "c", "u", "m", "scum"}
    long = "q" * 30 + "insult" + "r" * 30
    assert any("insult" in u for u in toxicity.units(long)) and max(map(len, toxicity.units(long))) <= toxicity.WIDE
    assert set("".join(sorted(toxicity.units("ab" * 50_000)))) == {"a", "b"}
    assert toxicity.units("") == toxicity.units(" \n!?") == set()


def corpus(n, seed):
    random.seed(seed)
    rows, labels = [], []
    common = ["".join(random.choice("aeioulnrst") for _ in range(random.randrange(2, 9))) for _ in range(300)]
    for i in range(n):
        words = random.choices(common, k=random.randrange(5, 80))
        toxic = int(i % 4 == 0)
        if toxic:
            words.insert(random.randrange(len(words)), random.choice(INSULTS))
        rows.append((i, ". ".join(" ".join(words[k : k + 12]) for k in range(0, len(words), 12))))
        labels.append((i, toxic))
    return rows, labels


def test_insults_with_gaps_and_put_in_letters_are_caught(spark):
    rows, labels = corpus(600, 4)
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "0 AS label", "'x' AS unit", "1 AS TEXT")
    model = toxicity.learn(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert set(INSULTS) <= set(model.landmarks)
    clean = "the rest of this text is harmless and long enough"
    for word in INSULTS:
        for form in (word, word[:3] + "x" + word[3:], word[0] + word, " ".join(word), "-".join(word), word.upper() + "s"):
            assert model.scores([f"{clean} {form} {clean}"])[0] >= 0.5, form
    assert model.scores([clean, "", "?"]).max() < 0.5
    got = toxicity.score(docs, model).collect()
    assert len(got) == 600
    wrong = [r for r in got if r["held_out"] and r["predicted"] != int(r["doc_id"] % 4 == 0)]
    assert not wrong and sum(r["held_out"] for r in got) > 80


def test_rows_of_all_kinds_have_a_score(spark):
    rows, labels = corpus(300, 5)
    odd = [(None, "grobnik"), (None, None), (3, None), (7, ""), (7, " \n"), (8, "x" * 200_000), (9, "a " * 50_000 + "pemdrak"), (9, "?!")]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string")
    marks = spark.createDataFrame([*labels, (None, 1), (10, None), (11, 7), (99_999, 1)], "doc_id long, toxic int")
    model = toxicity.learn(docs, marks)
    got = toxicity.score(docs, model).collect()
    assert len(got) == 308 and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["held_out"] == (zlib.crc32(("" if r["doc_id"] is None else str(r["doc_id"])).encode()) % 5 == 0) for r in got)
    assert {r["predicted"] for r in got if r["doc_id"] is None} == {0, 1}
    assert toxicity.score(docs.where("false"), model).count() == 0
    again = toxicity.learn(docs.repartition(7), marks.repartition(3))
    assert np.allclose(again.scores([t or "" for _, t in rows[:50]]), model.scores([t or "" for _, t in rows[:50]]))


@pytest.mark.parametrize(("classes", "share"), [((), 0.0), ((0,), 0.0), ((1,), 1.0)])
def test_fewer_than_two_classes_give_the_share(spark, classes, share):
    docs = spark.createDataFrame([(i, "some text") for i in range(20)], "doc_id long, text string")
    marks = spark.createDataFrame([(i, c) for i in range(20) for c in classes], "doc_id long, toxic int")
    got = toxicity.score(docs, toxicity.learn(docs, marks)).collect()
    assert {r["score"] for r in got} == {share} and len(got) == 20


def test_query_ranks_held_out_rows(spark):
    """At sf0.01, 45 toxic rows teach; the insults of the few held-out ones in other languages do not occur among them."""
    folder = "/root/testdata/sf0.01"
    got = entry.queries()["op13_toxicity"](spark, folder)
    assert got.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    marked = got.join(spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic"), "doc_id").where("held_out").collect()
    toxic, clean = ([r["score"] for r in marked if r["toxic"] == c] for c in (1, 0))
    assert np.mean([[(t > c) + 0.5 * (t == c) for c in clean] for t in toxic]) > 0.8
    assert np.mean([c >= 0.5 for c in clean]) <= 0.02
