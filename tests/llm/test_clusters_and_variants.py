"""Centroid clusters and spelling variants against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from dimlathe.llm import centroid_clusters, entry, spelling_variants

SMALL = "/root/testdata/sf0.001"


def brute_clusters(rows, k, rounds, dims):
    kept = [
        (i, [int(1024 * x // 1) for x in v])
        for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and abs(x) < float("inf") for x in v)
    ]
    hashed = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in hashed[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        groups = [[] for _ in centroids]
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        centroids = [
            [sum(x) // len(g) for x in zip(*g, strict=True)] if g else c for g, c in zip(groups, centroids, strict=True)
        ]
    return Counter((i, nearest(v)[1], nearest(v)[0]) for i, v in kept), centroids


@pytest.mark.parametrize(("k", "spread"), [(1, 1.0), (5, 1.0), (8, 0.004), (6, 900.0)])
def test_clusters_equal_plain_rounds(spark, k, spread):
    random.seed(k)
    rows = [(i, [random.choice((0, 3, 6)) + random.uniform(-spread, spread) for _ in range(4)]) for i in range(500)]
    rows += [(7, rows[7][1]), (7, rows[8][1]), (None, [0.0] * 4), (None, [1.0] * 4)]  # repeated and null ids
    rows += [(600, None), (601, [1.0]), (602, [1.0, None, 0.0, 0.0]), (603, [float("nan"), 0.0, 0.0, 0.0])]
    rows += [(604, [float("-inf"), 0.0, 0.0, 0.0]), (605, [1e5, -1e5, 0.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr(
        "*", "'x' AS cluster", "1 AS block", "2 AS VEC_ID", "3 AS x"
    )
    got, centroids = centroid_clusters.cluster(frame, k=k, rounds=6, dims=4)
    want, last = brute_clusters(rows, k, 6, 4)
    assert centroids == last
    assert Counter(map(tuple, got.collect())) == want


def test_clusters_of_nothing_of_equals_and_of_few(spark):
    frame = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(3)], "vec_id long, embedding array<float>")
    assert centroid_clusters.cluster(frame.where("false"), dims=2)[0].count() == 0
    assert centroid_clusters.cluster(frame)[0].count() == 0  # no vector has 64 components
    got, centroids = centroid_clusters.cluster(frame, dims=2)
    assert centroids == [[1024, 2048]] * 3
    assert {tuple(r) for r in got.collect()} == {(0, 0, 0), (1, 0, 0), (2, 0, 0)}


def test_a_round_leaves_vectors_on_their_heaps(spark):
    """What the method saves: with centroids at rest nothing is popped, and the heaps' bytes stay as they are."""
    x = np.random.default_rng(0).integers(-50, 50, (200, 3)).astype(np.int16)
    centroids = np.array([[-20, 0, 0], [20, 0, 0]])
    batch = pa.RecordBatch.from_pylist([{"block": 1, "n": 200, "x": x.tobytes()}])
    (first,) = centroid_clusters.one_round(centroids, np.zeros(2), True)([batch])
    row = first.to_pylist()[0] | {"n": 200, "x": x.tobytes()}
    again = pa.RecordBatch.from_pylist([row])
    (second,) = centroid_clusters.one_round(centroids, np.zeros(2) - 1e-6, False)([again])
    assert second.to_pylist()[0]["keys"] == row["keys"] and second.to_pylist()[0]["moved"] == []


def lowered(run):
    return re.sub("[A-Z]", lambda m: m[0].lower(), run)


def brute_words(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            w = lowered(run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            counts[w[: h % len(w)] + w[h % len(w) + 1 :] if h % 31 == 0 else w] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    i = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a != b and (a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else len(a) + 1 == len(b) and a[i:] == b[i + 1 :])


def brute_variants(words, factor=10):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= factor * words[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {(w, words[w], len(near[w]), form[w], words.get(form[w]), root(w)) for w in words}


def mutated(word, letters):
    at = random.randrange(len(word) + 1)
    kind = random.randrange(3)
    if kind == 0:
        return word[:at] + random.choice(letters) + word[at:]
    at = min(at, len(word) - 1)
    return word[:at] + (random.choice(letters) if kind == 1 else "") + word[at + 1 :]


@pytest.mark.parametrize("letters", ["ab", "abcé", "abcdefghijklmnopqrstuvwxyzßÿ×"])
def test_variants_equal_brute_force(spark, letters):
    random.seed(len(letters))
    words = {"a" * 7, "a" * 8, "a" * 40, "b" * 9, "ab" * 6, "ba" * 6, "aab" * 5}
    words |= {"".join(random.choice(letters) for _ in range(random.randrange(6, 13))) for _ in range(60)}
    for _ in range(3):
        words |= {mutated(w, letters) for w in sorted(words)[::2]}
    counted = {w: random.choice((2, 3, 20, 30, 250, 2600)) for w in words if len(w) >= 4}
    frame = spark.createDataFrame(sorted(counted.items()), "word string, n long")
    got = {tuple(r) for r in spelling_variants.variants(frame).collect()}
    assert got == brute_variants(counted)


def test_vocabulary_and_query_equal_brute_force(spark):
    random.seed(3)
    rows = [(i, " ".join(random.choice(("Straße", "straßen", "NAÏVETÉ", "grandmother", "Grandmothers", "x" * 3000)) for _ in range(30))) for i in range(80)]
    rows += [(None, "grandmother grandmother1grandmother"), (3, None), (4, ""), (5, rows[5][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS id", "2 AS run", "3 AS TEXT")
    assert {r["word"]: r["n"] for r in spelling_variants.vocabulary(docs).collect()} == brute_words(rows)
    assert spelling_variants.variants(spelling_variants.vocabulary(docs.where("false"))).count() == 0
    given = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = {(w, f, r, n, near, fn) for w, n, near, f, fn, r in brute_variants(brute_words(given))}
    assert {tuple(r) for r in entry.queries()["op12_spelling_variants"](spark, SMALL).collect()} == want


def test_long_chains_of_forms_are_followed(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    chain = [letters[:7] + letters[7 : 7 + i] for i in range(17)]
    forms = spark.createDataFrame(list(zip(chain, chain[1:], strict=False)), "word string, form string")
    assert {tuple(r) for r in spelling_variants.roots(forms).collect()} == {(w, chain[-1]) for w in chain[:-1]}
