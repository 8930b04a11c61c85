"""Operators against brute force and exact round trips, on small tables with nulls, repeats, ties and clashing names."""

import base64
import hashlib
import random
import re
from collections import Counter

import duckdb
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from check import compare, oracle
from dimlathe.llm import (
    byte_bpe,
    entry,
    fingerprints,
    html_extract,
    license_scan,
    mixing,
    ngram_join,
    pii,
    quality_rules,
    sharding,
    warc,
)

SMALL = "/root/testdata/sf0.001"
ODD = [
    (1, "one two three four five six seven eight nine ten " * 3, "a"),
    (2, "One TWO three four five six seven eight nine ten " * 3, "a"),
    (2, "One TWO three four five six seven eight nine ten " * 3, "a"),
    (3, None, None),
    (4, "", "b"),
    (5, " \n\t ", "b"),
    (6, "x" * 5000 + " mail a.b@c-d.org, 10.0.0.1 or +1 (555) 010-9999; 4111 1111 1111 1111", "b"),
    (7, "Licensed under the Apache License, Version 2.0.\nAll rights reserved.", "a"),
    (None, "no id here", "c"),
]


@pytest.fixture
def docs(spark):
    made = spark.createDataFrame(ODD, "doc_id long, text string, source string")
    clash = made.withColumns({"failed": F.lit("x"), "h": F.lit(1), "words": F.lit(2), "TERM": F.lit(0), "row": F.lit("y")})
    return clash.withColumns({"lang": F.lit("en"), "n_chars": F.length("text").cast("long")})


@pytest.fixture
def nothing(docs):
    return docs.where("false")


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_gives_the_rows_of_its_sql(name, spark):
    assert compare(entry.queries()[name](spark, SMALL), oracle(SMALL), entry.oracle_sql()[name]) is None


def test_quality_ledger(docs, nothing):
    rows = quality_rules.apply_policy(quality_rules.ledger(docs)).collect()
    assert len(rows) == len(ODD)
    assert quality_rules.ledger(nothing).count() == 0
    assert quality_rules.ablations(quality_rules.ledger(nothing)).count() == 0
    kept = quality_rules.keep_good(docs, quality_rules.Policy("none", ()))
    assert kept.columns == docs.columns and kept.count() == len(ODD)
    costs = {r["rule"]: r for r in quality_rules.ablations(quality_rules.ledger(docs)).collect()}
    assert costs["few_words"]["failing"] == len(ODD)


def test_license_scan(docs, nothing):
    found = {r["doc_id"]: r for r in license_scan.scan(docs).collect()}
    assert found[7]["base_labels"] == "reserved" and found[7]["labels"] == "apache-2.0,reserved"
    assert (found[7]["n_base"], found[7]["first_word"], found[7]["score"]) == (1, 8, 1.0)
    assert found[3]["n_words"] == 0 and found[3]["labels"] == "" and found[3]["first_word"] is None
    assert license_scan.scan(docs).count() == len(ODD) and license_scan.scan(nothing).count() == 0


def brute_components(rows, percent):
    sets = []
    for _, text, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        k = min(4, len(w))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set())
    top = {r[0]: r[0] for r in rows if r[0] is not None}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * len(a | sets[j]) and None not in (rows[i][0], rows[j][0]):
                x, y = sorted((find(rows[i][0]), find(rows[j][0])))
                top[y] = x
    return [(r[0], len(s), None if r[0] is None else find(r[0])) for r, s in zip(rows, sets, strict=True)]


def test_ngram_join_equals_brute_force(spark, docs, nothing):
    random.seed(5)
    base = [[random.choice("abcdefghij") + str(random.randrange(60)) for _ in range(random.choice((6, 40, 90)))] for _ in range(6)]
    rows = []
    for i in range(90):
        words = list(random.choice(base))
        for _ in range(random.randrange(4)):
            words[random.randrange(len(words))] = f"new{random.randrange(9)}"
        rows.append((i * 3, " ".join(words)))
    got = ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == sorted(brute_components(rows, 85))
    assert Counter(map(tuple, ngram_join.join(docs).collect())) == Counter(brute_components(ODD, 85))
    assert ngram_join.join(nothing).count() == 0


def test_an_id_with_two_texts_keeps_the_links_of_both(spark):
    random.seed(9)
    one, two = ([f"{side}{random.randrange(900)}" for _ in range(60)] for side in "pq")
    near = two[:-1] + ["other"]
    rows = [(1, " ".join(one)), (1, " ".join(two)), (2, " ".join(near)), (3, " ".join(one[:-1])), (0, "far from all of these words"), (4, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, ngram_join.join(frame).collect())) == sorted(brute_components(rows, 85))
    got = {(r["doc_id"], r["n_shingles"]): (r["component_id"], r["n_links"]) for r in ngram_join.linked(frame).collect()}
    assert got[(2, 57)] == (1, 1) and got[(3, 56)] == (1, 1) and got[(0, 3)] == (0, 0)


def test_links_within_a_family_are_all_counted(spark, docs, nothing):
    random.seed(8)
    base = [[f"w{random.randrange(4000)}" for _ in range(n)] for n in (60, 400)]
    rows = []
    for i in range(700):
        words = list(base[i % 2])
        for _ in range(random.randrange(1 + len(words) // 60)):
            words[random.randrange(len(words))] = f"new{random.randrange(99)}"
        rows.append((i, " ".join(words)))
    sets = [{tuple(w[k : k + 4]) for k in range(len(w) - 3)} for w in (t.split() for _, t in rows)]
    want, pairs = Counter(), set()
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if 100 * both >= 85 * (len(a) + len(sets[j]) - both):
                want.update((i, j))
                if a != sets[j]:
                    pairs.add(frozenset((frozenset(a), frozenset(sets[j]))))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = ngram_join.linked(frame).collect()
    assert {r["doc_id"]: r["n_links"] for r in got} == {i: want[i] for i in range(700)}
    assert sorted(tuple(r)[:3] for r in got) == sorted(brute_components(rows, 85))
    assert ngram_join.class_pairs(frame).count() == len(pairs) > 1000
    odd = Counter((r["doc_id"], r["n_links"]) for r in ngram_join.linked(docs).collect())
    assert odd == Counter([(1, 2), (2, 2), (2, 2), (3, 0), (4, 0), (5, 0), (6, 0), (7, 0), (None, 0)])
    assert ngram_join.linked(nothing).count() == 0


def test_likely_pairs_make_no_more_rows_than_members(spark, monkeypatch):
    random.seed(4)
    base = [f"w{random.randrange(4000)}" for _ in range(120)]
    rows = []
    for i in range(240):  # one family about the threshold: some of its 28,680 pairs are links, nearly all may be
        words = list(base)
        for _ in range(random.randrange(1, 4)):
            words[random.randrange(len(words))] = f"new{random.randrange(9999)}"
        rows.append((i, " ".join(words)))
    written = {}
    write = ngram_join.Scratch.write

    def counted(self, df, name):
        table = write(self, df, name)
        written[name] = max(written.get(name, 0), table.count())
        return table

    monkeypatch.setattr(ngram_join.Scratch, "write", counted)
    got = ngram_join.linked(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(tuple(r)[:3] for r in got) == sorted(brute_components(rows, 85))
    assert sum(r["n_links"] for r in got) > 240 * 20
    assert max(written.values()) == written["prefixes"], written


def test_signatures_of_unlike_width_lose_no_link():
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(2)
    one = [np.unique(rng.choice(2**63, n).astype(np.uint64)) for n in (40, 130, 257, 900, 2600)]
    two = [np.unique(np.concatenate([s[: int(0.93 * len(s))], rng.choice(2**63, len(s) // 30).astype(np.uint64)])) for s in one]
    sets = one + two
    bits = pd.Series([ngram_join.bitmap(s, ngram_join.width_for(len(s))).tobytes() for s in sets])
    assert bits.map(len).nunique() > 3 and ngram_join.signatures(bits).shape == (10, 8)
    narrow = np.stack([np.frombuffer(ngram_join.bitmap(s).tobytes(), np.uint64) for s in sets])
    assert (ngram_join.signatures(bits) == narrow).all()
    i, j = np.triu_indices(10, 1)
    may = ngram_join.may_link(bits, np.array([len(s) for s in sets]), i, j)
    both = np.array([len(np.intersect1d(sets[x], sets[y])) for x, y in zip(i, j, strict=True)])
    sizes = np.array([len(s) for s in sets])
    assert (may == (100 * both >= 85 * (sizes[i] + sizes[j] - both))).all() and may.sum() == 5


def test_forest_keeps_components_with_few_edges():
    import numpy as np

    a, b = np.array([9, 4, 7, 30, 31, 9, 4]), np.array([7, 9, 2, 31, 30, 2, 4])
    assert dict(zip(*(x.tolist() for x in ngram_join.forest(a, b)), strict=True)) == {4: 2, 7: 2, 9: 2, 31: 30}
    chain = np.arange(5000)
    x, y = ngram_join.forest(chain[1:], chain[:-1])
    assert len(x) == 4999 and not y.any()
    assert not len(ngram_join.forest(chain[:0], chain[:0])[0])


def test_tree_finds_every_close_pair():
    import numpy as np

    rng = np.random.default_rng(1)
    sets = []
    for _ in range(40):
        start = rng.choice(2**63, rng.integers(5, 300)).astype(np.uint64)
        for _ in range(5):
            sets.append(np.unique(np.where(rng.random(len(start)) < 0.05, rng.choice(2**63, len(start)).astype(np.uint64), start)))
    sets.sort(key=len)
    bits = np.stack([np.frombuffer(ngram_join.bitmap(s).tobytes(), np.uint64) for s in sets])
    tree = ngram_join.Tree(np.array([len(s) for s in sets]), bits, np.arange(len(sets)))
    found = set(zip(*(x.tolist() for x in ngram_join.traverse(tree, tree)), strict=True))
    for i, a in enumerate(sets):
        for j in range(i):
            n = len(np.intersect1d(a, sets[j]))
            if 100 * n >= 85 * (len(a) + len(sets[j]) - n):
                assert (i, j) in found or (j, i) in found


def test_personal_data(docs, nothing):
    found = {r["doc_id"]: r for r in pii.spans(docs).collect()}
    at = ODD[6][1]
    for kind, value in (("email", "a.b@c-d.org"), ("ip", "10.0.0.1"), ("card", "4111 1111 1111 1111"), ("phone", "+1 (555) 010-9999")):
        (span,) = found[6][kind]
        assert (span["start"], span["end"]) == (at.index(value), at.index(value) + len(value))
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(docs).collect()}
    assert clean[6].endswith("mail [EMAIL], [IP] or [PHONE]; [CARD]") and clean[1] == ODD[0][1] and clean[3] == ""
    assert pii.spans(docs).count() == len(ODD) and pii.spans(nothing).count() == 0


def test_disclosing_terms(spark):
    rows = [(i, f"{'abcdefgh'[i]} common words then zanzibar writes to me@x.org about {'abcdefgh'[i]} common things") for i in range(6)]
    rows += [(i, f"common things about words then number {i}") for i in range(10, 60)]
    terms = pii.disclosing(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {t for r in terms for t in r["removed"]} == {"zanzibar", "writes"}
    clean = pii.sanitise(spark.createDataFrame(rows, "doc_id long, text string")).where("doc_id = 0").first()["text"]
    assert "zanzibar" not in clean and "common" in clean


def test_rare_entities_are_judged_by_whole_texts(spark):
    gap = "plain filler words " * 20  # far from the entity
    rows = [(1, f"write to one@x.org {gap} Quetzal"), (1, f"write to one@x.org {gap} Quetzal"), (None, f"plain words of two@x.org {gap} zephyr")]
    rows += [(i, f"write plain filler words number {i} zephyr" if i < 40 else f"write plain filler words {i}") for i in range(10, 700)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r["doc_id"], s["value"]) for r in pii.spans(frame).collect() for s in r["term"]}
    assert found == {(1, "Quetzal")}  # once in the corpus and with this address; zephyr stands in 30 other texts
    clean = [r["text"] for r in pii.sanitise(frame).where("doc_id = 1").collect()]
    assert len(clean) == 2 and all("Quetzal" not in t and "filler" in t for t in clean)


def test_html_extraction(spark):
    pages = duckdb.sql(f"SELECT page_id, html FROM '{SMALL}/pages.parquet'").fetchall()
    model = html_extract.Model([h for _, h in pages[:25]])
    for _, page in pages[25:]:  # held out
        inside = re.search("<article>(.*)</article>", page, re.S)[1]
        blocks = [html_extract._SPACE.sub(" ", re.sub("<br>|</?b>", "", b)).strip() for b in re.split("</?(?:p|h1)>", inside)]
        import html

        assert model.text(page) == "\n\n".join(html.unescape(b) for b in blocks if b)
    odd = spark.createDataFrame([(1, "u", None), (1, None, ""), (None, "u", "<p>a")], "page_id long, url string, html string")
    assert html_extract.extract(odd).count() == 3 and html_extract.extract(odd.where("false")).count() == 0


def test_mixing(spark, docs, nothing):
    rows = [(i, "w " * (1 + i % 9), "abc"[min(i % 7, 2)]) for i in range(400)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    taken = Counter()
    for r in got:
        taken[r["source"]] += r["taken"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    targets = {r["source"]: r["target"] for r in got}
    assert sum(targets.values()) == pytest.approx(sum(r["size"] for r in got))
    assert all(abs(taken[s] - t) <= 1 for s, t in targets.items())
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()))
    assert mixing.mix(docs).count() == len(ODD) and mixing.mix(nothing).count() == 0


def test_byte_level_bpe(spark, docs, nothing):
    path = public_tokenizers.path(byte_bpe.VOCABULARY)
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    random.seed(2)
    texts = ["", "a" * 3000, " " * 999, "é" * 400, "ab" * 128, "it's <|endoftext|>\n\n 日本 x", "\x1c\x85\xa0 1²"]
    texts += ["".join(random.choice("abcdé ,.\n12") for _ in range(random.randint(1, 600))) for _ in range(100)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in byte_bpe.encode(frame).collect()}
    for i, text in enumerate(texts):
        assert got[i]["ids"] == own.encode_ordinary(text)
        assert got[i]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    back = byte_bpe.decode(byte_bpe.encode(frame)).collect()
    assert all(bytes(r["data"]).decode() == texts[r["doc_id"]] for r in back)
    assert byte_bpe.encode(docs).count() == len(ODD) and byte_bpe.encode(nothing).count() == 0


def test_fingerprints(docs, nothing):
    rows = [r for r in fingerprints.compare(docs).collect()]
    assert len(rows) == len(ODD) and fingerprints.compare(nothing).count() == 0
    by_id = {r["doc_id"]: r for r in rows}
    ordered = sorted(ODD, key=lambda r: (r[0] is None, r[0] or 0))
    for k, (doc_id, text, _) in enumerate(ordered):
        text, following = text or "", ordered[(k + 1) % len(ordered)][1] or ""
        quarter = len(text) // 4
        changed = text[: len(text) - quarter] + following[:quarter]
        if doc_id != 2:
            assert by_id[doc_id]["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
    assert len({r["fingerprint"] for r in rows if r["doc_id"] == 2}) == 1
    assert max(r["near_next"] for r in rows if r["doc_id"] == 2) == 1.0


def test_one_line_texts_keep_their_likeness(spark):
    random.seed(3)

    def line(n):
        return " ".join("".join(random.choice("abcdefghinorst") for _ in range(random.randint(2, 9))) for _ in range(n))

    texts = [line(n) for n in (60, 80, 300, 900, 60)] + ["".join(random.choice("abcdefghijklmnop") for _ in range(3000))]
    rows = fingerprints.compare(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert all(0.5 < r["near_edited"] < 0.9 for r in rows) and all(r["near_next"] < 0.2 for r in rows)
    pairs = [(t, t[:40] + "Q" + t[40:]) for t in texts if len(t) > 1000]  # one character more near the start of a long line
    cut = spark.createDataFrame(pairs, "a string, b string").select(*(fingerprints.paragraphs(F.col(c)).alias(c) for c in "ab")).collect()
    assert all(len(set(r["a"]) & set(r["b"])) > 0.8 * len(set(r["a"])) for r in cut)


def test_sketches_peel_or_grow(spark):
    one = [checked(x) for x in range(4000)]
    two = one[:3000] + [checked(x) for x in range(9000, 9400)]
    frame = spark.createDataFrame([(one, two), (one[:5], one[:3]), ([], [])], "p array<long>, q array<long>")
    frame = frame.select("*", F.expr(fingerprints.sketch("p")).alias("sp"), F.expr(fingerprints.sketch("q")).alias("sq"))
    assert [r[0] for r in frame.select(fingerprints.differing("p", "q", "sp", "sq")).collect()] == [1400, 2, 0]


def checked(x: int) -> int:
    from pyspark.sql import SparkSession

    if not _CHECKED:
        spark = SparkSession.getActiveSession()
        _CHECKED.update({r[0]: r[1] for r in spark.range(10_000).select("id", fingerprints.checked(F.xxhash64("id"))).collect()})
    return _CHECKED[x]


_CHECKED: dict[int, int] = {}


def test_archives(spark, folder):
    pages = [(i, f"http://x/{i}", f"<p>{i % 3}é</p>") for i in range(40)] + [(50, None, None), (51, "u", ""), (None, "u", "<p>0é</p>"), (7, "http://x/7", "<p>1é</p>")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("row", F.lit(0))
    manifest = warc.write(frame, f"file://{folder}", roll=2000)
    records = warc.read(spark, f"file://{folder}")
    assert manifest.agg(F.sum("records")).first()[0] == len(pages) == records.count()
    got = records.collect()
    assert Counter(r["record_type"] for r in got)["response"] == 4  # three bodies and the empty one
    assert {r["refers_to"] for r in got if r["record_type"] == "revisit"} == {37, 38, 39, 51}
    restored = sorted(map(str, warc.restore(records).collect()))
    assert len(restored) == len(pages)
    assert warc.write(frame.where("false"), f"file://{folder}/none").count() == 0


def test_sharding(docs, nothing):
    import numpy as np

    for count in (1, 2, 3, 100, 1025):
        placed = sharding.permute(np.arange(count), count, 9)
        assert sorted(placed.tolist()) == list(range(count))
        assert sharding.permute(placed, count, 9, inverse=True).tolist() == list(range(count))
    numbered, count = sharding.number(docs)
    rows = sharding.shard(numbered, count, shards=4).collect()
    sizes = Counter(r["shard"] for r in rows)
    assert count == len(ODD) and max(sizes.values()) - min(sizes.values()) <= 1
    assert all(sorted(r["slot"] for r in rows if r["shard"] == k) == list(range(n)) for k, n in sizes.items())
    numbered, count = sharding.number(nothing)
    assert sharding.shard(numbered, max(count, 1)).count() == 0


def test_pipeline_keeps_its_word(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = corpus_pipeline.quality(spark, docs, SMALL)
    single = corpus_pipeline.near_duplicates(spark, kept, SMALL)
    rows = [(r["doc_id"], r["text"]) for r in kept.collect()]
    tops = {top for _, _, top in brute_components(rows, 85)}
    assert {r["doc_id"] for r in single.collect()} == tops
    cleaned = corpus_pipeline.private(spark, single, SMALL)
    assert cleaned.count() == len(tops) and cleaned.columns == list(corpus_pipeline.DOCUMENT_COLUMNS)
    assert cleaned.where(F.col("text").contains("@mail")).count() == 0
