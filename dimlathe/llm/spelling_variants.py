"""Spelling variants of a corpus: words one edit apart, found by pivotal grams, grouped under the frequent form.

A word's bigrams are ordered by how many words hold them, rare ones first. Its *prefix* are its first three in that order,
its *pivots* two disjoint ones of them, chosen by dynamic programming for the smallest lists. One edit
touches only one of two disjoint bigrams. So of two words one edit apart, the one whose prefix ends earlier in
the order has a pivot that survives in the other's prefix.

The place of a surviving bigram is limited too: the edit lies on one side of it, so on the other side both words are equal. A
pivot is therefore indexed twice, with all that precedes it and with all that follows it, and looked up in the same way. Where
that is less than ``SHARED`` code points, the edit lies either beyond these (then all of them are equal) or before their end
(then the rest of the word is equal, moved by one place at most). Candidates are verified by edit distance, and a pair found in several ways counts once.

Equal bigrams of a word are told apart by their places. An edit moves the number of a bigram among its equals by at
most two, so a prefix that ends within equals is looked up with ``REPEATS`` of them.

Rows. A null text has no words, a null doc_id counts as empty text. Repeated rows count as often as they are there. Very long
runs are words like others. No documents or no repeated words give no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimlathe.llm.common import pick, table, whole_text
from dimlathe.session import materialize

LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bigrams in a prefix (two may be touched by one edit), pivots, and equals of a prefix's last bigram that are looked up.
PREFIX, PIVOTS, REPEATS = 3, 2, 5
#: Code points that two words must share at the start or end before they are compared without looking further.
SHARED = 6
#: Doublings that reach the end of any chain of forms: counts grow at least tenfold a step, and a long has 19 digits.
DOUBLINGS = 5

KEYED = "word string, n long, last int, pivots array<long>, lookups array<long>"


def vocabulary(docs: DataFrame, least: int = 7, repeats: int = 2, typo_every: int = 31) -> DataFrame:
    """(word, n): runs of letters, A-Z lower-cased, where one in ``typo_every`` by crc32 of ``<doc_id>:<run>`` loses a letter.

    Only words of ``least`` code points and ``repeats`` occurrences stay. Counts combine before the shuffle.
    """
    # A shorter run cannot give a word of the least length, and the pattern takes whole runs or none.
    runs = F.regexp_extract_all(whole_text(), F.lit(f"[{LETTERS}]{{{least},}}"), 0)
    lowered = F.transform(runs, lambda run: F.translate(run, UPPER, LOWER))
    prefix = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"))
    # Hashed before the rows are made, so that Spark does not repeat the hash in each expression that uses it.
    hashed = F.transform(
        lowered, lambda run: F.struct(run.alias("run"), F.crc32(F.concat(prefix, run).cast("binary")).alias("h"))
    )
    found = pick(docs, "doc_id", "text").select(F.inline(hashed))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    typo = F.col("h") % typo_every == 0
    long_enough = F.length("run") >= F.when(typo, least + 1).otherwise(least)
    return (
        found.where(long_enough)
        .select(F.when(typo, shorter).otherwise(F.col("run")).alias("word"))
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= repeats)
    )


def gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = Counter()
    for batch in batches:
        for word in batch.column("word").to_pylist():
            counts.update(map("".join, zip(word, word[1:])))  # noqa: B905
    yield pa.record_batch([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["gram", "n"])


def choose_pivots(prefix: list[tuple[int, int]], weight) -> list[int]:
    """Places of ``PIVOTS`` disjoint bigrams of the prefix with the smallest total weight.

    ``best[j]`` holds the cheapest choice of j bigrams among those seen whose last one ends before the next may start.
    """
    spots = sorted((at, rank) for rank, at in prefix)
    best = {0: [(0, -2, ())]}
    for at, rank in spots:
        for j in range(PIVOTS, 0, -1):
            free = [b for b in best.get(j - 1, ()) if b[1] + 2 <= at]
            if free:
                cost, _, chosen = min(free)
                best.setdefault(j, []).append((cost + weight[rank], at, (*chosen, at)))
    return list(min(best[PIVOTS])[2])


def start_keys(word: str, end: int, side: int, shifts: tuple[int, ...]) -> Iterator[int]:
    """Keys of a word whose first ``end`` code points are untouched; ``shifts`` are the places the rest may have moved by."""
    yield xxhash.xxh64_intdigest(word[: max(end, SHARED)].encode(), side) - 2**63
    if end < SHARED:
        head = f"{word[:end]}\n".encode()
        for shift in shifts:
            yield xxhash.xxh64_intdigest(head + word[SHARED + shift :].encode(), side + 2) - 2**63


def keys(word: str, turned: str, at: int, shifts: tuple[int, ...]) -> list[int]:
    """Keys of the bigram at a place, for an edit behind it and for one before it (the same on the reversed word)."""
    return [*start_keys(word, at + 2, 0, shifts), *start_keys(turned, len(word) - at, 1, shifts)]


def keyed(order: dict[str, int], weight: list[int]):
    """Words with the keys of their pivots and of the bigrams to look up."""

    def one(word: str):
        grams = sorted((order[word[i : i + 2]], i) for i in range(len(word) - 1))
        prefix = grams[:PREFIX]
        last = prefix[-1][0]
        before = sum(1 for rank, _ in prefix if rank < last)
        looked_up = [g for g in grams[: before + REPEATS] if g[0] <= last]
        turned = word[::-1]
        pivots = {k for at in choose_pivots(prefix, weight) for k in keys(word, turned, at, (0,))}
        return last, sorted(pivots), sorted({k for _, at in looked_up for k in keys(word, turned, at, (-1, 0, 1))})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [one(word) for word in batch.column("word").to_pylist()]
            yield pa.record_batch(
                [
                    batch.column("word"),
                    batch.column("n"),
                    pa.array([m[0] for m in made], pa.int32()),
                    pa.array([m[1] for m in made], pa.list_(pa.int64())),
                    pa.array([m[2] for m in made], pa.list_(pa.int64())),
                ],
                names=["word", "n", "last", "pivots", "lookups"],
            )

    return run


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, n_a, b, n_b), a before b: words exactly one inserted, deleted or replaced code point apart, each pair once.

    ``words`` is a stored table of distinct words of four code points or more. The driver and each task hold the counts of
    bigrams, at most the square of the alphabet: 8,100.
    """
    counts = words.mapInArrow(gram_counts, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    ranked = sorted((r["n"], r["gram"]) for r in counts.collect())
    order, weight = {gram: i for i, (_, gram) in enumerate(ranked)}, [n for n, _ in ranked]
    table_of_keys = materialize(words.mapInArrow(keyed(order, weight), KEYED), "variant-keys")

    def rows(column: str, side: str) -> DataFrame:
        return table_of_keys.select(
            F.explode(column).alias("key"),
            F.col("word").alias(f"w_{side}"),
            F.col("n").alias(f"n_{side}"),
            F.col("last").alias(f"last_{side}"),
            F.length("word").alias(f"len_{side}"),
        )

    p, q = rows("pivots", "p"), rows("lookups", "q")
    near = (
        (F.col("last_p") <= F.col("last_q"))
        & (F.abs(F.col("len_p") - F.col("len_q")) <= 1)
        & (F.col("w_p") != F.col("w_q"))
        & (F.levenshtein("w_p", "w_q", 1) == 1)
    )
    first = F.col("w_p") < F.col("w_q")

    def either(x: str, y: str, name: str):
        return F.when(first, F.col(x)).otherwise(F.col(y)).alias(name)

    return (
        p.join(q, "key")
        .where(near)
        .select(either("w_p", "w_q", "a"), either("n_p", "n_q", "n_a"), either("w_q", "w_p", "b"), either("n_q", "n_p", "n_b"))
        .distinct()
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of stored (word, form) rows: the last form of the chain. Each round doubles the steps that a word has followed."""
    reached = forms.select("word", F.col("form").alias("root"))
    for _ in range(DOUBLINGS):
        on = reached.select(F.col("word").alias("__at"), F.col("root").alias("__next"))
        further = reached.join(on, F.col("root") == F.col("__at"), "left")
        stepped = materialize(further.select("word", F.coalesce("__next", "root").alias("root"), F.col("__at").isNotNull().alias("went")), "variant-roots")
        reached = stepped.select("word", "root")
        if stepped.where("went").isEmpty():
            break
    return reached


def variants(words: DataFrame, factor: int = 10) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for a stored table (word, n) of distinct words.

    The form is the near word of largest n (ties: smallest in code-point order) if that is ``factor`` (2 or more) times the word's own.
    """
    pairs = materialize(near_pairs(words), "variant-pairs")
    both = pairs.selectExpr("a AS word", "n_a AS n", "b AS other", "n_b AS other_n").unionByName(
        pairs.selectExpr("b AS word", "n_b AS n", "a AS other", "n_a AS other_n")
    )
    best = both.groupBy("word", "n").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form"))).alias("best")
    )
    enough = -F.col("best.less") >= factor * F.col("n")
    judged = materialize(
        best.select(
            "word",
            "n_near",
            F.when(enough, F.col("best.form")).alias("form"),
            F.when(enough, -F.col("best.less")).alias("form_n"),
        ),
        "variant-forms",
    )
    ends = roots(judged.where("form IS NOT NULL"))
    return (
        words.join(judged, "word", "left")
        .join(ends, "word", "left")
        .select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            "form",
            "form_n",
            F.coalesce("root", "word").alias("root"),
        )
    )


def op12_spelling_variants(spark, sf_dir: str) -> DataFrame:
    """Form and root of every repeated word of the documents."""
    words = materialize(vocabulary(table(spark, sf_dir, "documents")), "variant-words")
    return variants(words).select("word", "form", "root", "n", "n_near", "form_n")
