"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps one bit per failed rule and the measurements behind
it. A policy is a version with a mask of the rules it enforces, so a change of policy, or the question what a rule
costs, is bitwise work on the ledger and reads no text.

Native: built-in expressions only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimlathe.llm.common import pick, whole_text

SPACE = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Rule:
    """``fails`` is a SQL condition over the measurements. The rule's place in its list is its bit."""

    name: str
    fails: str


#: Append only: a stored ledger keeps its bits.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("word_length", "word_chars < 3 * n_words OR word_chars > 10 * n_words"),
    Rule("repeated_lines", "100 * n_dup_lines > 40 * n_lines"),
    Rule("capitals", "2 * n_capitals > word_chars"),
)
BASE = ("few_words", "repeated_windows")


@dataclass(frozen=True)
class Policy:
    version: str
    rules: Sequence[str]

    def mask(self, rules: Sequence[Rule] = RULES) -> int:
        return sum(1 << k for k, rule in enumerate(rules) if rule.name in self.rules)


BASE_POLICY = Policy("2026-base", BASE)
PRODUCTION = Policy("2026-production", tuple(rule.name for rule in RULES))


def _window_hashes(words: Column) -> Column:
    """A 64-bit hash of each 3-word window."""
    count = F.greatest(F.size(words) - 2, F.lit(0))
    windows = F.arrays_zip(*(F.slice(words, start, count) for start in (1, 2, 3)))
    return F.transform(windows, lambda window: F.xxhash64(window))


def _placed(hashes: Column) -> Column:
    """Hashes with their places, sorted so that equal ones meet; empty where all differ."""
    placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), placed)


def _again(placed: Column) -> Column:
    """Places of windows that the text holds twice or more. ``placed`` is a column: the lambda reads it per element."""

    def repeated(x: Column, k: Column) -> Column:
        before, after = F.get(placed, k - 1)["h"], F.get(placed, k + 1)["h"]
        return F.coalesce(before == x["h"], F.lit(False)) | F.coalesce(after == x["h"], F.lit(False))

    return F.filter(placed, repeated)


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and what the rules look at: n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_capitals (A-Z),
    n_repeat_words.

    One row for each row of ``docs``, repeated rows and null ids included. A null text has no words. Other columns
    are left out. The work is per row, so no row's size or frequency matters to the others.
    """
    read = pick(docs, "doc_id", "text").withColumn("text", whole_text())
    words = read.select(
        "doc_id",
        "text",
        F.array_remove(F.split("text", SPACE, -1), "").alias("words"),
        F.filter(F.split("text", "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    hashed = words.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.length(F.regexp_replace("text", r"[^A-Z]+", "")).cast("long").alias("n_capitals"),
        _window_hashes(F.col("words")).alias("hashes"),
    )
    placed = hashed.withColumn("placed", _placed(F.col("hashes"))).drop("hashes")
    covered = F.flatten(F.transform(_again(F.col("placed")), lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))
    repeated = F.coalesce(F.size(F.array_distinct(covered)), F.lit(0))
    return placed.withColumn("n_repeat_words", F.when(F.col("placed").isNull(), 0).otherwise(repeated).cast("long")).drop("placed")


def ledger(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The measurements and ``failed``, the bits of the failed rules. At most 63 rules."""
    bits = [F.when(F.expr(rule.fails), F.lit(1 << k)).otherwise(0).cast("long") for k, rule in enumerate(rules)]
    return measure(docs).withColumn("failed", reduce(lambda a, b: a.bitwiseOR(b), bits, F.lit(0).cast("long")))


def passes(policy: Policy, rules: Sequence[Rule] = RULES) -> Column:
    return F.col("failed").bitwiseAND(policy.mask(rules)) == 0


def apply_policy(written: DataFrame, policy: Policy = PRODUCTION, rules: Sequence[Rule] = RULES) -> DataFrame:
    """A ledger with ``policy`` and ``kept``."""
    return written.withColumns({"policy": F.lit(policy.version), "kept": passes(policy, rules)})


def ablations(written: DataFrame, policy: Policy = PRODUCTION, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Per enforced rule: documents that fail it, and those that would be kept if only this rule were dropped.

    The ledger is first counted by its failed bits, so the shuffle carries one row per combination and task.
    An empty ledger gives no row.
    """
    mask = policy.mask(rules)
    enforced = F.array(
        *(
            F.struct(F.lit(rule.name).alias("rule"), F.lit(1 << k).cast("long").alias("bit"))
            for k, rule in enumerate(rules)
            if mask >> k & 1
        )
    )
    counted = written.groupBy(F.col("failed").bitwiseAND(mask).alias("bits")).agg(F.count("*").alias("n"))
    each = counted.select("bits", "n", F.inline(enforced))
    hit = F.when(F.col("bits").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)
    return each.groupBy("rule").agg(
        F.sum(hit).alias("failing"),
        F.sum(F.when(F.col("bits") == F.col("bit"), F.col("n")).otherwise(0)).alias("kept_without_it"),
    )


def keep_good(docs: DataFrame, policy: Policy = PRODUCTION) -> DataFrame:
    """The rows of ``docs`` that the policy keeps, with all their columns.

    The ledger rides along with its row, so rows with equal or null ids are judged one by one.
    """
    names = docs.columns
    positions = [f"__{i}" for i in range(len(names))]
    row = docs.toDF(*positions).select(
        F.struct(*positions).alias("doc_id"), F.col(f"__{names.index('text')}").alias("text")
    )
    # The row number keeps the filter where it is: pushed below the ledger it would evaluate the rules once more.
    kept = ledger(row).withColumn("__row", F.monotonically_increasing_id()).where(passes(policy) & (F.col("__row") >= 0))
    return kept.select(*(F.col(f"doc_id.{p}").alias(n) for p, n in zip(positions, names, strict=True)))


def op3_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    judged = apply_policy(ledger(docs))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~passes(BASE_POLICY)).alias("base_failed"), "kept", "failed", "n_lines", "n_capitals", "policy",
    )


OP3_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
cut AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM docs),
windows AS (
  SELECT rid, unnest(range(1, len(w) - 1)) AS i, unnest(w[:-3]) AS a, unnest(w[2:-2]) AS b, unnest(w[3:]) AS c FROM cut WHERE len(w) > 2),
repeated AS (
  SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, a, b, c) > 1),
covered AS (SELECT rid, count(DISTINCT i + d) AS n FROM repeated, (VALUES (0), (1), (2)) t(d) GROUP BY rid),
measured AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
    CAST(length(regexp_replace(text, '[^A-Z]+', '', 'g')) AS BIGINT) AS n_capitals,
    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM cut LEFT JOIN covered USING (rid)),
judged AS (
  SELECT *, CAST(1 * CAST(n_words < 50 AS INT) + 2 * CAST(100 * n_repeat_words > 50 * n_words AS INT)
    + 4 * CAST(10 * n_symbols > n_words AS INT)
    + 8 * CAST(word_chars < 3 * n_words OR word_chars > 10 * n_words AS INT)
    + 16 * CAST(100 * n_dup_lines > 40 * n_lines AS INT)
    + 32 * CAST(2 * n_capitals > word_chars AS INT) AS BIGINT) AS failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed & 3 <> 0 AS base_failed,
  failed = 0 AS kept, failed, n_lines, n_capitals, '2026-production' AS policy FROM judged
"""
