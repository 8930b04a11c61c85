"""License notices by an exact set-similarity join of text windows with templates.

A text is cut into windows of words. A window matches a template when it holds at least a threshold share of the
template's distinct words (containment). Template words are ranked by their document frequency over all
texts, rare first. A window that reaches the threshold must hold one of the template's first
``m - need + 1`` ranked words (prefix filter), at least ``need`` template words (length filter), and enough words
ranked after the one found (positional filter); survivors are counted exactly. Nothing that meets the threshold is
lost, because every filter is a necessary condition.

Native: built-in expressions and joins only. The templates are a parameter; their index is the only side that is
broadcast, and ``TEMPLATE_LIMIT`` bounds it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimlathe.llm.common import pick, whole_text

# Words, phrases and labels of the base search.
SEPARATORS = r"\x00-\x2F\x3A-\x60\x7B-\x7F"
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: label -> notice; distinct lower-case words of each are the set to be contained.
TEMPLATES = {
    "apache-2.0": "licensed under the apache license version 2 0",
    "cc-by": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc-by-nc": "licensed under cc by nc 4 0",
    "cc-by-sa": "licensed under cc by sa 4 0",
    "gpl": "licensed under the gnu general public license version 3",
    "lgpl": "licensed under the gnu lesser general public license version 3",
    "mit": "released under the mit license",
    "mpl-2.0": "subject to the terms of the mozilla public license version 2 0",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted",
    "unlicense": "this is free and unencumbered software released into the public domain",
}
TEMPLATE_LIMIT = 10_000
#: In percent, so that all comparisons are between whole numbers.
THRESHOLD = 90
WINDOW = 32


@dataclass(frozen=True)
class Template:
    label: str
    words: frozenset

    def need(self, threshold: int) -> int:
        return -(-threshold * len(self.words) // 100)


def templates_of(notices: Mapping[str, str]) -> list[Template]:
    found = [Template(label, frozenset(text.split())) for label, text in notices.items()]
    if sum(len(t.words) for t in found) > TEMPLATE_LIMIT:
        raise ValueError(f"the templates hold more than {TEMPLATE_LIMIT} words")
    if max((len(t.words) for t in found), default=0) > WINDOW:
        raise ValueError(f"a template has more than {WINDOW} distinct words")
    return found


def words_of(docs: DataFrame) -> DataFrame:
    """doc_id and the words of the text, A-Z lower-cased.

    ``lower`` also changes letters beyond ASCII. That can make no separator and, once the Kelvin sign is out of the
    way, no ASCII letter, so neither the places of words nor any comparison with a template change.
    """
    text = F.lower(F.replace(whole_text(), F.lit("K"), F.lit("å")))
    return pick(docs, "doc_id", "text").select(
        "doc_id", F.array_remove(F.split(text, f"[{SEPARATORS}]+", -1), "").alias("words")
    )


def _literal(words) -> Column:
    return F.array(*(F.lit(w) for w in words)) if words else F.array().cast("array<string>")


def places(words: str, phrase: str) -> Column:
    """Where the phrase's words stand consecutively in the column ``words``."""
    parts = phrase.split()
    w = F.col(words)

    def here(i: Column) -> Column:
        hit = F.get(w, i) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            hit = hit & (F.get(w, i + k) == part)
        return hit

    last = F.size(w) - len(parts)
    none = F.array().cast("array<int>")
    could = F.forall(_literal(parts), lambda p: F.array_contains(w, p)) & (last >= 0)
    return F.when(could, F.filter(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), here)).otherwise(none)


def ranks(words: DataFrame, templates: Sequence[Template]) -> list[str]:
    """All template words, rarest in the corpus first; ties by the word. At most ``TEMPLATE_LIMIT`` words reach the
    driver, each with one count."""
    known = sorted(set().union(*(t.words for t in templates)))
    held = words.select(F.explode(F.array_intersect("words", _literal(known))).alias("word"))
    counts = dict(held.groupBy("word").count().collect())
    return sorted(known, key=lambda w: (counts.get(w, 0), w))


def scan(docs: DataFrame, notices: Mapping[str, str] = TEMPLATES, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, n_words, the base phrases' places, and per row the labels and the best containment of its windows.

    Windows hold ``2 * WINDOW`` words and start every ``WINDOW`` words, so any run of ``WINDOW`` words lies in one.
    One row per row of ``docs``, also for repeated rows and null ids; a null or empty text has no words, no labels
    and score 0. Other columns are left out. Only windows that hold a prefix word leave their row, so the shuffle
    carries no text, and a frequent word is in no prefix unless the template has no rarer one.
    """
    templates = templates_of(notices)
    words = words_of(docs)
    ranked = ranks(words, templates)
    place = {w: i for i, w in enumerate(ranked)}
    index = []
    for number, t in enumerate(templates):
        order = sorted(t.words, key=place.get)
        need = t.need(threshold)
        for at, word in enumerate(order[: len(order) - need + 1]):
            index.append((word, number, t.label, order, len(order), need, at))
    spark = docs.sparkSession
    ddl = "token string, template int, label string, members array<string>, m int, need int, at int"
    prefixes = sorted({row[0] for row in index})

    base = {p: places("words", p) for p in PHRASES}
    found = words.select("doc_id", "words", *(c.alias(f"p{k}") for k, c in enumerate(base.values())))
    starts = F.concat(*(F.col(f"p{k}") for k in range(len(base))))
    labelled = F.array_compact(
        F.array(*(F.when(F.size(f"p{k}") > 0, F.lit(label)) for k, label in enumerate(PHRASES.values())))
    )
    rows = found.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        "words",
        F.size("words").cast("long").alias("n_words"),
        F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        F.array_sort(labelled).alias("base"),
    )
    # Windows of documents with a prefix word, cut to template words; those with none are gone before the join.
    w = F.col("words")
    last = F.greatest(F.floor((F.size(w) - 1 - WINDOW) / F.lit(WINDOW)), F.lit(0)).cast("int")
    cut = F.transform(
        F.sequence(F.lit(0), last),
        lambda b: F.array_intersect(_literal(ranked), F.slice(w, b * WINDOW + 1, F.lit(2 * WINDOW))),
    )
    windows = F.when(
        F.arrays_overlap(w, _literal(prefixes)), F.filter(cut, lambda x: F.arrays_overlap(x, _literal(prefixes)))
    )
    kept = ["row", "doc_id", "n_words", "n_base", "first_word", "last_word", "base"]
    blocks = rows.select(*kept, F.explode_outer(windows).alias("block"))
    tokens = blocks.select(
        *kept, "block", F.explode_outer(F.array_intersect("block", _literal(prefixes))).alias("token")
    )
    if index:
        joined = tokens.join(F.broadcast(spark.createDataFrame(index, ddl)), "token", "left")
    else:
        joined = tokens.select("*", *(F.lit(None).cast(x.split()[1]).alias(x.split()[0]) for x in ddl.split(", ")[1:]))
    # Block and members are in rank order. A pair is judged once, at its first common prefix word; what is ranked
    # after that word bounds the overlap on both sides.
    m, need, at = F.col("m"), F.col("need"), F.col("at")
    earlier = F.arrays_overlap("block", F.slice("members", F.lit(1), at))
    behind = F.size("block") - F.array_position("block", F.col("token")) + 1
    fits = (F.size("block") >= need) & (F.least(m - at, behind) >= need) & ~earlier
    overlap = F.when(fits, F.size(F.array_intersect("block", "members")))
    share = F.when(overlap >= F.col("need"), overlap / F.col("m"))
    judged = joined.select(*kept, "label", share.alias("share"))
    return (
        judged.groupBy(*kept)
        .agg(
            F.collect_set(F.when(F.col("share").isNotNull(), F.col("label"))).alias("labels"),
            F.coalesce(F.max("share"), F.lit(0.0)).alias("share"),
        )
        .select(
            *kept[1:6],
            F.array_join("base", ",").alias("base_labels"),
            F.array_join(F.array_sort(F.array_union("base", "labels")), ",").alias("labels"),
            F.when(F.size("base") > 0, 1.0).otherwise(F.col("share")).alias("score"),
        )
    )


def op1_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _sql() -> str:
    phrases = ",\n  ".join(
        f"p{k} AS (SELECT rid, i FROM (SELECT rid, w, unnest(range(1, len(w) + 1)) AS i FROM cut WHERE list_contains(w, '{p.split()[0]}')) "
        f"WHERE {' AND '.join(f'w[i + {j}] = {chr(39)}{x}{chr(39)}' for j, x in enumerate(p.split()))})"
        for k, p in enumerate(PHRASES)
    )
    hits = " UNION ALL ".join(f"SELECT rid, i - 1 AS i, '{label}' AS label FROM p{k}" for k, label in enumerate(PHRASES.values()))
    notices = ", ".join(
        f"('{t.label}', [{', '.join(repr(x) for x in sorted(t.words))}], {t.need(THRESHOLD)})" for t in templates_of(TEMPLATES)
    )
    return rf"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
  cut AS (SELECT rid, doc_id, regexp_extract_all(text, '[^{SEPARATORS}]+') AS w FROM docs),
  {phrases},
  hits AS ({hits}),
  base AS (SELECT rid, count(*) AS n, min(i) AS a, max(i) AS z, list_sort(list(DISTINCT label)) AS l FROM hits GROUP BY rid),
  blocks AS (SELECT rid, unnest(range(0, greatest((len(w) - 1 - {WINDOW}) // {WINDOW}, 0) + 1)) AS b, w FROM cut),
  sets AS (SELECT rid, list_distinct(w[b * {WINDOW} + 1 : b * {WINDOW} + {2 * WINDOW}]) AS s FROM blocks),
  notices(label, members, need) AS (VALUES {notices}),
  matched AS (
    SELECT rid, label, len(list_intersect(s, members)) / len(members) AS share, len(list_intersect(s, members)) AS n, need
    FROM sets, notices),
  best AS (SELECT rid, max(share) AS share, list(DISTINCT label) AS l FROM matched WHERE n >= need GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(base.n, 0) AS BIGINT) AS n_base,
  CAST(base.a AS BIGINT) AS first_word, CAST(base.z AS BIGINT) AS last_word,
  coalesce(array_to_string(base.l, ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.l, []), coalesce(best.l, [])))), ','), '') AS labels,
  CASE WHEN base.n > 0 THEN 1.0::DOUBLE ELSE coalesce(best.share, 0.0::DOUBLE) END AS score
FROM cut LEFT JOIN base USING (rid) LEFT JOIN best USING (rid)
"""


OP1_SQL = _sql()
