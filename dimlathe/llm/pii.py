"""Personal data: patterns, and terms that would give protected entities away.

The patterns find e-mail addresses, IP addresses, card and phone numbers. Each distinct value is a protected entity.
Blanking it does not help if other words of the text still single it out, so co-occurrence in the corpus measures how
strongly a term reveals an entity: the pointwise mutual information of term and entity over the information content
of the entity, log(c N / ((n_t + s) n_e)) / log(N / n_e), which nears 1 for a term that occurs with this entity only. Terms over
a threshold are generalised in the entity's texts, those over a higher one removed.

``c``, ``n_e``, ``n_t`` and ``N`` all count distinct whole texts of the corpus, so copies of one text are no evidence. The
smoothing ``s`` stands for unseen texts that hold the term without the entity: entities and terms of a single text are judged
too, the more carefully the smaller the corpus is.

Native: built-in expressions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimlathe.llm.common import pick, running_sum, whole_text
from dimlathe.session import materialize

# Kinds and what they look like. The look-behinds only spare attempts that cannot succeed, since a run that
# fails at its start fails at each later place; \G lets a match begin where the one before ended.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without this has no valid match, so the costlier pattern is not tried on it.
HINTS = {
    "email": r"@[A-Za-z0-9-]++\.",
    "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]",
    "card": r"[0-9](?:[\x20-]?[0-9]){12}",
    "phone": r"\+[0-9]",
}
TERM = "term"
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"

#: Texts added to a term's count as if they held it without the entity.
SMOOTHING = 0.5
#: Disclosure from which a term is generalised, and from which it is removed.
GENERALISE, REMOVE = 0.8, 0.95
LETTERS = r"\p{L}+"
#: Words of four letters and more are terms.
WORDS = r"(?<![^\P{L}])\p{L}{4,}"
SPAN = "array<struct<kind:string,start:bigint,end:bigint,value:string>>"


def _luhn(digits: Column) -> Column:
    def weighed(i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    total = F.aggregate(
        F.transform(F.sequence(F.lit(0), F.length(digits) - 1), weighed), F.lit(0), lambda acc, x: acc + x
    )
    return total % 10 == 0


def _valid(kind: str, span: Column) -> Column:
    value = span["value"]
    if kind == "ip":
        return value.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _validity(kind: str):
    return lambda span: _valid(kind, span)


def located(df: DataFrame, text: str, pattern: str, where: Column, out: str) -> DataFrame:
    """Adds ``out``: the pattern's matches with their places (start, end in code points, value), empty unless ``where``.

    ``split`` gives what lies between the matches, so places are running sums of lengths.
    """
    m, p, g, s = (f"__{out}_{x}" for x in "mpgs")
    df = df.withColumns({
        m: F.when(where, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))),
        p: F.when(where, F.split(text, pattern, -1)),
    })
    lengths = F.transform(
        m, lambda x, i: (F.length(F.get(p, i)) + F.when(i > 0, F.length(F.get(m, i - 1))).otherwise(0)).cast("long")
    )
    df = df.withColumn(g, lengths).withColumn(s, F.when(F.size(g) > 0, running_sum(F.col(g))))
    spans = F.transform(
        m,
        lambda x, i: F.struct(
            F.lit(out).alias("kind"), F.get(s, i).alias("start"), (F.get(s, i) + F.length(x)).alias("end"), x.alias("value")
        ),
    )
    return df.withColumn(out, F.coalesce(spans, F.array().cast(SPAN))).drop(m, p, g, s)


def base_spans(df: DataFrame) -> DataFrame:
    """Adds a column per kind with its valid matches."""
    for kind in KINDS:
        df = located(df, "text", PATTERNS[kind], F.col("text").rlike(HINTS[kind]), kind)
        df = df.withColumn(kind, F.filter(kind, _validity(kind)))
    return df


def _entity(span: Column) -> Column:
    return F.concat(span["kind"], F.lit(":"), F.lower(span["value"]))


def _digest(text: str) -> dict[str, Column]:
    """128 bits by which texts are told apart."""
    return {"__d1": F.xxhash64(text), "__d2": F.xxhash64(F.lit(1), text)}


def _terms(text: str) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(WORDS), F.lit(0)), F.lower))


def disclosing(docs: DataFrame) -> DataFrame:
    """__d1, __d2 (a text's digest), generalised and removed: the terms to treat in a text that holds a protected entity.

    Texts without such terms have no row. Counts are summed before they are shuffled. A pair of entity and term is formed only
    where the term is rare enough for its disclosure to reach ``GENERALISE`` in all texts of the entity; as ``c`` is at most
    ``n_e``, no pair that reaches it is left out.
    """
    key = ["__d1", "__d2"]
    read = pick(docs, "text").withColumn("text", whole_text()).withColumns(_digest("text"))
    # An outer explode: a filter on the spans would be pushed into the scan with the whole search inlined.
    found = base_spans(read).withColumn("entities", F.array_distinct(F.transform(F.concat(*KINDS), _entity)))
    listed = found.select(*key, F.explode_outer(F.when(F.size("entities") > 0, F.array("entities"))).alias("entities"), "text")
    listed = listed.where("entities IS NOT NULL").select(*key, "entities", _terms("text").alias("terms"))
    holders = materialize(materialize(listed, "pii-listed").dropDuplicates(key), "pii-holders")
    of_entity = holders.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count("*").alias("n_e"))
    held = materialize(holders.select(*key, F.explode("entities").alias("entity")).join(of_entity, "entity"), "pii-entities")
    if held.isEmpty():
        return holders.select(*key, F.col("terms").alias("generalised"), F.col("terms").alias("removed"))
    # Each copy of a text counts 1 / copies, so that sums need no distinct texts; rounding undoes what is lost in the last bits.
    copies = materialize(read.groupBy(*key).agg(F.count("*").alias("copies")), "pii-copies")
    n = F.lit(float(copies.count()))
    repeated = materialize(copies.where("copies > 1").toDF("__e1", "__e2", "copies"), "pii-repeated")
    weighed = read.join(repeated, (F.col("__d1") == F.col("__e1")) & (F.col("__d2") == F.col("__e2")), "left")
    words = weighed.select(F.explode(_terms("text")).alias("term"), (1 / F.coalesce("copies", F.lit(1))).alias("share"))
    of_term = words.groupBy("term").agg(F.greatest(F.round(F.sum("share")), F.lit(1.0)).alias("n_t"))

    def reach(n_e: Column) -> Column:
        """The largest n_t + s with which a term can still be generalised: log(N / (n_t + s)) = GENERALISE log(N / n_e)."""
        return n_e * F.pow(n / n_e, F.lit(1 - GENERALISE)) * (1 + 1e-9)

    # Spark broadcasts written tables if they are small, and shuffles both sides if not.
    top = held.groupBy(*key).agg(F.max(reach(F.col("n_e"))).alias("reach"))
    most = held.agg(F.max(reach(F.col("n_e"))).alias("m")).first()["m"]
    rare = materialize(of_term.where(F.col("n_t") + SMOOTHING <= F.lit(most)), "pii-terms")
    texts = holders.select(*key, F.explode("terms").alias("term")).join(rare, "term").join(top, key)
    texts = texts.where(F.col("n_t") + SMOOTHING <= F.col("reach")).select(*key, "term", "n_t")
    pairs = texts.join(held, key).where(F.col("n_t") + SMOOTHING <= reach(F.col("n_e")))
    pairs = materialize(pairs.select(*key, "entity", "term", "n_e", "n_t"), "pii-pairs")
    counted = pairs.groupBy("entity", "term").agg(F.count("*").alias("c"), F.first("n_e").alias("n_e"), F.first("n_t").alias("n_t"))
    information = F.ln(n / F.col("n_e"))
    mutual = F.ln(F.col("c") * n / ((F.col("n_t") + SMOOTHING) * F.col("n_e")))
    judged = counted.withColumn("disclosure", F.when(information > 0, mutual / information).otherwise(0.0))
    judged = materialize(judged.where(F.col("disclosure") >= GENERALISE).select("entity", "term", "disclosure"), "pii-judged")
    # Terms go to the texts that hold both, so a frequent entity does not carry each of its terms to each of its texts.
    treated = pairs.join(judged, ["entity", "term"]).groupBy(*key, "term").agg(F.max("disclosure").alias("disclosure"))
    high = F.col("disclosure") >= REMOVE
    return treated.groupBy(*key).agg(
        F.collect_set(F.when(~high, F.col("term"))).alias("generalised"), F.collect_set(F.when(high, F.col("term"))).alias("removed")
    )


def spans(docs: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """doc_id, text, the columns ``keep``, a column of spans per kind, and ``term``: spans of disclosing terms that touch no other span.

    One row per row of ``docs``; a null text is empty and has no spans; rows of one text share their terms, whatever their ids. Other
    columns are left out.
    """
    terms = materialize(disclosing(docs), "pii-disclosing")
    read = pick(docs, "doc_id", "text", *keep).withColumn("text", whole_text()).withColumns(_digest("text"))
    joined = read.join(terms, ["__d1", "__d2"], "left").drop("__d1", "__d2")
    df = located(base_spans(joined), "text", LETTERS, F.col("generalised").isNotNull(), TERM)
    df = df.withColumn("__all", F.concat(*KINDS))
    listed = F.array_union("generalised", "removed")
    free = F.filter(
        TERM,
        lambda x: F.array_contains(listed, F.lower(x["value"]))
        & ~F.exists("__all", lambda b: (x["start"] < b["end"]) & (x["end"] > b["start"])),
    )
    return df.withColumn(TERM, F.when(F.size(TERM) > 0, free).otherwise(F.col(TERM))).drop("__all")


def sanitise(docs: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """doc_id, the columns ``keep``, and the text with protected spans replaced by their kind, disclosing terms generalised or removed.

    Overlapping spans are replaced as one, by the kind of the first.
    """
    found = spans(docs, keep).withColumn("__s", F.array_sort(F.transform(F.concat(*KINDS, TERM), lambda x: F.struct(x["start"], x["end"], x["kind"], x["value"]))))
    merged = F.aggregate(
        "__s", F.array().cast("array<struct<start:bigint,end:bigint,kind:string,value:string>>"),
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["end"] > x["start"]),
            F.concat(
                F.slice(acc, F.lit(1), F.size(acc) - 1),
                F.array(F.struct(
                    F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["end"], x["end"]).alias("end"),
                    F.element_at(acc, -1)["kind"].alias("kind"), F.element_at(acc, -1)["value"].alias("value"),
                )),
            ),
        ).otherwise(F.concat(acc, F.array(x))),
    )
    found = found.withColumn("__m", F.when(F.size("__s") > 0, merged))

    def piece(x: Column, i: Column) -> Column:
        start = F.coalesce(F.get("__m", i - 1)["end"], F.lit(0))
        gone = (x["kind"] == TERM) & F.array_contains(F.col("removed"), F.lower(x["value"]))
        return F.concat(
            F.substring("text", start.cast("int") + 1, (x["start"] - start).cast("int")),
            F.when(gone, "").otherwise(F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]"))),
        )

    tail = F.substring("text", F.element_at("__m", -1)["end"].cast("int") + 1, F.length("text"))
    text = F.when(F.col("__m").isNotNull(), F.concat(F.array_join(F.transform("__m", piece), ""), tail)).otherwise(F.col("text"))
    return found.select("doc_id", text.alias("text"), *keep)


def op4_pii(spark, sf_dir: str) -> DataFrame:
    found = spans(spark.read.parquet(f"{sf_dir}/documents.parquet"))

    def told(*kinds: str) -> Column:
        return F.array_join(
            F.transform(F.concat(*kinds), lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ","
        )

    return found.select(
        "doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(told(*KINDS).cast("binary"), 256).alias("base_sha256"), told(*KINDS, TERM).alias("spans"),
    )
