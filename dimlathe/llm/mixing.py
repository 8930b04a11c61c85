"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each document draws a key -ln(u) / w, with u from a hash of its id and w its quality weight; ascending keys are a
weighted sample without replacement. A source's budget is spent in complete epochs first; the rest goes to its
documents in key order until the prefix sum of sizes reaches the budget.

The prefix sum needs no sort of a whole source: sizes are summed per source and key bucket, whole buckets before the
boundary are taken, and only the one bucket per source that holds the boundary is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dimlathe.llm.common import pick, whole_text
from dimlathe.session import materialize

SEED = 20_260
#: A source's targets stop at so many times its size.
EPOCHS = 3
WEIGHTS = (1, 2, 3)
#: Key buckets of a source. A boundary bucket holds about one part in this many of its source.
BUCKETS = 1 << 16
SPACE = r"[\x20\x09-\x0D]+"


def words_in(text: Column) -> Column:
    """The number of words of a text."""
    return F.size(F.array_remove(F.split(text, SPACE, -1), "")).cast("long")


def quality_weight(text: Column, size: Column) -> Column:
    """1 for a text of words about five letters long, less the further its mean word length is from that."""
    mean = F.length(text) / F.greatest(size, F.lit(1))
    return F.greatest(F.lit(0.25), F.lit(1.0) - F.abs(mean - 6.0) / 10.0)


def draw(weight: Column, *identity: Column) -> Column:
    """The key: exponential with rate ``weight``, fixed by the identity and the seed."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(SEED), *identity), 11)
    uniform = (bits.cast("double") + 0.5) / F.lit(float(1 << 53))
    return -F.ln(uniform) / weight


def targets(sources: DataFrame, weights=WEIGHTS, most: int = EPOCHS) -> DataFrame:
    """``target`` for one row per source (source, source_size).

    Sources by code point, null last, weigh 1, 2, 3, repeating, and share the total. Targets stop at ``most`` times
    the source's size and the excess goes to the others by weight until none is above: with sources in the order
    of cap / weight, the first whose cap lies above the level that the rest can reach gives everyone's level. The
    windows see one row per source.
    """
    cycle = F.array(*(F.lit(w) for w in weights))
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    weighed = sources.withColumn("w", F.get(cycle, (F.row_number().over(by_name) - 1) % len(weights)).cast("long"))
    weighed = weighed.withColumn("cap", F.col("source_size") * most)
    by_ratio = W.orderBy((F.col("cap") / F.col("w")).asc(), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    since = by_ratio.rowsBetween(0, W.unboundedFollowing)
    everyone = W.partitionBy()
    left = F.sum("source_size").over(everyone) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    levelled = weighed.withColumn("level", left / F.sum("w").over(since))
    free = F.col("cap") > F.col("level") * F.col("w")
    first = F.struct(F.row_number().over(by_ratio).alias("n"), F.col("level").alias("level"))
    levelled = levelled.withColumn("final", F.min(F.when(free, first)).over(everyone)["level"])
    target = F.least(F.col("cap").cast("double"), F.coalesce(F.col("final") * F.col("w"), F.col("cap").cast("double")))
    return levelled.select("source", "source_size", target.alias("target"))


def plan(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (doc_id, source, size, key, bucket), sizes per source and bucket, and each source's target, complete
    epochs and rest. One narrow row per document is written to the shared folder and read twice."""
    read = pick(docs, "doc_id", "text", "source").withColumn("text", whole_text())
    sized = read.select("doc_id", "source", "text", words_in(F.col("text")).alias("size"))
    keyed = sized.select(
        "doc_id", "source", "size",
        draw(quality_weight(F.col("text"), F.col("size")), F.col("doc_id"), F.crc32(F.col("text").cast("binary"))).alias("key"),
    )
    rows = materialize(keyed, "mix")
    # Any non-decreasing map of the key does; this one spreads exponential keys evenly.
    rows = rows.withColumn("bucket", F.floor((1 - F.exp(-F.col("key"))) * BUCKETS).cast("int"))
    piles = rows.groupBy("source", "bucket").agg(F.sum("size").alias("pile"))
    sources = piles.groupBy("source").agg(F.sum("pile").alias("source_size"))
    wanted = targets(sources)
    epochs = F.least(F.floor(F.col("target") / F.greatest("source_size", F.lit(1))), F.lit(EPOCHS)).cast("long")
    wanted = wanted.withColumn("epochs", epochs)
    wanted = wanted.withColumn("rest", F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long"))
    return rows, piles, wanted


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, size, source, source_size, target, taken: how many words of each document the mix takes, repeats counted.

    Of the document at the boundary the mix takes a part, so a source's taken words differ from its target by
    rounding only. Ties of the key go by doc_id, then size; rows equal in all are interchangeable. A null text has size 0
    and takes nothing; a null source is a source. Other columns are left out. An empty table gives no rows.
    """
    rows, piles, wanted = plan(docs)
    ahead = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    piled = piles.withColumn("ahead", F.coalesce(F.sum("pile").over(ahead), F.lit(0)))
    # The one bucket per source in which the budget ends; in earlier ones all is taken, in later ones nothing.
    split = (
        piled.join(wanted, piled["source"].eqNullSafe(wanted["source"]))
        .where("ahead < rest AND ahead + pile >= rest")
        .select(piled["source"], F.col("bucket").alias("edge"), "ahead")
    )
    edges = wanted.join(split, wanted["source"].eqNullSafe(split["source"]), "left").select(
        wanted["source"].alias("s"), "source_size", "target", "epochs", "rest",
        F.when(F.col("rest") <= 0, -1).otherwise(F.coalesce("edge", F.lit(BUCKETS + 1))).alias("edge"),
        F.coalesce("ahead", F.lit(0)).alias("ahead"),
    )
    placed = rows.join(edges, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    out = ["doc_id", "size", "source", "source_size", "target"]
    whole = F.col("size") * F.col("epochs")
    clear = placed.where("bucket <> edge").select(
        *out, (whole + F.when(F.col("bucket") < F.col("edge"), F.col("size")).otherwise(0)).alias("taken")
    )
    order = W.partitionBy("source").orderBy("key", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    room = F.col("rest") - F.col("ahead") - F.coalesce(F.sum("size").over(order), F.lit(0))
    part = F.greatest(F.lit(0), F.least(F.col("size"), room))
    edge = placed.where("bucket = edge").select(*out, (whole + part).alias("taken"))
    return clear.unionByName(edge)


def op6_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def copies(docs: DataFrame) -> DataFrame:
    """The mixed documents themselves: each row of ``docs`` as often as the mix takes it, whole.

    The document at a boundary is in if at least half of it is wanted. Rows are matched by id, so ids should be unique; of rows
    with an equal or null id, the most taken count holds for all. Columns stay.
    """
    counted = mix(docs).select(
        F.col("doc_id").alias("__id"),
        F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5)).otherwise(0).cast("int").alias("__n"),
    )
    counted = counted.groupBy("__id").agg(F.max("__n").alias("__n"))
    joined = docs.join(counted, docs["doc_id"].eqNullSafe(counted["__id"])).where("__n > 0")
    repeated = joined.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__n"))))
    return repeated.select(*(docs[c] for c in docs.columns))
