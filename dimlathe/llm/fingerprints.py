"""Document fingerprints as invertible Bloom lookup sketches of digests of short pieces.

A text's lines are cut into pieces of a few dozen code points where their content says so, so an insertion changes the pieces
around it only. Pieces are hashed to 64-bit digests: 36 bits of hash, 8 of length, 20 of check of the other 44. Each digest goes into three cells, one in
each third of the table; a cell holds the XOR of its digests. Sketches of two versions are subtracted cell by cell, by XOR: what
both hold cancels. Peeling then takes digests out of cells whose check says that they hold just one, until nothing is left;
that yields the digests that differ. Where the published sketch gets stuck it is retried with a larger one: blocks of a
few cells, as many blocks as the two texts' pieces need, each peeled on its own. A block that gets stuck is retried as four, with other cells, and so on
until all are peeled. So cells are folded into short arrays only, and the work is linear in the pieces. Likeness is the share of code points in pieces
that don't differ.

Native: built-in expressions only.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dimlathe.llm.common import parts_for, pick, whole_text

#: Cells of a block, a multiple of three and 63 at most, and blocks of the published fingerprint.
BLOCK, BLOCKS = 18, 3
#: Seed of the published fingerprint's cells; retries are numbered from 1.
PUBLISHED = "0"
#: Digests of both versions in a block of the first retry, on average.
LOAD = 6
#: Retries: the n-th has up to 4^n times as many cells as the first. Two digests stay together in all of them with a chance of 4^-40.
RETRIES = 40
#: Code points of a piece: at least (but at a line's end), at most where words or sentences end, at most anywhere. Below 256.
LEAST, USUAL, MOST = 24, 72, 250
#: A piece ends behind a mark, or a word that ends in one of some letters; where no word ends, behind one of some frequent characters.
PIECES = (
    rf"(?:.{{{LEAST},{USUAL}}}?(?:[.!?;:,\u3002\uff0c\uff01\uff1f\u3001]+\s*|[aehnory0-4\u00e9\u0430\u043e\u0435](?=\s)\s+|$)"
    rf"|.{{{LEAST},{MOST - 1}}}?[aeio048\u306e\u306f\u3092\u306b\u7684\u662f\u4e86\u4e00\u0e32\u0e19]|.{{1,{USUAL}}})"
)
#: Rounds of peeling; each takes all single cells at once. A block holds no more digests than cells if it peels.
ROUNDS = BLOCK
#: Rows of a bucket, about, in which a document finds the next one.
BUCKET_ROWS = 20_000
BUCKETS = 1024


def paragraphs(text: Column) -> Column:
    """Digests of the pieces of the text's lines; repeated ones are told apart later, by ``numbered``."""
    lines = F.filter(F.split(text, "\n", -1), lambda p: F.length(p) > 0)
    pieces = F.flatten(F.transform(lines, lambda p: F.regexp_extract_all(p, F.lit("(?s)" + PIECES), F.lit(0))))
    return F.transform(pieces, lambda p: sized(F.xxhash64(p), F.least(F.length(p), F.lit(255)).cast("long")))


def sized(h: Column, length: Column) -> Column:
    """A checked digest of a hash's upper 36 bits and a length."""
    return checked(h.bitwiseAND(-1 << 28).bitwiseOR(F.shiftleft(length, 20)))


def length_of(digest: str) -> str:
    """SQL: the length in a digest."""
    return f"(shiftrightunsigned({digest}, 20) & 255)"


def checked(h: Column) -> Column:
    """The upper 44 bits of a hash, with a 20-bit check of them below."""
    return F.get(F.transform(F.array(F.shiftrightunsigned(h, 20)), lambda x: F.shiftleft(x, 20).bitwiseOR(F.xxhash64(F.lit(11), x).bitwiseAND(0xFFFFF))), F.lit(0))


def numbered(digests: str) -> Column:
    """The digests of the column in order, the second of equal ones hashed once more, and so on."""
    again = "xxhash64(x, k)"
    length = length_of("x")
    other = f"(shiftright({again}, 28) << 28 | {length} << 20)"
    other = f"((shiftrightunsigned({other}, 20) << 20) | (xxhash64(11, shiftrightunsigned({other}, 20)) & 1048575))"
    runs = "filter(sequence(0, size(s) - 1), i -> i = 0 OR get(s, i) <> get(s, i - 1))"
    # A run of equal digests starts at a place of r and ends before the next place.
    told = f"""flatten(transform(r, (f, j) -> transform(array(get(s, f)), x ->
        transform(sequence(0, coalesce(get(r, j + 1), size(s)) - f - 1), k -> IF(k = 0, x, {other})))[0]))"""
    ordered = f"sort_array({digests})"
    return F.expr(
        f"IF(size(array_distinct({digests})) = size({digests}), {ordered}, "
        f"transform(array({ordered}), s -> transform(array({runs}), r -> {told})[0])[0])"
    )


def _triples() -> str:
    """SQL: for each choice of one cell in each third of a block, which cells are chosen. The optimizer folds it into a constant."""
    third = BLOCK // 3
    chosen = [(x, third + y, 2 * third + z) for x in range(third) for y in range(third) for z in range(third)]
    rows = json.dumps([[i in cells for i in range(BLOCK)] for cells in chosen], separators=(",", ":"))
    return f"from_json('{rows}', 'array<array<boolean>>')"


def _triple(digest: str, seed: str) -> str:
    """SQL: the number of the digest's choice of cells. Published ones (seed 0) draw each third's cell from other bits of the hash."""
    third = BLOCK // 3
    if seed != PUBLISHED:
        return f"int(pmod(xxhash64({seed}, {digest}), {third ** 3}))"
    one = [f"(shiftrightunsigned(h, {21 * k}) & 1048575) % {third} * {third ** (2 - k)}" for k in range(3)]
    return f"transform(array(xxhash64({seed}, {digest})), h -> int({' + '.join(one)}))[0]"


def _put(cells: str, digests: str, seed: str) -> str:
    """SQL: the cells with all digests put in, or taken out, each of its three.

    Spark interprets lambdas node by node, and this one runs for each digest and cell: so cells are looked up, not worked out."""
    return (
        f"aggregate({digests}, {cells}, (cells, e) -> "
        f"zip_with(cells, get({_triples()}, {_triple('e', seed)}), (x, here) -> IF(here, x ^ e, x)))"
    )


def block(digests: str, seed: str) -> str:
    """SQL: the cells of one block of digests."""
    return _put(f"array_repeat(0L, {BLOCK})", digests, seed)


def _block_of(digest: str, blocks: str) -> str:
    """SQL: the digest's block, from 0: equal ranges of the hash, in the order of digests."""
    return f"shiftright((shiftright({digest}, 28) + {1 << 35}L) * {blocks}, 36)"


def sketch(digests: str) -> str:
    """SQL: the published cells of an array of digests, by block."""
    cells = block(f"filter(v, d -> {_block_of('d', str(BLOCKS))} = j)", PUBLISHED)
    return f"transform(array({digests}), v -> transform(sequence(0, {BLOCKS - 1}), j -> {cells}))[0]"


def subtract(a: str, b: str) -> str:
    return f"zip_with({a}, {b}, (x, y) -> x ^ y)"


def peel(difference: str, seed: str) -> str:
    """SQL: the digests that a subtracted block holds, null where peeling gets stuck. Where the XOR of several digests passes for one,
    that one is put in and taken out again, so a block in which a digest comes out twice counts as stuck.

    ``out`` begins with two zeros."""
    single = "(x & 1048575) = (xxhash64(11, shiftrightunsigned(x, 20)) & 1048575)"
    emptied = _put("s.cells", "s.pure", seed)
    return f"""aggregate(
      sequence(1, {ROUNDS}),
      named_struct('cells', {difference}, 'pure', array(0L), 'out', array(0L)),
      (s, n) -> IF(size(s.pure) = 0, s,
        transform(array(IF(n = 1, s.cells, {emptied})), cells -> named_struct(
          'cells', cells, 'pure', filter(array_distinct(array_remove(cells, 0L)), x -> {single}), 'out', flatten(array(s.out, s.pure))))[0]),
      s -> IF(size(s.pure) = 0 AND size(array_distinct(s.out)) = size(s.out) - 1 AND size(array_remove(s.cells, 0L)) = 0, array_remove(s.out, 0L), NULL))"""


def grown(a: str, b: str) -> str:
    """SQL: the digests in which two arrays differ, by blocks that are split while they are stuck.

    As subtraction is XOR like putting in, one version's digests are put into the cells of the other's, which subtracts them. Sorted
    digests of both are cut into blocks where the block's number changes.
    """
    count = f"greatest(1, int(ceil((size({a}) + size({b})) / {LOAD}.0D)))"
    numbers = f"transform(v.d, d -> {_block_of('d', 'v.n')})"
    starts = "filter(sequence(0, size(w) - 1), i -> i = 0 OR get(w, i) <> get(w, i - 1))"
    dealt = "transform(r, (f, j) -> transform(sequence(f, coalesce(get(r, j + 1), size(w)) - 1), i -> get(v.d, i)))"
    blocks = f"""IF(size({a}) + size({b}) = 0, array_repeat(array_repeat(0L, 0), 0),
        transform(array(named_struct('n', {count}, 'd', sort_array(concat({a}, {b})))), v ->
        transform(array({numbers}), w -> transform(array({starts}), r -> {dealt})[0])[0])[0])"""
    split = "transform(sequence(0, 3), j -> filter(y.x, d -> pmod(xxhash64(-k, d), 4) = j))"
    return f"""aggregate(
      sequence(1, {RETRIES}),
      named_struct('left', {blocks}, 'out', array(0L)),
      (g, k) -> IF(size(g.left) = 0, g, transform(array(transform(g.left, x -> named_struct('x', x, 'd', {peel(block("x", "k"), "k")}))), t ->
        named_struct(
          'left', flatten(transform(filter(t, y -> y.d IS NULL), y -> {split})),
          'out', concat(g.out, flatten(transform(filter(t, y -> y.d IS NOT NULL), y -> y.d)))))[0]),
      g -> IF(size(g.left) = 0, array_remove(g.out, 0L), NULL))"""


def difference(a: str, b: str, sketch_a: str, sketch_b: str) -> str:
    """SQL: the digests in which two columns of digests differ. The columns' published sketches, given, are tried first, but not where
    more digests must differ than they have cells."""
    each = f"zip_with({sketch_a}, {sketch_b}, (g, h) -> {peel(subtract('g', 'h'), PUBLISHED)})"
    first = f"transform(array({each}), t -> IF(exists(t, y -> y IS NULL), NULL, flatten(t)))[0]"
    return f"coalesce(IF(abs(size({a}) - size({b})) <= {BLOCK * BLOCKS}, {first}, NULL), {grown(a, b)})"


def differing(a: str, b: str, sketch_a: str, sketch_b: str) -> Column:
    """How many digests of two columns differ."""
    return F.expr(f"size({difference(a, b, sketch_a, sketch_b)})")


def weight(digests: str) -> str:
    """SQL: the code points of all pieces of an array of digests."""
    return f"aggregate({digests}, 0L, (sum, d) -> sum + {length_of('d')})"


def likeness(differ: str, a: str, b: str) -> Column:
    """The share of code points that two columns' pieces have in common."""
    return F.expr(f"IF(size({a}) + size({b}) = 0, 1.0D, 1 - {weight(differ)} / ({weight(a)} + {weight(b)}))")


def as_text(cells: str, digests: str, n_chars: str) -> Column:
    """A fingerprint's text: code points and paragraphs, then the filled cells by place."""
    filled = f"filter(transform(flatten({cells}), (x, i) -> IF(x = 0, NULL, concat(string(i), ':', lower(hex(x))))), x -> x IS NOT NULL)"
    return F.expr(f"concat({n_chars}, '/', size({digests}), ';', array_join({filled}, ';'))")


def with_next(docs: DataFrame, made: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """bucket, doc_id, text, the columns that ``made`` adds, and each but the first two once more as next_*: those of the next row by
    doc_id (nulls last, ties by the text), after the last the first.

    Rows are dealt to buckets by quantiles of doc_id, whole ids to one bucket, and each bucket is sorted once. The first id of
    every bucket is also sent to the bucket before it, so no row needs a second shuffle. At most ``BUCKETS`` bounds reach the driver.
    """
    spark = docs.sparkSession
    read = pick(docs, "doc_id", "text").withColumn("text", whole_text())
    ids = read.select(F.col("doc_id").cast("long").alias("doc_id"))
    count = ids.count()
    if not count:
        empty = made(read.select(F.lit(0).alias("bucket"), "*"))
        return empty.select("*", *(F.col(c).alias(f"next_{c}") for c in empty.columns[2:]))
    wanted = min(BUCKETS, parts_for(spark, count, BUCKET_ROWS) * 4)
    shares = F.array(*(F.lit(k / wanted) for k in range(1, wanted)))
    bounds = ids.agg(F.percentile_approx("doc_id", shares, F.lit(10_000)).alias("b")).first()["b"] or []
    bounds = sorted(set(bounds))
    limits = F.expr(f"array({', '.join(f'{b}L' for b in bounds)})") if bounds else F.array().cast("array<bigint>")
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))
    placed = read.withColumn("bucket", F.size(F.filter(limits, lambda b: b < key)))
    # The smallest row of each bucket, sent to the bucket before; the first of all also goes to the last.
    keys = placed.select("bucket", F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("k"))
    firsts = [tuple(r) for r in keys.groupBy("bucket").agg(F.min("k")).orderBy("bucket").collect()]
    schema = "goes int, first long, wraps boolean"
    moves = [(firsts[i - 1][0], firsts[i][1], False) for i in range(1, len(firsts))] + [(firsts[-1][0], firsts[0][1], True)]
    guests = read.join(F.broadcast(spark.createDataFrame(moves, schema)), key == F.col("first"))
    guests = guests.select("doc_id", "text", F.col("goes").alias("bucket"), F.when(F.col("wraps"), 2).otherwise(1).alias("guest"))
    both = placed.withColumn("guest", F.lit(0)).unionByName(guests)
    order = W.partitionBy("bucket").orderBy("guest", F.col("doc_id").asc_nulls_last(), "text")
    parts = parts_for(spark, len(firsts), 4)
    dealt = made(both.select("bucket", "doc_id", "text", "guest").repartition(parts, "bucket"))
    handed = [c for c in dealt.columns if c not in ("bucket", "doc_id", "guest")]
    return dealt.select("*", *(F.lead(c).over(order).alias(f"next_{c}") for c in handed)).where("guest = 0").drop("guest")


def edited(text: Column, following: Column) -> Column:
    """The text with its last quarter replaced by the first as many code points of the following text."""
    quarter = F.floor(F.length(text) / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - quarter), F.substring(following, F.lit(1), quarter))


def compare(docs: DataFrame) -> DataFrame:
    """Per row: its fingerprint, its edited text's, and the likeness of its own to that and to the next document's.

    A null text counts as empty: no paragraphs, and two texts without any are alike (1). Rows stay rows, also repeated ones; other
    columns are left out; a single row is its own next; an empty table gives no rows.
    """
    def made(df: DataFrame) -> DataFrame:
        cut = df.withColumn("raw", paragraphs(F.col("text"))).withColumn("p", numbered("raw")).drop("raw")
        return cut.withColumn("sp", F.expr(sketch("p")))

    rows = with_next(docs, made).withColumn("edited", edited(F.col("text"), F.col("next_text")))
    told = rows.select(
        "doc_id", "p", "sp", F.col("next_p").alias("r"), F.col("next_sp").alias("sr"),
        F.length("text").cast("long").alias("n_chars"), F.length("edited").cast("long").alias("edited_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), paragraphs(F.col("edited")).alias("raw"),
    )
    sketched = told.withColumn("q", numbered("raw")).drop("raw").withColumn("sq", F.expr(sketch("q")))
    return sketched.select(
        "doc_id", "n_chars", "edited_sha256",
        as_text("sp", "p", "n_chars").alias("fingerprint"),
        as_text("sq", "q", "edited_chars").alias("edited_fingerprint"),
        likeness(difference("p", "q", "sp", "sq"), "p", "q").alias("near_edited"),
        likeness(difference("p", "r", "sp", "sr"), "p", "r").alias("near_next"),
    )


def op8_fingerprints(spark, sf_dir: str) -> DataFrame:
    return compare(spark.read.parquet(f"{sf_dir}/documents.parquet"))
