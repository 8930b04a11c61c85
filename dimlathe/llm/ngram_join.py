"""Exact n-gram Jaccard join with signature trees, and the components of its links.

1. *Sets.* A text's words are hashed, runs of four words are hashed again (64 bits); a document's set are its distinct
   hashes. Documents with equal sets form a class, and only its smallest doc_id goes on.
2. *Groups.* Shingles are ordered globally, rare ones first, by a frequency table of fixed size. Two sets that reach the
   threshold share one of the first ``n - ceil(t n) + 1`` shingles of each (prefix filter), so classes are grouped by these.
3. *Stars.* Each class is compared with one leader of its groups by size and signature. A pair that may link puts both into one
   family. That joins nearly all members of a family of copies without looking at its pairs.
4. *Signature trees.* What is left are groups that hold classes of different families. Their members are
   dealt to nodes by size and signature; pairs of nodes whose size ranges cannot reach the threshold are dropped. A task
   takes one pair of nodes, builds a tree over each (a node holds the OR of its members' token bitmaps and their range of sizes) and
   descends both at once; a pair of nodes is pruned when its largest possible overlap is too small, or when all
   members are of one family already. Of the pairs that come through a task returns a forest: each class with the smallest
   one it hangs together with, so there are never more rows than members.
5. *Links.* All links lie within a family. A small family is one block, a large one is dealt to blocks by size and hash. A task takes
   two blocks, descends their signature trees, counts overlaps on the sets, sums up what each class is linked with and returns the
   links as a forest once more; the components are those of all forests. ``class_pairs`` gives the pairs themselves. This is the only
   step that moves sets: each once in a small family, else once to each block of like size.

A link is lost only if a bound fails, and all bounds are necessary conditions; so the components are exact (up to 64-bit hash
collisions).
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dimlathe.llm.common import pick, shuffle_partitions, whole_text
from dimlathe.session import file_system, scratch_path

WORDS = 4
#: Similarity in percent: 100 * intersection >= PERCENT * union.
PERCENT = 85
#: Entries of the frequency table (one byte each once it is made): fixed, whatever the input's size.
SLOTS = 1 << 21
SLOT_BLOCK = 1 << 14
#: Bits of a set's signature: four to eight times its size, within these bounds.
BITS, MOST_BITS = 512, 8192
#: Members of a tree's leaf, children of a node, and members of one task's node, about.
LEAF, FAN, NODE = 8, 4, 512
#: Tasks of at most this many members are searched pair by pair, many tasks at once.
FEW = 12
#: Classes and tokens of a block whose links are counted, about, and tokens that a step of counting takes.
BLOCK, TOKENS, STEP = 512, 1 << 18, 4096

#: Blocks of counts that one task sums up.
GATHERED = 64
#: Rows of a batch that goes to a Python worker: texts and sets are large, and each worker holds a batch several times over.
BATCH = 2000
#: Words of 64 bits in the filter by which documents are chosen: fixed, whatever the input's size.
FILTER = 1 << 18
#: While a table is made. Shuffle files go once it is written.
_MAKING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH)}


@contextmanager
def _making(spark) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in _MAKING}
    for k, v in _MAKING.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


class Scratch:
    """Tables of one join in the shared folder. Each is deleted once its successors are written, and the shuffle files that made
    it go as soon as it is written, so disk holds what is still to be read and not the whole history."""

    def __init__(self, spark):
        self.spark, self.paths = spark, {}

    def write(self, df: DataFrame, name: str) -> DataFrame:
        self.drop(name)
        path = scratch_path(self.spark, f"ngram-{name}")
        with _making(self.spark):
            df.write.parquet(path)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            path = self.paths.pop(name, None)
            if path:
                hadoop_path, files = file_system(self.spark, path)
                files.delete(hadoop_path, True)


_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


@lru_cache(maxsize=4)
def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    def power(base: np.uint64) -> np.ndarray:
        steps = np.full(count, base, np.uint64)
        steps[0] = 1
        return np.multiply.accumulate(steps)

    return power(_BASE), power(_INVERSE)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's runs of ``words`` words; of all its words where it has fewer."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    if not len(data):
        return np.empty(0, np.uint64)
    space = _SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.empty(0, np.uint64)
    size = 1 << (len(data) + 1).bit_length()
    power, inverse = _powers(size)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * power[: len(data)], dtype=np.uint64)))
    hashes = mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    count = min(words, len(hashes))
    runs = np.zeros(len(hashes) - count + 1, np.uint64)
    for k in range(count):
        runs = mix(runs * _BASE + hashes[k : len(hashes) - count + 1 + k])
    return np.unique(runs)


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1


def needed(a, b, percent: int = PERCENT):
    """Smallest overlap of sets of these sizes that reaches the threshold: i >= t (a + b) / (1 + t)."""
    return -(-percent * (a + b) // (100 + percent))


def bitmap(hashes: np.ndarray, width: int = BITS) -> np.ndarray:
    bits = np.zeros(width, np.uint8)
    bits[(hashes >> np.uint64(8)) % np.uint64(width)] = 1
    return np.packbits(bits)


def width_for(n: int) -> int:
    """Bits of the signature of a set of this size, a power of two."""
    return min(MOST_BITS, max(BITS, 1 << (4 * n).bit_length()))


def signatures(bits: pd.Series) -> np.ndarray:
    """The signatures of some sets as rows of words, as wide as the narrowest: the parts of wider ones are combined."""
    widths = bits.map(len).to_numpy()
    width = int(widths.min())
    out = np.empty((len(bits), width // 8), np.uint64)
    for w in np.unique(widths):
        at = np.flatnonzero(widths == w)
        parts = np.frombuffer(b"".join(bits.iloc[at]), np.uint64).reshape(len(at), w // width, width // 8)
        out[at] = np.bitwise_or.reduce(parts, axis=1)
    return out


def may_link(bits: pd.Series, sizes: np.ndarray, i: np.ndarray, j: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """For pairs of places, whether sizes and signatures allow the threshold. Each pair is judged at the width of its narrower one."""
    widths = bits.map(len).to_numpy()
    narrow = np.minimum(widths[i], widths[j])
    out = np.zeros(len(i), bool)
    for w in np.unique(narrow):
        of_width = np.flatnonzero(narrow == w)
        for k in range(0, len(of_width), 1 << 14):
            at = of_width[k : k + (1 << 14)]
            used, ends = np.unique(np.concatenate([i[at], j[at]]), return_inverse=True)
            words = signatures(bits.iloc[used])
            x, y = ends[: len(at)], ends[len(at) :]
            a, b = sizes[i[at]], sizes[j[at]]
            slack = sizes[used] - np.bitwise_count(words).sum(axis=1, dtype=np.int64)
            shared = np.bitwise_count(words[x] & words[y]).sum(axis=1, dtype=np.int64)
            most = np.minimum(shared + np.minimum(slack[x], slack[y]), np.minimum(a, b))
            out[at] = most >= needed(a, b, percent)
    return out


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The edges (a, b) as fewer ones with the same components: each node but the smallest of its component, and that one."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(nodes))
    while (root[x] != root[y]).any():
        low = np.minimum(root[x], root[y])
        hung = root.copy()
        np.minimum.at(hung, root[x], low)
        np.minimum.at(hung, root[y], low)
        while (hung[hung] != hung).any():
            hung = hung[hung]
        root = hung[root]
    rest = root != np.arange(len(nodes))
    return nodes[rest], nodes[root[rest]]


def frequencies(docs: DataFrame, words: int = WORDS) -> np.ndarray:
    """log2 of how many documents hold a shingle of each slot. The table has ``SLOTS`` entries at any input size: tasks
    send blocks of partial counts, which are summed by block."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        total = np.zeros(SLOTS, np.int32)  # a task has fewer documents than that counts to
        for batch in batches:
            for text in batch["text"]:
                np.add.at(total, (shingles(text, words) % np.uint64(SLOTS)).astype(np.int64), 1)
        blocks = total.reshape(-1, SLOT_BLOCK)
        task = TaskContext.get().partitionId()
        for k in np.flatnonzero(blocks.any(axis=1)):
            yield pd.DataFrame({"block": [k], "task": [task], "counts": [blocks[k].astype("<i8").tobytes()]})

    def gather(group: pd.DataFrame) -> pd.DataFrame:
        summed = sum(np.frombuffer(c, "<i8") for c in group["counts"])
        return pd.DataFrame({"block": group["block"][:1], "task": group["task"][:1] // GATHERED, "counts": [summed.tobytes()]})

    def logs(group: pd.DataFrame) -> pd.DataFrame:
        summed = sum(np.frombuffer(c, "<i8") for c in group["counts"])
        return pd.DataFrame({"block": group["block"][:1], "classes": [np.log2(summed + 1).astype(np.uint8).tobytes()]})

    layout = "block int, task int, counts binary"
    texts = docs.select(whole_text().alias("text"))
    parts, tasks = texts.mapInPandas(count, layout), texts.rdd.getNumPartitions()
    while tasks > GATHERED:  # no more than GATHERED blocks come together in a group
        tasks = -(-tasks // GATHERED)
        parts = parts.groupBy("block", F.floor(F.col("task") / GATHERED).alias("g")).applyInPandas(gather, layout)
    # The last sums become logarithms where they are made: a second Python step in the stage would take a second worker for each task.
    with _making(docs.sparkSession):
        # A few MB at any size of the input: SLOTS bytes.
        rows = parts.groupBy("block").applyInPandas(logs, "block int, classes binary").collect()
    table = np.zeros((SLOTS // SLOT_BLOCK, SLOT_BLOCK), np.uint8)
    for row in rows:
        table[row["block"]] = np.frombuffer(row["classes"], np.uint8)
    return table.ravel()


def profiles(docs: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """doc_id, n, digest (of the whole set) and rep (64 bits of it), prefix (first shingles in the global order) and bits of every row."""
    table = frequencies(docs, words)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(table)  # SLOTS bytes

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib

        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                found = shingles(text, words)
                order = np.lexsort((found, shared.value[(found % np.uint64(SLOTS)).astype(np.int64)]))
                head = found[order[: prefix_length(len(found), percent)]] if len(found) else found
                digest = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
                rep = int.from_bytes(digest[:8], "little", signed=True)
                rows.append((doc_id, len(found), digest, rep, head.view(np.int64), bitmap(found, width_for(len(found))).tobytes()))
            yield pd.DataFrame(rows, columns=["doc_id", "n", "digest", "rep", "prefix", "bits"])

    read = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    schema = "doc_id long, n int, digest binary, rep long, prefix array<long>, bits binary"
    return read.where("doc_id IS NOT NULL").mapInPandas(work, schema)


def sets_of(docs: DataFrame, wanted: DataFrame, words: int = WORDS) -> DataFrame:
    """rep and set of the classes in ``wanted`` (rep, name: a document that has the set). A document may stand for other texts too;
    those are left out."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib

        for batch in batches:
            sets = [shingles(t, words) for t in batch["text"]]
            reps = [int.from_bytes(hashlib.blake2b(x.tobytes(), digest_size=16).digest()[:8], "little", signed=True) for x in sets]
            yield pd.DataFrame({"rep": reps, "set": [x.view(np.int64) for x in sets]})

    # A bit per hash of a name, so that the texts are chosen where they are read. Bits may collide; the join on rep is exact.
    def slot(of: str):
        return F.pmod(F.xxhash64(of), F.lit(FILTER * 64))

    bits = wanted.select(slot("name").alias("p")).groupBy(F.expr("shiftright(p, 6)").alias("__p"))
    bits = bits.agg(F.bit_or(F.expr("shiftleft(1L, int(p & 63))")).alias("__bits"))
    read = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("name"), whole_text().alias("text"), slot("name").alias("p"))
    here = (F.expr("shiftright(p, 6)") == F.col("__p")) & F.expr("shiftrightunsigned(__bits, int(p & 63)) & 1 = 1")
    found = read.where("name IS NOT NULL").join(F.broadcast(bits), here, "left_semi").select("text").mapInPandas(cut, "rep long, set array<long>")
    return found.join(wanted.select(F.col("rep").alias("__r")), F.col("rep") == F.col("__r"), "left_semi").dropDuplicates(["rep"])


def likely(pairs: DataFrame, classes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) of classes that may reach the threshold by their sizes and signatures."""
    left = classes.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("bits").alias("bits_a"))
    right = classes.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("bits_b"))

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                bits = pd.concat([batch["bits_a"], batch["bits_b"]], ignore_index=True)
                sizes = np.concatenate([batch["na"], batch["nb"]]).astype(np.int64)
                at = np.arange(len(batch))
                yield batch.loc[may_link(bits, sizes, at, at + len(batch), percent), ["a", "b"]]

    return pairs.join(left, "a").join(right, "b").select("a", "na", "bits_a", "b", "nb", "bits_b").mapInPandas(judge, "a long, b long")


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """node and the smallest node it is connected with, for the nodes of ``links`` (a, b).

    Large-star and small-star steps in turn, each an aggregation and a join, until nothing changes. Every step is written to
    the shared folder and replaces the step before last.
    """
    edges = scratch.write(links.select("a", "b").where("a <> b").distinct(), f"{name}-1")

    def state(e: DataFrame):
        return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first())

    def star(e: DataFrame, large: bool) -> DataFrame:
        # Each node's neighbours (large: all; small: the smaller ones) are hung on the smallest of them.
        both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        around = both if large else both.where("b < a")
        low = around.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        low = low.withColumn("m", F.least("m", "u"))
        hung = around.join(low, around["a"].eqNullSafe(low["u"])).where(F.col("b") > F.col("a") if large else F.col("b") < F.col("a"))
        out = hung.select(F.col("b").alias("a"), F.col("m").alias("b"))
        if not large:
            out = out.union(low.select("u", "m"))
        return out.where("a <> b").distinct()

    before = None
    while (now := state(edges)) != before:
        before = now
        edges = scratch.write(star(edges, True), f"{name}-0")
        edges = scratch.write(star(edges, False), f"{name}-1")
    scratch.drop(f"{name}-0")
    tops = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    found = scratch.write(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")).union(tops), name)
    scratch.drop(f"{name}-1")
    return found


class Tree:
    """A signature tree over members in order: levels of nodes with OR-combined bitmaps, ranges of sizes, the most
    tokens that one member's bitmap merges, and the component shared by all members (-1 if there are several)."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray, comps: np.ndarray):
        slack = sizes - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
        level = (bits, sizes, sizes, slack, comps)
        self.levels, self.fans = [level], []
        fan = LEAF
        while len(self.levels[-1][1]) > 1:
            bits, low, high, slack, comps = self.levels[-1]
            cut = np.arange(0, len(low), fan)
            lowest, highest = np.minimum.reduceat(comps, cut), np.maximum.reduceat(comps, cut)
            self.levels.append((
                np.bitwise_or.reduceat(bits, cut, axis=0), np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut),
                np.maximum.reduceat(slack, cut), np.where(lowest == highest, lowest, -1),
            ))
            self.fans.append(fan)
            fan = FAN


def traverse(one: Tree, two: Tree, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """Places of members that may reach the threshold and are of different components: both trees are descended at once,
    level by level, from the pair of roots."""
    i, j = np.zeros(1, np.int64), np.zeros(1, np.int64)
    at, bt = len(one.levels) - 1, len(two.levels) - 1
    kept: list[tuple[np.ndarray, np.ndarray]] = []

    def possible(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        bits, low, high, slack, comps = one.levels[at]
        bits2, low2, high2, slack2, comps2 = two.levels[bt]
        shared = np.bitwise_count(bits[i] & bits2[j]).sum(axis=1, dtype=np.int64)
        most = np.minimum(shared + np.minimum(slack[i], slack2[j]), np.minimum(high[i], high2[j]))
        apart = (comps[i] != comps2[j]) | (comps[i] < 0)
        # The largest overlap must serve the smallest sizes of the two nodes that can meet at all.
        a, b = np.maximum(low[i], -(-percent * low2[j] // 100)), np.maximum(low2[j], -(-percent * low[i] // 100))
        return apart & (most >= needed(a, b, percent)) & (high[i] * 100 >= low2[j] * percent) & (high2[j] * 100 >= low[i] * percent)

    stack = [(at, bt, i, j)]
    while stack:
        at, bt, i, j = stack.pop()
        for k in range(0, len(i), 1 << 16) if len(i) > 1 << 16 else ():
            stack.append((at, bt, i[k : k + (1 << 16)], j[k : k + (1 << 16)]))
        if len(i) > 1 << 16:
            continue
        ok = possible(i, j)
        i, j = i[ok], j[ok]
        if not len(i):
            continue
        if not at and not bt:
            kept.append((i, j))
            continue
        if at >= bt and at:
            fan, size = one.fans[at - 1], len(one.levels[at - 1][1])
            child = (i[:, None] * fan + np.arange(fan)).ravel()
            i, j, at = child, np.repeat(j, fan), at - 1
            i, j = i[child < size], j[child < size]
        else:
            fan, size = two.fans[bt - 1], len(two.levels[bt - 1][1])
            child = (j[:, None] * fan + np.arange(fan)).ravel()
            i, j, bt = np.repeat(i, fan), child, bt - 1
            i, j = i[child < size], j[child < size]
        stack.append((at, bt, i, j))
    if not kept:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([k[0] for k in kept]), np.concatenate([k[1] for k in kept])


def tree_forest(postings: DataFrame, classes: DataFrame, comps: DataFrame, scratch: Scratch, percent: int = PERCENT) -> DataFrame:
    """Edges (a, b) that join all classes which may link, of different components, out of groups that hold more than one component: no
    more of them than rows that are searched."""
    labelled = postings.join(comps, postings["rep"] == comps["node"], "left").select(
        "h", "rep", F.coalesce("component", "rep").alias("component")
    )
    groups = labelled.groupBy("h").agg(
        F.count("*").alias("c"), F.min("component").alias("low"), F.max("component").alias("high"),
        F.bit_xor(F.xxhash64("rep")).alias("s1"), F.bit_xor(F.xxhash64(F.lit(7), "rep")).alias("s2"),
    )
    # Groups with the same members need one visit: their signature is the XOR of the members' hashes, twice.
    open_groups = groups.where("low <> high").groupBy("c", "s1", "s2").agg(F.min("h").alias("h"))
    open_groups = scratch.write(open_groups.select(F.col("h").alias("g"), F.ceil(F.col("c") / NODE).cast("int").alias("salts")), "open")
    sized = classes.select(F.col("rep").alias("r"), "n")
    step = -float(np.log(percent / 100)) / 2
    members = labelled.join(open_groups, F.col("h") == F.col("g")).join(sized, F.col("rep") == F.col("r"))
    members = members.select(
        "h", "rep", "component", "n",
        F.struct(F.floor(F.ln("n") / step).cast("int").alias("s"), F.pmod(F.xxhash64("rep"), F.col("salts")).cast("int").alias("k")).alias("node"),
    )
    members = scratch.write(members, "members")
    nodes = members.groupBy("h", "node").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.min("component").alias("c0"), F.max("component").alias("c1"))
    one, two = nodes.toDF("h", "node", "low1", "high1", "c01", "c11"), nodes.toDF("h", "node2", "low2", "high2", "c02", "c12")
    near = one.join(two, "h").where("node <= node2").where(
        (F.col("high1") * 100 >= F.col("low2") * percent) & (F.col("high2") * 100 >= F.col("low1") * percent)
        & ~((F.col("c01") == F.col("c11")) & (F.col("c02") == F.col("c12")) & (F.col("c01") == F.col("c02")))
    ).select("h", "node", "node2")
    sides = near.select("h", F.col("node").alias("at"), "node", "node2", F.lit(0).alias("side")).union(
        near.where("node <> node2").select("h", "node2", "node", "node2", F.lit(1))
    )
    dealt = members.withColumnRenamed("node", "at").join(sides, ["h", "at"])

    keys = ["h", "s", "k", "s2", "k2"]

    def few(bits, sizes, comps, starts, lengths, splits) -> tuple[np.ndarray, np.ndarray]:
        """Places of pairs out of small tasks, all tasks of one shape at once."""
        i, j = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for length, split in np.unique(np.stack([lengths, splits], axis=1), axis=0):
            x, y = np.triu_indices(length, 1)
            if split < length:
                across = (x < split) & (y >= split)
                x, y = x[across], y[across]
            at = starts[(lengths == length) & (splits == split)][:, None]
            i.append((at + x).ravel())
            j.append((at + y).ravel())
        i, j = np.concatenate(i), np.concatenate(j)
        apart = comps[i] != comps[j]
        i, j = i[apart], j[apart]
        ok = may_link(bits, sizes, i, j, percent)
        return i[ok], j[ok]

    def many(bits, sizes, comps, split: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of pairs out of one task's two nodes (the second starts at ``split``), or out of one with itself."""
        words = signatures(bits)
        one = Tree(sizes[:split], words[:split], comps[:split])
        two = Tree(sizes[split:], words[split:], comps[split:]) if split < len(sizes) else one
        i, j = traverse(one, two, percent)
        return i, j + split if split < len(sizes) else j

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Rows come sorted by key; what may go on in the next batch is held over.
        def worked(rows: pd.DataFrame) -> pd.DataFrame:
            ids = rows[keys].to_numpy(np.int64)
            starts = np.flatnonzero(np.concatenate(([True], (ids[1:] != ids[:-1]).any(axis=1), [True])))
            bits = rows["bits"]
            sizes, comps, reps, second = (rows[c].to_numpy(np.int64) for c in ("n", "component", "rep", "side"))
            lengths = np.diff(starts)
            splits = lengths - np.add.reduceat(second, starts[:-1])
            small = lengths <= FEW
            i, j = few(bits, sizes, comps, starts[:-1][small], lengths[small], splits[small])
            one, two = [reps[i]], [reps[j]]
            for a, length, split in zip(starts[:-1][~small], lengths[~small], splits[~small], strict=True):
                b = a + length
                i, j = many(bits.iloc[a:b], sizes[a:b], comps[a:b], split)
                x, y = forest(reps[a + i], reps[a + j])
                one.append(x)
                two.append(y)
            x, y = forest(np.concatenate(one), np.concatenate(two))
            return pd.DataFrame({"a": x, "b": y})

        held = None
        for batch in batches:
            rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
            if not len(rows):
                continue
            last = (rows[keys] == rows[keys].iloc[-1]).all(axis=1).to_numpy()
            first = int(np.argmax(last))
            held = rows.iloc[first:].reset_index(drop=True)
            if first:
                yield worked(rows.iloc[:first])
        if held is not None and len(held):
            yield worked(held)

    dealt = dealt.select("h", "node.s", "node.k", F.col("node2.s").alias("s2"), F.col("node2.k").alias("k2"), "side", "rep", "n", "component")
    # Narrow rows are dealt first; signatures join last.
    dealt = dealt.join(classes.select(F.col("rep").alias("r"), "bits"), F.col("rep") == F.col("r")).drop("r")
    # An explicit number of partitions: the rows are few but the work on them is not.
    parts = max(shuffle_partitions(classes.sparkSession), classes.sparkSession.sparkContext.defaultParallelism) * 2
    dealt = dealt.repartition(parts, *keys).sortWithinPartitions(*keys, "side", "n", "rep")
    return dealt.mapInPandas(search, "a long, b long")


def overlaps(one: list[np.ndarray], two: list[np.ndarray]) -> np.ndarray:
    """How many hashes each set of ``one`` shares with each of ``two``: products of incidence matrices, ``STEP`` hashes at a time."""
    out = np.zeros((len(one), len(two)), np.int64)
    left, right = np.concatenate(one), np.concatenate(two)
    row, col = np.repeat(np.arange(len(one)), [len(x) for x in one]), np.repeat(np.arange(len(two)), [len(x) for x in two])
    shared = np.intersect1d(left, right)
    at, bt = np.searchsorted(shared, left), np.searchsorted(shared, right)
    at_in, bt_in = (shared[np.minimum(x, len(shared) - 1)] == y if len(shared) else np.zeros(len(y), bool) for x, y in ((at, left), (bt, right)))
    row, at, col, bt = row[at_in], at[at_in], col[bt_in], bt[bt_in]
    order, order2 = np.argsort(at, kind="stable"), np.argsort(bt, kind="stable")
    row, at, col, bt = row[order], at[order], col[order2], bt[order2]
    for k in range(0, len(shared), STEP):
        a, b = np.searchsorted(at, (k, k + STEP)), np.searchsorted(bt, (k, k + STEP))
        x, y = np.zeros((len(one), STEP), np.float32), np.zeros((len(two), STEP), np.float32)
        x[row[a[0] : a[1]], at[a[0] : a[1]] - k] = 1
        y[col[b[0] : b[1]], bt[b[0] : b[1]] - k] = 1
        out += (x @ y.T).astype(np.int64)
    return out


def _dealt(classes: DataFrame, docs: DataFrame, scratch: Scratch, percent: int, words: int) -> DataFrame:
    """Rows for tasks: the classes of two blocks of one component, with their sets. Components of one class have no rows, small ones
    are one block."""
    several = classes.groupBy("component").agg(F.count("*").alias("k"), F.sum("n").alias("tokens")).where("k > 1")
    several = several.select(F.col("component").alias("g"), ((F.col("k") <= BLOCK) & (F.col("tokens") <= TOKENS)).alias("whole"))
    step = -float(np.log(percent / 100)) / 2
    live = classes.join(several, F.col("component").eqNullSafe(F.col("g"))).drop("g")
    live = live.withColumn("s", F.when(F.col("whole"), -1).otherwise(F.floor(F.ln("n") / step)).cast("int")).drop("whole")
    live = scratch.write(live, "live")
    salts = F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") / TOKENS)).cast("int")
    sized = live.groupBy("component", "s").agg(salts.alias("salts"), F.min("n").alias("low"), F.max("n").alias("high"))
    sized = scratch.write(sized, "sized")

    members = live.join(sized.select("component", "s", "salts"), ["component", "s"])
    members = members.withColumn("k", F.pmod(F.xxhash64("digest"), F.col("salts")).cast("int")).drop("salts")
    blocks = sized.select("component", "s", "low", "high", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("k"))
    one, two = blocks.toDF("component", "s1", "low1", "high1", "k1"), blocks.toDF("component", "s2", "low2", "high2", "k2")
    near = one.join(two, "component").where("s1 < s2 OR s1 = s2 AND k1 <= k2").where(F.col("high1") * 100 >= F.col("low2") * percent)
    near = near.select("component", "s1", "k1", "s2", "k2")
    sides = near.select("*", F.col("s1").alias("s"), F.col("k1").alias("k"), F.lit(0).alias("side")).union(
        near.where("s1 <> s2 OR k1 <> k2").select("*", "s2", "k2", F.lit(1))
    )
    keys = ["component", "s1", "k1", "s2", "k2"]
    spark = classes.sparkSession
    parts = max(shuffle_partitions(spark), spark.sparkContext.defaultParallelism) * 2
    # Narrow rows are dealt first; the sets join last and move once to their class and once to each task that compares them.
    narrow = scratch.write(members.join(sides, ["component", "s", "k"]).select(*keys, "side", "digest", "rep", "n", "bits", "copies"), "dealt")
    dealt = narrow.join(sets_of(docs, live, words), "rep").select(*keys, "side", "digest", "rep", "n", "bits", "copies", "set")
    return dealt.repartition(parts, *keys).sortWithinPartitions(*keys, "side", "n", "digest")


def _searched(dealt: DataFrame, percent: int, pairs: bool) -> DataFrame:
    """The verified pairs of classes (a, b: digests), or per class and task the documents of other classes that it is linked with, and the
    smallest class that those links join it with."""
    keys = ["component", "s1", "k1", "s2", "k2"]

    def linked(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """Places of linked classes in the rows of one task, each pair once."""
        split = len(rows) - int(rows["side"].sum())
        bits = signatures(rows["bits"])
        sizes, names = rows["n"].to_numpy(np.int64), np.arange(len(rows))
        one = Tree(sizes[:split], bits[:split], names[:split])
        alone = split == len(rows)
        two = one if alone else Tree(sizes[split:], bits[split:], names[split:])
        if not split or not len(two.levels[0][1]):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        i, j = traverse(one, two, percent)
        if alone:
            i, j = i[i < j], j[i < j]
        else:
            j = j + split
        if not len(i):
            return i, j
        x, y = np.unique(i), np.unique(j)
        sets = rows["set"].tolist()
        both = overlaps([sets[k].view(np.uint64) for k in x], [sets[k].view(np.uint64) for k in y])
        common = both[np.searchsorted(x, i), np.searchsorted(y, j)]
        close = common * 100 >= (sizes[i] + sizes[j] - common) * percent
        return i[close], j[close]

    def told(rows: pd.DataFrame) -> pd.DataFrame:
        i, j = linked(rows)
        if pairs:
            names = rows["digest"].to_numpy()
            return pd.DataFrame({"a": names[i], "b": names[j]})
        copies, total = rows["copies"].to_numpy(np.int64), np.zeros(len(rows), np.int64)
        np.add.at(total, i, copies[j])
        np.add.at(total, j, copies[i])
        reps = rows["rep"].to_numpy(np.int64)
        kept = np.flatnonzero(total)
        roots = dict(zip(*(x.tolist() for x in forest(reps[i], reps[j])), strict=True))
        return pd.DataFrame({"rep": reps[kept], "links": total[kept], "root": [roots.get(r, r) for r in reps[kept].tolist()]})

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Rows come sorted by key; what may go on in the next batch is held over.
        held: list[pd.DataFrame] = []
        for batch in batches:
            ids = batch[keys].to_numpy(np.int64)
            if not len(ids):
                continue
            starts = np.flatnonzero(np.concatenate(([True], (ids[1:] != ids[:-1]).any(axis=1), [True])))
            for a, b in zip(starts[:-1], starts[1:], strict=True):
                if held and (held[-1][keys].iloc[-1].to_numpy(np.int64) != ids[a]).any():
                    yield told(pd.concat(held, ignore_index=True))
                    held = []
                held.append(batch.iloc[a:b])
        if held:
            yield told(pd.concat(held, ignore_index=True))

    return dealt.mapInPandas(search, "a binary, b binary" if pairs else "rep long, links long, root long")


def classified(docs: DataFrame, made: DataFrame, rows: DataFrame, scratch: Scratch, percent: int, words: int, pairs: bool = False) -> DataFrame:
    """Every class of equal sets: rep, name (its smallest doc_id), n, copies (rows that have it), others (rows of other classes linked
    with it), component and top, the smallest doc_id of its component. Classes are known by their sets, so a doc_id with several texts
    stands for several; these are in one component. Or the linked pairs of classes."""
    whole = made.where("n > 0")
    classes = scratch.write(
        whole.groupBy("rep").agg(
            F.min("doc_id").alias("name"), F.first("n").alias("n"), F.first("digest").alias("digest"), F.first("bits").alias("bits"),
            F.count("*").alias("copies"),
        ),
        "classes",
    )
    # Of equal sets any row has the prefix; the first row's is taken before the shingles are dealt out.
    firsts = whole.groupBy("rep").agg(F.first("prefix").alias("prefix"))
    postings = scratch.write(firsts.select("rep", F.explode("prefix").alias("h")), "prefixes")
    # One shuffle of the narrow postings, whatever the number of groups.
    group = W.partitionBy("h")
    counted = postings.withColumn("lead", F.min("rep").over(group)).withColumn("last", F.max("rep").over(group))
    common = scratch.write(counted.where("lead <> last").select("rep", "h", "lead"), "postings")
    scratch.drop("prefixes", "profiles")
    # A leader of unlike size cannot be near, so it is not worth fetching its set.
    sizes = classes.select(F.col("rep").alias("__r"), "n")
    told = common.where("rep <> lead").select("rep", "lead").distinct()
    told = told.join(sizes.withColumnRenamed("n", "n1"), F.col("rep") == F.col("__r")).drop("__r")
    told = told.join(sizes.withColumnRenamed("n", "n2"), F.col("lead") == F.col("__r"))
    told = told.where(F.least("n1", "n2") * 100 >= F.greatest("n1", "n2") * percent)
    stars = told.groupBy(F.col("rep").alias("b")).agg(F.min("lead").alias("a")).select("a", "b")
    first = scratch.write(likely(scratch.write(stars, "stars"), classes, percent), "likely")
    comps = components(first, scratch, "components")
    trees = scratch.write(tree_forest(common.select("h", "rep"), classes, comps, scratch, percent), "trees")
    scratch.drop("postings", "members", "open", "stars")
    families = components(first.union(trees), scratch, "families")
    scratch.drop("likely", "trees", "components")
    grouped = classes.join(families, F.col("rep") == F.col("node")).drop("node")
    dealt = _dealt(grouped, docs, scratch, percent, words)
    if pairs:
        return _searched(dealt, percent, True)
    told = scratch.write(_searched(dealt, percent, False), "told")
    scratch.drop("families", "live", "sized", "dealt")
    # The classes of one id hang together.
    held = rows.where("n > 0")
    ids = held.groupBy("doc_id").agg(F.min("rep").alias("b"), F.max("rep").alias("z")).where("b <> z")
    twins = held.select("doc_id", F.col("rep").alias("a")).join(ids.select("doc_id", "b"), "doc_id").select("a", "b")
    final = components(told.select(F.col("rep").alias("a"), F.col("root").alias("b")).union(twins), scratch, "final")
    counts = told.groupBy(F.col("rep").alias("__r")).agg(F.sum("links").alias("others"))
    placed = classes.join(final, F.col("rep") == F.col("node"), "left").withColumn("component", F.coalesce("component", "rep")).drop("node")
    placed = placed.join(counts, F.col("rep").eqNullSafe(F.col("__r")), "left").drop("__r").withColumn("others", F.coalesce("others", F.lit(0)))
    tops = placed.groupBy(F.col("component").alias("__c")).agg(F.min("name").alias("top"))
    found = placed.drop("bits", "digest").join(tops, F.col("component").eqNullSafe(F.col("__c"))).drop("__c")
    found = scratch.write(found, "classified")
    scratch.drop("classes", "final", "told")
    return found


def _prepared(docs: DataFrame, percent: int, words: int, pairs: bool = False) -> tuple[DataFrame, DataFrame]:
    """The narrow rows of all documents with an id (doc_id, n, rep), and the classes, or the pairs of classes."""
    scratch = Scratch(docs.sparkSession)
    made = scratch.write(profiles(docs, percent, words), "profiles")
    rows = scratch.write(made.select("doc_id", "n", "rep"), "rows")
    return rows, classified(docs, made, rows, scratch, percent, words, pairs)


def _nameless(docs: DataFrame, words: int) -> DataFrame:
    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: len(shingles(t, words)))

    lost = pick(docs, "doc_id", "text").where("doc_id IS NULL")
    return lost.select(F.lit(None).cast("long").alias("doc_id"), count(whole_text()).alias("n_shingles"), F.lit(None).cast("long").alias("component_id"))


def class_pairs(docs: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """a, b: all linked pairs of different classes by their digests, each pair once. With the classes' members these are all links."""
    return _prepared(docs, percent, words, pairs=True)[1]


def linked(docs: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """The rows of ``join`` and n_links: with how many other rows each is linked, exactly.

    Rows of equal sets are linked with each other. A row without words or doc_id has no links.
    """
    rows, classes = _prepared(docs, percent, words)
    known = classes.select(F.col("rep").alias("__r"), "top", (F.col("copies") - 1 + F.col("others")).alias("n_links"))
    with_id = rows.join(known, F.col("rep").eqNullSafe(F.col("__r")), "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("top", "doc_id").alias("component_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")
    )
    return with_id.unionByName(_nameless(docs, words).withColumn("n_links", F.lit(0).cast("long")))


def join(docs: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles and component_id of every row.

    A null or wordless text has the empty set and is its own component. Rows with equal ids count as documents of their
    own with one name: links of any of them hold for the id. A null doc_id gives a row with a null component that is linked with
    nothing. Other columns are left out. An empty table gives no rows.
    """
    rows, classes = _prepared(docs, percent, words)
    known = classes.select(F.col("rep").alias("__r"), "top")
    out = rows.join(known, F.col("rep").eqNullSafe(F.col("__r")), "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("top", "doc_id").alias("component_id")
    )
    return out.unionByName(_nameless(docs, words))


def op2_ngram_join(spark, sf_dir: str) -> DataFrame:
    return linked(spark.read.parquet(f"{sf_dir}/documents.parquet"))
