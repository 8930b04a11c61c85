"""Centroid clustering with heap-ordered bounds: exact rounds that rescan only vectors whose bound has run out.

A vector scanned against all centroids leaves a *gap*: the distance to its second nearest centroid less the distance
to its own. In a round, the gap of a vector of cluster c shrinks by at most the drift of c plus the largest drift of
any other centroid. Each cluster adds up that number, and a vector is pushed on its cluster's heap with its gap plus
the sum at that time. So one comparison with the heap's smallest key tells whether any vector of the cluster can have
a new nearest centroid: while keys do not exceed the sum, they are popped, rescanned exactly in integers and pushed
again. A vector that stays on the heap is nearer to its own centroid than to any other, ties included.

Vectors lie in blocks of at most ``BLOCK``. The blocks are written once, bucketed by block number; a round's heaps
and owners are a narrow table with the same buckets, so a round joins both without a shuffle and writes only heaps.
What vectors change cluster moves sums and counts by exact integers; ``k * (dims + 1)`` sums reach the driver.

Rows. A vector is left out if it is null, has another number of components than ``dims``, or a null or non-finite
component. Components beyond ``LARGEST`` in size count as ``LARGEST``, so squared distances fit 64 bits; inertias
beyond 64 bits count as the largest long. Repeated ids are vectors of their own. A null id is kept and comes last for the
first centroids; ties there are settled by the components. Fewer vectors than ``k`` give fewer centroids, none give no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimlathe.llm.common import parts_for, pick, table
from dimlathe.session import file_system, materialize, scratch_path

BLOCK = 2048
LARGEST = 2**27
#: Vectors in a bucket, and the number of buckets that Spark takes at most.
BUCKET, MOST_BUCKETS = 262_144, 100_000
#: Distances are rounded; gaps are made smaller and drifts larger by this share, so that rounding never hides a rescan.
SLACK = 1e-9
MOST = 2**63 - 1

BLOCKS = "block long, n int, ids array<long>, x binary"
HEAPS = "block long, owners binary, keys binary, items binary, sizes binary, moved array<long>"
OWNED = "vec_id long, cluster int, distance long"


def integers(vectors: DataFrame, dims: int, scale: int, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, v): kept vectors as integers floor(scale * x)."""
    x = F.col("x").cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    most = float(LARGEST)
    whole = F.transform(x, lambda c: F.floor(F.greatest(F.least(c * scale, F.lit(most)), F.lit(-most))).cast("long"))
    return (
        pick(vectors, vec_id, embedding)
        .toDF("vec_id", "x")
        .where((F.size("x") == dims) & F.coalesce(finite, F.lit(False)))
        .select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v"))
    )


def first_centroids(kept: DataFrame, k: int, salt: int) -> list[list[int]]:
    """The ``k`` vectors whose ids have the smallest sha256, in that order."""
    order = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    return [r["v"] for r in kept.orderBy(order.asc_nulls_last(), "v").limit(k).collect()]


def pack(dims: int):
    """Batches of vectors as blocks: ids and one matrix, 16 bits a component where that is enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 33
        for batch in batches:
            ids, v = batch.column("vec_id"), batch.column("v")
            x = np.asarray(v.flatten()).reshape(-1, dims)
            for at in range(0, len(x), BLOCK):
                part = x[at : at + BLOCK]
                kind = np.int16 if np.abs(part).max(initial=0) < 2**15 else np.int32
                yield pa.record_batch(
                    [
                        pa.array([block]),
                        pa.array([len(part)], pa.int32()),
                        pa.array([ids.slice(at, len(part)).to_pylist()], pa.list_(pa.int64())),
                        pa.array([part.astype(kind).tobytes()], pa.binary()),
                    ],
                    names=["block", "n", "ids", "x"],
                )
                block += 1

    return run


def matrix(x: bytes, n: int, dims: int) -> np.ndarray:
    kind = np.int16 if len(x) == 2 * n * dims else np.int32
    return np.frombuffer(x, kind).reshape(n, dims).astype(np.int64)


def squared(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances, one row per vector."""
    return np.stack([((x - c) ** 2).sum(1) for c in centroids], 1)


def scan(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each vector (the smaller number on ties) and its gap, rounded down."""
    d = squared(x, centroids)
    owner = d.argmin(1).astype(np.int32)
    if len(centroids) == 1:
        return owner, np.full(len(x), np.inf)
    two = np.sqrt(np.partition(d, 1, axis=1)[:, :2].astype(np.float64))
    return owner, two[:, 1] - two[:, 0] - SLACK * (1 + two.sum(1))


def one_round(centroids: np.ndarray, drift: np.ndarray, first: bool):
    """Blocks with their heaps of the round before (none in the first) to their heaps after this one."""
    k, dims = centroids.shape

    def block(n, x, owners, keys, items, sizes):
        x = matrix(x, n, dims)
        moved = np.zeros((k, dims + 1), np.int64)

        def move(at, to, sign):
            for c in np.unique(to):
                these = at[to == c]
                moved[c, :dims] += sign * x[these].sum(0)
                moved[c, dims] += sign * len(these)

        if first:
            owner, gap = scan(x, centroids)
            heaps = [[] for _ in range(k)]
            for i, c in enumerate(owner.tolist()):
                heaps[c].append((gap[i] + drift[c], i))
            for heap in heaps:
                heapq.heapify(heap)
            move(np.arange(n), owner, 1)
        else:
            owner = np.frombuffer(owners, np.int32)
            ends = np.cumsum(np.frombuffer(sizes, np.int32))
            keys, items = np.frombuffer(keys), np.frombuffer(items, np.int32)
            spans = [(e - s, e) for s, e in zip(np.frombuffer(sizes, np.int32), ends, strict=True)]
            due = [c for c, (a, b) in enumerate(spans) if a < b and keys[a] <= drift[c]]
            if not due:
                return None
            heaps = [list(zip(keys[a:b].tolist(), items[a:b].tolist(), strict=True)) for a, b in spans]
            popped = []
            for c in due:
                while heaps[c] and heaps[c][0][0] <= drift[c]:
                    popped.append(heapq.heappop(heaps[c])[1])
            popped = np.array(popped, np.int64)
            new, gap = scan(x[popped], centroids)
            for i, c, g in zip(popped.tolist(), new.tolist(), gap.tolist(), strict=True):
                heapq.heappush(heaps[c], (g + drift[c], i))
            old = owner[popped]
            changed = old != new
            move(popped[changed], old[changed], -1)
            move(popped[changed], new[changed], 1)
            owner = owner.copy()
            owner[popped] = new
        flat = [entry for heap in heaps for entry in heap]
        return (
            owner.tobytes(),
            np.array([e[0] for e in flat], np.float64).tobytes(),
            np.array([e[1] for e in flat], np.int32).tobytes(),
            np.array([len(h) for h in heaps], np.int32).tobytes(),
            moved.ravel().tolist() if moved.any() else [],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                before = [row.get(name) for name in ("owners", "keys", "items", "sizes")]
                after = block(row["n"], row["x"], *before) or (*before, [])
                yield pa.record_batch(
                    [
                        pa.array([row["block"]]),
                        *(pa.array([part], pa.binary()) for part in after[:4]),
                        pa.array([after[4]], pa.list_(pa.int64())),
                    ],
                    names=["block", "owners", "keys", "items", "sizes", "moved"],
                )

    return run


def distances(centroids: np.ndarray):
    """Blocks and owners to one row per vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                x, owner = matrix(row["x"], row["n"], centroids.shape[1]), np.frombuffer(row["owners"], np.int32)
                yield pa.record_batch(
                    [
                        pa.array(row["ids"], pa.int64()),
                        pa.array(owner),
                        pa.array(((x - centroids[owner]) ** 2).sum(1)),
                    ],
                    names=["vec_id", "cluster", "distance"],
                )

    return run


class Bucketed:
    """Tables in the shared scratch folder, bucketed by block, so that joins on it need no shuffle."""

    def __init__(self, spark, buckets: int):
        self.spark, self.buckets, self.held = spark, buckets, {}

    def write(self, df: DataFrame) -> str:
        name, path = f"clusters_{uuid.uuid4().hex}", scratch_path(self.spark, "clusters")
        df.write.format("parquet").bucketBy(self.buckets, "block").option("path", path).saveAsTable(name)
        self.held[name] = path
        return name

    def drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE {name}")
        path, files = file_system(self.spark, self.held.pop(name))
        files.delete(path, True)


def cluster(
    vectors: DataFrame,
    k: int = 8,
    rounds: int = 10,
    salt: int = 3,
    dims: int = 64,
    scale: int = 1024,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> tuple[DataFrame, list[list[int]]]:
    """(vec_id, cluster, distance) per kept vector after ``rounds`` rounds and one more assignment, and the final
    centroids, in integers of 1 / ``scale``.

    The driver holds ``k * dims`` numbers and starts one job for each round. Rounds end early once no centroid moves, which
    changes nothing: every later round would give the same.
    """
    spark = vectors.sparkSession
    kept = integers(vectors, dims, scale, vec_id, embedding)
    centroids = first_centroids(kept, k, salt)
    if not centroids:
        return spark.createDataFrame([], OWNED), []
    k = len(centroids)
    buckets = min(MOST_BUCKETS, parts_for(spark, vectors.count(), BUCKET))
    store = Bucketed(spark, buckets)
    blocks = store.write(kept.mapInArrow(pack(dims), BLOCKS).repartition(buckets, "block"))
    sums, drift, heaps = [[0] * (dims + 1) for _ in range(k)], np.zeros(k), None
    for turn in range(rounds + 1):
        x = spark.table(blocks).drop("ids")
        # A shuffled hash join keeps the wide side streaming; with equal buckets nothing is shuffled.
        state = x if heaps is None else x.join(spark.table(heaps).drop("moved").hint("shuffle_hash"), "block")
        now = np.array(centroids, np.int64)
        after = store.write(state.mapInArrow(one_round(now, drift, heaps is None), HEAPS))
        if heaps:
            store.drop(heaps)
        heaps = after
        if turn == rounds:
            break
        moved = (
            spark.table(heaps)
            .select(F.posexplode("moved").alias("at", "by"))
            .groupBy("at")
            .agg(F.sum(F.col("by").cast("decimal(38,0)")).alias("by"))
        )
        for row in moved.collect():  # k * (dims + 1) sums at most
            sums[row["at"] // (dims + 1)][row["at"] % (dims + 1)] += int(row["by"])
        new = [[s // row[dims] for s in row[:dims]] if row[dims] else old for row, old in zip(sums, centroids, strict=True)]
        if new == centroids:
            break
        step = [sum((a - b) ** 2 for a, b in zip(p, q, strict=True)) ** 0.5 * (1 + SLACK) for p, q in zip(new, centroids, strict=True)]
        drift = drift + np.array([step[c] + max(step[:c] + step[c + 1 :], default=0.0) for c in range(k)])
        centroids = new
    owned = spark.table(blocks).join(spark.table(heaps).select("block", "owners").hint("shuffle_hash"), "block")
    rows = materialize(owned.mapInArrow(distances(np.array(centroids, np.int64)), OWNED), "clustered")
    for name in list(store.held):
        store.drop(name)
    return rows, centroids


def op11_centroid_clusters(spark, sf_dir: str) -> DataFrame:
    """Cluster, squared distance, inertias and the digest of the cluster's centroid for each kept vector."""
    rows, centroids = cluster(table(spark, sf_dir, "embeddings"))
    apart = {r["cluster"]: int(r["d"]) for r in rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    all_in = min(sum(apart.values()), MOST)
    held = [(c, min(d, MOST), all_in, digest[c]) for c, d in apart.items()]
    facts = spark.createDataFrame(held, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # One row per centroid.
    return rows.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def op11_sql(k: int = 8, rounds: int = 10, dims: int = 64) -> str:
    near = (
        "SELECT rid, any_value(v) AS v, any_value(vec_id) AS vec_id, min({{'d': d, 'cl': cl}}) AS best FROM (SELECT rid, vec_id, v, cl, "
        "CAST(list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d "
        "FROM kept CROSS JOIN c{0}) GROUP BY rid"
    )
    parts = [
        f"""kept AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id,
            list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
            WHERE len(embedding) = {dims} AND list_count(embedding) = {dims}
              AND len(list_filter(embedding, lambda x: isfinite(x))) = {dims})""",
        f"""c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY sha256('3:' || vec_id), v) - 1 AS INTEGER) AS cl, v AS c
            FROM kept ORDER BY sha256('3:' || vec_id), v LIMIT {k})""",
    ]
    for r in range(rounds):
        parts += [
            f"a{r} AS MATERIALIZED ({near.format(r)})",
            f"""s{r} AS (SELECT best.cl AS cl, i, CAST(sum(v[i]) AS BIGINT) AS s, count(*) AS n
                FROM a{r}, range(1, {dims + 1}) AS t(i) GROUP BY 1, 2)""",
            f"""c{r + 1} AS MATERIALIZED (SELECT c{r}.cl AS cl, coalesce(m.c, c{r}.c) AS c FROM c{r} LEFT JOIN
                (SELECT cl, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM s{r} GROUP BY cl) m ON m.cl = c{r}.cl)""",
        ]
    return (
        "WITH "
        + ",\n".join(parts)
        + f""", last AS MATERIALIZED ({near.format(rounds)})
        SELECT vec_id, best.cl AS cluster, best.d AS distance,
               CAST(sum(best.d) OVER (PARTITION BY best.cl) AS BIGINT) AS cluster_inertia,
               CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
               sha256(array_to_string(c, ',')) AS centroid_sha256
        FROM last JOIN c{rounds} ON c{rounds}.cl = best.cl"""
    )


OP11_SQL = op11_sql()
