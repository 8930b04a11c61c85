"""Reproducible shuffle into shards by a keyed permutation of global row numbers.

A Feistel network over the smallest even number of bits that holds the row count, walked along its cycle until it
lands below the count, is a permutation of 0..n-1 (cycle walking). Row r goes to place p(r): shard p mod k and slot
p div k. Any place can be computed, in both directions, from r, n and the seed, without a table.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimlathe.llm.common import pick
from dimlathe.operators.keys import dense_key

ROUNDS = 6
SHARDS = 24


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    """A 64-bit finaliser (multiply and shift)."""
    x = (x + np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _keys(seed: int) -> list[int]:
    return [int(k) for k in _mix(np.arange(1, ROUNDS + 1, dtype=np.uint64), seed & (2**63 - 1))]


def _half_bits(count: int) -> int:
    return max(1, (max(count - 1, 1).bit_length() + 1) // 2)


def permute(rows: np.ndarray, count: int, seed: int, inverse: bool = False) -> np.ndarray:
    """Places of row numbers in 0..count-1, or with ``inverse`` the row numbers at places."""
    half = np.uint64(_half_bits(count))
    low = np.uint64((1 << int(half)) - 1)
    keys = _keys(seed)

    def network(x: np.ndarray) -> np.ndarray:
        left, right = x >> half, x & low
        for key in reversed(keys) if inverse else keys:
            if inverse:
                left, right = right ^ (_mix(left, key) & low), left
            else:
                left, right = right, left ^ (_mix(right, key) & low)
        return left << half | right

    out = network(rows.astype(np.uint64))
    while len(outside := np.flatnonzero(out >= np.uint64(count))):
        out[outside] = network(out[outside])
    return out.astype(np.int64)


def shard(numbered: DataFrame, count: int, shards: int = SHARDS, seed: int = 1, row: str = "row") -> DataFrame:
    """Adds ``shard`` and ``slot`` to rows numbered 0..count-1 in the column ``row``.

    Shard sizes differ by one at most, and slots have no gaps. An empty table gives an empty result. No shuffle.
    """

    @F.pandas_udf("long")
    def place(rows: pd.Series) -> pd.Series:
        return pd.Series(permute(rows.to_numpy(), count, seed))

    placed = numbered.withColumn("__place", place(F.col(row)))
    return placed.select(
        *(F.col(f"`{c}`") for c in numbered.columns if c not in ("shard", "slot")),
        (F.col("__place") % shards).cast("int").alias("shard"),
        F.expr(f"__place div {shards}").alias("slot"),
    )


def number(docs: DataFrame) -> tuple[DataFrame, int]:
    """Narrow rows (doc_id, size, text_crc32) with global numbers ``row`` from 0 in the order of these columns, nulls
    last, and their count. Rows equal in all three are interchangeable. Texts stay where they are: only 20 bytes a row
    are range-partitioned, and the numbering is fixed by writing it to the shared folder.
    """
    narrow = pick(docs, "doc_id", "text").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    numbered = dense_key(narrow, "row", ["doc_id", "size", "text_crc32"], start=-1)
    return numbered, numbered.count()


def op10_sharding(spark, sf_dir: str) -> DataFrame:
    """The law is ``rows``: shard counts are at most one apart."""
    numbered, count = number(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    placed = shard(numbered, count)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "row",
    )
