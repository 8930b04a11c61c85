"""Byte-level BPE encoding and decoding by ranks, on padded numpy matrices.

A text is cut by the tokenizer's pattern; each distinct piece of a batch is encoded once. Pieces are grouped by length
into matrices with one row per piece, padded on the right. In every round each row merges its leftmost pair of the
smallest rank, looked up in an open-addressing hash table of pairs, and the row is closed up by one; a row
without a pair in the table is finished and leaves the matrix. Pieces beyond ``WIDE`` bytes, where a round per
merge would cost the square of the length, follow the same rule with a heap of pairs.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimlathe.llm.common import pick, whole_text

VOCABULARY = "byte_bpe_50k.tiktoken"
WIDE = 256
#: Encoded pieces that a task remembers, and bytes of longest one it does.
REMEMBERED, REMEMBERED_BYTES = 100_000, 64
#: Code points of texts that are taken together, about.
CHUNK = 1_000_000
#: The tokenizer's pattern as it reads on ASCII text, where the faster standard engine can take it.
ASCII_PATTERN = r"'(?:[stmd]|re|ve|ll)| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"
_NONE = np.int64(1 << 40)


def read_ranks(path: str) -> list[bytes]:
    """Tokens by id. The file is a few hundred kB on every machine that has the tokenizer package."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    ranked = {int(rank): base64.b64decode(token) for token, rank in pairs}
    return [ranked[i] for i in range(len(ranked))]


class PairTable:
    """(left id, right id) -> id of their concatenation, as a hash table in arrays."""

    def __init__(self, tokens: list[bytes]):
        ids = {t: i for i, t in enumerate(tokens)}
        keys, values = [], []
        for i, token in enumerate(tokens):
            for cut in range(1, len(token)):
                left, right = ids.get(token[:cut]), ids.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 20 | right)
                    values.append(i)
        self.bits = max(4, (2 * len(keys)).bit_length() + 1)
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, _NONE, np.int64)
        todo, value = np.array(keys, np.int64), np.array(values, np.int64)
        slot = self._slot(todo)
        while len(todo):
            free = self.keys[slot] == -1
            first = np.unique(slot[free], return_index=True)[1]
            put = np.flatnonzero(free)[first]
            self.keys[slot[put]], self.values[slot[put]] = todo[put], value[put]
            rest = np.ones(len(todo), bool)
            rest[put] = False
            todo, value, slot = todo[rest], value[rest], slot[rest]
            taken = self.keys[slot] != -1
            slot = np.where(taken, slot + 1 & (1 << self.bits) - 1, slot)
        self.exact = dict(zip(keys, values, strict=True))

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs, ``_NONE`` where a pair is not in the table or an id is padding (-1)."""
        keys = left << 20 | right
        keys[(left < 0) | (right < 0)] = -2
        flat = keys.ravel()
        out = np.full(len(flat), _NONE, np.int64)
        todo = np.flatnonzero(flat != -2)
        slot = self._slot(flat[todo])
        while len(todo):
            held = self.keys[slot]
            found = held == flat[todo]
            out[todo[found]] = self.values[slot[found]]
            more = ~found & (held != -1)
            todo, slot = todo[more], slot[more] + 1 & (1 << self.bits) - 1
        return out.reshape(keys.shape)


class Bpe:
    def __init__(self, path: str, pattern: str):
        self.tokens = read_ranks(path)
        ids = {t: i for i, t in enumerate(self.tokens)}
        self.bytes = np.array([ids[bytes([b])] for b in range(256)], np.int64)
        self.pairs = PairTable(self.tokens)
        self.find = regex.compile(pattern).findall
        self.find_ascii = re.compile(ASCII_PATTERN).findall if pattern == public_tokenizers.PATTERN else self.find
        self.known: dict[str, tuple[int, str, bytes]] = {}

    def cut(self, text: str) -> list[str]:
        return self.find_ascii(text) if text.isascii() else self.find(text)

    def matrix(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of pieces of similar length."""
        lengths = np.array([len(p) for p in pieces])
        rows = np.full((len(pieces), lengths.max()), -1, np.int64)
        inside = np.arange(rows.shape[1]) < lengths[:, None]
        rows[inside] = self.bytes[np.frombuffer(b"".join(pieces), np.uint8)]
        out: list[list[int]] = [[]] * len(pieces)
        at = np.arange(len(pieces))
        ranks = self.pairs.ranks(rows[:, :-1], rows[:, 1:])
        while len(at):
            place = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(at), np.int64)
            best = ranks[np.arange(len(at)), place] if ranks.shape[1] else np.full(len(at), _NONE)
            merging = best < _NONE
            for i in np.flatnonzero(~merging):
                out[at[i]] = [x for x in rows[i].tolist() if x >= 0]
            at, rows, ranks, place, best = at[merging], rows[merging], ranks[merging], place[merging], best[merging]
            if not len(at):
                break
            # Close up: what lies behind the pair moves one to the left.
            here = np.arange(len(at))
            rows[here, place] = best
            behind = np.arange(rows.shape[1] - 1) > place[:, None]
            rows[:, :-1] = np.where(behind, rows[:, 1:], rows[:, :-1])
            rows = rows[:, :-1]
            width = rows.shape[1]
            if width < 2:
                ranks = ranks[:, :0]
                continue
            behind = np.arange(width - 1) > place[:, None]
            ranks = np.where(behind, ranks[:, 1:], ranks[:, :-1])
            left = np.maximum(place - 1, 0)
            right = np.minimum(place, width - 2)
            fresh_left = self.pairs.ranks(rows[here, left], rows[here, left + 1])
            fresh_right = self.pairs.ranks(rows[here, right], rows[here, right + 1])
            ranks[here, left] = fresh_left
            ranks[here, right] = fresh_right
        return out

    def long(self, piece: bytes) -> list[int]:
        """Ids of one long piece: the same rule, with the pairs in a heap by rank and place."""
        ids = self.bytes[np.frombuffer(piece, np.uint8)].tolist()
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        exact, end = self.pairs.exact, len(ids)

        def pair(i: int) -> None:
            j = after[i]
            if j < end and (rank := exact.get(ids[i] << 20 | ids[j])) is not None:
                heapq.heappush(heap, (rank, i, ids[i], ids[j]))

        heap: list[tuple[int, int, int, int]] = []
        for i in range(end - 1):
            pair(i)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= end or ids[j] != b:
                continue
            ids[i], ids[j] = rank, -1
            after[i] = after[j]
            if after[j] < end:
                before[after[j]] = i
            pair(i)
            if before[i] >= 0:
                pair(before[i])
        return [x for x in ids if x >= 0]

    def encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        out: list[list[int]] = [[]] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            if len(piece) > WIDE:
                out[i] = self.long(piece)
            elif piece:
                buckets.setdefault((len(piece) + 1) // 2 if len(piece) < 32 else (len(piece) + 79) // 16, []).append(i)
        for group in buckets.values():
            for k in range(0, len(group), 8192):
                some = group[k : k + 8192]
                for i, ids in zip(some, self.matrix([pieces[i] for i in some]), strict=True):
                    out[i] = ids
        return out

    def learn(self, texts: list[list[str]]) -> dict[str, tuple[int, str, bytes]]:
        """Of each distinct piece of cut texts that is not known yet: the count of ids, the ids as text, and the bytes
        that decoding the ids gives."""
        fresh = list(set().union(*texts).difference(self.known))
        found = {}
        for piece, ids in zip(fresh, self.encode_pieces([p.encode() for p in fresh]), strict=True):
            entry = (len(ids), " ".join(map(str, ids)), self.decode(ids))
            if len(piece) <= REMEMBERED_BYTES and len(self.known) < REMEMBERED:
                self.known[piece] = entry
            else:
                found[piece] = entry
        return found

    def forget(self) -> None:
        """Workers stay alive for other tasks and other steps, so what a task has learned goes with it."""
        self.known = {}

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.tokens[i] for i in ids])


_LOADED: dict[tuple[str, str], Bpe] = {}


def loaded(path: str, pattern: str) -> Bpe:
    """One tokenizer per worker process."""
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = Bpe(path, pattern)
    return _LOADED[path, pattern]


def encode_texts(bpe: Bpe, texts: list[str]) -> Iterator[tuple[int, str, bytes]]:
    """Of each text the number of ids, the ids joined by single spaces, and the bytes decoded from them."""
    cut = [bpe.cut(text) for text in texts]
    extra = bpe.learn(cut)
    known = bpe.known
    for pieces in cut:
        entries = [known.get(p) or extra[p] for p in pieces] if extra else [known[p] for p in pieces]
        counts, ids, data = zip(*entries, strict=True) if entries else ((), (), ())
        yield sum(counts), " ".join(ids), b"".join(data)


def encode(
    docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN, keep_ids: bool = True
) -> DataFrame:
    """doc_id, n_tokens, ids (array of int; with ``keep_ids``), ids_sha256 and decoded_sha256 of each row's whole text.

    The decoded bytes come from the ids. A null text counts as empty and has no ids. Rows stay rows, repeated ones
    too; other columns are left out. No shuffle.
    """
    path = path or public_tokenizers.path(VOCABULARY)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = loaded(path, pattern)
        try:
            for batch in batches:
                # Texts are taken together up to CHUNK code points, so that distinct pieces are many and memory is bounded.
                chunk = batch["text"].str.len().cumsum() // CHUNK
                for _, some in batch.groupby(chunk):
                    yield told(bpe, some)
        finally:
            bpe.forget()

    def told(bpe: Bpe, some: pd.DataFrame) -> pd.DataFrame:
        counts, lists, digests = [], [], []
        for count, joined, decoded in encode_texts(bpe, some["text"].tolist()):
            counts.append(count)
            digests.append((hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(decoded).hexdigest()))
            if keep_ids:
                lists.append(np.array(joined.split(), np.int32))
        out = pd.DataFrame({"doc_id": some["doc_id"].array, "n_tokens": counts})
        if keep_ids:
            out["ids"] = pd.Series(lists, out.index, object)
        out["ids_sha256"], out["decoded_sha256"] = zip(*digests, strict=True)
        return out

    read = pick(docs, "doc_id", "text").withColumn("text", whole_text())
    kind = read.schema["doc_id"].dataType.simpleString()
    ids = "ids array<int>, " if keep_ids else ""
    return read.mapInPandas(work, f"doc_id {kind}, n_tokens long, {ids}ids_sha256 string, decoded_sha256 string")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and the bytes of ``ids``."""
    path = path or public_tokenizers.path(VOCABULARY)

    @F.pandas_udf("binary")
    def unpack(ids: pd.Series) -> pd.Series:
        bpe = loaded(path, public_tokenizers.PATTERN)
        return ids.map(lambda x: bpe.decode([] if x is None else list(x)))

    return encoded.select("doc_id", unpack("ids").alias("data"))


def op7_byte_bpe(spark, sf_dir: str) -> DataFrame:
    return encode(spark.read.parquet(f"{sf_dir}/documents.parquet"), keep_ids=False)
