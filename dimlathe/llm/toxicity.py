"""Toxicity by a subsequence string-kernel support vector machine with Nyström landmarks.

*Kernel.* Two strings are as alike as the subsequences of ``ORDER`` letters that they share; each occurrence weighs
``DECAY`` to the power of the places it spans, gaps included. The kernel is normalised. An insult with a letter put in or with a stem's
other ending keeps most of its subsequences, so it stays near its landmark.

*Units.* A text's units are its lower-cased words without punctuation (``i.d.i.o.t`` is ``idiot``), and runs of single letters
joined (``i d i o t``); longer ones than ``WIDE`` are cut into windows that overlap by half. All units of whole texts count.

*Learning.* Labels belong to documents, and a document's sentences inherit them. A sentence is an example by its most suspicious unit,
its *witness*; a toxic document's sentences count only where that is suspicious, since most of them are harmless. Suspicion is first a
lower bound of the log odds of units in toxic and clean sentences, then the machine's own decision. Landmarks are
units of both kinds that are unlike each other. Nyström features are the kernels with the landmarks times
the inverse root of the kernels among them; a squared-hinge machine is trained on them by Newton's method.
Witnesses also stand with one letter put in. A text's decision is that of its most suspicious unit,
turned into a score by a logistic curve fitted on the learning documents.

*Scoring.* A decision is linear in the landmarks' kernels, hence in the subsequences: they are folded into one weight per
subsequence, so a unit costs one table look-up for each of its subsequences and its own norm, however many landmarks there are.

Learning reads at most ``LABELLED`` labelled rows, those with the smallest sha256 of their id, and never rows held out. What reaches
the driver is bounded by ``UNITS`` and ``LABELLED``. With fewer than two classes among them, every text gets the share of label 1 (0 without rows).

Rows. Null and empty texts have no unit and score as a text without suspicion. A null doc_id counts as empty text. Repeated
rows are scored alike. Labels without document or class teach nothing. Other columns are never read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimlathe.llm.common import pick, table, whole_text
from dimlathe.session import materialize

ORDER, DECAY = 3, 0.8
#: Code points of a unit's windows.
WIDE = 24
#: Labelled rows to learn from, units of either kind in a round of training, landmarks of either kind, their letters.
LABELLED, UNITS, LANDMARKS, LETTERS = 12_000, 3_000, 48, 95
#: Log odds above which a unit is suspected, and how many standard errors are taken off first.
SUSPECT, ERRORS = 1.5, 1.64
#: Rounds in which the machine chooses its own witnesses.
ROUNDS = 1
#: Cost of a wrong example; each class's examples share it equally.
COST = 200.0

_NOISE = re.compile(r"[^\w\s]+|_+")
_SPACED = re.compile(r"(?<!\S)\w(?:\s\w){2,}(?!\S)")
_SENTENCE = re.compile(r"[.!?\n]+")


def units(text: str) -> set[str]:
    """The units of a text, each once."""
    plain = _NOISE.sub("", text.lower())
    found = set(plain.split())
    found.update("".join(run.split()) for run in _SPACED.findall(plain))
    for long in [u for u in found if len(u) > WIDE]:
        found.remove(long)
        found.update(long[at : at + WIDE] for at in range(0, len(long) - WIDE // 2, WIDE // 2))
    return found


def by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the words of each length and their code points as a matrix."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(lengths, kind="stable")
    for n, first, count in zip(*np.unique(lengths[order], return_index=True, return_counts=True), strict=True):
        at = order[first : first + count]
        if n:
            yield at, np.array([words[i] for i in at], f"U{n}").view(np.uint32).reshape(count, n)


@lru_cache(maxsize=None)
def before(n: int) -> np.ndarray:
    """Decay from each place to the places behind it."""
    gap = np.arange(n)[:, None] - np.arange(n)[None, :] - 1
    return np.where(gap >= 0, DECAY ** np.maximum(gap, 0), 0.0)


def aligned(same: np.ndarray) -> np.ndarray:
    """Kernels of stacks of pairs, given which letters are the same."""
    match = same * DECAY**2
    ends = match
    for _ in range(ORDER - 1):
        ends = match * (before(same.shape[-2]) @ ends @ before(same.shape[-1]).T)
    return ends.sum((-2, -1))


def norms(codes: np.ndarray) -> np.ndarray:
    """Roots of the kernels of equally long strings with themselves."""
    step = max(1, 2_000_000 // codes.shape[1] ** 2)
    parts = [codes[at : at + step] for at in range(0, len(codes), step)]
    return np.sqrt(np.concatenate([aligned(p[:, :, None] == p[:, None, :]) for p in parts]))


@lru_cache(maxsize=None)
def places(n: int) -> tuple[np.ndarray, ...]:
    """All triples of places of a string, and their weights."""
    i, j, k = (np.array(x, np.intp) for x in zip(*((i, j, k) for i in range(n) for j in range(i + 1, n) for k in range(j + 1, n)), strict=True))
    return i, j, k, DECAY ** (k - i + 1.0)


def numbers(letters: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Places of letters in a sorted alphabet, from 1; 0 is any other letter."""
    found = np.minimum(np.searchsorted(letters, codes), len(letters) - 1)
    return np.where(letters[found] == codes, found + 1, 0)


def subsequences(letters: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Number of each subsequence of equally long strings, in the order of ``places``."""
    i, j, k, _ = places(codes.shape[1])
    number, base = numbers(letters, codes), len(letters) + 1
    return (number[:, i] * base + number[:, j]) * base + number[:, k]


class Landmarks:
    """Strings whose kernels with others are looked up by subsequence."""

    def __init__(self, words: list[str]):
        seen = sorted({c for z in words for c in z}, key=lambda c: (-sum(c in z for z in words), c))
        self.words, self.letters = words, np.array(sorted(map(ord, seen[:LETTERS])), np.uint32)
        base = len(self.letters) + 1
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for at, codes in by_length(words):
            if codes.shape[1] < ORDER:
                continue
            weight, (i, j, k, _), number = places(codes.shape[1])[3], places(codes.shape[1]), numbers(self.letters, codes)
            known = (number[:, i] > 0) & (number[:, j] > 0) & (number[:, k] > 0)
            share = weight[None, :] / norms(codes)[:, None]
            held.append((subsequences(self.letters, codes)[known], np.broadcast_to(at[:, None], known.shape)[known], share[known]))
        keys, which, share = (np.concatenate(x) for x in zip(*held, strict=True))
        known, row = np.unique(keys, return_inverse=True)
        self.rows = np.zeros((len(known) + 1, len(words)))
        np.add.at(self.rows, (row + 1, which), share)
        self.slot = np.zeros(base**3, np.int32)
        self.slot[known] = np.arange(1, len(known) + 1)

    def kernels(self, words: list[str]) -> np.ndarray:
        """Normalised kernels of words with the landmarks; 0 for words shorter than ``ORDER``."""
        out = np.zeros((len(words), len(self.words)))
        for at, codes in by_length(words):
            if codes.shape[1] >= ORDER:
                slots, raw = self.slot[subsequences(self.letters, codes)], np.zeros((len(at), len(self.words)))
                for column, weight in zip(slots.T, places(codes.shape[1])[3], strict=True):
                    raw += weight * self.rows[column]
                out[at] = raw / norms(codes)[:, None]
        return out

    def machine(self, beta: np.ndarray, bias: float) -> Machine:
        """The machine whose decision is ``beta`` times the kernels, plus ``bias``."""
        return Machine(self.letters, (self.rows @ beta)[self.slot], bias)


@dataclass(frozen=True)
class Machine:
    """Weights of subsequences, folded from the landmarks. ``letters`` holds their alphabet, sorted."""

    letters: np.ndarray
    weights: np.ndarray
    bias: float

    def decisions(self, words: list[str]) -> np.ndarray:
        out = np.full(len(words), self.bias)
        for at, codes in by_length(words):
            n = codes.shape[1]
            if n < ORDER:
                continue
            weight = places(n)[3]
            step = max(1, 1_000_000 // len(weight))
            for first in range(0, len(at), step):
                part = codes[first : first + step]
                raw = self.weights[subsequences(self.letters, part)] @ weight
                out[at[first : first + step]] += raw / norms(part)
        return out


def train(examples: list[tuple[str, int, float]], landmarks: list[str]) -> Machine:
    """A squared-hinge machine on Nyström features of (unit, label, weight) examples."""
    held = Landmarks(landmarks)
    among = held.kernels(landmarks)
    values, vectors = np.linalg.eigh(among)
    large = values > 1e-6
    root = vectors[:, large] / np.sqrt(values[large])
    x = held.kernels([e[0] for e in examples]) @ root
    x = np.hstack([x, np.ones((len(x), 1))])
    y = np.array([1.0 if e[1] else -1.0 for e in examples])
    cost = np.array([e[2] for e in examples], float)
    for side in (y > 0, y < 0):
        cost[side] *= COST / cost[side].sum()
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    w, active = np.zeros(x.shape[1]), np.ones(len(y), bool)
    for _ in range(50):
        part = x[active] * cost[active][:, None]
        w = np.linalg.solve(ridge + part.T @ x[active], part.T @ y[active])
        now = y * (x @ w) < 1
        if (now == active).all():
            break
        active = now
    return held.machine(root @ w[:-1], float(w[-1]))


def unlike(candidates: list[str], most: int, limit: float = 0.5) -> list[str]:
    """The first candidates that are not too like an earlier choice."""
    chosen: list[str] = []
    for word in candidates:
        if len(chosen) == most:
            break
        if len(word) >= ORDER and (not chosen or Landmarks(chosen).kernels([word]).max() < limit):
            chosen.append(word)
    return chosen


def put_in(word: str) -> list[str]:
    """The word with one letter put in, at every inner place: a far one and a doubled one."""
    return [word[:i] + c + word[i:] for i in range(1, len(word)) for c in ("x", word[i - 1])]


def sample(docs: DataFrame, labels: DataFrame, labelled: int) -> DataFrame:
    """(label, text) of at most ``labelled`` labelled rows that are not held out."""
    known = (
        pick(labels, "doc_id", "toxic")
        .where("doc_id IS NOT NULL AND toxic IN (0, 1)")
        .where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
        .orderBy(F.sha2(F.col("doc_id").cast("string"), 256), "toxic")
        .limit(labelled)
        .select(F.col("doc_id").alias("__id"), F.col("toxic").cast("int").alias("label"))
    )
    whole = pick(docs, "doc_id", "text").select("doc_id", whole_text().alias("text"))
    # At most `labelled` pairs of numbers.
    return whole.join(F.broadcast(known), F.col("doc_id") == F.col("__id")).select("label", "text")


def sentence_units(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(label, unit) of each sentence, each unit once."""
    for batch in batches:
        rows = [
            (label, unit)
            for label, text in zip(batch["label"], batch["text"], strict=True)
            for sentence in _SENTENCE.split(text)
            for unit in units(sentence)
        ]
        yield pd.DataFrame(rows, columns=["label", "unit"])


def witnesses(judge):
    """(label, unit, suspicion): every sentence with a unit, by its most suspicious one."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            held = [
                (label, [sorted(u) for u in map(units, _SENTENCE.split(text)) if u])
                for label, text in zip(batch["label"], batch["text"], strict=True)
            ]
            words = list({u for _, sentences in held for s in sentences for u in s})
            value = dict(zip(words, judge(words), strict=True))
            rows = []
            for label, sentences in held:
                tops = [max(s, key=lambda u: (value[u], u)) for s in sentences]
                rows += [(label, u, float(value[u])) for u in tops]
            yield pd.DataFrame(rows, columns=["label", "unit", "suspicion"])

    return run


def examples(learning: DataFrame, judge, floor: float, prior: float) -> list[tuple[str, int, float]]:
    """Witnesses of toxic sentences at or above ``floor``, unless clean sentences have them too, and of clean sentences:
    the most suspicious ones and others by hash. ``prior`` is the log odds of a toxic sentence."""
    found = learning.mapInPandas(witnesses(judge), "label int, unit string, suspicion double")
    toxic_n, clean_n = F.sum("label"), F.sum(1 - F.col("label"))
    counted = materialize(
        found.groupBy("unit").agg(toxic_n.alias("toxic"), clean_n.alias("clean"), F.max("suspicion").alias("s")), "toxicity-witnesses"
    )
    odds = F.log((F.col("toxic") + 0.5) / (F.col("clean") + 0.5)) - prior
    toxic = counted.where((F.col("toxic") > 0) & (F.col("s") >= floor) & (odds >= SUSPECT))
    toxic = toxic.select("unit", F.col("toxic").alias("n")).orderBy(F.desc("n"), "unit").limit(UNITS).collect()
    clean = counted.where("clean > 0").select("unit", F.col("clean").alias("n"), "s")
    hard = clean.orderBy(F.desc("s"), "unit").limit(UNITS).collect()
    other = clean.orderBy(F.sha2("unit", 256)).limit(UNITS).collect()
    made = {(r["unit"], 0): float(r["n"]) for r in (*hard, *other)} | {(r["unit"], 1): float(r["n"]) for r in toxic}
    for r in toxic:
        inside = put_in(r["unit"])
        for word in inside:
            made[(word, 1)] = made.get((word, 1), 0.0) + 0.5 * r["n"] / len(inside)
    return [(unit, label, n) for (unit, label), n in sorted(made.items())]


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by Newton's method with a little ridge."""
    a = np.stack([x, np.ones(len(x))], 1)
    w = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + 1e-2 * np.eye(2), a.T @ (p - y) + 1e-2 * w)
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def strongest(machine: Machine, texts) -> np.ndarray:
    """Each text's largest decision; the bias for a text without units."""
    number: dict[str, int] = {}
    held = [np.fromiter((number.setdefault(u, len(number)) for u in units(t)), np.int64) for t in texts]
    value = machine.decisions(list(number))
    return np.array([max(value[h].max(initial=-np.inf), machine.bias) if len(h) else machine.bias for h in held], float)


@dataclass(frozen=True)
class Model:
    """A machine and the curve from decisions to scores; without a machine, one score for all."""

    machine: Machine | None
    slope: float = 0.0
    offset: float = 0.0
    share: float = 0.0
    landmarks: tuple[str, ...] = ()

    def scores(self, texts) -> np.ndarray:
        if self.machine is None:
            return np.full(len(texts), self.share)
        z = self.slope * strongest(self.machine, texts) + self.offset
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def learn(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> Model:
    """The model of the labelled rows that are not held out."""
    learning = materialize(sample(docs, labels, labelled), "toxicity-learning")
    size = {r["label"]: r["count"] for r in learning.groupBy("label").count().collect()}
    if len(size) < 2:
        return Model(None, share=float(size.get(1, 0) > 0))
    counts = learning.mapInPandas(sentence_units, "label int, unit string").groupBy("unit").agg(
        F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean")
    )
    totals = learning.mapInPandas(
        lambda batches: (pd.DataFrame({"label": b["label"], "n": b["text"].map(lambda t: len(_SENTENCE.split(t)))}) for b in batches),
        "label int, n long",
    ).groupBy("label").agg(F.sum("n").alias("n"))
    whole = {r["label"]: r["n"] for r in totals.collect()}
    prior = math.log(whole[1] / whole[0])
    odds = F.log((F.col("toxic") + 0.5) / (F.col("clean") + 0.5)) - prior
    error = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    rated = counts.select("unit", "toxic", (odds - ERRORS * error).alias("odds")).where(F.col("odds") >= SUSPECT)
    suspects = rated.orderBy(F.desc(F.col("toxic") * F.col("odds")), "unit").limit(UNITS).collect()
    common = counts.where("clean > toxic").orderBy(F.desc("clean"), "unit").limit(UNITS).collect()
    toxic_marks = unlike([r["unit"] for r in suspects], LANDMARKS)
    landmarks = toxic_marks + unlike([r["unit"] for r in common if r["unit"] not in toxic_marks], LANDMARKS)
    if not toxic_marks:
        return Model(None, share=size[1] / sum(size.values()))
    first = {r["unit"]: r["odds"] for r in suspects}
    found = examples(learning, lambda words: [first.get(u, 0.0) for u in words], SUSPECT, prior)
    machine = train(found, landmarks)
    for _ in range(ROUNDS):
        found = examples(learning, machine.decisions, 0.0, prior)
        machine = train(found, landmarks)

    def judged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"label": batch["label"], "d": strongest(machine, batch["text"])})

    # One pair of numbers per learning row.
    pairs = learning.mapInPandas(judged, "label int, d double").toPandas()
    slope, offset = logistic(pairs["d"].to_numpy(float), pairs["label"].to_numpy(float))
    return Model(machine, slope, offset, landmarks=tuple(landmarks))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted for every row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": model.scores(batch["text"])})

    scored = pick(docs, "doc_id", "text").select("doc_id", whole_text().alias("text"))
    typed = docs.select(F.col("doc_id").cast("long").alias("doc_id")).schema
    rows = scored.mapInPandas(run, typed.add("score", "double"))
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0
    return rows.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op13_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text, learnt from labelled rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return score(docs, learn(docs, table(spark, sf_dir, "labels")))
