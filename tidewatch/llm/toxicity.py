"""Toxicity: a factorization machine over hashed terms."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import stored

TRAIN_ROWS = 20_000
TERMS = 2_048
FACTORS = 4
SPACE = (1 << 30) - 1
LETTERS = re.compile(r"[^\W\d_]+")
CACHE = 400_000


def term_hashes(word: str) -> tuple[int, ...]:
    """The hashed terms of a word: itself and its beginnings, which inflected forms share."""
    ends = [word] + [f"{word[:n]}*" for n in (4, 5) if len(word) >= n]
    return tuple(zlib.crc32(x.encode()) & SPACE for x in ends)


def hashed_terms(text: str | None) -> set[int]:
    return {h for w in set(LETTERS.findall((text or "").lower())) for h in term_hashes(w)}


@dataclass
class Machine:
    """score = sigmoid(bias + sum of w + half of (sum of v)^2 - sum of v^2, per factor) over the terms present."""

    terms: list[int]
    bias: float
    w: np.ndarray
    v: np.ndarray

    def scores(self, starts: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Scores of rows given as concatenated positions in `terms`; starts has one more entry than there are rows."""
        row = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        raw = self.bias + np.bincount(row, self.w[ids], len(starts) - 1)
        for f in range(self.v.shape[1]):
            x = self.v[ids, f]
            raw += 0.5 * (np.bincount(row, x, len(starts) - 1) ** 2 - np.bincount(row, x * x, len(starts) - 1))
        return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


def fit_machine(rows: list[list[int]], labels: list[int], terms: list[int], factors: int = FACTORS, rounds: int = 200, rate: float = 0.05, decay: float = 1e-4, seed: int = 5) -> Machine:
    """Full-batch Adam on the log loss; `rows` are positions in `terms`."""
    n, y = len(rows), np.array(labels, float)
    ids = np.array([i for r in rows for i in r], np.int64)
    row = np.repeat(np.arange(n), [len(r) for r in rows])
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    dice = np.random.default_rng(seed)
    params = [np.array([np.log(share / (1 - share))]), np.zeros(len(terms)), dice.normal(0, 0.05, (len(terms), factors))]
    means, squares = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, rounds + 1):
        bias, w, v = params
        vx = v[ids]
        sums = np.stack([np.bincount(row, vx[:, f], n) for f in range(factors)], axis=1)
        raw = bias[0] + np.bincount(row, w[ids], n)
        raw += 0.5 * (sums**2).sum(1) - 0.5 * np.bincount(row, (vx**2).sum(1), n)
        error = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - y) / n
        each = error[row]
        pull = each[:, None] * (sums[row] - vx)
        slope = [
            np.array([error.sum()]),
            np.bincount(ids, each, len(terms)) + decay * w,
            np.stack([np.bincount(ids, pull[:, f], len(terms)) for f in range(factors)], axis=1) + decay * v,
        ]
        for i, g in enumerate(slope):
            means[i] = 0.9 * means[i] + 0.1 * g
            squares[i] = 0.999 * squares[i] + 0.001 * g * g
            params[i] = params[i] - rate * (means[i] / (1 - 0.9**step)) / (np.sqrt(squares[i] / (1 - 0.999**step)) + 1e-8)
    return Machine(terms, float(params[0][0]), params[1], params[2])


def _held_out(doc_id: str):
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", rows: int = TRAIN_ROWS, terms: int = TERMS) -> Machine | None:
    """A machine learnt from at most `rows` labelled documents outside the held-out quarter, picked by hash of the id.

    The `terms` hashed terms kept have the largest chi-square among those more
    frequent in toxic documents. None without labels of both kinds.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~_held_out(id_col))
    known = known.groupBy(F.col(id_col).alias("_id")).agg(F.max(F.col(label_col).cast("int")).alias("_toxic"))
    # Bounded by `rows`, so small enough to be sent to every task.
    known = stored(known.orderBy(F.xxhash64("_id"), "_id").limit(rows), "toxic-labels")
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")).join(F.broadcast(known), "_id")

    def terms_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                found = [sorted(hashed_terms(x.as_py())) for x in part.column("_text")]
                yield pa.RecordBatch.from_arrays([part.column("_toxic"), pa.array(found, pa.list_(pa.int64()))], names=["toxic", "terms"])

    hashed = stored(texts.select("_toxic", "_text").mapInArrow(terms_of, "toxic int, terms array<bigint>"), "toxic-terms")
    n, bad = hashed.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not bad or bad == n:
        return None
    counts = hashed.select("toxic", F.explode("terms").alias("term")).groupBy("term").agg(F.sum("toxic").alias("a"), F.count(F.lit(1)).alias("b"))
    lift = F.col("a") * float(n) - F.col("b") * float(bad)
    chi = lift * lift / (F.col("b") * (n - F.col("b")) + 1.0)
    best = counts.where((F.col("a") >= 3) & (lift > 0)).orderBy(chi.desc(), "term").limit(terms)
    chosen = sorted(r["term"] for r in best.select("term").collect())
    place = {t: i for i, t in enumerate(chosen)}
    wanted = F.array_intersect("terms", F.array(*[F.lit(t) for t in chosen])) if chosen else F.array().cast("array<bigint>")
    sample = sorted((r["toxic"], r["terms"]) for r in hashed.select("toxic", wanted.alias("terms")).collect())
    return fit_machine([[place[t] for t in terms] for _, terms in sample], [toxic for toxic, _ in sample], chosen)


class Scorer:
    """Scores batches of texts inside a task; words it has met are kept, up to CACHE of them."""

    def __init__(self, machine: Machine | None):
        self.machine = machine
        self.place = {t: i for i, t in enumerate(machine.terms)} if machine else {}
        self.known: dict[str, tuple[int, ...]] = {}

    def terms(self, text: str | None) -> list[int]:
        found: set[int] = set()
        for word in set(LETTERS.findall((text or "").lower())):
            if (terms := self.known.get(word)) is None:
                if len(self.known) >= CACHE:
                    self.known.clear()
                terms = tuple(self.place[h] for h in term_hashes(word) if h in self.place)
                self.known[word] = terms
            found.update(terms)
        return sorted(found)

    def scores(self, texts: pa.Array) -> np.ndarray:
        if not self.machine:
            return np.zeros(len(texts))
        rows = [self.terms(x.as_py()) for x in texts]
        starts = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int64)
        return self.machine.scores(starts, np.array([i for r in rows for i in r], np.int64))


def score(docs: DataFrame, machine: Machine | None, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every whole text.

    Null text is empty text, whose score is that of no terms. Without a machine
    every score is 0. A null id isn't held out. Rows may repeat; other columns
    aren't read; an empty table gives an empty one.
    """
    sent = docs.sparkSession.sparkContext.broadcast(machine)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                found = [part.column(0), part.column(1), pa.array(scorer.scores(part.column(2)))]
                yield pa.RecordBatch.from_arrays(found, names=["doc_id", "held_out", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    given = docs.select(F.col(id_col).alias("doc_id"), _held_out(id_col).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    found = given.mapInArrow(scored, f"doc_id {kind}, held_out boolean, score double")
    return found.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def toxicity(docs: DataFrame, labels: DataFrame, **params) -> DataFrame:
    return score(docs, train(docs, labels), **params)


def drop_toxic(docs: DataFrame, machine: Machine | None, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """`docs`, all its columns, without the rows the machine predicts toxic; scored in place, no join."""
    sent = docs.sparkSession.sparkContext.broadcast(machine)
    at_text = docs.columns.index(text_col)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                yield part.filter(pa.array(scorer.scores(part.column(at_text)) < threshold))

    return docs.mapInArrow(kept, docs.schema)
