"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams.

Features of a text are its distinct hashed words (whole and by their first
letters), word pairs and skip pairs (one word between).  FTRL-proximal keeps a learning rate per coordinate and
an L1 threshold, so most weights are exactly zero; the non-zero ones are a
compact table, which is broadcast for scoring.

The fit takes about ``TRAIN_DOCS`` labelled rows at most (whole texts) and
runs in one task over their features; scoring covers every row.

Defined results: null and empty texts have no features and score the
model's intercept; without any training row every score is 0; repeated rows
are scored each; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, labelled_sample, mix64, ship
from .licenses import WORD_BYTES

BITS = 20
STEMS = (4, 6)
TRAIN_DOCS = 12_000
EPOCHS = 5
ALPHA, BETA, L1, L2 = 2.0, 1.0, 4.0, 0.1
SEED = 6_553
SCHEMA = "doc_id long, score double"

_U = np.uint64
_PAIR, _SKIP = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F)


class WordTable(dict):
    """Word -> row of a growing table of its hashes: the word and its first
    ``STEMS`` bytes (a crude stem, so inflected forms share features).
    Emptied when it holds ``most`` words."""

    def __init__(self, most: int = 200_000):
        super().__init__()
        self.most = most
        self.rows = np.zeros((most, 1 + len(STEMS)), _U)

    def __missing__(self, word: bytes) -> int:
        at = len(self)
        if at >= self.most:
            raise OverflowError
        of = xxhash.xxh3_64_intdigest
        # a word no longer than a stem is its own stem
        self.rows[at] = [of(word), *(of(word[:k], seed=k) if len(word) > k else of(word) for k in STEMS)]
        self[word] = at
        return at

    def look(self, words: list[bytes]) -> np.ndarray:
        try:
            at = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        except OverflowError:
            self.clear()
            if len(set(words)) > self.most:      # one text with more words than the table holds
                half = len(words) // 2
                return np.concatenate([self.look(words[:half]), self.look(words[half:])])
            at = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return self.rows[at]


def features(data: bytes, table: WordTable) -> np.ndarray:
    """Hashed features of a text, with repeats."""
    words = data.translate(WORD_BYTES).split()
    if not words:
        return np.zeros(0, np.int64)
    own = table.look(words)
    word = np.ascontiguousarray(own[:, 0])
    parts = [own.ravel(), mix64(word[:-1] * _PAIR + word[1:]), mix64(word[:-2] * _SKIP + word[2:])]
    return (np.concatenate(parts) >> _U(64 - BITS)).astype(np.int64)


class Ftrl:
    """Weights by coordinate, lazily computed from (z, n)."""

    def __init__(self, size: int):
        self.z, self.n = np.zeros(size), np.zeros(size)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def step(self, at: np.ndarray, y: int) -> None:
        w = self.weights(at)
        p = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35)))
        g = p - y
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


def fit(rows: list[tuple[np.ndarray, int]], epochs: int = EPOCHS, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """(feature, weight) of the non-zero weights; feature ``2 ** BITS`` is
    the intercept.  A feature of one text alone is left out: it says
    nothing about others."""
    size = (1 << BITS) + 1
    seen = np.zeros(size, np.int32)
    sets = [np.unique(f) for f, _ in rows]
    for f in sets:
        seen[f] += 1
    sets = [np.append(f[seen[f] > 1], size - 1) for f in sets]
    model = Ftrl(size)
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for k in order.permutation(len(rows)).tolist():
            model.step(sets[k], rows[k][1])
    weights = model.weights(np.arange(size))
    at = np.flatnonzero(weights)
    return at, weights[at]


def train(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "toxic", most: int = TRAIN_DOCS,
          seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Fit on the labelled rows where ``learn`` (a condition on doc_id) holds."""
    sample = labelled_sample(docs, labels, label, learn, most, seed).select("doc_id", F.col("text").cast("binary"), "y")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordTable()
        for batch in batches:
            found = [np.unique(features(t.as_py(), words)).astype(np.int32).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary()), batch.column(2)],
                                             names=["doc_id", "features", "y"])

    def learn_all(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "features"])
        at, w = fit([(np.frombuffer(f, np.int32), y) for f, y in zip(rows["features"], rows["y"])], seed=seed)
        return pd.DataFrame({"feature": at.astype(np.int64), "weight": w})

    ship(docs.sparkSession)
    bounded = sample.mapInArrow(make, "doc_id long, features binary, y int")
    found = bounded.groupBy(F.lit(0).alias("fit")).applyInPandas(learn_all, "feature long, weight double").toPandas()
    return found["feature"].to_numpy(np.int64), found["weight"].to_numpy(np.float64)


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """doc_id, score of every row."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, w = held.value
        dense = np.zeros((1 << BITS) + 1, np.float32)
        dense[at] = w
        words = WordTable()
        for batch in batches:
            sums = []
            for text in batch.column(1):
                own = features(text.as_py() or b"", words)
                hit = np.unique(own[dense.take(own) != 0])
                sums.append(dense[hit].sum(dtype=np.float64) + dense[-1])
            odds = np.clip(np.array(sums), -35, 35)
            value = 1 / (1 + np.exp(-odds)) if len(at) else np.zeros(len(sums))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(value, pa.float64())], names=["doc_id", "score"])

    return arrow_rows(SCHEMA, make, docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")))
