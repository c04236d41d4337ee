"""Language ID: prediction by partial matching over bytes.

For every language a context tree of depth ``ORDER`` holds how often each
byte followed each context in the training texts.  The code length of a text
is the sum of -log2 of the probabilities of its bytes: a byte unseen in a
context escapes (method C: a context with n bytes, d of them distinct, with
d / (n + d)) to the next shorter context, where the bytes seen in the longer
one are excluded, and at last to all bytes alike.  The statistics are frozen
after training, so the code length of a byte depends on the ``ORDER`` bytes
before it alone.  Texts are lower-cased (Unicode) and coded in UTF-8.

A tree is sparse: sorted arrays of the byte sequences seen, and no others.
It is grown in one task per language, from about ``TRAIN_DOCS`` whole texts
and ``TRAIN_BYTES`` bytes at most; nothing is left out of it.  So a tree has
at most ``2 * (ORDER + 1) * TRAIN_BYTES`` entries of 12 bytes, in practice
some 100,000.  One row per language passes the driver.

``fits`` tells whether a text is coded about as well as texts of the
language are that the tree has not seen: a fifth of the sample, coded by a
tree of the rest, gives the rate (see ``limit``).

Defined results: ``und`` with score 0 (and not ``fits``) for null texts and
texts without a letter, and when there is nothing to learn from; ties go to
the first language by name; repeated rows are scored each; extra columns are
ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_rows, ship, tidy

ORDER = 4
TRAIN_DOCS = 500             # expected texts learned from, per language
TRAIN_BYTES = 1 << 20        # and their expected bytes
SEED = 4_099
PART = 1 << 20               # code lengths computed at once (bytes times languages)
MEMO = 1 << 24               # code lengths remembered (sequences times languages)
CONFIDENCE_BYTES = 48        # the score is the posterior of a passage of this length
LIMIT_QUANTILE, LIMIT_MARGIN, LIMIT_BITS = 0.95, 1.4, 64
LETTER = re.compile(r"[^\W\d_]")
START = b" " * ORDER         # the context before a text

SCHEMA = "doc_id long, lang_pred string, score double, code_bits double, fits boolean"
U64 = np.uint64


def _last(grams: np.ndarray, size: int) -> np.ndarray:
    """The last ``size`` bytes of byte sequences."""
    return grams & U64((1 << 8 * size) - 1)


def _keyed(grams: np.ndarray, size: int) -> np.ndarray:
    """Sequences of ``size`` bytes, told apart from those of other sizes."""
    return grams | U64(size << 8 * (ORDER + 1))


def sequences(data: bytes) -> np.ndarray:
    """For each byte from the ``ORDER``-th on: it and the ``ORDER`` before it."""
    x = np.frombuffer(data, np.uint8)
    out = np.zeros(max(0, len(x) - ORDER), U64)
    for k in range(ORDER + 1):
        out = (out << U64(8)) | x[k:len(x) - ORDER + k]
    return out


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return at, (keys[at] == wanted) if len(keys) else np.zeros(len(wanted), bool)


class Tree(NamedTuple):
    """Code lengths of the sequences seen, and what an escape costs in each
    context seen (``lost``: in the empty one)."""
    grams: np.ndarray
    bits: np.ndarray
    contexts: np.ndarray
    escapes: np.ndarray
    lost: float

    def lengths(self, sequences: np.ndarray) -> np.ndarray:
        """Code length of the last byte of each sequence."""
        cost, rest = np.zeros(len(sequences)), np.arange(len(sequences))
        for size in range(ORDER + 1, 0, -1):
            own = sequences[rest]
            at, seen = _find(self.grams, _keyed(_last(own, size), size))
            cost[rest[seen]] += self.bits[at[seen]]
            rest, own = rest[~seen], own[~seen]
            if size > 1:
                at, seen = _find(self.contexts, _keyed(_last(own >> U64(8), size - 1), size - 1))
                cost[rest[seen]] += self.escapes[at[seen]]
        cost[rest] += self.lost + 8
        return cost


def grow(texts: list[bytes]) -> Tree:
    full = np.concatenate([sequences(START + t) for t in texts] or [np.zeros(0, U64)])
    grams, bits, contexts, escapes = [], [], [], []
    lost, shorter, chance = 0.0, None, None
    for size in range(1, ORDER + 2) if len(full) else ():
        own, n = np.unique(_last(full, size), return_counts=True)
        context = own >> U64(8)
        first = np.flatnonzero(np.append(True, context[1:] != context[:-1]))
        kinds, total = np.diff(first, append=len(own)), np.add.reduceat(n, first)
        below = np.full(len(own), 1 / 256) if size == 1 else chance[np.searchsorted(shorter, _last(own, size - 1))]
        unseen = np.maximum(1 - np.add.reduceat(below, first), 1e-12)
        escape = np.where(kinds < 256, kinds / (total + kinds), 0)
        chance, shorter = n / np.repeat(total / (1 - escape), kinds), own
        grams.append(_keyed(own, size))
        bits.append(-np.log2(chance))
        cost = -np.log2(np.maximum(escape, 1e-300) / unseen)
        if size == 1:
            lost = float(cost[0])
        else:
            contexts.append(_keyed(context[first], size - 1))
            escapes.append(cost)
    joined = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)
    return Tree(joined(grams, U64), joined(bits, np.float32), joined(contexts, U64), joined(escapes, np.float32), lost)


def limit(texts: list[bytes]) -> float:
    """Bits a byte up to which a text passes as one of the language: from
    every fifth text, coded by a tree of the others, the rate that
    ``LIMIT_QUANTILE`` of them stay below, and a margin on it.  Texts may
    use ``LIMIT_BITS`` more, so short ones are not judged by a few bytes."""
    if len(texts) < 5:
        return float("inf")
    model = Model(["own"], [grow([t for k, t in enumerate(texts) if k % 5])], [0.0])
    unseen = [t for t in texts[::5] if t]
    rates = model.code_lengths(unseen)[:, 0] / np.array([len(t) for t in unseen])
    return float(np.quantile(rates, LIMIT_QUANTILE) * LIMIT_MARGIN) if len(rates) else float("inf")


class Model:
    def __init__(self, langs: list[str], trees: list[Tree], limits: list[float]):
        self.langs, self.trees, self.limits = langs, trees, np.array(limits)
        self._memo = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_memo": None}

    def _lengths(self, data: np.ndarray) -> np.ndarray:
        """Code length per sequence (row) and language (column).  Those met
        last are remembered, one per slot of a table."""
        if self._memo is None:
            slots = 1 << min(20, max(10, (MEMO // len(self.langs)).bit_length() - 1))
            self._memo = np.zeros(slots, U64), np.zeros((slots, len(self.langs)), np.float32)
        known, bits = self._memo
        slot = lambda x: ((x * U64(0x9E3779B97F4A7C15)) >> U64(64 - len(known).bit_length() + 1)).astype(np.int64)
        keyed = _keyed(data, ORDER + 1)
        at = slot(keyed)
        out = bits.take(at, axis=0)
        missed = np.flatnonzero(known.take(at) != keyed)
        if len(missed):
            new, which = np.unique(data[missed], return_inverse=True)
            found = np.stack([t.lengths(new) for t in self.trees], 1).astype(np.float32)
            out[missed] = found[which]
            keyed = _keyed(new, ORDER + 1)
            at, first = np.unique(slot(keyed), return_index=True)
            known[at], bits[at] = keyed[first], found[first]
        return out

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Code length in bits per text (row) and language (column)."""
        total = np.zeros((len(texts), len(self.langs)))
        most = max(1 << 12, PART // len(self.langs))
        parts, owners, size = [], [], 0
        for k, text in enumerate(texts):
            text = START + text
            for i in range(ORDER, len(text), most):
                parts.append(sequences(text[i - ORDER:i + most]))
                owners.append(k)
                size += len(parts[-1])
                if size >= most:
                    self._add(total, parts, owners)
                    parts, owners, size = [], [], 0
        if parts:
            self._add(total, parts, owners)
        return total

    def _add(self, total: np.ndarray, parts: list[np.ndarray], owners: list[int]) -> None:
        bits = self._lengths(np.concatenate(parts))
        np.add.at(total, owners, np.add.reduceat(bits, np.cumsum([0, *(len(p) for p in parts[:-1])]), axis=0, dtype=np.float64))

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Language, score, code length in it and whether that fits, of each text."""
        pred, score, bits, fits = ["und"] * len(texts), np.zeros(len(texts)), np.full(len(texts), np.nan), np.zeros(len(texts), bool)
        at = np.array([k for k, t in enumerate(texts) if t and LETTER.search(t)], np.int64)
        if len(at) and self.langs:
            raw = [prepared(texts[k]) for k in at]
            lengths, size = self.code_lengths(raw), np.array([len(t) for t in raw])
            best = lengths.argmin(1)
            least = lengths.min(1)
            over = (lengths - least[:, None]) * np.minimum(1, CONFIDENCE_BYTES / size)[:, None]
            score[at] = 1 / np.exp2(-over).sum(1)
            bits[at] = least
            fits[at] = least <= self.limits[best] * size + LIMIT_BITS
            for k, b in zip(at.tolist(), best.tolist()):
                pred[k] = self.langs[b]
        return pred, score, bits, fits


def prepared(text: str) -> bytes:
    return text.lower().encode()


def train(docs: DataFrame, learn: Column, docs_per_lang: int = TRAIN_DOCS, bytes_per_lang: int = TRAIN_BYTES,
          seed: int = SEED) -> Model:
    """Model of every non-null lang among the rows where ``learn`` holds."""
    known = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "doc_id", "text")
    size = F.octet_length("text")
    totals = known.groupBy("lang").agg(F.least(F.lit(1.0), docs_per_lang / F.count(F.lit(1)), bytes_per_lang / F.greatest(F.sum(size), F.lit(1))).alias("rate"))
    unit = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", size), 11) / F.lit(float(1 << 53))
    # one short row per language is broadcast, so no text but the sample's is shuffled
    sample = known.join(F.broadcast(totals), "lang").where(unit < F.col("rate")).select("lang", "text")

    def learn_one(rows: pd.DataFrame) -> pd.DataFrame:
        texts = [prepared(t) for t in sorted(rows["text"])]
        tree = grow(texts)
        return pd.DataFrame({"lang": [rows["lang"].iloc[0]], **{k: [v.tobytes()] for k, v in tree._asdict().items() if k != "lost"},
                             "lost": [tree.lost], "most": [limit(texts)]})

    ship(docs.sparkSession)
    found = sample.groupBy("lang").applyInPandas(learn_one, "lang string, grams binary, bits binary, contexts binary, escapes binary, lost double, most double")
    rows = sorted(found.toLocalIterator(), key=lambda r: r.lang)
    kinds = {"grams": U64, "bits": np.float32, "contexts": U64, "escapes": np.float32}
    return Model([r.lang for r in rows], [Tree(**{k: np.frombuffer(r[k], t) for k, t in kinds.items()}, lost=r.lost) for r in rows],
                 [r.most for r in rows])


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score, code_bits (in the predicted language), fits."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pred, score, bits, fits = held.value.predict(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(pred, pa.string()), pa.array(score), pa.array(bits, mask=np.isnan(bits)), pa.array(fits)],
                names=["doc_id", "lang_pred", "score", "code_bits", "fits"])

    return arrow_rows(SCHEMA, make, docs.select(F.col("doc_id").cast("long"), "text"))


def predictor(spark: SparkSession, model: Model):
    """``predict`` as a column function of a text column: a struct of
    lang_pred, score and fits."""
    ship(spark)
    held = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred:string,score:double,fits:boolean>")
    def of(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        with tidy():
            for column in columns:
                pred, score, _, fits = held.value.predict(column.to_pylist())
                yield pa.StructArray.from_arrays([pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(fits, pa.bool_())],
                                                 ["lang_pred", "score", "fits"])

    return of
