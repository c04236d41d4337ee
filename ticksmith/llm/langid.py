"""Language ID: prediction by partial matching over bytes.

For every language a variable-order context tree of depth ``ORDER`` holds
how often each symbol followed each context in the training texts.  The
code length of a text is the sum of -log2 of the symbol probabilities: a
symbol unseen in a context escapes (method C) to the next shorter context,
at last to all symbols alike.  The statistics are frozen after training, so
the code length of a symbol depends on its context alone and all of them
are tabulated; scoring looks them up for whole arrays of bytes.

Symbols are bytes folded to at most 64: letters of either case alike, any
digit one, other ASCII one, and the most frequent other bytes.

Training counts come from a bounded sample of whole texts per language
(``TRAIN_DOCS``); of the contexts of full depth the ``MOST_CONTEXTS`` most
frequent are kept, others fall back to the next shorter one.  So the
broadcast table has at most ``(64**2 + MOST_CONTEXTS) * 64`` code lengths a
language.

Defined results: ``und`` with score 0 for null texts and texts without a
letter, and when there is nothing to learn from; ties go to the first
language by name; repeated rows are scored each; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_rows, fold, ship

ORDER = 3
SYMBOLS = 64
TRAIN_DOCS = 500             # expected texts learned from, per language
MOST_CONTEXTS = 12_000
SEED = 4_099
PART = 1 << 18               # bytes scored at once
CONFIDENCE_SYMBOLS = 48      # the score is the posterior of a passage of this length
LETTER = re.compile(r"[^\W\d_]")

SCHEMA = "doc_id long, lang_pred string, score double, code_bits double"


def base_symbols() -> np.ndarray:
    """Byte -> symbol: 0 other ASCII, 1 digits, 2-27 letters, 28 other bytes."""
    out = np.zeros(256, np.uint8)
    out[48:58] = 1
    out[97:123] = np.arange(2, 28)
    out[65:91] = np.arange(2, 28)
    out[128:] = 28
    return out


def folded(data: np.ndarray) -> np.ndarray:
    """Bytes with the Latin-1 capitals (C3 80 - C3 9E) lower-cased."""
    out = data.copy()
    capital = np.flatnonzero(data[:-1] == 0xC3) + 1
    capital = capital[(data[capital] >= 0x80) & (data[capital] <= 0x9E)]
    out[capital] += 0x20
    return out


class Model:
    """Frozen statistics: ``node`` maps a full-depth context to its table
    row, ``bits[row * SYMBOLS + symbol]`` holds a code length per language."""

    def __init__(self, symbols: np.ndarray, langs: list[str], counts: list[np.ndarray]):
        """``counts[l]``: dense counts of (ORDER + 1)-grams of symbols."""
        self.symbols, self.langs = symbols, langs
        s = SYMBOLS
        full = [c.reshape(s ** ORDER, s) for c in counts]
        weight = sum(c.sum(1) for c in full)
        kept = np.argsort(-weight, kind="stable")[:MOST_CONTEXTS]
        kept = np.sort(kept[weight[kept] > 1])
        self.node = np.tile(np.arange(s ** (ORDER - 1), dtype=np.int32), s)
        self.node[kept] = s ** (ORDER - 1) + np.arange(len(kept), dtype=np.int32)
        per_lang = []
        for c in full:
            p = np.full((1, s), 1 / s)
            for depth in range(ORDER):
                grams = c.reshape(-1, s ** (depth + 1)).sum(0).reshape(-1, s)      # counts after contexts of this depth
                p = self._blend(grams, np.tile(p, (grams.shape[0] // p.shape[0], 1)))
            top = self._blend(c[kept], p[kept % s ** (ORDER - 1)])
            per_lang.append(-np.log2(np.concatenate([p, top])))
        self.bits = np.stack(per_lang, -1).astype(np.float32).reshape(-1, len(langs))

    @staticmethod
    def _blend(counts: np.ndarray, shorter: np.ndarray) -> np.ndarray:
        """Escape method C: a context with n symbols, d of them distinct,
        escapes with d / (n + d); escaped mass goes to its unseen symbols as
        the shorter context has them."""
        n, seen = counts.sum(1, keepdims=True), counts > 0
        d = seen.sum(1, keepdims=True)
        rest = np.where(seen, 0, shorter)
        left = rest.sum(1, keepdims=True)
        escape = np.where(left > 0, d / np.maximum(n + d, 1), 0)
        known = counts / np.maximum(n, 1) * (1 - escape)
        return np.where(n > 0, known + escape * rest / np.maximum(left, 1e-300), shorter)

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Code length in bits per text (row) and language (column)."""
        total = np.zeros((len(texts), len(self.langs)))
        part, owners, size = [], [], 0
        for k, text in enumerate(texts):
            for i in range(0, len(text), PART):
                part.append(b" " * ORDER + text[i:i + PART] if not i else text[i - ORDER:i + PART])
                owners.append(k)
                size += len(part[-1])
            if part and (size >= PART or k == len(texts) - 1):
                np.add.at(total, owners, self._lengths(part))
                part, owners, size = [], [], 0
        if part:
            np.add.at(total, owners, self._lengths(part))
        return total

    def _lengths(self, part: list[bytes]) -> np.ndarray:
        x = self.symbols[folded(np.frombuffer(b"".join(part), np.uint8))].astype(np.int32)
        context = np.zeros(len(x), np.int32)
        for back in range(ORDER, 0, -1):
            context[ORDER:] = context[ORDER:] * SYMBOLS + x[ORDER - back:len(x) - back]
        bits = self.bits.take(self.node.take(context) * SYMBOLS + x, axis=0)
        starts = np.cumsum([0, *(len(p) for p in part[:-1])])
        for back in range(ORDER):
            bits[starts + back] = 0          # the context before a text codes nothing
        return np.add.reduceat(bits, starts, axis=0, dtype=np.float64)


def _learn_symbols(rows: DataFrame) -> np.ndarray:
    """Symbols of the most frequent non-ASCII bytes, from the sample."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(256, np.int64)
        for batch in batches:
            for text in batch.column(1):
                total += np.bincount(folded(np.frombuffer(text.as_py() or b" ", np.uint8)), minlength=256)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(128, 256)), pa.array(total[128:])], names=["byte", "n"])
    found = (arrow_rows("byte long, n long", make, rows).groupBy("byte").agg(F.sum("n").alias("n")).where("n > 0")
             .orderBy(F.desc("n"), "byte").limit(SYMBOLS - 29).collect())       # at most 35 rows
    symbols = base_symbols()
    for k, r in enumerate(found):
        symbols[r.byte] = 29 + k
    return symbols


def train(docs: DataFrame, learn: Column, docs_per_lang: int = TRAIN_DOCS, seed: int = SEED) -> Model | None:
    """Model of every non-null lang among the rows where ``learn`` holds.
    Counting is distributed; the gram counts gathered per language are a
    table of at most ``SYMBOLS ** (ORDER + 1)`` cells, and no larger than
    the sample."""
    known = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    totals = known.groupBy("lang").count()
    langs = [r.lang for r in totals.select("lang").orderBy("lang").collect()]    # one short row per language
    if not langs:
        return None
    unit = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", F.octet_length("text")), 11) / F.lit(float(1 << 53))
    sample = (known.join(F.broadcast(totals), "lang").where(unit < F.lit(float(docs_per_lang)) / F.col("count"))
              .select("lang", F.col("text").cast("binary").alias("text")))
    symbols = _learn_symbols(sample)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by: dict[str, list[bytes]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by.setdefault(lang, []).append(b" " * ORDER + text)
            for lang, texts in by.items():
                x = symbols[folded(np.frombuffer(b"".join(texts), np.uint8))].astype(np.int64)
                gram = np.zeros(max(0, len(x) - ORDER), np.int64)
                for k in range(ORDER + 1):
                    gram = gram * SYMBOLS + x[k:len(x) - ORDER + k]
                grams, n = np.unique(gram, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams)), pa.array(grams), pa.array(n)],
                                                 names=["lang", "gram", "n"])

    ship(docs.sparkSession)
    grams = sample.mapInArrow(make, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = {lang: np.zeros(SYMBOLS ** (ORDER + 1), np.float32) for lang in langs}
    found = grams.toPandas()
    for lang, rows in found.groupby("lang"):
        counts[lang][rows["gram"].to_numpy()] = rows["n"].to_numpy()
    return Model(symbols, langs, [counts[x] for x in langs])


def _predicted(model: Model | None, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    letters = np.array([bool(t and LETTER.search(t)) and model is not None for t in texts], bool)
    pred, score, bits = ["und"] * len(texts), np.zeros(len(texts)), np.full(len(texts), np.nan)
    at = np.flatnonzero(letters)
    if len(at):
        raw = [texts[k].encode() for k in at]
        lengths = model.code_lengths(raw)
        size = np.array([len(t) for t in raw])
        over = (lengths - lengths.min(1, keepdims=True)) * np.minimum(1, CONFIDENCE_SYMBOLS / size)[:, None]
        score[at] = 1 / np.exp2(-over).sum(1)
        bits[at] = lengths.min(1)
        for k, best in zip(at.tolist(), lengths.argmin(1).tolist()):
            pred[k] = model.langs[best]
    return pred, score, bits


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred, score, code_bits (of the predicted language)."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pred, score, bits = _predicted(held.value, batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(pred, pa.string()), pa.array(score), pa.array(bits, mask=np.isnan(bits))],
                names=["doc_id", "lang_pred", "score", "code_bits"])

    return arrow_rows(SCHEMA, make, docs.select(F.col("doc_id").cast("long"), "text"))


def predictor(spark: SparkSession, model: Model | None):
    """``predict`` as a column function of a text column: a struct of
    lang_pred and score."""
    ship(spark)
    held = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def of(column: pa.Array) -> pa.Array:
        pred, score, _ = _predicted(held.value, column.to_pylist())
        return pa.StructArray.from_arrays([pa.array(pred, pa.string()), pa.array(score, pa.float64())], ["lang_pred", "score"])

    return of


def learn_fold(folds: int = 3, held_out: int = 1) -> Column:
    return fold("doc_id", folds) != held_out
