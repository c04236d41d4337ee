"""Quality classifier: a linear-chain conditional random field over lines.

Every line of a text is labelled good or bad.  A line's features are binned
measures of its characters and words and those of the lines beside it; the
chain adds a weight for each pair of neighbouring labels.  Forward and
backward passes give the marginal of every line; the length-weighted mean of
the marginals, put through a logistic fitted on the training texts, is the
score of the text.

Labels are given per document, those of its lines are hidden.  The fit first
learns the feature weights with every line labelled as its document, then
all weights, those of neighbouring labels too, from the documents alone: the
label of a text is as likely as the length-weighted mean of its marginals,
and the gradient runs through the forward-backward pass.  It takes about
``TRAIN_DOCS`` labelled rows at most and runs in one task; long texts enter
it as segments of ``SEGMENT`` lines.  Scoring covers whole texts, as many at
a time as make about ``BLOCK`` bytes.

Defined results: a null or empty text is one empty line and is scored as
such; without training rows every score is 0.5; repeated rows are scored
each; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_rows, labelled_sample, ship, tidy

TRAIN_DOCS = 8_000
SEGMENT = 64
BINS = 8
STEPS, HIDDEN_STEPS = 60, 80    # with lines labelled as their text, and with hidden line labels
RATE, PENALTY = 0.15, 1e-4
NUDGE = 1e-4                    # step of the directional derivative, relative to its largest entry
BLOCK = 1 << 20
SEED = 3_571
SCHEMA = "doc_id long, score double, n_lines long, good_lines double"

LOWER, UPPER, DIGIT, SPACE, STOP, SHOUT, BAR, SYMBOL, HIGH = range(9)
N_CLASSES = 9
MEASURES = 13


def classes() -> np.ndarray:
    out = np.full(256, SYMBOL, np.uint8)
    out[97:123], out[65:91], out[48:58], out[128:] = LOWER, UPPER, DIGIT, HIGH
    for chars, kind in ((b" \t\r\x0b\x0c", SPACE), (b".,;:'\"()-", STOP), (b"!?", SHOUT), (b"|<>{}[]=/\\_", BAR)):
        out[list(chars)] = kind
    return out


_CLASS = classes()


def byte_counts(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of each class per line, and Latin-1 capitals (C3 80 - C3 9E)."""
    if len(lines) == 1:              # of any length: no array of its bytes but these two
        flat = np.frombuffer(lines[0], np.uint8)
        kinds = _CLASS[flat]
        capital = (flat[:-1] == 0xC3) & (flat[1:] >= 0x80) & (flat[1:] <= 0x9E)
        return np.array([[np.count_nonzero(kinds == k) for k in range(N_CLASSES)]]), np.array([np.count_nonzero(capital)])
    flat = np.frombuffer(b"".join(lines), np.uint8)
    owner = np.repeat(np.arange(len(lines), dtype=np.int32), [len(x) for x in lines])
    found = np.bincount(owner * N_CLASSES + _CLASS[flat], minlength=len(lines) * N_CLASSES).reshape(-1, N_CLASSES)
    high = np.flatnonzero(flat[:-1] == 0xC3)
    high = high[(flat[high + 1] >= 0x80) & (flat[high + 1] <= 0x9E)]
    return found, np.bincount(owner[high], minlength=len(lines))


def blocks(sizes: list[int], most: int = BLOCK) -> Iterator[slice]:
    """Slices of neighbours whose sizes add up to ``most``; a larger one alone."""
    start, total = 0, 0
    for k, size in enumerate(sizes):
        if total + size > most and k > start:
            yield slice(start, k)
            start, total = k, 0
        total += size
    if start < len(sizes):
        yield slice(start, len(sizes))


def measures(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Measures of every line (rows), lines per text, bytes per line."""
    lines, counts, words, distinct, copies = [], [], [], [], []
    for text in texts:
        own = text.split(b"\n")
        lines += own
        counts.append(len(own))
        again = Counter(own)
        copies += [again[x] for x in own]
        for x in own:
            w = x.split()
            words.append(len(w))
            distinct.append(len(set(w)))
    size = np.array([len(x) for x in lines])
    found, capital = map(np.concatenate, zip(*(byte_counts(lines[part]) for part in blocks(size.tolist()))))
    words, distinct, copies = (np.array(x, np.float64) for x in (words, distinct, copies))
    n = np.maximum(size, 1)[:, None]
    letters = found[:, LOWER] + found[:, UPPER] + found[:, HIGH]
    out = np.column_stack([
        letters / n[:, 0], (found[:, UPPER] + 2 * capital) / np.maximum(letters, 1), found[:, DIGIT] / n[:, 0],
        found[:, SPACE] / n[:, 0], found[:, STOP] / n[:, 0], found[:, SHOUT] / n[:, 0], found[:, BAR] / n[:, 0],
        found[:, SYMBOL] / n[:, 0], np.log1p(size), size / np.maximum(words, 1), distinct / np.maximum(words, 1),
        np.log1p(words), np.log(copies)])
    return out, np.array(counts), size


def neighbours(binned: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Feature numbers per line: its own bins, and those of the line before
    and after (``BINS`` marks the end of the text)."""
    first = np.cumsum(counts) - counts
    binned = binned.astype(np.int16)
    before, after = np.empty_like(binned), np.empty_like(binned)
    before[1:], after[:-1] = binned[:-1], binned[1:]
    before[first] = BINS
    after[first + counts - 1] = BINS
    at = np.arange(binned.shape[1], dtype=np.int16) * (BINS + 1)
    width = binned.shape[1] * (BINS + 1)
    return np.concatenate([binned + at, before + at + width, after + at + 2 * width], axis=1)


N_FEATURES = 3 * MEASURES * (BINS + 1)


def bin_edges(values: np.ndarray) -> np.ndarray:
    """Inner bin edges per measure: quantiles of the training lines."""
    return np.quantile(values, np.arange(1, BINS) / BINS, axis=0).T


def to_bins(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    return np.column_stack([np.searchsorted(e, v, side="left") for e, v in zip(edges, values.T)])


def chain(odds: np.ndarray, counts: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over many texts at once.  ``odds``: log odds of good
    by each line's features; ``pairs[a, b]``: weight of label a before b.
    Returns the marginal log odds and the forward and backward messages.

    A binary chain needs one log ratio per message; step t runs over all
    texts with more than t lines (texts in falling order of length)."""
    order = np.argsort(-counts, kind="stable")
    first = (np.cumsum(counts) - counts)[order]
    sizes = counts[order]
    ahead, back = np.zeros(len(odds)), np.zeros(len(odds))
    live = np.searchsorted(-sizes, -np.arange(1, sizes[0] + 1), side="right") if len(sizes) else []
    through = lambda x, w: np.logaddexp(x + w[1, 1], w[0, 1]) - np.logaddexp(x + w[1, 0], w[0, 0])
    for t in range(1, len(live)):
        at = first[:live[t]] + t
        ahead[at] = through(ahead[at - 1] + odds[at - 1], pairs)
    for t in range(1, len(live)):
        at = first[:live[t]] + sizes[:live[t]] - 1 - t
        back[at] = through(back[at + 1] + odds[at + 1], pairs.T)
    return ahead + odds + back, ahead, back


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def line_odds(columns: np.ndarray, weights: np.ndarray, bias: float) -> np.ndarray:
    """Log odds of good by each line's features (one row of ``columns`` each)."""
    return sum((weights[c] for c in columns), np.full(columns.shape[1], bias))


class Expectation:
    """What a chain's weights expect of given texts."""

    def __init__(self, columns: np.ndarray, counts: np.ndarray):
        self.columns, self.counts = columns, counts
        inner = np.ones(columns.shape[1], bool)
        inner[np.cumsum(counts) - counts] = False
        self.inner = np.flatnonzero(inner)               # lines with a line before them

    def __call__(self, odds: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Marginals of the lines, and the expected pairs of labels."""
        logit, ahead, back = chain(odds, self.counts, pairs)
        a, b = (ahead + odds)[self.inner - 1], (back + odds)[self.inner]
        joint = np.stack([pairs[i, j] + i * a + j * b for i in (0, 1) for j in (0, 1)], 1)
        joint = np.exp(joint - joint.max(1, keepdims=True))
        return _sigmoid(logit), (joint / joint.sum(1, keepdims=True)).sum(0)

    def features(self, per_line: np.ndarray) -> np.ndarray:
        """Sums of a value per line over the features and the bias."""
        return np.append(sum(np.bincount(c, per_line, N_FEATURES) for c in self.columns), per_line.sum())


class Crf:
    def __init__(self, edges: np.ndarray, weights: np.ndarray, bias: float, pairs: np.ndarray, slope: float, shift: float):
        self.edges, self.weights, self.bias, self.pairs, self.slope, self.shift = edges, weights, bias, pairs, slope, shift

    def marginals(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        values, counts, size = measures(texts)
        numbers = neighbours(to_bins(values, self.edges), counts)
        odds = line_odds(numbers.T, self.weights, self.bias)
        return chain(odds, counts, self.pairs)[0], counts, size

    def raw(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log odds of the length-weighted mean marginal, lines, good lines."""
        logit, counts, size = self.marginals(texts)
        good = _sigmoid(logit)
        first = np.cumsum(counts) - counts
        weight = size + 1.0
        mean = np.add.reduceat(good * weight, first) / np.add.reduceat(weight, first)
        mean = np.clip(mean, 1e-6, 1 - 1e-6)
        return np.log(mean / (1 - mean)), counts, np.add.reduceat(good, first)

    def score(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        raw, counts, good = self.raw(texts)
        return _sigmoid(self.slope * raw + self.shift), counts, good


def hidden_gradient(expect: Expectation, odds: np.ndarray, pairs: np.ndarray, y: np.ndarray,
                    weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Gradient of the loss of text labels ``y`` by line odds and pair weights, and the loss.

    The loss depends on the marginals, so its gradient is a product with the
    matrix of their derivatives: the change of all expectations as the odds
    move along the loss's gradient by the marginals."""
    counts, first = expect.counts, np.cumsum(expect.counts) - expect.counts
    share = weight / np.repeat(np.add.reduceat(weight, first), counts)
    mean = np.clip(np.add.reduceat(share * expect(odds, pairs)[0], first), 0.02, 0.98)
    along = share * np.repeat((mean - y) / (mean * (1 - mean)), counts)
    step = NUDGE / max(np.abs(along).max(), 1e-12)
    (p, joint), (q, other) = expect(odds + step * along, pairs), expect(odds - step * along, pairs)
    loss = -np.mean(np.where(y == 1, np.log(mean), np.log(1 - mean)))
    return (p - q) / (2 * step), (joint - other) / (2 * step), float(loss)


def fit(texts: list[bytes], y: np.ndarray) -> Crf:
    """Adam steps on the penalised likelihood: first that of lines labelled
    as their text without pair weights, then that of the text labels."""
    values, counts, size = measures(texts)
    edges = bin_edges(values)
    columns = np.ascontiguousarray(neighbours(to_bins(values, edges), counts).T)
    label = np.repeat(y, counts)
    # long texts as segments, so no text outweighs many others
    parts = [np.full(c // SEGMENT, SEGMENT).tolist() + ([c % SEGMENT] if c % SEGMENT else []) for c in counts.tolist()]
    counts = np.array([c for p in parts for c in p])
    expect, part_label = Expectation(columns, counts), label[np.cumsum(counts) - counts]
    theta = np.zeros(N_FEATURES + 1 + 4)
    for steps, hidden in ((STEPS, False), (HIDDEN_STEPS, True)):
        m, v = np.zeros_like(theta), np.zeros_like(theta)
        for step in range(1, steps + 1):
            pairs = theta[-4:].reshape(2, 2)
            odds = line_odds(columns, theta[:N_FEATURES], theta[N_FEATURES])
            if hidden:
                by_line, by_pair, _ = hidden_gradient(expect, odds, pairs, part_label, size + 1.0)
            else:
                by_line, by_pair = _sigmoid(odds) - label, np.zeros(4)
            grad = np.append(expect.features(by_line), by_pair) / len(counts) + PENALTY * theta
            m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
            theta -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    crf = Crf(edges, theta[:N_FEATURES], float(theta[N_FEATURES]), theta[-4:].reshape(2, 2).copy(), 1.0, 0.0)
    raw = [crf.raw(texts[part])[0] for part in blocks([len(t) for t in texts])]
    crf.slope, crf.shift = calibrate(np.concatenate(raw), y)
    return crf


def calibrate(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic of one variable by Newton steps, slightly penalised."""
    theta = np.array([0.5, 0.0])
    design = np.column_stack([x, np.ones_like(x)])
    for _ in range(30):
        p = _sigmoid(design @ theta)
        grad = design.T @ (p - y) + 0.1 * (theta - [0.5, 0])
        hess = (design * (p * (1 - p))[:, None]).T @ design + 0.1 * np.eye(2)
        theta = theta - np.linalg.solve(hess, grad)
    return float(max(theta[0], 1e-3)), float(theta[1])


def train(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "quality", most: int = TRAIN_DOCS,
          seed: int = SEED) -> Crf | None:
    """Fit on the labelled rows where ``learn`` (a condition on doc_id) holds;
    one task, bounded by ``most``.  None without rows."""
    sample = labelled_sample(docs, labels, label, learn, most, seed).select("doc_id", F.col("text").cast("binary").alias("text"), "y")

    def learn_all(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "text"])
        c = fit(rows["text"].tolist(), rows["y"].to_numpy(np.int64))
        return pd.DataFrame({"edges": [c.edges.ravel().tolist()], "weights": [c.weights.tolist()], "bias": [c.bias],
                             "pairs": [c.pairs.ravel().tolist()], "slope": [c.slope], "shift": [c.shift]})

    ship(docs.sparkSession)
    found = sample.groupBy(F.lit(0).alias("fit")).applyInPandas(
        learn_all, "edges array<double>, weights array<double>, bias double, pairs array<double>, slope double, shift double").first()
    if found is None:
        return None
    return Crf(np.array(found.edges).reshape(MEASURES, BINS - 1), np.array(found.weights), found.bias,
               np.array(found.pairs).reshape(2, 2), found.slope, found.shift)


def score(docs: DataFrame, model: Crf | None) -> DataFrame:
    """doc_id, score, n_lines, good_lines (expected) of every row."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        for batch in batches:
            for rows in blocks(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()):
                part = batch.slice(rows.start, rows.stop - rows.start)
                texts = [t.as_py() or b"" for t in part.column(1)]
                if own is None:
                    value, counts, good = (np.full(len(texts), 0.5), np.array([t.count(b"\n") + 1 for t in texts]),
                                           np.full(len(texts), np.nan))
                else:
                    value, counts, good = own.score(texts)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(value), pa.array(counts, pa.int64()),
                                                  pa.array(good, mask=np.isnan(good))],
                                                 names=["doc_id", "score", "n_lines", "good_lines"])

    return arrow_rows(SCHEMA, make, docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")))


def scorer(spark: SparkSession, model: Crf | None):
    """``score`` as a column function of a binary text column, for filters
    that keep their rows' other columns where they are."""
    ship(spark)
    held = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def of(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = held.value
        with tidy():
            for column in columns:
                out = []
                for rows in blocks(pc.fill_null(pc.binary_length(column), 0).to_pylist()):
                    texts = [t.as_py() or b"" for t in column.slice(rows.start, rows.stop - rows.start)]
                    out.append(own.score(texts)[0] if own else np.full(len(texts), 0.5))
                yield pa.array(np.concatenate(out) if out else np.zeros(0), pa.float64())

    return of
