"""Document fingerprints by locally consistent parsing.

The bytes of a text are parsed bottom-up.  On each level, runs of equal
symbols become one symbol; deterministic coin tossing (the lowest bit in which
a symbol differs from its left neighbour, and that bit) shrinks the alphabet
to a few labels while neighbours stay different; a phrase starts at every
local maximum of the labels and is named by a hash of its symbols.  A cut
depends on a handful of symbols around it, so equal substrings get equal
interior phrases wherever they stand.  The fingerprint is a one-permutation
MinHash of the phrase names of level ``LEVEL`` (``BINS`` bins, 8 bits each,
empty bins filled from the next one), in hex.

Defined results: equal texts have equal fingerprints; null is empty text,
and the empty text has the fingerprint of zeros, alike only to itself; a
null doc_id sorts after all others; rows that share a doc_id are ordered by
text; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, mix64, ship

LEVEL = 3
BINS = 128
RANGE_BYTES = 16 << 20        # text of one partition of the neighbour pass
BUCKETS_PER_PART = 4
MOST_BUCKETS = 20_000
CHUNK_CHARS = 1_500_000       # text parsed at once

U64 = np.uint64
PARSED_BYTES = 150_000        # parsed at once: the arrays of a pass stay in the processor's cache
_SYMBOL = mix64(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
_BASE = 0xD1342543DE82EF95    # odd, so it has an inverse modulo 2**64


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Powers:
    """Powers of the base and of its inverse, as many as asked for so far."""
    up = down = np.ones(1, U64)

    @classmethod
    def at_least(cls, n: int) -> None:
        if len(cls.up) < n:
            size = max(n, 1 << 18)
            cls.up, cls.down = _powers(_BASE, size), _powers(pow(_BASE, -1, 1 << 64), size)


def _toss(size: int) -> np.ndarray:
    """One coin toss on labels below ``size`` as a table [left, own]."""
    left, own = np.meshgrid(np.arange(size), np.arange(size), indexing="ij")
    differ = left ^ own
    lowest = differ & -differ
    place = np.where(differ, np.log2(np.maximum(lowest, 1)).astype(int), 0)
    return (2 * place + ((own & lowest) != 0)).astype(np.uint8)


_TOSS1, _TOSS2, _TOSS3, _TOSS4 = _toss(256).ravel(), _toss(256).ravel(), _toss(16).ravel(), _toss(8).ravel()


def _again(labels: np.ndarray, starts: np.ndarray, table: np.ndarray, size: int) -> np.ndarray:
    """A further toss; the first label of a text is tossed against its own
    with one bit changed."""
    at = labels.astype(np.uint16)
    at[1:] += labels[:-1].astype(np.uint16) * np.uint16(size)
    at[starts] = labels[starts] + (labels[starts] ^ 1).astype(np.uint16) * np.uint16(size)
    return table.take(at)


def _labels(names: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Labels below 6; neighbours differ."""
    if names.dtype == np.uint8:
        labels = _again(names, starts, _TOSS1, 256)
    else:
        left = np.empty_like(names)
        left[1:] = names[:-1]
        left[starts] = ~names[starts]
        left ^= names
        lowest = left & (~left + U64(1))
        labels = _again((np.bitwise_count(lowest - U64(1)) << 1) + ((names & lowest) != 0), starts, _TOSS2, 256)
    return _again(_again(labels, starts, _TOSS3, 16), starts, _TOSS4, 8)


def parse_level(names: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of one level (bytes on the lowest) and the first index of each
    text (all non-empty) -> the same of the next level."""
    new = np.empty(len(names), bool)
    np.not_equal(names[1:], names[:-1], out=new[1:])
    new[starts] = True
    at = np.flatnonzero(new)
    repeats = len(at) < len(names)
    if repeats:
        starts = np.searchsorted(at, starts)
        symbols = names[at]
    else:
        symbols = names
    labels = _labels(symbols, starts)
    cut = np.empty(len(symbols), bool)
    rise = labels[1:] > labels[:-1]
    cut[1:-1] = rise[:-1] & ~rise[1:]          # neighbours differ, so not rising is falling
    cut[-1] = False
    cut[starts[1:] - 1] = False                # a text does not end in a phrase of one symbol
    cut[starts] = True
    first = np.flatnonzero(cut)
    values = _SYMBOL.take(symbols) if symbols.dtype == np.uint8 else symbols
    if repeats:
        runs = np.diff(at, append=len(names))
        long = np.flatnonzero(runs > 1)
        values = values.copy() if values is names else values
        values[long] = mix64(values[long] + runs[long].astype(U64) * U64(0x94D049BB133111EB))
    _Powers.at_least(len(values))
    sums = np.add.reduceat(values * _Powers.up[:len(values)], first)
    return mix64(sums * _Powers.down[first]), np.searchsorted(first, starts)


def sketches(texts: list[bytes], level: int = LEVEL) -> np.ndarray:
    """Fingerprints of texts as rows of ``BINS`` bytes."""
    out = np.zeros((len(texts), BINS), np.uint8)
    full, size = [], 0
    for k, text in enumerate(texts):
        if text:
            full.append(k)
            size += len(text)
        if full and (size >= PARSED_BYTES or k == len(texts) - 1):
            out[full] = _sketch([texts[f] for f in full], level)
            full, size = [], 0
    return out


def _sketch(texts: list[bytes], level: int) -> np.ndarray:
    names = np.frombuffer(b"".join(texts), np.uint8)
    starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])[:-1]])
    for _ in range(level):
        names, starts = parse_level(names, starts)
    owner = np.repeat(np.arange(len(texts)), np.diff(starts, append=len(names)))
    slot = owner * BINS + (names % U64(BINS)).astype(np.int64)
    least = np.full(len(texts) * BINS, np.iinfo(U64).max, U64)
    np.minimum.at(least, slot, names >> U64(8))
    least = least.reshape(-1, BINS)
    empty = least == np.iinfo(U64).max
    # an empty bin takes the next filled one on its right, round the end, marked by the distance
    place = np.where(np.concatenate([empty, empty], 1), 2 * BINS, np.arange(2 * BINS))
    place = np.minimum.accumulate(place[:, ::-1], axis=1)[:, ::-1][:, :BINS]
    taken = np.take_along_axis(least, place % BINS, 1) + (place - np.arange(BINS)).astype(U64) * U64(0x9E3779B97F4A7C15)
    bits = (mix64(taken) >> U64(56)).astype(np.uint8)
    return np.maximum(bits, 1)           # a row of zeros is the empty text's alone


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard index of the phrase sets, row by row; chance
    agreement of 8-bit values is taken off."""
    same = (a == b).mean(axis=1)
    chance = 1 / 255
    return np.clip((same - chance) / (1 - chance), 0, 1)


def fingerprint(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, fingerprint."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            found = sketches([t.encode() for t in texts])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([row.tobytes().hex() for row in found], pa.string())], names=["doc_id", "n_chars", "fingerprint"])
    return arrow_rows("doc_id long, n_chars long, fingerprint string", make,
                      docs.select(F.col("doc_id").cast("long"), "text"))


NEIGHBOUR = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double")


def _compare(rows: list[tuple], level: int) -> pa.RecordBatch:
    """``rows`` (doc_id, text) in order; the last only serves as neighbour."""
    texts = [t for _, t in rows]
    edited = []
    for text, after in zip(texts, texts[1:]):
        k = len(text) // 3
        edited.append(text[:len(text) - k] + after[:k])
    raw = [t.encode() for t in edited]
    found = sketches([t.encode() for t in texts] + raw, level)
    own, after, changed = found[:len(edited)], found[1:len(texts)], found[len(texts):]
    columns = [
        pa.array([d for d, _ in rows[:-1]], pa.int64()), pa.array([len(t) for t in texts[:-1]], pa.int64()),
        pa.array([hashlib.sha256(t).hexdigest() for t in raw], pa.string()),
        pa.array([r.tobytes().hex() for r in own], pa.string()), pa.array([r.tobytes().hex() for r in changed], pa.string()),
        pa.array(likeness(own, changed)), pa.array(likeness(own, after))]
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in NEIGHBOUR.split(", ")])


def neighbours(docs: DataFrame, level: int = LEVEL) -> DataFrame:
    """Each text against its edited text and the next document's (descending
    doc_id, the last one's next is the first).

    One shuffle of the texts: ranges of doc_id go to partitions and are
    streamed in order.  The first document of a range is also sent to the
    range before it, as the neighbour of that one's last."""
    spark = docs.sparkSession
    ship(spark)
    lowest = -(1 << 63)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("key", F.coalesce("doc_id", F.lit(lowest)))
    about = rows.agg(F.sum(F.octet_length("text") + 64).alias("bytes"), F.max("key").alias("top")).first()
    if about.bytes is None:
        return spark.createDataFrame([], NEIGHBOUR)
    parts = max(1, math.ceil(about.bytes / RANGE_BYTES))
    buckets = min(MOST_BUCKETS, parts * BUCKETS_PER_PART)
    cuts = rows.agg(F.percentile_approx("key", [k / buckets for k in range(1, buckets)] or [0.5], 10_000).alias("q")).first().q
    firsts = np.array(sorted({about.top, *cuts}))          # ascending; bucket k holds keys in (firsts[k-1], firsts[k]]
    count = len(firsts)

    @F.pandas_udf("int")
    def bucket_of(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(firsts, key.to_numpy()).astype(np.int32))

    @F.pandas_udf("int")
    def halo_of(key: pd.Series) -> pd.Series:
        """The bucket that needs this row as neighbour, or -1."""
        at = np.searchsorted(firsts, key.to_numpy())
        return pd.Series(np.where(firsts[at] == key.to_numpy(), (at + 1) % count, -1).astype(np.int32))

    spots = F.filter(F.array(F.struct(bucket_of("key").alias("bucket"), F.lit(0).alias("halo")),
                             F.struct(halo_of("key").alias("bucket"), F.lit(1).alias("halo"))), lambda s: s["bucket"] >= 0)
    placed = rows.withColumn("spots", spots).select("doc_id", "text", "key", F.inline("spots"))
    placed = (placed.repartition(parts, "bucket").sortWithinPartitions("bucket", "halo", F.desc("key"), "text")
              .select("doc_id", "text", "bucket", "halo"))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        chars, current, closed = 0, None, True
        for batch in batches:
            for doc, text, bucket, halo in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if bucket != current:
                    held, chars, current, closed = [], 0, bucket, False
                if closed:
                    continue
                held.append((doc, text))
                chars += len(text)
                if halo or chars > CHUNK_CHARS and len(held) > 1:
                    if len(held) > 1:
                        yield _compare(held, level)
                    held = held[-1:]
                    chars = len(held[0][1])
                closed = bool(halo)

    return placed.mapInArrow(make, NEIGHBOUR)
