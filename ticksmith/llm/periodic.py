"""Periodic run detection by recompression.

A run is a stretch of consecutive words that repeats with a smallest period
q, covers it at least twice, and that no neighbouring word extends.  The
texts of a block are laid side by side, fences between them.  Recompression
alternates two steps until every text is one symbol: block compression
(equal neighbours become one symbol with an exponent) and pair compression
(a hash of each symbol and the level puts it left or right; a left symbol
before a right one becomes one symbol).  Equal stretches get equal symbols
but for a few at their ends, so one level costs a longest-common-extension
query at most one step on the way up and one on the way down.

Candidates come from the harmonic grid: a run of period q holds two
neighbouring multiples of q, and the words there are equal.  For every q and
every such pair of places the grammar gives the exact extension forwards and
backwards; the pair is in a run when both together cover q.  There are n ln n
places for n words, and only those with equal words are asked.

Nothing is shuffled: each task works on blocks of about ``BLOCK_WORDS``
words, a longer text being a block of its own.

Defined results: a null or empty text has no words, no runs and an empty
collapsed text; a null id stays null; repeated rows are worked each; other
columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, mix64

MIN_WORDS = 12              # least length of a run
BLOCK_WORDS = 200_000       # words that share one grammar
GRID = 400_000              # grid places looked at together
SCHEMA = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


class WordIds(dict):
    """Word -> number in order of first sight."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


class Grammar:
    """Run-length grammar of a sequence.  ``fence`` marks places that stay
    alone and equal no other place; the first and last place are fences.

    ``symbols[l]`` is level l; ``start[l][k]`` is the place on level l - 1
    where symbol k of level l starts, ``into[l][x]`` the symbol of level
    l + 1 that holds place x.  Both end with one more entry for the end."""

    def __init__(self, letters: np.ndarray, fence: np.ndarray):
        n = len(letters)
        letters = letters.astype(np.int64)
        letters[fence] = letters.max(initial=0) + 1 + np.arange(int(fence.sum()))
        self.symbols, self.start, self.into, self.is_block = [letters], [np.arange(n + 1)], [], [False]
        names = int(letters.max(initial=0)) + 1
        salt = 0
        while True:
            text = self.symbols[-1]
            inner = ~(fence[1:] | fence[:-1])        # two texts' symbols never join
            if not inner.any():
                break
            first = np.ones(len(text), bool)
            first[1:] = (text[1:] != text[:-1]) | ~inner
            if not first.all():
                text, fence, names = self._level(text, fence, first, names, True)
                inner = ~(fence[1:] | fence[:-1])
            side = (mix64(text.astype(np.uint64) ^ np.uint64((salt + 1) << 40)) & np.uint64(1)).astype(bool)
            salt += 1
            pairs, other = side[:-1] & ~side[1:] & inner, ~side[:-1] & side[1:] & inner
            if other.sum() > pairs.sum():
                pairs = other
            if pairs.any():
                first = np.ones(len(text), bool)
                first[1:] = ~pairs
                text, fence, names = self._level(text, fence, first, names, False)

    def _level(self, text, fence, first, names, block):
        start = np.flatnonzero(first)
        size = np.diff(np.append(start, len(text)))
        out = text[start].copy()
        joined = np.flatnonzero(size > 1)
        second = size[joined] if block else text[start[joined] + 1]
        _, own = np.unique((out[joined] << np.int64(32)) | second, return_inverse=True)
        out[joined] = names + own
        self.into.append(np.append(np.cumsum(first) - 1, len(out)))
        self.symbols.append(out)
        self.start.append(np.append(start, len(text)))
        self.is_block.append(block)
        return out, fence[start], names + (int(own.max()) + 1 if len(own) else 0)

    def extend(self, x: np.ndarray, y: np.ndarray, forward: bool) -> np.ndarray:
        """Longest common extension of every pair of cuts (x < y, between
        the same fences): equal letters from the cuts on, or before them."""
        origin = x
        x, y = x.copy(), y.copy()
        top = len(self.symbols) - 1
        stop = np.full(len(x), top)
        live = np.arange(len(x))
        back = 0 if forward else 1
        for level in range(top):                     # up
            text, into, start = self.symbols[level], self.into[level], self.start[level + 1]
            a, b = x[live], y[live]
            apart = np.flatnonzero((start[into[a]] != a) | (start[into[b]] != b))
            if len(apart):
                i, j = a[apart], b[apart]
                same = text[i - back] == text[j - back]
                if self.is_block[level + 1]:
                    if forward:
                        ri, rj = start[into[i] + 1] - i, start[into[j] + 1] - j
                    else:
                        ri, rj = i - start[into[i - 1]], j - start[into[j - 1]]
                    step, ends = np.where(same, np.minimum(ri, rj), 0), ~same | (ri != rj)
                else:
                    step, ends = same.astype(np.int64), ~same
                if not forward:
                    step = -step
                a[apart] += step
                b[apart] += step
                gone = apart[ends]
                if len(gone):
                    at = live[gone]
                    x[at], y[at], stop[at] = a[gone], b[gone], level
                    keep = np.ones(len(live), bool)
                    keep[gone] = False
                    live, a, b = live[keep], a[keep], b[keep]
            x[live], y[live] = into[a], into[b]
            if not len(live):
                break
        by_stop = np.argsort(-stop, kind="stable")
        reached = np.searchsorted(-stop[by_stop], -np.arange(top + 1), side="right")
        for level in range(top, 0, -1):              # down: the next symbols differ
            live = by_stop[:reached[level]]
            if not len(live):
                continue
            text, start = self.symbols[level - 1], self.start[level]
            i, j = x[live], y[live]
            a, b = start[i], start[j]
            same = text[a - back] == text[b - back]
            if self.is_block[level]:
                step = np.minimum(np.abs(start[i + 1 - 2 * back] - a), np.abs(start[j + 1 - 2 * back] - b)) * same
            else:
                step = same.astype(np.int64)
            x[live], y[live] = (a + step, b + step) if forward else (a - step, b - step)
        return np.abs(x - origin)


def grid(sizes: np.ndarray, firsts: np.ndarray, min_words: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Harmonic grid of texts of ``sizes`` words that begin at ``firsts``:
    places i and periods q, for every text, every q up to half of its words
    and every multiple i of q with i + q in the text; in pieces."""
    most = np.where(sizes >= min_words, sizes // 2, 0)
    text = np.repeat(np.arange(len(sizes)), most)
    q = np.arange(len(text)) - np.repeat(np.cumsum(most) - most, most) + 1
    places = (sizes[text] - 1) // q
    total = np.cumsum(places)
    at = 0
    while at < len(q):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + GRID, side="right")))
        count = places[at:to]
        own = np.repeat(q[at:to], count)
        k = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        yield np.repeat(firsts[text[at:to]], count) + k * own, own
        at = to


def find_runs(letters: np.ndarray, sizes: np.ndarray, min_words: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All runs of texts laid end to end: text number, start (in the text),
    length, smallest period; ordered by text, start, period."""
    firsts = np.cumsum(sizes + 1) - sizes            # a fence before every text
    fence = np.zeros(int(sizes.sum()) + len(sizes) + 1, bool)
    fence[firsts - 1] = True
    fence[-1] = True
    laid = np.zeros(len(fence), np.int64)
    laid[~fence] = letters
    grammar = None
    found = []
    for i, q in grid(sizes, firsts, min_words):
        equal = np.flatnonzero(laid[i] == laid[i + q])
        if not len(equal):
            continue
        grammar = grammar or Grammar(laid, fence)
        i, q = i[equal], q[equal]
        ahead = grammar.extend(i, i + q, True)
        before = grammar.extend(i, i + q, False)
        length = q + ahead + before
        good = np.flatnonzero(length >= np.maximum(min_words, 2 * q))
        if len(good):
            start = i[good] - before[good]
            found.append(np.unique(np.stack([start, start + length[good], q[good]], 1), axis=0))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    rows = np.unique(np.concatenate(found), axis=0)  # by start, end, period: the first of a stretch has its smallest period
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:, :2] != rows[:-1, :2]).any(1)
    start, end, period = rows[first].T
    owner = np.searchsorted(firsts, start, side="right") - 1
    order = np.lexsort((period, start))
    return owner[order], (start - firsts[owner])[order], (end - start)[order], period[order]


def kept_words(n: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which of n words stay: those that no run holds after its first period."""
    cover = np.zeros(n + 1, np.int64)
    np.add.at(cover, start + period, 1)
    np.add.at(cover, start + length, -1)
    return np.cumsum(cover[:n]) == 0


def _block(ids: list, texts: list[list[bytes]], min_words: int) -> pa.RecordBatch:
    sizes = np.array([len(t) for t in texts])
    number = WordIds()
    letters = np.fromiter((number[w] for t in texts for w in t), np.int64, int(sizes.sum()))
    owner, start, length, period = find_runs(letters, sizes, min_words)
    ends = np.searchsorted(owner, np.arange(len(texts) + 1))
    collapsed = []
    for k, words in enumerate(texts):
        own = slice(ends[k], ends[k + 1])
        if ends[k] < ends[k + 1]:
            keep = kept_words(len(words), start[own], length[own], period[own])
            words = [words[i] for i in np.flatnonzero(keep).tolist()]
        collapsed.append(b" ".join(words))
    runs = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], names=["start", "length", "period"])
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), runs),
         pa.array(collapsed, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` (start, length, smallest period; by
    start, then period) and ``collapsed``: the words that no run holds after
    its first period, joined by one space.  Words are split at ASCII white
    space."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, held = [], [], 0
        for batch in batches:
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = (value.as_py() or b"").split()
                if ids and held + len(words) > BLOCK_WORDS:
                    yield _block(ids, texts, min_words)
                    ids, texts, held = [], [], 0
                ids.append(doc)
                texts.append(words)
                held += len(words)
        if ids:
            yield _block(ids, texts, min_words)

    return arrow_rows(SCHEMA, make, docs.select(F.col("doc_id").cast("long"), F.col(text).cast("binary")))
