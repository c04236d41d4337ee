"""N-gram Jaccard join with prefix trees.

A document's set holds its distinct shingles as 64-bit hashes.  All sets are
ordered alike: by class of document frequency, rare shingles first, then by
hash.  Two sets can only reach the threshold if the first few shingles of
each in that order (the prefix) have one in common.

1. ``frequency_classes``: counts the shingles of the lower half of all hash
   values over all documents (packed arrays are shuffled, never one row per
   shingle) and keeps the largest frequency class per cell of a table of
   fixed size.  The half that is not counted comes last in the order.  Any
   order gives right results; a sharper one, fewer candidates.
2. ``postings``: per document its set's key and size, and the prefix
   postings (shingle, key, size), packed by hash range.  A range is sorted;
   neighbours in a shingle's list with sizes that can match are connected.
   Connected components of that hold every pair that can link.
3. ``verify``: within a component the whole sets are stored in a trie in
   a common order, and each set is run down the trie.  Sets below a node
   share the overlap counted to it; a subtree is left where the remaining
   lengths can't reach the threshold, or where all its sets are already
   connected to the probing one.  Large components are split into pairs of
   blocks.  What leaves a task is a spanning forest.

Documents with equal sets are one class throughout and are stored once.

Defined results: null, empty and blank texts have an empty set and link with
nothing; with fewer words than the shingle size the whole sequence is one
shingle; rows that share a doc_id are one node; a null doc_id has the
component of its class, or none; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Forest, WordHashes, arrow_rows, collect_bits, components, materialise, mix64, power_of_two, ship, spanning_edges

WORDS = 4
PERCENT = 85
CELLS = 1 << 24              # of the frequency table, a byte each
COUNTED = np.uint64(1 << 63)  # shingles with smaller hashes are counted and come first in the order
DOCS_PER_RANGE = 400
FLUSH = 1_500_000            # packed entries a task holds before it passes them on
BLOCK = 1_500                # sets of one trie
BIN = 400                    # expected small components' sets verified together
SKETCH_BITS = 24             # of the filter that says which documents are candidates

_U = np.uint64
POSTING = np.dtype([("token", "<u4"), ("size", "<u4"), ("key", "<u8")])


class Shingler:
    """Texts to sorted sets of shingle hashes."""

    def __init__(self, words: int = WORDS):
        self.n, self.hashes = words, WordHashes()
        self.by = mix64(np.arange(1, words + 1, dtype=_U)) | _U(1)

    def __call__(self, text: bytes) -> np.ndarray:
        words = text.lower().split()                 # bytes: A-Z only, ASCII white space only
        if not words:
            return np.zeros(0, _U)
        own = np.fromiter(map(self.hashes.__getitem__, words), _U, len(words))
        if len(own) < self.n:
            return mix64((own * self.by[:len(own)]).sum(keepdims=True, dtype=_U) + _U(len(own)))
        total = own[:len(own) - self.n + 1] * self.by[0]
        for k in range(1, self.n):
            total += own[k:len(own) - self.n + 1 + k] * self.by[k]
        return np.unique(mix64(total))


def prefix_size(n: int, percent: int = PERCENT) -> int:
    return n - (percent * n + 99) // 100 + 1


def least_overlap(a: int, b: int, percent: int = PERCENT) -> int:
    """Smallest intersection with 100 * i >= percent * (a + b - i)."""
    return -(-percent * (a + b) // (100 + percent))


def set_key(tokens: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(tokens.tobytes())


def key_number(key: bytes) -> int:
    """The part of a set key that postings carry."""
    return int.from_bytes(key[:8], "little", signed=True)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))


class _Ranges:
    """Packs (range, bytes) rows: entries are gathered and passed on when
    there are many, so a task's memory stays bounded."""

    def __init__(self, ranges: int):
        self.shift = _U(64 - int(math.log2(ranges)))
        self.ranges, self.parts, self.size = ranges, [], 0

    def add(self, tokens: np.ndarray, entries: np.ndarray) -> None:
        self.parts.append((tokens, entries))
        self.size += len(tokens)

    def flush(self, unique: bool) -> tuple[list[int], list[bytes]]:
        if not self.size:
            return [], []
        tokens = np.concatenate([t for t, _ in self.parts])
        entries = np.concatenate([e for _, e in self.parts])
        self.parts, self.size = [], 0
        if unique:                                  # equal sets give equal postings
            _, at = np.unique(entries, return_index=True)
            tokens, entries = tokens[at], entries[at]
        where = (tokens >> self.shift).astype(np.int64) if self.ranges > 1 else np.zeros(len(tokens), np.int64)
        order = np.argsort(where, kind="stable")
        where, entries = where[order], entries[order]
        first = np.flatnonzero(np.diff(where, prepend=-1))
        return where[first].tolist(), [e.tobytes() for e in np.split(entries, first[1:])]


def frequency_classes(docs: DataFrame, ranges: int, words: int = WORDS) -> np.ndarray:
    """Cell -> largest log2 class of the document frequency of its shingles."""
    lead = _U(int(math.log2(ranges)))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, held = Shingler(words), _Ranges(ranges)
        pack = lambda r: pa.RecordBatch.from_arrays([pa.array(r[0], pa.int64()), pa.array(r[1], pa.binary())], names=["part", "data"])
        for batch in batches:
            for text in batch.column(0):
                own = shingles(text.as_py() or b"")
                low = own[:np.searchsorted(own, COUNTED)]
                held.add(low, (low << lead >> _U(32)).astype(np.uint32))     # the 32 bits after those of the range
                if held.size > FLUSH:
                    yield pack(held.flush(False))
        yield pack(held.flush(False))

    span = CELLS // ranges

    def reduce(rows: pa.Table) -> pa.Table:
        tokens = np.sort(np.concatenate([np.frombuffer(x.as_py(), np.uint32) for x in rows.column("data")]))
        part = rows.column("part")[0].as_py()
        first = np.flatnonzero(np.diff(tokens, prepend=~tokens[:1]))
        count = np.diff(first, append=len(tokens))
        level = np.where(count > 1, np.ceil(np.log2(count)), 0).astype(np.uint8).clip(0, 31)
        cell = tokens[first].astype(np.int64) >> (32 - int(math.log2(span)))
        table = np.zeros(span, np.uint8)
        edge = np.flatnonzero(np.diff(cell, prepend=-1))
        table[cell[edge]] = np.maximum.reduceat(level, edge)
        return pa.table({"at": pa.array([part * span], pa.int64()), "bytes": pa.array([table.tobytes()], pa.binary())})

    rows = arrow_rows("part long, data binary", make, _texts(docs).select("text"))
    return collect_bits(rows.groupBy("part").applyInArrow(reduce, "at long, bytes binary"), CELLS)


def ordered_prefix(tokens: np.ndarray, classes: np.ndarray, percent: int) -> np.ndarray:
    """The prefix of a set in the common order (as a set)."""
    p = prefix_size(len(tokens), percent)
    if p >= len(tokens):
        return tokens
    low = int(np.searchsorted(tokens, COUNTED))
    if low <= p:
        return tokens[:p]
    rank = (classes[(tokens[:low] >> _U(64 - int(math.log2(CELLS)))).astype(np.int64)].astype(_U) << _U(59)) | (tokens[:low] >> _U(5))
    return tokens[np.argpartition(rank, p - 1)[:p]]


def postings(docs: DataFrame, classes: np.ndarray, ranges: int, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Rows of two kinds, written once: (doc_id, n_shingles, key) of every
    document, and (part, data) of packed prefix postings."""
    held = docs.sparkSession.sparkContext.broadcast(classes)
    schema = "doc_id long, n_shingles long, key binary, key64 long, part long, data binary"

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, packed, names = Shingler(words), _Ranges(ranges), ["doc_id", "n_shingles", "key", "key64", "part", "data"]

        def flushed() -> pa.RecordBatch:
            parts, data = packed.flush(True)
            none = [None] * len(parts)
            return pa.RecordBatch.from_arrays([pa.array(none, pa.int64()), pa.array(none, pa.int64()), pa.array(none, pa.binary()),
                                               pa.array(none, pa.int64()), pa.array(parts, pa.int64()), pa.array(data, pa.binary())], names=names)

        for batch in batches:
            sizes, keys = [], []
            for text in batch.column(1):
                own = shingles(text.as_py() or b"")
                sizes.append(len(own))
                keys.append(set_key(own) if len(own) else None)
                if len(own):
                    prefix = ordered_prefix(own, held.value, percent)
                    rows = np.empty(len(prefix), POSTING)
                    rows["token"], rows["size"], rows["key"] = prefix & _U(0xFFFFFFFF), len(own), key_number(keys[-1]) & 0xFFFFFFFFFFFFFFFF
                    packed.add(prefix, rows)
                    if packed.size > FLUSH:
                        yield flushed()
            none = pa.nulls(batch.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
                                              pa.array([key_number(k) if k else None for k in keys], pa.int64()), none,
                                              pa.nulls(batch.num_rows, pa.binary())], names=names)
        yield flushed()

    return materialise(arrow_rows(schema, make, _texts(docs)), "jaccard-postings")


def near_in_lists(data: list[bytes], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect, in every shingle's list, the sets whose sizes can
    match: in order of size, neighbours connect all others."""
    rows = np.unique(np.concatenate([np.frombuffer(x, POSTING) for x in data]))      # by token, size, key
    same = (rows["token"][1:] == rows["token"][:-1]) & (rows["key"][1:] != rows["key"][:-1])
    same &= 100 * rows["size"][:-1].astype(np.int64) >= percent * rows["size"][1:].astype(np.int64)
    at = np.flatnonzero(same)
    return spanning_edges(rows["key"][at].view(np.int64), rows["key"][at + 1].view(np.int64))


class Trie:
    """Path-compressed prefix tree over ordered sets.  A node is
    [path, children by first token, ids of sets ending here, smallest size,
    largest size, longest rest below, a member, are all below one component]."""

    PATH, KIDS, ENDS, LEAST, MOST, REST, MEMBER, ONE = range(8)

    def __init__(self, universe: int, forest: Forest, sizes: list[int], percent: int):
        self.root = self._node(np.zeros(0, np.int64), 0, 0)
        self.mark = np.zeros(universe, bool)
        self.forest, self.sizes, self.percent = forest, sizes, percent
        self.filled = False

    @staticmethod
    def _node(path: np.ndarray, ident: int, size: int) -> list:
        return [path, {}, [], size, size, 0, ident, True]

    def insert(self, ident: int, tokens: np.ndarray) -> None:
        size, root, rest, node = self.sizes[ident], self.forest.find(ident), tokens, self.root
        if not self.filled:
            node[self.LEAST], node[self.MEMBER], self.filled = size, ident, True
        while True:
            node[self.LEAST], node[self.MOST] = min(node[self.LEAST], size), max(node[self.MOST], size)
            node[self.REST] = max(node[self.REST], len(rest))
            if node[self.ONE] and self.forest.find(node[self.MEMBER]) != root:
                node[self.ONE] = False
            if not len(rest):
                node[self.ENDS].append(ident)
                return
            kid = node[self.KIDS].get(int(rest[0]))
            if kid is None:
                kid = self._node(rest, ident, size)
                kid[self.ENDS].append(ident)
                node[self.KIDS][int(rest[0])] = kid
                return
            path = kid[self.PATH]
            m = min(len(path), len(rest))
            differ = np.flatnonzero(path[:m] != rest[:m])
            cut = int(differ[0]) if len(differ) else m
            if cut < len(path):                       # split the edge
                upper = self._node(path[:cut], kid[self.MEMBER], kid[self.LEAST])
                upper[self.MOST], upper[self.ONE] = kid[self.MOST], kid[self.ONE]
                upper[self.REST] = kid[self.REST] + len(path) - cut
                kid[self.PATH] = path[cut:]
                upper[self.KIDS][int(path[cut])] = kid
                node[self.KIDS][int(path[0])] = upper
                kid = upper
            node, rest = kid, rest[cut:]

    def probe(self, ident: int, tokens: np.ndarray) -> list[int]:
        """Sets that link with this one and are not connected to it yet;
        they are connected at once."""
        mark, forest, sizes, percent = self.mark, self.forest, self.sizes, self.percent
        mark[tokens] = True
        found, size = [], sizes[ident]
        stack = [(self.root, 0)]
        while stack:
            node, shared = stack.pop()
            if node[self.ONE] and forest.find(node[self.MEMBER]) == forest.find(ident):
                continue
            if 100 * node[self.MOST] < percent * size or percent * node[self.LEAST] > 100 * size:
                continue
            path = node[self.PATH]
            if len(path):
                shared += int(np.count_nonzero(mark[path]))
                rest = len(tokens) - int(np.searchsorted(tokens, path[-1], "right"))
            else:
                rest = len(tokens)
            if shared + min(rest, node[self.REST]) < least_overlap(size, max(node[self.LEAST], -(-percent * size // 100)), percent):
                continue
            for other in node[self.ENDS]:
                if shared >= least_overlap(size, sizes[other], percent) and forest.union(ident, other):
                    found.append(other)
            stack.extend((kid, shared) for kid in node[self.KIDS].values())
        mark[tokens] = False
        return found


def trie_join(sets: list[np.ndarray], percent: int = PERCENT) -> list[tuple[int, int]]:
    """Spanning forest of the links among sets (indices)."""
    sizes = [len(s) for s in sets]
    _, rank, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.empty(len(count), np.int64)
    order[np.argsort(-count, kind="stable")] = np.arange(len(count))       # shared paths first
    shared = np.count_nonzero(count > 1)
    rank = order[rank]
    cuts = np.cumsum(sizes)[:-1]
    paths = [np.sort(p[p < shared]) for p in np.split(rank, cuts)]         # a token of one set alone is in no overlap
    forest, edges = Forest(len(sets)), []
    trie = Trie(max(1, shared), forest, sizes, percent)
    for k in sorted(range(len(sets)), key=lambda k: (sizes[k], k)):
        if trie.filled:
            edges += [(k, other) for other in trie.probe(k, paths[k])]
        trie.insert(k, paths[k])
    return edges


def candidate_bits(ids: DataFrame) -> np.ndarray:
    """Filter of fixed size over doc_ids (a set bit may be another's)."""
    spans = 64
    size = 1 << SKETCH_BITS
    at = F.pmod(F.xxhash64("doc_id"), F.lit(size))

    def reduce(rows: pa.Table) -> pa.Table:
        part = rows.column("span")[0].as_py()
        bits = np.zeros(size // spans, np.uint8)
        bits[rows.column("bit").to_numpy() - part * (size // spans)] = 1
        return pa.table({"at": pa.array([part * (size // spans // 8)], pa.int64()), "bytes": pa.array([np.packbits(bits).tobytes()], pa.binary())})

    rows = ids.select(at.alias("bit")).distinct().select("bit", F.floor(F.col("bit") / (size // spans)).alias("span"))
    return collect_bits(rows.groupBy("span").applyInArrow(reduce, "at long, bytes binary"), size // 8)


def candidate_sets(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """doc_id, key, tokens of the candidates (and a few more, by the filter)."""
    held = docs.sparkSession.sparkContext.broadcast(candidate_bits(ids))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, bits = Shingler(words), held.value
        for batch in batches:
            at = batch.column(2).to_numpy()
            hit = np.flatnonzero((bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1)
            for i in range(0, len(hit), 500):
                some = hit[i:i + 500]
                own = [shingles(t.as_py() or b"") for t in batch.column(1).take(pa.array(some))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(some)), pa.array([set_key(x) for x in own], pa.binary()),
                     pa.array([x.tobytes() for x in own], pa.binary())], names=["doc_id", "key", "tokens"])

    rows = _texts(docs).where("doc_id is not null").withColumn("bit", F.pmod(F.xxhash64("doc_id"), F.lit(1 << SKETCH_BITS)))
    return arrow_rows("doc_id long, key binary, tokens binary", make, rows)


def verify(docs: DataFrame, candidates: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``candidates(doc_id, key, n_shingles, family)``, one document per set -> links
    (a, b) by doc_id, a spanning forest of those of each family."""
    sets = candidate_sets(docs, candidates, words).withColumnsRenamed({"doc_id": "d", "key": "k"})
    size = candidates.groupBy("family").agg(F.count(F.lit(1)).alias("members"))
    # sets of a large family only meet those of their own and the next size band; sizes that can match are at most one band apart
    band = F.floor(F.log(F.col("n_shingles").cast("double")) / math.log(100 / percent)).cast("int")
    own = candidates.join(size, "family").withColumn(
        "part", F.explode(F.when(F.col("members") > BLOCK, F.array(band, band + 1)).otherwise(F.array(F.lit(-1)))))
    size = own.groupBy("family", "part").agg(F.count(F.lit(1)).alias("sets"))
    own = own.join(size, ["family", "part"]).withColumn("blocks", F.ceil(F.col("sets") / BLOCK).cast("int"))
    bins = max(1, math.ceil(candidates.count() / BIN))
    own = own.withColumn("mine", F.pmod(F.xxhash64(F.lit(1), "doc_id", "key"), F.col("blocks")).cast("int"))
    own = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    own = own.where((F.col("blocks") == 1) | (F.col("mine") != F.col("other")))       # pairs within a block are in each of its pairs
    low, high = F.least("mine", "other"), F.greatest("mine", "other")
    # small families share a bin; each pair of blocks of a large one is a group of its own
    group = F.when(F.col("members") <= BLOCK, F.pmod(F.xxhash64("family"), F.lit(bins))).otherwise(F.xxhash64("family", "part", low, high))
    own = own.withColumn("grp", group)
    full = own.join(sets, (F.col("doc_id") == F.col("d")) & (F.col("key") == F.col("k"))).select("grp", "family", "doc_id", "tokens")

    def join(rows: pa.Table) -> pa.Table:
        frame = rows.to_pandas()
        a, b = [], []
        for _, part in frame.groupby("family", sort=False):
            if len(part) > 1:
                ids = part["doc_id"].to_numpy()
                for i, j in trie_join([np.frombuffer(t, _U) for t in part["tokens"]], percent):
                    a.append(ids[i])
                    b.append(ids[j])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    ship(docs.sparkSession)
    return full.groupBy("grp").applyInArrow(join, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    ship(docs.sparkSession)
    ranges = power_of_two(docs.count() / DOCS_PER_RANGE, 16, 1 << 18)
    rows = postings(docs, frequency_classes(docs, ranges, words), ranges, words, percent)
    sets = rows.where("n_shingles is not null").select("doc_id", "n_shingles", "key", "key64")

    def connect(table: pa.Table) -> pa.Table:
        a, b = near_in_lists([x.as_py() for x in table.column("data")], percent)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    edges = rows.where("part is not null").select("part", "data").groupBy("part").applyInArrow(connect, "a long, b long")
    families = components(edges, "jaccard-families").select(F.col("node").alias("key64"), F.col("component").alias("family"))
    classes = materialise(sets.where("key is not null").groupBy("key")
                          .agg(F.min("doc_id").alias("rep"), F.min("key64").alias("key64"),
                               F.min("n_shingles").alias("n_shingles")), "jaccard-classes")
    candidates = materialise(classes.where("rep is not null").join(families, "key64").select(F.col("rep").alias("doc_id"), "key", "n_shingles", "family"),
                             "jaccard-candidates")
    links = verify(docs, candidates, words, percent)
    shared = sets.where("doc_id is not null and key is not null").groupBy("doc_id").agg(F.count_distinct("key").alias("n")).where("n > 1")
    same_id = (sets.join(shared.select("doc_id"), "doc_id").join(classes.where("rep is not null"), "key")
               .select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).where("a <> b"))
    groups = components(links.unionByName(same_id), "jaccard-groups")
    classes = (classes.join(groups, F.col("rep") == F.col("node"), "left")
               .select("key", F.coalesce("component", "rep").alias("component")))
    out = sets.select("doc_id", "n_shingles", "key").join(classes, "key", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One document of each group stays: the one with the smallest doc_id
    (of its repeated rows the smallest, columns that have no order by their
    JSON text).  Rows without a doc_id stay."""
    groups = near_duplicates(docs, words, percent)
    kept = groups.where(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    rest = [c for c in docs.columns if c != "doc_id"]
    whole = F.struct(*(F.col(f"`{c}`") for c in rest))
    ordered = {c: not any(t in kind for t in ("map<", "variant")) for c, kind in docs.dtypes}
    if all(ordered.values()):
        first = F.min(whole)
    else:
        first = F.min_by(whole, F.struct(*(F.col(f"`{c}`") if ordered[c] else F.to_json(F.struct(F.col(f"`{c}`"))) for c in rest)))
    own = (docs.where("doc_id is not null").join(kept, "doc_id", "left_semi").groupBy("doc_id").agg(first.alias("row"))
           .select("doc_id", "row.*").select(*(F.col(f"`{c}`") for c in docs.columns)))
    return own.unionByName(docs.where("doc_id is null"))
