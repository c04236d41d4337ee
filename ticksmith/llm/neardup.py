"""Embedding near-dedup by iterative quantisation (ITQ).

A rotation learned by ITQ gives balanced binary codes; the code is cut into
tables of a few bits.  Retrieval is exact, not approximate.  For unit
vectors x, y with cosine >= c, |x - y|^2 <= 2 (1 - c).  In one of the m
tables their squared distance is at most 2 (1 - c) / m, and there x is
within half that distance of the midpoint of x and y: the midpoint's code
differs from x's only in bits whose coordinates of x square-sum to at most
2 (1 - c) / (4 m).  So every vector is filed, per table, under all codes it
reaches within that budget, and two linked vectors meet in the bucket of
their midpoint.  A met pair is reranked by its original vectors in double
precision, in that one bucket alone, so each link is counted once.

Short codes keep the places of a vector few: 8 bits give about 33 of 64
random coordinates, 16 bits 124, and every place costs a copy of the vector on
its way to the rerank.  Longer buckets are compared by matrix products.

Equal (label, vector) rows are one class and are filed once.  Only buckets
with two classes or more fetch vectors.  A bucket above ``BLOCK`` classes is
split into pairs of blocks, each a group of its own; a group gives per class
the number of its links and a spanning forest, never its pairs.

Defined results: rows with a null label, a null or zero vector or a null or
non-finite component link with nothing, nor do vectors of different length;
rows that share a vec_id are one node; a null vec_id has no component; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Forest, arrow_rows, components, concat_groups, materialise, ship

COSINE = 0.98
SAMPLE = 20_000          # vectors the rotation is learned on, at most about
ROUNDS = 30
LEAST_BITS = 8           # of a table; more when a label has more than 2 ** LEAST_BITS * PER_CODE vectors
PER_CODE = 256
BLOCK = 1_024
PRODUCT_ROWS = 256       # of a matrix product at a time
SEED = 9_176
SLACK = 1e-9


def itq(sample: np.ndarray, rounds: int = ROUNDS, seed: int = SEED) -> np.ndarray:
    """Rotation that brings unit vectors near the corners of a cube: sign
    codes and rotation are fitted to each other in turn (Procrustes)."""
    d = sample.shape[1]
    rotation = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, d)))[0]
    if len(sample) < 2:
        return rotation
    for _ in range(rounds):
        corners = np.where(sample @ rotation >= 0, 1.0, -1.0)
        u, _, vt = np.linalg.svd(sample.T @ corners)
        rotation = u @ vt
    return rotation


def table_slices(d: int, n: int) -> list[slice]:
    """Code bits of each table: as many tables as leave each at least
    log2(n / PER_CODE) bits, so that the buckets of a label with n vectors
    stay small as the rows grow."""
    tables = max(1, d // max(LEAST_BITS, math.ceil(math.log2(max(2, n / PER_CODE)))))
    cuts = np.linspace(0, d, tables + 1).astype(int)
    return [slice(a, b) for a, b in zip(cuts, cuts[1:])]


def reached(coords: np.ndarray, budget: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, code) of every code within the budget of each row: the sign
    code with any set of bits flipped whose coordinates square-sum to at
    most ``budget``."""
    n, width = coords.shape
    row = np.arange(n)
    code = ((coords >= 0) * (np.uint64(1) << np.arange(width, dtype=np.uint64))).sum(1, dtype=np.uint64)
    left = np.full(n, budget)
    for bit in range(width):                     # flip or leave each bit in turn
        cost = coords[row, bit] ** 2
        able = cost <= left
        row = np.concatenate([row, row[able]])
        code = np.concatenate([code, code[able] ^ np.uint64(1 << bit)])
        left = np.concatenate([left, left[able] - cost[able]])
    return row, code


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(1))[:, None]


class Index:
    """The learned rotation and its tables, per vector length."""

    def __init__(self, rotations: dict[int, np.ndarray], n: int, cosine: float):
        self.rotations, self.n, self.cosine = rotations, n, cosine

    def rotation(self, d: int) -> np.ndarray:
        if d not in self.rotations:              # a length outside the sample: any rotation is right
            self.rotations[d] = itq(np.zeros((0, d)))
        return self.rotations[d]

    def keys(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, table, code) of every place a vector is filed under."""
        d = vectors.shape[1]
        turned = unit(vectors) @ self.rotation(d)
        slices = table_slices(d, self.n)
        budget = 2 * (1 - self.cosine) / (4 * len(slices)) + SLACK
        rows, tables, codes = [], [], []
        for t, s in enumerate(slices):
            row, code = reached(turned[:, s], budget)
            rows.append(row)
            tables.append(np.full(len(row), t))
            codes.append(code)
        return np.concatenate(rows), np.concatenate(tables), np.concatenate(codes)

    def met_at(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(table, code) where each pair of unit rotated rows is counted."""
        slices = table_slices(x.shape[1], self.n)
        apart = (x - y) ** 2
        table = np.stack([apart[:, s].sum(1) for s in slices], 1).argmin(1)
        middle = (x + y) >= 0
        code = np.zeros(len(x), np.uint64)
        for t, s in enumerate(slices):
            at = np.flatnonzero(table == t)
            width = s.stop - s.start
            code[at] = (middle[at, s] * (np.uint64(1) << np.arange(width, dtype=np.uint64))).sum(1, dtype=np.uint64)
        return table, code


def with_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, label, embedding (floats stay floats on their way, and are
    reckoned with in double precision), whole: the row can be linked (label,
    finite components, not all zero)."""
    kind = "array<float>" if dict(vectors.dtypes)["embedding"] == "array<float>" else "array<double>"
    own = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast(kind).alias("embedding"))
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    nonzero = F.exists("embedding", lambda v: v != 0)
    return own.withColumn("whole", F.coalesce(F.col("label").isNotNull() & finite & nonzero, F.lit(False)))


def class_hash(salt: int) -> "F.Column":
    return F.xxhash64(F.lit(salt), "label", "embedding")


def classes(vectors: DataFrame) -> tuple[DataFrame, int]:
    """label, embedding, rep (smallest vec_id), copies and class_id of the
    comparable vectors, and the salt of ``class_hash`` under which no two
    classes share an id: ids are counted, and dealt again with the next salt
    while two are equal."""
    good = with_vectors(vectors).where("whole")
    own = materialise(good.groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "itq-classes")
    salt = 0
    while not own.groupBy(class_hash(salt).alias("h")).count().where("count > 1").isEmpty():
        salt += 1
    return own.withColumn("class_id", class_hash(salt)), salt


def _dense(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(-1, d)


def learn(own: DataFrame, cosine: float = COSINE, sample: int = SAMPLE, seed: int = SEED) -> Index:
    """ITQ on about ``sample`` classes at most, drawn by hash."""
    about = own.groupBy("label").agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n").alias("n"), F.max("n").alias("most")).first()
    rate = min(1.0, sample / max(1, about.n or 0))
    picked = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "class_id"), 11) / F.lit(float(1 << 53)) < rate
    rows = own.where(picked).orderBy("class_id").select("embedding").limit(2 * sample).toPandas()["embedding"]
    by: dict[int, list] = {}
    for v in rows:
        by.setdefault(len(v), []).append(v)
    return Index({d: itq(unit(np.array(v, float))) for d, v in by.items()}, about.most or 0, cosine)


def filed(own: DataFrame, index: Index) -> DataFrame:
    """bucket (hash of label, length, table, code), table, code, class_id."""
    held = own.sparkSession.sparkContext.broadcast(index)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.diff(batch.column(1).offsets.to_numpy())
            for d in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == d)
                part = batch.take(pa.array(rows))
                for i in range(0, part.num_rows, 2_000):
                    some = part.slice(i, 2_000)
                    row, table, code = held.value.keys(_dense(some.column(1), d))
                    yield pa.RecordBatch.from_arrays(
                        [some.column(0).take(pa.array(row)), some.column(2).take(pa.array(row)), pa.array(np.full(len(row), d)),
                         pa.array(table), pa.array(code.view(np.int64))], names=["class_id", "label", "d", "tab", "code"])

    rows = arrow_rows("class_id long, label string, d long, tab long, code long", make,
                      own.select("class_id", "embedding", F.col("label").cast("string")))
    return rows.select("class_id", "tab", "code", F.xxhash64("label", "d", "tab", "code").alias("bucket"))


def links(own: DataFrame, index: Index) -> DataFrame:
    """Per group: class_id, linked (rows of other classes linked directly),
    toward (a linked class, one edge of a spanning forest, or null)."""
    places = materialise(filed(own, index), "itq-places")
    crowded = places.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    met = places.join(crowded, "bucket").withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int"))
    met = met.withColumn("mine", F.pmod(F.xxhash64(F.lit(SEED), "class_id"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    met = met.select("class_id", "tab", "code", "bucket", "mine", other.alias("other"))
    met = met.withColumn("grp", F.xxhash64("bucket", F.least("mine", "other"), F.greatest("mine", "other")))
    full = met.join(own.select("class_id", "embedding", "copies"), "class_id")
    full = full.withColumn("cross", F.when(F.col("mine") == F.col("other"), 0).otherwise(F.when(F.col("mine") < F.col("other"), 1).otherwise(2)))
    parts = (full.repartition("grp").sortWithinPartitions("grp", "bucket", "class_id")
             .select("grp", "bucket", "tab", "code", "class_id", "copies", "cross", "embedding"))
    held = own.sparkSession.sparkContext.broadcast(index)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in concat_groups(batches, "grp"):
            yield _count(table.combine_chunks().to_batches()[0], held.value)

    return arrow_rows("class_id long, linked long, toward long", make, parts)


def _near_pairs(units: np.ndarray, group: np.ndarray, bucket: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one group and bucket (each a run of rows) whose
    product is at least ``least``, 50,000 at most at a time."""
    edge = np.flatnonzero((group[1:] != group[:-1]) | (bucket[1:] != bucket[:-1])) + 1
    for start, stop in zip([0, *edge.tolist()], [*edge.tolist(), len(group)]):
        for i in range(start, stop - 1, PRODUCT_ROWS):
            a, c = np.nonzero(units[i:min(i + PRODUCT_ROWS, stop)] @ units[i:stop].T >= least)
            a, c = a[a < c] + i, c[a < c] + i
            for at in range(0, len(a), 50_000):
                yield a[at:at + 50_000], c[at:at + 50_000]


def _count(rows: pa.RecordBatch, index: Index) -> pa.RecordBatch:
    group, bucket, tab, code, ident, copies, cross = (rows.column(k).to_numpy() for k in range(7))
    offsets = rows.column(7).offsets.to_numpy()
    sizes = np.diff(offsets)
    linked = np.zeros(len(group), np.int64)
    # forest edges: each non-root member points at the member it was joined to
    forest, extra = Forest(len(group)), []
    for d in np.unique(sizes).tolist():
        own = np.flatnonzero(sizes == d)
        vectors = _dense(rows.column(7).take(pa.array(own)), d)
        norms = np.sqrt((vectors * vectors).sum(1))
        units = vectors / norms[:, None]
        turned = units @ index.rotation(d)
        for a, c in _near_pairs(units, group[own], bucket[own], index.cosine - SLACK):
            # blocks 0: pairs within the block; 1 and 2: pairs across the two
            ok = (cross[own[a]] == 0) | (cross[own[a]] != cross[own[c]])
            ok &= (vectors[a] * vectors[c]).sum(1) / (norms[a] * norms[c]) >= index.cosine
            a, c = a[ok], c[ok]
            if not len(a):
                continue
            t, z = index.met_at(turned[a], turned[c])
            here = ident[own[a]] != ident[own[c]]
            for side in (a, c):                  # both filed there, should two buckets share a hash
                here &= (t == tab[own[side]]) & (z == code[own[side]].view(np.uint64))
            a, c = own[a[here]], own[c[here]]
            np.add.at(linked, a, copies[c])
            np.add.at(linked, c, copies[a])
            extra += [(ident[i], 0, ident[j]) for i, j in zip(a.tolist(), c.tolist()) if forest.union(i, j)]
    hit = np.flatnonzero(linked)
    e = np.array(extra, np.int64).reshape(-1, 3)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate([ident[hit], e[:, 0]])), pa.array(np.concatenate([linked[hit], e[:, 1]])),
         pa.array(np.concatenate([np.zeros(len(hit), np.int64), e[:, 2]]), mask=np.arange(len(hit) + len(e)) < len(hit))],
        names=["class_id", "linked", "toward"])


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept of every vector."""
    ship(vectors.sparkSession)
    own, salt = classes(vectors)
    found = materialise(links(own, learn(own, cosine)), "itq-links")
    counted = found.groupBy("class_id").agg(F.sum("linked").alias("linked"))
    rep = own.where("rep is not null").select("class_id", "rep")
    edges = (found.where("toward is not null").select("class_id", "toward").join(rep.withColumnRenamed("rep", "a"), "class_id")
             .join(rep.select(F.col("class_id").alias("toward"), F.col("rep").alias("b")), "toward").select("a", "b"))
    # rows that share a vec_id with another class belong to one node
    groups = components(edges.unionByName(_shared_ids(vectors, own, salt)))
    own = (own.join(counted, "class_id", "left").join(groups, F.col("rep") == F.col("node"), "left")
           .select("class_id", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                   F.coalesce("component", "rep").alias("component_id")))
    rows = with_vectors(vectors).select("vec_id", F.when(F.col("whole"), class_hash(salt)).alias("class_id"))
    out = rows.join(own, "class_id", "left")         # a row without a class links with nothing
    mine = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), mine.alias("component_id"),
                      F.coalesce(F.col("vec_id") == mine, F.lit(False)).alias("kept"))


def _shared_ids(vectors: DataFrame, own: DataFrame, salt: int) -> DataFrame:
    """Edges between the classes of a repeated vec_id, by representative."""
    rows = with_vectors(vectors).where("whole and vec_id is not null").select("vec_id", class_hash(salt).alias("class_id"))
    again = rows.groupBy("vec_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("vec_id")
    return rows.join(again, "vec_id").join(own.select("class_id", "rep"), "class_id").select(F.col("vec_id").alias("a"), F.col("rep").alias("b")).where("a <> b").distinct()
