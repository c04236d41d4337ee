"""Shared helpers of the training-data operators."""

from __future__ import annotations

import ctypes
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Hashable, Iterator
from contextlib import contextmanager
from typing import Any

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

_SHIPPED: set[str] = set()


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One input table, through Spark's reader only (any file system)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


BATCH_ROWS = 2_000           # of an Arrow batch at most, unless the session says otherwise
BATCH_BYTES = 2 << 20        # and its bytes (a longer row is a batch alone)
READ_ROWS = 512              # of a batch of the Parquet reader


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of every executor
    (once per application), so functions pickle by reference.  Arrow batches
    hold ``BATCH_ROWS`` rows and ``BATCH_BYTES`` bytes at most where the
    session sets no number of its own: rows are whole texts here, and a task
    has several batches in memory, in the JVM and in Python.  Batches read
    from Parquet files hold ``READ_ROWS`` rows."""
    sc = spark.sparkContext
    for key, most in (("execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("execution.arrow.maxBytesPerBatch", BATCH_BYTES),
                      ("parquet.columnarReaderBatchSize", READ_ROWS)):
        if spark.conf.get(f"spark.sql.{key}", None) is None:
            spark.conf.set(f"spark.sql.{key}", most)
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    base = os.path.join(tempfile.mkdtemp(prefix="ticksmith-py-"), "ticksmith_src")
    shutil.make_archive(base, "zip", os.path.dirname(package), os.path.basename(package))
    sc.addPyFile(base + ".zip")        # the driver serves it to the executors
    _SHIPPED.add(sc.applicationId)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder."""
    return scratch_path(spark, "llm", f"{name}-{uuid.uuid4().hex[:12]}")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: written to the shared folder, read back from there.
    Survives lost executors, and several readers compute it once."""
    path = shared_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def power_of_two(n: float, least: int, most: int) -> int:
    out = least
    while out < n and out < most:
        out *= 2
    return out


class WordHashes(dict):
    """Word (bytes) -> 64-bit hash, memoised; emptied when it holds
    ``most`` words, so memory stays bounded on any vocabulary."""

    def __init__(self, most: int = 300_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def mix64(x: np.ndarray) -> np.ndarray:
    """Avalanche a uint64 array (in place where possible)."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def concat_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Batches of a partition sorted by ``key`` -> tables that end at a key
    boundary, so every key lies whole in one table."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cut = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if (keys != keys[-1]).any() else 0
        if cut or (held and held[-1].column(key)[-1].as_py() != keys[0]):
            held.append(batch.slice(0, cut)) if cut else None
            whole = [b for b in held if b.num_rows]
            if whole:
                yield pa.Table.from_batches(whole)
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


class Forest:
    """Union-find over dense indices; the smaller root wins."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def union(self, i: int, j: int) -> bool:
        a, b = self.find(i), self.find(j)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def spanning_edges(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the given links: at most one edge per node."""
    if not len(left):
        return left, right
    nodes, at = np.unique(np.concatenate([left, right]), return_inverse=True)
    pairs = np.unique(at.reshape(2, -1).T, axis=0)
    forest = Forest(len(nodes))
    kept = [k for k, (i, j) in enumerate(pairs.tolist()) if forest.union(i, j)]
    return nodes[pairs[kept, 0]], nodes[pairs[kept, 1]]


CONTRACT = 500_000           # edges that one task contracts at a time


def local_stars(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The given links' components as stars: every node but the smallest of
    its component, with that smallest node."""
    if not len(left):
        return left, right
    nodes, at = np.unique(np.concatenate([left, right]), return_inverse=True)
    forest = Forest(len(nodes))
    for i, j in at.reshape(2, -1).T.tolist():
        forest.union(i, j)
    root = np.fromiter(map(forest.find, range(len(nodes))), np.int64, len(nodes))
    leaf = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[leaf], nodes[root[leaf]]


def _contract(edges: DataFrame, name: str) -> DataFrame:
    """Each task replaces its edges, ``CONTRACT`` at a time, by the stars of
    their components.  Nodes and connectivity stay; the number of tasks
    grows with the edges."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def stars() -> pa.RecordBatch:
            a, b = local_stars(*(np.concatenate([x.column(k).to_numpy() for x in held]) for k in (0, 1)))
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= CONTRACT:
                yield stars()
                held, size = [], 0
        if held:
            yield stars()

    tasks = max(1, -(-edges.count() // CONTRACT))
    return materialise(arrow_rows("a long, b long", make, edges.coalesce(tasks)), name)


def _all_stars(edges: DataFrame) -> bool:
    """No node has two edges upwards, or edges both ways."""
    ends = (edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
            .unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))))
    odd = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or (up = 1 and down = 1)")
    return odd.isEmpty()


def components(edges: DataFrame, name: str = "components", most_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a, b)`` (longs) -> ``(node, component)``,
    component = the smallest node.  Nodes without an edge are not returned.

    Tasks contract their edges to stars.  While stars still meet, a round
    links every neighbour of a node, and the node, to the smallest of them,
    and the result is contracted again.  That tends to one star per component
    in about log(diameter) rounds at most; each step is written to the shared
    folder.  Minima are pre-aggregated, and the join back is by node, so AQE
    splits a hub."""
    down = (F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current = _contract(materialise(edges.select(*down).where("a <> b"), name), name)
    for _ in range(most_rounds):
        if _all_stars(current):
            break
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        moved = both.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        current = _contract(materialise(moved.unionByName(least.select("a", F.col("m").alias("b")))
                                        .where("a <> b").select(*down).distinct(), name), name)
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return (current.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionByName(current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()))


def collect_bits(rows: DataFrame, cells: int) -> np.ndarray:
    """``(at, bytes)`` pieces of one fixed-size table of ``cells`` bytes ->
    the table.  What reaches the driver is bounded by ``cells``."""
    out = np.zeros(cells, np.uint8)
    for r in rows.toLocalIterator(prefetchPartitions=True):
        piece = np.frombuffer(r.bytes, np.uint8)
        out[r.at:r.at + len(piece)] = piece
    return out


_KEPT: dict[Hashable, Any] = {}


def kept(key: Hashable, build: Callable[[], Any]) -> Any:
    """An object that a Python worker keeps from task to task; it keeps one."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = build()
    return _KEPT[key]


def _trimmer() -> Callable[[int], int] | None:
    try:
        return ctypes.CDLL(None).malloc_trim       # glibc's
    except (AttributeError, OSError, TypeError):
        return None


def release() -> None:
    """Hand this process's unused memory back to the system.  Spark uses its
    Python workers again, and allocators keep what was freed, so a worker
    would hold the most that any of its tasks, of any stage, ever took."""
    pa.default_memory_pool().release_unused()
    if trim := _trimmer():
        trim(0)


@contextmanager
def tidy(keep: bool = False) -> Iterator[None]:
    """Around the work of a Python task: memory is released before and after
    it, and without ``keep`` also what earlier tasks have ``kept``."""
    if not keep:
        _KEPT.clear()
    release()
    try:
        yield
    finally:
        release()


def arrow_rows(schema: str, make: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], df: DataFrame,
               keep: bool = False) -> DataFrame:
    """``df.mapInArrow`` with the package shipped to the workers, ``tidy``."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with tidy(keep):
            yield from make(batches)

    return df.mapInArrow(run, schema)


def fold(doc_id: str, folds: int) -> "F.Column":
    """crc32 of the id as text, modulo ``folds`` (a null id: 0)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds, F.lit(0))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: "F.Column", most: int, seed: int) -> DataFrame:
    """About ``most`` labelled documents at most: ``(doc_id, text, y)``.

    Rows with a null id, text or label are left out; of repeated labels the
    largest holds.  The sample is a hash threshold, so it needs no sort; it
    is small by ``most``, so it is broadcast and the texts are not shuffled."""
    own = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).where(learn)
           .groupBy("doc_id").agg(F.max(label).cast("int").alias("y")))
    total = own.count()
    if total > most:
        unit = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id"), 11) / F.lit(float(1 << 53))
        own = own.where(unit < most / total)
    texts = docs.where(F.col("text").isNotNull()).select("doc_id", "text")
    return texts.join(F.broadcast(own), "doc_id")
