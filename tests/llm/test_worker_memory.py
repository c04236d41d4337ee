"""What Python tasks hold: the size of their batches, and memory between tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ticksmith.llm import common, packing
from ticksmith.llm.common import arrow_rows, kept, release, tidy


@pytest.fixture
def fresh_batches(spark):
    """The session without batch sizes of its own, as it was afterwards."""
    keys = ["spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.parquet.columnarReaderBatchSize"]
    before = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.unset(k)
    yield keys
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _batches(spark, letters: int, rows: int) -> list:
    def make(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.column(1).nbytes])], names=["n", "size"])

    docs = spark.range(rows, numPartitions=1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), letters).alias("text"))
    return arrow_rows("n long, size long", make, docs).collect()


def test_batches_are_bounded_by_bytes(spark, fresh_batches):
    found = _batches(spark, 20_000, 1_000)               # 20 MB; by rows alone one batch
    assert sum(r.n for r in found) == 1_000
    assert max(r.size for r in found) < 1.2 * common.BATCH_BYTES
    assert len(_batches(spark, 3 * common.BATCH_BYTES, 2)) == 2    # a longer row comes whole, alone
    assert len(_batches(spark, 10, 1_000)) == 1


def test_batch_sizes_of_the_session_hold(spark, fresh_batches):
    for key in fresh_batches:
        spark.conf.set(key, "77")
    _batches(spark, 1, 1)
    assert {spark.conf.get(key) for key in fresh_batches} == {"77"}


def _own_mb() -> float:
    """Anonymous memory of this process."""
    with open("/proc/self/smaps_rollup") as f:
        return next(int(line.split()[1]) for line in f if line.startswith("Anonymous:")) / 1024


def test_release_hands_freed_memory_back():
    """Many small blocks, freed below one that stays, are kept by malloc."""
    release()
    before = _own_mb()
    parts = [np.ones(1_000) for _ in range(20_000)]      # 160 MB
    stays = np.ones(1_000)
    assert _own_mb() > before + 100
    del parts
    release()
    assert _own_mb() < before + 50 and len(stays)


def test_a_task_drops_what_another_operator_kept():
    with tidy(keep=True):
        one = kept("a", lambda: [1])
    with tidy(keep=True):
        assert kept("a", lambda: [2]) is one
        kept("b", lambda: [3])
        assert list(common._KEPT) == ["b"]               # one at a time
    with tidy():
        assert not common._KEPT


def test_the_encoder_stays_between_packing_tasks_only(spark):
    from ticksmith.llm import queries
    try:
        file = queries.tokenizer_file()
    except ImportError:
        pytest.skip("no tokenizer files here")
    docs = spark.createDataFrame([(k, "some words of a text") for k in range(4)], "doc_id long, text string").repartition(2)
    assert packing.pieces(docs, file).count() == 4
    assert packing.encoder(file) is packing.encoder(file)
    with tidy():
        assert not common._KEPT
