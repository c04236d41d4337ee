"""Spark session setup and the shared materialisation folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Session defaults for this engine.  AQE stays on so shuffle partition
# counts are coalesced at runtime and skewed join partitions are split.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",      # by measured size
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.mergeSchema": "false",
    # partition values are identities (match_id, evento, fase), never numbers
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "ticksmith", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session.  On a cluster pass ``master=None`` and let
    the launcher decide; locally ``local[N]`` is used."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        # single-host runs: pin the driver to loopback so task results are
        # never lost to an unroutable interface
        builder = (builder.config("spark.driver.host", "127.0.0.1")
                   .config("spark.driver.bindAddress", "127.0.0.1"))
        builder = builder.config("spark.driver.memory", os.environ.get("TICKSMITH_DRIVER_MEMORY", "16g"))
        if master.startswith("local"):
            # one JVM: list partition folders on the driver instead of launching
            # a listing job (clusters keep the distributed listing)
            builder = builder.config("spark.sql.sources.parallelPartitionDiscovery.threshold", "100000")
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster
    (``spark.checkpoint.dir``).  Only on a local master with nothing
    configured (tests) a fresh private folder is created and registered; on a
    cluster a machine-local folder would not be shared, so that is an error."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf = tempfile.mkdtemp(prefix="ticksmith-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path below the shared checkpoint folder (visible to every executor)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, "ticksmith", *parts])


def fresh_scratch_path(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")
