"""Build orchestration: land bronze, build silver and gold incrementally,
check quality, publish.

Physical layout (all Parquet):

* ``<root>/bronze/<table>/evento=/fase=/match_id=/``  all strings (``lote=<n>/`` for a landing of many matches)
* ``<root>/silver/<table>/evento=/balde=/``           typed, sorted by match inside files
* ``<root>/gold/<fact>/evento=/balde=/``              facts
* ``<root>/publish/_versions/<version>/<name>/``      published read copies; ``_CURRENT`` names the version

``balde`` is one of ``BUCKETS`` buckets of a tournament's matches (by hash of
the match), the unit that a replaced match rewrites.

Incremental rules:

* what has to be built comes from the landing ledger (one row per match and
  load number) minus the model's own ledger of the loads it has processed: new
  matches and reloaded ones alike, without opening a bronze file;
* silver: every input is restricted to those matches (partition pruning on
  bronze); new files are appended, unless the table has rows of the matches
  (a reload, or a build that stopped before its ledger entry): those are
  replaced;
* gold facts: the same rule on the loads that all silver inputs of the fact
  have processed, then upsert by match -- rows of the batch's matches replace
  any rows those matches had; written with dynamic partition overwrite of the
  affected buckets after the merged frame is checkpointed (never read and
  overwrite the same files in one job);
* ``full_refresh`` rebuilds a model from nothing.
"""

from __future__ import annotations

import hashlib
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import quality as Q
from ..operators.facts import Gold
from ..operators.joins import MatchBatch
from ..operators.ranking import rank, ranking_specs
from ..operators.silver import Silver
from ..schemas import ALL_TABLES, AUDIT, CLOCKED_TABLES, bronze_schema
from ..session import fresh_scratch_path, scratch_path
from ..sources.bronze import (LOADS, _children, _escape_partition, _hadoop, _remove, _rename, header_last, landed_loads,
                              loaded_matches, skip_loaded, table_path, write_bronze)
from ..sources.fixtures import FixtureBronze
from .catalog import LandedBronze

GOLD_FACTS = ["combate_jogador_partida", "granadas_jogador_partida", "posicionamento_jogador_partida",
              "bomba_jogador_partida", "clutches_jogador_partida", "dim_jogador_partida"]
GOLD_VIEWS = ["dim_partida"] + list(ranking_specs())
# facts that read the tick digest
TICK_FACTS = {"combate_jogador_partida", "posicionamento_jogador_partida", "clutches_jogador_partida",
              "dim_jogador_partida"}


def build_parallelism(spark: SparkSession) -> int:
    """Independent table jobs submitted at once (``ticksmith.build.parallelism``).
    Small-table jobs cannot fill a cluster on their own; running the nine
    silver tables (or six facts) side by side keeps executors busy."""
    try:
        return max(1, int(spark.conf.get("ticksmith.build.parallelism", "4")))
    except Exception:
        return 4


def run_concurrently(spark: SparkSession, tasks: list) -> list:
    """Run independent Spark jobs from a small thread pool (each thread
    submits its own job); results in submission order, first error raised."""
    n = min(build_parallelism(spark), len(tasks))
    if n <= 1:
        return [t() for t in tasks]
    with ThreadPoolExecutor(max_workers=n) as pool:
        futures = [pool.submit(t) for t in tasks]
        return [f.result() for f in futures]


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def _touch(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.create(p, True).close()


# ---------------------------------------------------------------- landing


def land_fixture_bronze(spark: SparkSession, sf_dir: str, root: str | None = None) -> str:
    """Land the bronze projection of a test-data directory once (a marker
    file makes it idempotent); returns the bronze root."""
    if root is None:
        # keyed by the input files as they are now: changed data is landed anew
        state = []
        for name in ("events", "lineitem", "part"):
            fs, p = _hadoop(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")
            st = fs.getFileStatus(p)
            state.append((st.getPath().toString(), st.getLen(), st.getModificationTime()))
        key = hashlib.sha1(repr(state).encode()).hexdigest()[:12]
        root = scratch_path(spark, f"landing-{key}", "bronze")
    marker = f"{root}/_LANDED"
    if path_exists(spark, marker):
        return root
    fx = FixtureBronze(spark, sf_dir)
    # dynamic overwrite: a retried landing replaces exactly the matches it rewrites
    run_concurrently(spark, [lambda t=t: write_bronze(fx.table(t), root, t, mode="overwrite") for t in ALL_TABLES])
    _touch(spark, marker)
    return root


def land_new_matches(spark: SparkSession, tables: dict[str, DataFrame], root: str) -> DataFrame:
    """Idempotent landing of parsed tables: matches already in bronze are
    skipped; returns the match ids that were landed."""
    loaded = loaded_matches(spark, root)
    new_ids = skip_loaded(tables["header"].select("match_id").distinct(), loaded).checkpoint()
    for t in header_last(t for t in ALL_TABLES if t in tables):
        # overwrite by match: a landing repeated after a crash replaces what it left
        write_bronze(tables[t].join(new_ids, "match_id", "left_semi"), root, t, mode="overwrite")
    return new_ids


# ---------------------------------------------------------------- writing


def stamp(df: DataFrame, layer: str) -> DataFrame:
    """Audit columns added at write time."""
    col = "_transformado_em" if layer == "silver" else "_gerado_em"
    return df.withColumn("_camada", F.lit(layer)).withColumn(col, F.current_timestamp())


def _existing_ids(spark: SparkSession, path: str) -> DataFrame | None:
    if not path_exists(spark, path):
        return None
    return spark.read.parquet(path).select("match_id").where(F.col("match_id").isNotNull()).distinct()


# ---------------------------------------------------------------- ledger of processed matches

def ledger_path(lake: "Lake", key: str) -> str:
    return f"{lake.root}/_ledger/{key}"


def processed_loads(lake: "Lake", key: str, target: str) -> DataFrame | None:
    """``match_id``, ``load``: the last load of every match that a model has
    processed, from its ledger (also for matches without rows in the table),
    else -- for a target written before ledgers existed -- the target's own
    match ids as load 0."""
    p = ledger_path(lake, key)
    if path_exists(lake.spark, p):
        own = lake.spark.read.schema(LOADS).parquet(p)
        return own.groupBy("match_id").agg(F.max(F.coalesce("load", F.lit(0))).alias("load"))
    ids = _existing_ids(lake.spark, target)
    return None if ids is None else ids.withColumn("load", F.lit(0).cast("long"))


def processed_ids(lake: "Lake", key: str, target: str) -> DataFrame | None:
    """Matches a model has already processed."""
    own = processed_loads(lake, key, target)
    return None if own is None else own.select("match_id")


def record_processed(lake: "Lake", key: str, ids: DataFrame, overwrite: bool = False) -> None:
    load = F.max("load") if "load" in ids.columns else F.lit(0)
    (ids.groupBy("match_id").agg(load.cast("long").alias("load")).coalesce(1)
     .write.mode("overwrite" if overwrite else "append").option("partitionOverwriteMode", "static").parquet(ledger_path(lake, key)))


def landed(lake: "Lake") -> DataFrame:
    """``match_id``, ``load`` of everything landed: the landing ledger, and as
    load 0 the matches of files that were not written through it."""
    root = lake.bronze_root or f"{lake.root}/bronze"
    loads = landed_loads(lake.spark, root)
    foreign = [n for n in _children(lake.spark, table_path(root, "header")) if not n.startswith(("evento=", "lote="))]
    if loads is not None and not foreign:
        return loads
    seen = lake.bronze.table("header").select("match_id").where("match_id is not null").distinct().withColumn("load", F.lit(0).cast("long"))
    return seen if loads is None else seen.unionByName(loads).groupBy("match_id").agg(F.max("load").alias("load"))


class _Restricted:
    """A layer (bronze or stored silver) seen through one match batch."""

    def __init__(self, layer, batch: MatchBatch, rate: DataFrame | None = None):
        self.layer = layer
        self.batch = batch
        self._cache = {}
        if rate is not None:
            self.rate = batch.restrict(rate)

    def table(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self.batch.restrict(self.layer.table(name))
        return self._cache[name]


def new_ids(source_ids: DataFrame, done: DataFrame | None) -> DataFrame:
    """Matches of the source that are not done; when both carry load numbers,
    also those with a later load than the done one."""
    loads = "load" in source_ids.columns
    ids = source_ids.where(F.col("match_id").isNotNull()).select("match_id", *["load"] * loads).distinct()
    if done is not None:
        if loads and "load" in done.columns:
            ids = ids.join(done.withColumnRenamed("load", "done"), "match_id", "left").where("done is null or load > done").drop("done")
        else:
            ids = ids.join(done.select("match_id"), "match_id", "left_anti")
    return ids.checkpoint()          # small; fixes the batch's match set


def new_batch(source_ids: DataFrame, done: DataFrame | None) -> MatchBatch:
    ids = new_ids(source_ids, done)
    batch = MatchBatch(ids)
    batch.loads = ids
    return batch


# ---------------------------------------------------------------- layout of written layers

BUCKETS = 8             # of a tournament; fixed, a stored match is found by it again
STORED_BY = ["evento", "balde"]
# read by many tasks already and never shuffled to be written
LARGE_TABLES = ("ticks", "grenades")


def with_layout(df: DataFrame) -> DataFrame:
    return (df.withColumn("evento", F.split_part(F.col("match_id"), F.lit("/"), F.lit(1)))
            .withColumn("balde", F.pmod(F.xxhash64("match_id"), F.lit(BUCKETS)).cast("int")))


def write_new_matches(df: DataFrame, path: str, layer: str, append: bool, large: bool = False) -> None:
    """Write a layer table by tournament and bucket, rows sorted by match
    inside each task (Parquet min/max statistics then prune by match).  A
    ``large`` table is written by the tasks that read it, without a shuffle,
    so file sizes follow the input splits; others are gathered by bucket.
    ``append`` adds new matches next to the stored ones; a new column simply
    appears in the new files (old rows read NULL)."""
    out = with_layout(stamp(df, layer))
    if not large:
        out = out.hint("rebalance", *STORED_BY)
    (out.sortWithinPartitions(*STORED_BY, "match_id")
     .write.mode("append" if append else "overwrite").option("partitionOverwriteMode", "static")
     .partitionBy(*STORED_BY).parquet(path))


def append_new_matches(df: DataFrame, path: str, layer: str, full_refresh: bool = False) -> None:
    """Incremental append of a computed frame: only matches absent from
    the target are written."""
    existing = None if full_refresh else _existing_ids(df.sparkSession, path)
    out = df if existing is None else df.join(existing, "match_id", "left_anti")
    write_new_matches(out, path, layer, append=existing is not None)


MOST_PATHS = 2_000       # folders named one by one; beyond, the table is read whole and joined


def upsert_by_match(df: DataFrame, path: str, layer: str = "gold", full_refresh: bool = False,
                    replace_ids: DataFrame | None = None) -> None:
    """Upsert keyed by match: rows of the incoming matches (or of
    ``replace_ids``, which also covers matches that now have no rows at
    all) replace the stored rows of those matches.  Only the buckets that the
    batch touches are read and rewritten."""
    spark = df.sparkSession
    new = with_layout(stamp(df, layer))
    if full_refresh or not path_exists(spark, path):
        (new.hint("rebalance", *STORED_BY).write.mode("overwrite").option("partitionOverwriteMode", "static")
         .partitionBy(*STORED_BY).parquet(path))
        return
    ids = (replace_ids if replace_ids is not None else new).select("match_id").distinct().checkpoint()
    touched = with_layout(ids).select(*STORED_BY).distinct()
    few = touched.limit(MOST_PATHS + 1).collect()
    folders = [f"{path}/evento={_escape_partition(r.evento)}/balde={r.balde}" for r in few]
    stored = None
    if len(few) > MOST_PATHS:
        stored = spark.read.option("mergeSchema", "true").parquet(path).join(touched, STORED_BY, "left_semi")
    elif held := [f for f in folders if path_exists(spark, f)]:
        # columns that only stored rows have are kept, from the footers of these folders alone
        stored = spark.read.option("mergeSchema", "true").option("basePath", path).parquet(*held)
    merged = new if stored is None else (stored.withColumn("balde", F.col("balde").cast("int")).join(ids, "match_id", "left_anti")
                                         .unionByName(new, allowMissingColumns=True))
    merged = merged.checkpoint()                     # cut lineage before overwrite
    (merged.hint("rebalance", *STORED_BY).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*STORED_BY).parquet(path))
    # a bucket left without rows has no folder in the new output: remove the old one
    for r in touched.join(merged.select(*STORED_BY).distinct(), STORED_BY, "left_anti").toLocalIterator():
        folder = f"{path}/evento={_escape_partition(r.evento)}/balde={r.balde}"
        if path_exists(spark, folder):
            _remove(spark, folder)


# ---------------------------------------------------------------- model registry


@dataclass
class Lake:
    spark: SparkSession
    root: str
    bronze_root: str | None = None
    built: list[str] = field(default_factory=list)

    _bronze: LandedBronze | None = None
    _shapes: Gold | None = None

    @property
    def bronze(self):
        # one instance: the folder listing and schema merge happen once
        if self._bronze is None:
            self._bronze = LandedBronze(self.spark, self.bronze_root or f"{self.root}/bronze")
        return self._bronze

    def silver_path(self, t: str) -> str:
        return f"{self.root}/silver/{t}"

    def gold_path(self, t: str) -> str:
        return f"{self.root}/gold/{t}"

    def _read(self, path: str, model: DataFrame, layer: str, drop: tuple[str, ...] = ("evento", "balde")) -> DataFrame:
        """A stored table by the columns its model has (no footer is read to
        find them; files without one of them give NULL)."""
        return self.spark.read.schema(stamp(model, layer).schema).parquet(path).drop(*drop)

    @property
    def _models(self) -> Gold:
        if self._shapes is None:
            self._shapes = Gold(Silver(_NoBronze(self.spark)))
        return self._shapes

    def read_silver(self, t: str) -> DataFrame:
        return self._read(self.silver_path(t), self._models.silver.table(t), "silver")

    def read_gold(self, t: str) -> DataFrame:
        return self._read(self.gold_path(t), self._models.table(t), "gold")

    def read_gold_by_evento(self, t: str) -> DataFrame:
        """With the tournament, a partition column: filters on it prune folders."""
        return self._read(self.gold_path(t), self._models.table(t), "gold", ("balde",))


class _NoBronze:
    """Bronze without rows: what the models built on it look like."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def table(self, name: str) -> DataFrame:
        return self.spark.createDataFrame([], bronze_schema(name))


class _StoredSilver:
    """Silver view over written tables (for gold builds)."""

    def __init__(self, lake: Lake, rate: DataFrame):
        self.lake = lake
        self.rate = rate

    def table(self, name: str) -> DataFrame:
        return self.lake.read_silver(name).drop(*[c for c in AUDIT if c != "_carregado_em"])


def _stored(spark: SparkSession, df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Written to the shared folder and read from there: computed once, and
    of known size to the joins that use it."""
    path = fresh_scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def build_silver(lake: Lake, select: list[str] | None = None, full_refresh: bool = False) -> None:
    """Bronze -> silver for every (or the selected) table.  Only loads not yet
    processed are read, as the ledgers tell; every bronze input (the table,
    plus rounds / cvars for the clock) is restricted to their matches.  Tables
    with the same batch share one stored rate and round clock."""
    spark, tables = lake.spark, select or ALL_TABLES
    loads = landed(lake).checkpoint()        # what this build covers: a load that lands meanwhile is the next build's

    def batch_of(t):
        done = None if full_refresh else processed_loads(lake, f"silver_{t}", lake.silver_path(t))
        return None if done is None else new_batch(loads, done)

    batches = dict(zip(tables, run_concurrently(spark, [lambda t=t: batch_of(t) for t in tables])))
    todo = {t: b for t, b in batches.items() if b is None or not b.empty}
    lake.built.extend(f"silver_{t}" for t in tables)
    if not todo:
        return
    lake._bronze = None                      # list the folders as they are now
    groups: dict = {}
    for t, b in todo.items():
        groups.setdefault(None if b is None else tuple(b.values) if b.values is not None else t, []).append(t)
    layers, scratch = {}, []
    for own in groups.values():
        batch = todo[own[0]]
        silver = Silver(lake.bronze if batch is None else _Restricted(lake.bronze, batch))
        if len(set(own) & {*CLOCKED_TABLES, "rounds"}) > 1:
            for name in ("rate", "clock"):
                silver._cache[name], path = _stored(spark, getattr(silver, name), f"silver-{name}")
                scratch.append(path)
        layers |= dict.fromkeys(own, silver)

    def one(t):
        key, batch, df = f"silver_{t}", todo[t], layers[t].table(t)
        large = t in LARGE_TABLES
        if batch is None:
            write_new_matches(df, lake.silver_path(t), "silver", append=False, large=large)
            record_processed(lake, key, loads, overwrite=True)
            return
        if batch.restrict(lake.read_silver(t)).isEmpty():
            write_new_matches(df, lake.silver_path(t), "silver", append=True, large=large)
        else:        # a reload, or rows of a build that stopped before its ledger entry: replace them
            upsert_by_match(df, lake.silver_path(t), "silver", replace_ids=batch.ids)
        record_processed(lake, key, batch.loads)

    run_concurrently(spark, [lambda t=t: one(t) for t in todo])
    for path in scratch:
        _remove(spark, path)


# silver tables of which a fact needs every match
FACT_INPUTS = {"combate_jogador_partida": ["ticks", "kills", "damages"], "posicionamento_jogador_partida": ["ticks"],
               "clutches_jogador_partida": ["ticks", "kills", "rounds"], "dim_jogador_partida": ["ticks"],
               "granadas_jogador_partida": ["grenades"], "bomba_jogador_partida": ["bomb"]}


def ready_loads(lake: Lake, name: str) -> DataFrame | None:
    """``match_id``, ``load``: the load that every silver input of a fact has
    processed."""
    ids = None
    for t in FACT_INPUTS[name]:
        own = processed_loads(lake, f"silver_{t}", lake.silver_path(t))
        if own is None:
            return None
        ids = own if ids is None else (ids.join(own.withColumnRenamed("load", "other"), "match_id")
                                       .select("match_id", F.least("load", "other").alias("load")))
    return ids


def build_gold(lake: Lake, select: list[str] | None = None, full_refresh: bool = False) -> None:
    """Silver -> gold facts.  A first build computes everything (the tick
    digest is checkpointed once for all tick-based facts); later builds
    restrict every silver input to the matches with loads the fact has not
    processed yet and upsert them."""
    from ..operators.silver import tick_rate
    names = select or GOLD_FACTS

    def batch_of(name):
        src = ready_loads(lake, name)
        if src is None:
            return None
        done = None if full_refresh else processed_loads(lake, name, lake.gold_path(name))
        src = src.checkpoint()
        return (src, None) if done is None else (src, new_batch(src, done))

    found = dict(zip(names, run_concurrently(lake.spark, [lambda n=n: batch_of(n) for n in names])))
    todo = {n: f for n, f in found.items() if f is not None and (f[1] is None or not f[1].empty)}
    lake.built.extend(names)
    if not todo:
        return
    rate = tick_rate(lake.bronze.table("rounds"), lake.bronze.table("cvars"))
    stored = _StoredSilver(lake, rate)
    shared = Gold(stored)
    if any(n in TICK_FACTS and b is None for n, (_, b) in todo.items()):
        shared.materialize_digest()          # ticks read once for all facts below
        shared.players                       # roster derived once from the stored digest

    def one(name):
        src, batch = todo[name]
        if batch is None:
            upsert_by_match(shared.table(name), lake.gold_path(name), "gold", full_refresh=True)
            record_processed(lake, name, src, overwrite=True)
            return
        gold = Gold(_Restricted(stored, batch, rate))
        upsert_by_match(gold.table(name), lake.gold_path(name), "gold", replace_ids=batch.ids)
        record_processed(lake, name, batch.loads)

    run_concurrently(lake.spark, [lambda n=n: one(n) for n in todo])


class _Only:
    """A layer restricted to the given matches."""

    def __init__(self, layer, ids: DataFrame, rate: DataFrame | None = None):
        self.layer = layer
        self.ids = ids
        if rate is not None:
            self.rate = rate.join(ids, "match_id", "left_semi")

    def table(self, name: str) -> DataFrame:
        return self.layer.table(name).join(self.ids, "match_id", "left_semi")


def refresh_matches(lake: Lake, match_ids: DataFrame) -> None:
    """Propagate a forced reload of bronze matches: recompute their silver
    rows from bronze and their gold rows from silver, and replace what the
    layers held for them (a table where a match now has no rows loses the
    old ones too)."""
    from ..operators.silver import tick_rate
    ids = match_ids.select("match_id").where(F.col("match_id").isNotNull()).distinct().checkpoint()
    lake._bronze = None
    loads = ids.join(landed(lake), "match_id", "left").fillna(0, ["load"]).checkpoint()
    silver = Silver(_Only(lake.bronze, ids))
    root = lake.bronze_root or f"{lake.root}/bronze"
    for t in (t for t in ALL_TABLES if path_exists(lake.spark, table_path(root, t))):
        upsert_by_match(silver.table(t), lake.silver_path(t), "silver", replace_ids=ids)
        record_processed(lake, f"silver_{t}", loads)     # else the next build would take them again
    rate = tick_rate(lake.bronze.table("rounds"), lake.bronze.table("cvars"))
    gold = Gold(_Only(_StoredSilver(lake, rate), ids, rate))
    for name in (n for n in GOLD_FACTS if all(path_exists(lake.spark, lake.silver_path(t)) for t in FACT_INPUTS[n])):
        upsert_by_match(gold.table(name), lake.gold_path(name), "gold", replace_ids=ids)
        record_processed(lake, name, loads)


def gold_view(lake: Lake, name: str) -> DataFrame:
    """Views recomputed on read: match dimension and the rankings."""
    from ..operators.facts import dim_partida
    dim = dim_partida(lake.read_silver("header"))
    if name == "dim_partida":
        return dim
    spec = ranking_specs()[name]
    return rank(lake.read_gold(spec.fact), spec, dim)


def quality_report(lake: Lake) -> DataFrame:
    """Every declared test and invariant over the stored tables."""
    class _S:
        def table(self, t):
            return lake.read_silver(t)

    class _G:
        def table(self, t):
            return gold_view(lake, t) if t == "dim_partida" else lake.read_gold(t)

    frames = Q.model_frames(_S(), _G())
    return Q.generic_report(frames).unionByName(Q.invariant_report(Q.invariant_frames(_S(), _G())))


class QualityGateFailed(RuntimeError):
    pass


def gated_publish(lake: Lake, target: str | None = None, tests: DataFrame | None = None) -> list[str]:
    """Publish every gold table and view (one Parquet folder per name,
    replaced whole) only when no quality test fails."""
    report = tests if tests is not None else quality_report(lake)
    failing = report.where(F.col("failures") > 0).collect()   # one row per declared test at most
    if failing:
        raise QualityGateFailed("; ".join(f"{r.model}.{r.test}({r.column_name})={r.failures}" for r in failing))
    return publish(lake, target)


def publish(lake: Lake, target: str | None = None, names: list[str] | None = None) -> list[str]:
    """Write every (or the named) gold table and view below a new version folder, then point
    ``_CURRENT`` at it.  Until then, and after a crash on the way, readers see
    the version before; it is kept until the next publish."""
    spark, out = lake.spark, target or f"{lake.root}/publish"
    version = uuid.uuid4().hex[:12]
    names = names or GOLD_FACTS + GOLD_VIEWS
    for name in names:
        df = lake.read_gold(name) if name in GOLD_FACTS else gold_view(lake, name)
        watch = Observation(f"publish-{name}")
        df = df.observe(watch, F.count(F.lit(1)).alias("rows"))
        df.write.mode("overwrite").parquet(f"{out}/_versions/{version}/{name}")
        _check_written(spark, f"{out}/_versions/{version}/{name}", watch.get["rows"], name)
    before = current_version(spark, out)
    _point_at(spark, out, version)
    for old in _children(spark, f"{out}/_versions"):
        if old not in (version, before):
            _remove(spark, f"{out}/_versions/{old}")
    return list(names)


def _check_written(spark: SparkSession, path: str, rows: int, name: str) -> None:
    """What can be read back is what the write saw."""
    found = spark.read.parquet(path).count()         # from footers
    if found != rows:
        raise QualityGateFailed(f"{name}: {found} rows written of {rows}")


def current_version(spark: SparkSession, published_root: str) -> str | None:
    fs, p = _hadoop(spark, f"{published_root}/_CURRENT")
    if not fs.exists(p):
        return None
    reader = spark.sparkContext._jvm.java.io.BufferedReader(spark.sparkContext._jvm.java.io.InputStreamReader(fs.open(p)))
    try:
        return reader.readLine()
    finally:
        reader.close()


def _point_at(spark: SparkSession, published_root: str, version: str) -> None:
    """The pointer is written beside the old one, then takes its place."""
    fs, fresh = _hadoop(spark, f"{published_root}/_CURRENT.{version}")
    stream = fs.create(fresh, True)
    stream.write(bytearray(version.encode()))
    stream.close()
    target = _hadoop(spark, f"{published_root}/_CURRENT")[1]
    if fs.exists(target):
        fs.delete(target, False)
    _rename(fs, fresh, target)


def gold_scan(spark: SparkSession, published_root: str, name: str) -> DataFrame:
    """A published table of the current version.  Should a crash have struck
    while the pointer was exchanged, the version it was exchanged for."""
    version = current_version(spark, published_root)
    if version is None:
        fs, p = _hadoop(spark, published_root)
        waiting = [f.getPath().getName().split(".", 1)[1] for f in fs.listStatus(p) if f.getPath().getName().startswith("_CURRENT.")]
        version = waiting[0] if waiting else None
    return spark.read.parquet(f"{published_root}/_versions/{version}/{name}" if version else f"{published_root}/{name}")


MODELS = ["silver_" + t for t in ALL_TABLES] + GOLD_FACTS


def build(lake: Lake, select: list[str] | None = None, full_refresh: bool = False) -> list[str]:
    """Build the selected models (default: all) in dependency order."""
    chosen = select or MODELS
    silver = [m[len("silver_"):] for m in chosen if m.startswith("silver_")]
    gold = [m for m in chosen if m in GOLD_FACTS]
    if silver:
        build_silver(lake, silver, full_refresh)
    if gold:
        build_gold(lake, gold, full_refresh)
    return lake.built
