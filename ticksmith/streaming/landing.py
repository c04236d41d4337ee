"""Queued landing of recordings as a Structured Streaming job.

Upload requests arrive as JSON-lines files in a landing folder (one line
per request: ``evento``, ``fase``, ``arquivo`` and optional ``forcar``).
The parsed tables of each recording part are staged as string Parquet
under ``<staged>/<table>/`` with a ``caminho`` column holding the relative
recording path (``evento/fase/name[-pN].dem``).  When the staged files
also carry the match identity -- best as a ``match_id=`` partition folder
-- each micro-batch reads only its own matches' folders.

Each micro-batch (``foreachBatch``):

1. validates the requests (required folder names, file name rules);
2. derives the match identity and part number of each accepted request;
3. opens accepted archives: their members, staged by the decoder as
   ``<staged>/members`` (``caminho`` of the archive, ``entrada``), become
   requests of their own, grouped by match;
4. skips matches already landed (unless ``forcar``);
5. gathers the staged rows of every part of those matches, stitches the
   parts (round / tick offsets), and lands all nine tables with dynamic
   partition overwrite -- a re-run of the same batch rewrites the same
   match folders, so the sink is idempotent.  Forced matches that are
   already landed are staged and swapped in; a forced match without staged
   rows, or whose load fails, keeps its rows;
6. appends one status row per recording request, and per match of an archive
   (``membros`` recordings of it) and per refused member, to ``<status>``
   (loaded, skipped, rejected, ignored, error) -- the job's status is read
   from there and from ``StreamingQuery.lastProgress``.

Loading runs as one job per table for the whole micro-batch.  If that
fails, the batch is retried one match at a time so a bad recording does
not stop the others; a failing new match is removed again from bronze and
reported with its error.

The checkpoint makes each request file processed once across restarts;
``cleanSource`` can delete or archive processed request files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import blank, to_bigint
from ..operators.joins import MatchBatch
from ..schemas import ALL_TABLES, bronze_schema
from ..sources import bronze as B
from ..sources.stitch import part_offsets, shift_table

REQUEST_SCHEMA = "evento string, fase string, arquivo string, forcar boolean"
STATUS_SCHEMA = ("request_file string, evento string, fase string, arquivo string, match_id string, status string, erro string, "
                 "epoch bigint, membros bigint, membro string")
MEMBERS_SCHEMA = "caminho string, entrada string"


def _staged(spark: SparkSession, staged_root: str, table: str) -> DataFrame | None:
    """Staged rows of one table by its declared layout (no footer is read to
    find the columns); None when nothing is staged for it."""
    path = f"{staged_root.rstrip('/')}/{table}"
    try:
        return spark.read.schema(bronze_schema(table).add("caminho", "string")).parquet(path)
    except Exception as exc:
        if "PATH_NOT_FOUND" in str(exc):
            return None
        raise


def _members(spark: SparkSession, staged_root: str) -> DataFrame:
    """Entries of the staged archives."""
    try:
        return spark.read.schema(MEMBERS_SCHEMA).parquet(f"{staged_root.rstrip('/')}/members")
    except Exception as exc:
        if "PATH_NOT_FOUND" in str(exc):
            return spark.createDataFrame([], MEMBERS_SCHEMA)
        raise


def _land_matches(spark: SparkSession, staged_root: str, bronze_root: str, ids: DataFrame,
                  loaded_at: str | None, record: bool = True) -> None:
    """Gather the staged rows of every part of the given matches (identity
    from the recording path), stitch the parts and land all nine tables."""
    parts = {}
    batch = MatchBatch(ids)          # the batch's ids, read once for every staged table
    for t in ALL_TABLES:
        st = _staged(spark, staged_root, t)
        if st is None:
            continue
        # staged by identity (ideally as a partition column): prune to the batch's matches first
        st = batch.restrict_or_null(st)
        st = B.with_identity(st.drop("match_id"), "caminho")
        parts[t] = st.join(ids, "match_id", "left_semi")
    if "rounds" not in parts:
        return
    r = parts["rounds"].select("match_id", "parte", to_bigint(blank("round_num")).alias("round_num"),
                               to_bigint(blank("official_end")).alias("official_end"))
    tk = (parts["ticks"].select("match_id", "parte", to_bigint(blank("tick")).alias("tick"))
          if "ticks" in parts else None)
    offsets = part_offsets(r, tk).checkpoint()
    for t in B.header_last(parts):
        df = parts[t]
        if t == "header":
            first = df.groupBy("match_id").agg(F.min("parte").alias("parte"))
            # parts per recording are few: the ordered list of their sources is small
            srcs = (df.groupBy("match_id")
                    .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("parte", "caminho"))),
                                                  lambda s: s["caminho"]), ", ").alias("_arquivo_origem")))
            df = df.join(first, ["match_id", "parte"], "left_semi").drop("_arquivo_origem").join(srcs, "match_id")
        else:
            df = shift_table(df, offsets, t).withColumn("_arquivo_origem", F.col("caminho"))
        if loaded_at:
            df = df.withColumn("_carregado_em", F.lit(loaded_at))
        df = df.withColumn("_camada", F.lit("bronze")).drop("parte", "caminho")
        B.write_bronze(df, bronze_root, t, mode="overwrite", record=record)


def _reload_matches(spark: SparkSession, staged_root: str, bronze_root: str, ids: DataFrame, loaded_at: str | None) -> None:
    """Land matches into a staging folder and swap in those that arrived
    whole (with a header); the others keep what they have."""
    staging = B.staging_root(bronze_root)
    _land_matches(spark, staged_root, staging, ids, loaded_at, record=False)
    B.swap_in(spark, bronze_root, staging)


def _land_one_by_one(spark: SparkSession, ids: DataFrame, land, undo) -> DataFrame:
    """Slow path after a failed batch: ``land`` each match on its own; one
    that fails is reported with its error after ``undo``."""
    errors = []
    for row in ids.toLocalIterator():          # one match after another, as many as there are
        try:
            land(spark.createDataFrame([(row.match_id,)], "match_id string"))
        except Exception as exc:  # reported per match, the others go on
            undo(row.match_id)
            errors.append((row.match_id, str(exc).strip()))
    return spark.createDataFrame(errors, "match_id string, erro_carga string")


def _land(spark: SparkSession, ids: DataFrame, land, undo) -> DataFrame:
    """All matches in one job per table; if that fails, one at a time, so one
    bad recording does not stop the others.  Returns the failures."""
    if ids.isEmpty():
        return spark.createDataFrame([], "match_id string, erro_carga string")
    try:
        land(ids)
        return spark.createDataFrame([], "match_id string, erro_carga string")
    except Exception:
        return _land_one_by_one(spark, ids, land, undo)


def expand_archives(requests: DataFrame, members: DataFrame, max_entries: int | None = B.MAX_BATCH_ENTRIES) -> DataFrame:
    """Accepted requests -> one row per recording: ``item_id``, ``caminho``,
    ``membro`` (its entry in an archive), ``situacao``.  Of an archive,
    ``situacao`` is the entry's (accepted, ignored, rejected, batch_refused;
    no_members without any entry); a single recording is accepted."""
    archives = requests.where("tipo = 'zip'")
    entries = archives.join(members, "caminho").select("item_id", "evento", "fase", "entrada")
    listed = B.batch_members(entries, "item_id", "entrada", max_entries)
    opened = (archives.select("item_id").join(listed.drop("n_entradas"), "item_id", "left")
              .select("item_id", F.concat_ws("/", "evento", "fase", "nome_base").alias("caminho"), F.col("entrada").alias("membro"),
                      F.coalesce("status", F.lit("no_members")).alias("situacao")))
    single = requests.where("tipo <> 'zip'").select("item_id", "caminho", F.lit(None).cast("string").alias("membro"),
                                                    F.lit("accepted").alias("situacao"))
    return single.unionByName(opened)


def land_requests(batch: DataFrame, epoch: int, staged_root: str, bronze_root: str, status_path: str,
                  loaded_at: str | None = None) -> None:
    spark = batch.sparkSession
    B.recover_swaps(spark, bronze_root)
    reqs = batch.withColumn("item_id", F.monotonically_increasing_id()).checkpoint()
    v = B.manifest_validate(reqs).join(reqs.select("item_id", "request_file", "forcar"), "item_id")
    accepted = B.manifest_paths(v.where("aceito"))
    recordings = expand_archives(accepted, _members(spark, staged_root)).join(reqs.select("item_id", "forcar"), "item_id")
    recordings = B.with_identity(recordings).checkpoint()
    wanted = recordings.where("situacao = 'accepted'").groupBy("match_id").agg(F.bool_or(F.coalesce("forcar", F.lit(False))).alias("forcar"))
    loaded = B.loaded_matches(spark, bronze_root).withColumn("presente", F.lit(True))
    todo = wanted.join(loaded, "match_id", "left").where("forcar or presente is null").checkpoint()
    new, again = (todo.where(c).select("match_id") for c in ("presente is null", "presente"))
    before = B.landed_loads(spark, bronze_root)
    before = before.checkpoint() if before is not None else spark.createDataFrame([], B.LOADS)
    failed = _land(spark, new, lambda ids: _land_matches(spark, staged_root, bronze_root, ids, loaded_at),
                   lambda match: B.drop_matches(spark, bronze_root, [match]))     # no half-landed match stays
    failed = failed.unionByName(_land(spark, again, lambda ids: _reload_matches(spark, staged_root, bronze_root, ids, loaded_at),
                                      lambda match: None))
    B.recover_swaps(spark, bronze_root)              # staged rows of failed reloads

    # loaded is what the ledger has a further load of; a match without staged rows has none
    now = B.landed_loads(spark, bronze_root)
    now = (now if now is not None else spark.createDataFrame([], B.LOADS)).withColumnRenamed("load", "now")
    arrived = now.join(before, "match_id", "left").where("now > coalesce(load, 0)").select("match_id", F.lit(True).alias("chegou"))
    outcome = (todo.join(failed, "match_id", "left").join(arrived, "match_id", "left")
               .withColumn("erro_carga", F.when(F.col("erro_carga").isNull() & F.col("chegou").isNull(), F.lit("no rows landed"))
                           .otherwise(F.col("erro_carga")))
               .select("match_id", F.when(F.col("erro_carga").isNull(), F.lit("loaded")).otherwise(F.lit("error")).alias("carga"), "erro_carga"))
    per_match = (recordings.where("situacao = 'accepted'").groupBy("item_id", "match_id")
                 .agg(F.count("membro").alias("membros")).join(outcome, "match_id", "left")
                 .select("item_id", "match_id", F.coalesce("carga", F.lit("skipped")).alias("status"), "erro_carga",
                         F.when(F.col("membros") > 0, F.col("membros")).alias("membros"), F.lit(None).cast("string").alias("membro")))
    reason = F.when(F.col("situacao") == "batch_refused", F.lit("too many entries")).when(
        F.col("situacao") == "no_members", F.lit("no members staged")).when(F.col("situacao") == "rejected", F.lit("arquivo: invalid_file"))
    # a refused archive has one row, every refused or ignored member its own
    refused = (recordings.where("situacao <> 'accepted'")
               .select("item_id", F.lit(None).cast("string").alias("match_id"),
                       F.when(F.col("situacao") == "ignored", "ignored").when(F.col("situacao") == "no_members", "error").otherwise("rejected").alias("status"),
                       reason.alias("erro_carga"), F.lit(None).cast("bigint").alias("membros"),
                       F.when(F.col("situacao") != "batch_refused", F.col("membro")).alias("membro")).distinct())
    err = F.concat_ws("; ", *[F.when(F.col(c).isNotNull(), F.concat(F.lit(c[5:] + ": "), F.col(c)))
                              for c in ["erro_evento", "erro_fase", "erro_arquivo"]])
    status = (v.join(per_match.unionByName(refused), "item_id", "left")
              .select("request_file", "evento", "fase", "arquivo", "match_id",
                      F.coalesce(F.col("status"), F.lit("rejected")).alias("status"),
                      F.when(~F.col("aceito"), err).otherwise(F.col("erro_carga")).alias("erro"),
                      F.lit(epoch).cast("bigint").alias("epoch"), "membros", "membro"))
    status.write.mode("append").parquet(status_path)


def batch_report(status: DataFrame) -> DataFrame:
    """One row per archive request: matches loaded, skipped and failed,
    recordings accepted, members rejected and ignored."""
    n = lambda cond: F.count_if(cond).alias
    own = status.where(F.lower("arquivo").endswith(".zip"))
    match = F.col("match_id").isNotNull()
    return own.groupBy("epoch", "request_file", "evento", "fase", "arquivo").agg(
        n(match & (F.col("status") == "loaded"))("partidas_carregadas"), n(match & (F.col("status") == "skipped"))("partidas_puladas"),
        n(match & (F.col("status") == "error"))("partidas_com_erro"), F.coalesce(F.sum("membros"), F.lit(0)).alias("membros_aceitos"),
        n(~match & (F.col("status") == "rejected") & F.col("membro").isNotNull())("membros_rejeitados"),
        n(F.col("status") == "ignored")("membros_ignorados"),
        F.max(F.when(~match & F.col("membro").isNull(), F.col("erro"))).alias("recusa"))


def ingest_stream(spark: SparkSession, landing: str, staged_root: str, bronze_root: str, status_path: str,
                  checkpoint: str, clean_source: str | None = None, available_now: bool = True,
                  max_files: int = 100):
    """Start the landing stream; returns the StreamingQuery."""
    reader = (spark.readStream.schema(REQUEST_SCHEMA).option("maxFilesPerTrigger", max_files))
    if clean_source:
        reader = reader.option("cleanSource", clean_source)
    reqs = reader.json(landing).withColumn("request_file", F.input_file_name())
    writer = (reqs.writeStream.option("checkpointLocation", checkpoint)
              .foreachBatch(lambda df, epoch: land_requests(df, epoch, staged_root, bronze_root, status_path)))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def read_status(spark: SparkSession, status_path: str) -> DataFrame:
    return spark.read.schema(STATUS_SCHEMA).parquet(status_path)

