"""Write-side operators as queries: each performs its writes in a fresh
folder below the shared checkpoint folder and returns a table read back, so
its result can be compared with SQL over the same inputs.

Every query goes through the sequence that its operator has to withstand: a
repeated write, a reload that fails, a reload followed by a plain build."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import fresh_scratch_path
from ..sources import bronze as B
from ..streaming import landing as L
from . import build as BLD
from .catalog import Workspace

FIRST_CUP, OTHER_CUPS = "match_id LIKE 'cup-a/%'", "match_id NOT LIKE 'cup-a/%'"
KILL_COLUMNS = ["match_id", "round_num", "tick", "weapon", "victim_steamid"]
_KILLS_SQL = "SELECT match_id, round_num, tick, weapon, victim_steamid FROM bronze_kills"


def _tables(ws: Workspace, *names: str) -> dict[str, DataFrame]:
    return {t: ws.bronze.table(t) for t in names}


def _land(ws: Workspace, root: str, names: tuple[str, ...], keep=None, mode: str = "overwrite") -> None:
    for t in B.header_last(names):
        df = ws.bronze.table(t)
        B.write_bronze(df if keep is None else df.where(keep), root, t, mode=mode)


def bronze_write(ws: Workspace) -> DataFrame:
    """Kills written, and half of the matches written again: a repeated
    landing replaces its matches, it does not double them."""
    root = fresh_scratch_path(ws.spark, "bronze-write")
    _land(ws, root, ("kills",))
    _land(ws, root, ("kills",), FIRST_CUP)
    return B.bronze_scan(ws.spark, root, "kills").select(KILL_COLUMNS)


def bronze_layouts(ws: Workspace) -> DataFrame:
    """Half of the matches in partition folders, half in files at
    ``<evento>/<fase>/<confronto>.parquet``: one scan reads both."""
    root = fresh_scratch_path(ws.spark, "bronze-layouts")
    kills = ws.bronze.table("kills")
    B.write_bronze(kills.where(FIRST_CUP), root, "kills")
    B.write_flat_bronze(kills.where(OTHER_CUPS), root, "kills")
    return B.bronze_scan(ws.spark, root, "kills").select(KILL_COLUMNS)


def reload_match(ws: Workspace) -> DataFrame:
    """One tournament is reloaded with the kills of even rounds only; before
    that a reload of the other one fails for want of headers."""
    root = fresh_scratch_path(ws.spark, "reload")
    names = ("header", "kills")
    _land(ws, root, names)
    own = _tables(ws, *names)
    ids = own["header"].select("match_id").distinct()
    try:
        B.replace_match(ws.spark, root, {"header": own["header"].limit(0), "kills": own["kills"].limit(0)}, ids.where(OTHER_CUPS))
    except B.NothingStaged:
        pass
    own["kills"] = own["kills"].where(F.col("round_num").cast("int") % 2 == 0)
    B.replace_match(ws.spark, root, own, ids.where(FIRST_CUP))
    return B.bronze_scan(ws.spark, root, "kills").select(KILL_COLUMNS)


def landing_ingest(ws: Workspace) -> DataFrame:
    """Requests for one tournament's recordings, some twice, through the
    landing stream; the kills it landed."""
    base = fresh_scratch_path(ws.spark, "ingest")
    staged, requests = f"{base}/staged", f"{base}/requests"
    for t in ("header", "rounds", "kills", "cvars"):
        # in the order of the matches: few files, pruned by match
        (ws.bronze.table(t).withColumn("caminho", F.concat("match_id", F.lit(".dem"))).repartitionByRange("match_id")
         .sortWithinPartitions("match_id").write.parquet(f"{staged}/{t}"))
    wanted = ws.bronze.table("header").where(FIRST_CUP).select(
        F.split_part("match_id", F.lit("/"), F.lit(1)).alias("evento"), F.split_part("match_id", F.lit("/"), F.lit(2)).alias("fase"),
        F.concat(F.split_part("match_id", F.lit("/"), F.lit(3)), F.lit(".dem")).alias("arquivo"))
    for _ in range(2):                   # the second round finds every match loaded
        wanted.write.mode("append").json(requests)
        L.ingest_stream(ws.spark, requests, staged, f"{base}/bronze", f"{base}/status", f"{base}/checkpoint").awaitTermination()
    return B.bronze_scan(ws.spark, f"{base}/bronze", "kills").select(KILL_COLUMNS)


def batch_report(ws: Workspace) -> DataFrame:
    """One archive per product type, its members the type's manifest rows; a
    quarter of the members have staged rows, so some matches load and others
    are reported as errors."""
    base = fresh_scratch_path(ws.spark, "batches")
    rows = ws.fixtures.manifest().select("item_id", F.replace("evento", F.lit(" "), F.lit("-")).alias("evento"), F.lit("final").alias("fase"),
                                         F.concat_ws("/", "fase", "arquivo").alias("entrada"))
    path = F.concat_ws("/", "evento", "fase", F.lit("lote.zip"))
    rows.select(path.alias("caminho"), "entrada").write.parquet(f"{base}/staged/members")
    decoded = rows.where("item_id % 4 = 0").select(F.concat_ws("/", "evento", "fase", F.substring_index("entrada", "/", -1)).alias("caminho"))
    decoded.select(F.lit("de_nuke").alias("map_name"), "caminho").write.parquet(f"{base}/staged/header")
    decoded.select(F.lit("1").alias("round_num"), F.lit("90").alias("official_end"), "caminho").write.parquet(f"{base}/staged/rounds")
    requests = rows.select("evento", "fase", F.lit("lote.zip").alias("arquivo"), F.lit(False).alias("forcar")).distinct()
    L.land_requests(requests.withColumn("request_file", F.lit("r")), 0, f"{base}/staged", f"{base}/bronze", f"{base}/status")
    return L.batch_report(L.read_status(ws.spark, f"{base}/status")).select(
        "evento", "partidas_carregadas", "partidas_com_erro", "membros_aceitos", "membros_rejeitados", "membros_ignorados", "recusa")


_BATCH_SQL = """
WITH e AS (SELECT item_id, replace(evento, ' ', '-') AS evento, concat_ws('/', fase, arquivo) AS entrada,
  regexp_extract(concat_ws('/', fase, arquivo), '([^/]*)$', 1) AS nome FROM manifest
  WHERE NOT concat_ws('/', fase, arquivo) LIKE '%/'),
n AS (SELECT evento, count(*) AS entradas FROM e GROUP BY evento),
s AS (SELECT e.*, CASE WHEN entradas > 200 THEN 'refused' WHEN NOT lower(nome) LIKE '%.dem' THEN 'ignored'
  WHEN NOT regexp_matches(nome, '^[A-Za-z0-9_-]+\\.dem$') THEN 'rejected' ELSE 'accepted' END AS status,
  regexp_replace(regexp_replace(nome, '\\.dem$', ''), '-p[0-9]+$', '') AS jogo, item_id % 4 = 0 AS decodificado FROM e JOIN n USING (evento)),
m AS (SELECT evento, jogo, max(CASE WHEN decodificado THEN 1 ELSE 0 END) AS chegou FROM s WHERE status = 'accepted' GROUP BY evento, jogo)
SELECT n.evento, (SELECT count(*) FROM m WHERE m.evento = n.evento AND chegou = 1) AS partidas_carregadas,
  (SELECT count(*) FROM m WHERE m.evento = n.evento AND chegou = 0) AS partidas_com_erro,
  (SELECT count(*) FROM s WHERE s.evento = n.evento AND status = 'accepted') AS membros_aceitos,
  (SELECT count(DISTINCT entrada) FROM s WHERE s.evento = n.evento AND status = 'rejected') AS membros_rejeitados,
  (SELECT count(DISTINCT entrada) FROM s WHERE s.evento = n.evento AND status = 'ignored') AS membros_ignorados,
  CASE WHEN entradas > 200 THEN 'too many entries' END AS recusa
FROM n"""


def incremental_append(ws: Workspace) -> DataFrame:
    """Silver rounds after two landings with a build each, and a third build
    without news."""
    lake = BLD.Lake(ws.spark, fresh_scratch_path(ws.spark, "append"))
    for keep in (FIRST_CUP, OTHER_CUPS):
        _land(ws, f"{lake.root}/bronze", ("header", "rounds", "cvars"), keep)
        BLD.build(lake, ["silver_rounds"])
    BLD.build(lake, ["silver_rounds"])
    return lake.read_silver("rounds").drop(*BLD.AUDIT)


def incremental_upsert(ws: Workspace) -> DataFrame:
    """A fact of which one tournament was first landed with the bomb events of
    even rounds only; after its reload a plain build replaces those rows."""
    lake = BLD.Lake(ws.spark, fresh_scratch_path(ws.spark, "upsert"))
    names, models = ("header", "rounds", "cvars", "bomb"), ["silver_bomb", "bomba_jogador_partida"]
    own = _tables(ws, *names)
    for t in B.header_last(names):
        partial = f"{OTHER_CUPS} OR CAST(round_num AS INT) % 2 = 0"
        B.write_bronze(own[t].where(partial) if t == "bomb" else own[t], f"{lake.root}/bronze", t)
    BLD.build(lake, models)
    B.replace_match(ws.spark, f"{lake.root}/bronze", own, own["header"].where(FIRST_CUP).select("match_id"))
    BLD.build(lake, models)
    return lake.read_gold("bomba_jogador_partida").drop(*BLD.AUDIT)


def full_refresh(ws: Workspace) -> DataFrame:
    """Silver rounds after one tournament's matches left bronze: a full
    refresh drops them, and the build after it adds nothing."""
    lake = BLD.Lake(ws.spark, fresh_scratch_path(ws.spark, "refresh"))
    _land(ws, f"{lake.root}/bronze", ("header", "rounds", "cvars"))
    BLD.build(lake, ["silver_rounds"])
    gone = ws.bronze.table("header").where(FIRST_CUP).select("match_id").distinct()
    B.drop_matches(ws.spark, f"{lake.root}/bronze", gone)
    BLD.build(lake, ["silver_rounds"], full_refresh=True)
    BLD.build(lake, ["silver_rounds"])
    return lake.read_silver("rounds").drop(*BLD.AUDIT)


def gold_scan(ws: Workspace) -> DataFrame:
    """A fact published twice, read through the pointer."""
    lake = BLD.Lake(ws.spark, fresh_scratch_path(ws.spark, "publish"))
    _land(ws, f"{lake.root}/bronze", ("header", "rounds", "cvars", "bomb"))
    BLD.build(lake, ["silver_bomb", "bomba_jogador_partida"])
    for _ in range(2):
        BLD.publish(lake, names=["bomba_jogador_partida"])
    return BLD.gold_scan(ws.spark, f"{lake.root}/publish", "bomba_jogador_partida").drop(*BLD.AUDIT)


QUERIES = {
    "bronze_write": (_KILLS_SQL, bronze_write),
    "bronze_layouts": (_KILLS_SQL, bronze_layouts),
    "reload_match": (f"{_KILLS_SQL} WHERE {OTHER_CUPS} OR CAST(round_num AS INTEGER) % 2 = 0", reload_match),
    "landing_ingest": (f"{_KILLS_SQL} WHERE {FIRST_CUP}", landing_ingest),
    "batch_report": (f"SELECT * FROM ({_BATCH_SQL.strip()}) q", batch_report),
    "incremental_append": ("SELECT * FROM s_rounds", incremental_append),
    "incremental_upsert": ("SELECT * FROM g_bomba", incremental_upsert),
    "full_refresh": (f"SELECT * FROM s_rounds WHERE {OTHER_CUPS}", full_refresh),
    "gold_scan": ("SELECT * FROM g_bomba", gold_scan),
}
