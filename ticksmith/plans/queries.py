"""Registry of every query: a Spark builder and (where SQL can state it)
the reference SQL.  Builders take a :class:`Workspace` and return a lazy
DataFrame; nothing here collects.  Audit columns (load / transform
stamps) are left out of results, they depend on the run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import (blank, grenade_category, opposite_side, safe_ratio, tick_to_seconds, to_bigint,
                                 to_bool, to_double, to_int, to_u64)
from ..operators import clutch as C
from ..operators import facts as G
from ..operators import pages as P
from ..operators import quality as Q
from ..operators import ranking as R
from ..operators import silver as S
from ..schemas import ALL_TABLES, CLOCKED_TABLES, COLUMNS
from ..sources import bronze as B
from ..sources import stitch as ST
from ..sources.fixture_sql import PARTS_OF_EVERY
from . import oracle as O
from .catalog import Workspace

Builder = Callable[[Workspace], DataFrame]
REGISTRY: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        REGISTRY[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _silver(ws: Workspace, t: str) -> DataFrame:
    return ws.silver.table(t).drop("_carregado_em")


def _steps(ws: Workspace) -> C.ClutchSteps:
    if not hasattr(ws, "_clutch"):
        ws._clutch = C.ClutchSteps(ws.gold.digest, ws.silver.table("kills"), ws.silver.table("rounds"),
                                   ws.gold.players)
    return ws._clutch


# ================================================================ silver (2.3)

for _t in COLUMNS:
    register(f"silver_{_t}", f"SELECT * FROM s_{_t}")(lambda ws, _t=_t: _silver(ws, _t))

register("tick_rate", "SELECT * FROM o_rate")(lambda ws: ws.silver.rate)
register("round_start", "SELECT * FROM o_round_start")(lambda ws: S.round_start(ws.bronze.table("rounds")))
register("restart_artifacts", "SELECT match_id, round_num, tick, CAST(qtd AS BIGINT) AS qtd FROM o_restart")(
    lambda ws: S.restart_artifacts(ws.bronze.table("kills")))


@register("tick_rate_first_round", """
SELECT f.match_id, f.d / v.v::DOUBLE AS taxa_de_tick
FROM (SELECT match_id, d FROM (SELECT match_id, freeze_end - start AS d,
        row_number() OVER (PARTITION BY match_id ORDER BY round_num, freeze_end - start NULLS FIRST) AS rn
      FROM s_rounds WHERE round_num IS NOT NULL) x WHERE rn = 1) f
JOIN (SELECT c.match_id, min(c.value) AS v FROM s_cvars c
      JOIN (SELECT match_id, min(tick) AS mt FROM s_cvars WHERE name = 'mp_freezetime' AND tick IS NOT NULL GROUP BY 1) m
        ON m.match_id = c.match_id AND c.tick = m.mt
      WHERE c.name = 'mp_freezetime' GROUP BY c.match_id) v ON v.match_id = f.match_id""")
def q_tick_rate_first_round(ws):
    return S.tick_rate_first_round(ws.silver.table("rounds"), ws.silver.table("cvars"))


# ================================================================ gold (2.6)

for _name, _cte in O.GOLD_NAMES.items():
    register(_name, f"SELECT * FROM {_cte}")(lambda ws, _name=_name: ws.gold.table(_name))


@register("headshots_by_place", """
SELECT d.evento, d.fase, d.mapa, k.attacker_steamid AS steamid, k.attacker_place AS place, count(*) AS headshots
FROM s_kills k JOIN g_dim_partida d ON d.match_id = k.match_id
WHERE k.headshot AND k.attacker_steamid IS NOT NULL AND k.attacker_side <> k.victim_side
GROUP BY 1, 2, 3, 4, 5""")
def q_headshots_by_place(ws):
    return G.headshots_by_place(ws.silver.table("kills"), ws.gold.table("dim_partida"))


@register("headshots_by_place_playoffs", """
SELECT d.evento, d.fase, d.mapa, k.attacker_steamid AS steamid, k.attacker_place AS place, count(*) AS headshots
FROM s_kills k JOIN g_dim_partida d ON d.match_id = k.match_id
WHERE k.headshot AND k.attacker_steamid IS NOT NULL AND k.attacker_side <> k.victim_side
  AND k.attacker_place = 'BombsiteB' AND d.mapa = 'de_mirage' AND d.fase IN ('semi-final', 'final')
GROUP BY 1, 2, 3, 4, 5""")
def q_headshots_playoffs(ws):
    return G.headshots_by_place(ws.silver.table("kills"), ws.gold.table("dim_partida"), place="BombsiteB",
                                mapa="de_mirage", fases=["semi-final", "final"])


@register("tick_digest", """
SELECT match_id, round_num, side, steamid, place, count(*) AS qtd_ticks, min(name) AS nome
FROM s_ticks GROUP BY 1, 2, 3, 4, 5""")
def q_tick_digest(ws):
    return ws.gold.digest


# ================================================================ clutch chain (2.7)

register("round_roster", "SELECT * FROM c_roster")(lambda ws: _steps(ws).roster)
register("round_roster_names", "SELECT * FROM c_roster_names")(lambda ws: _steps(ws).roster_names)
register("deaths_per_tick", "SELECT * FROM c_deaths")(lambda ws: _steps(ws).deaths)
register("alive_running", """
SELECT match_id, round_num, side, tick, mortes_no_tick, tam_time, CAST(vivos AS BIGINT) AS vivos FROM c_alive""")(
    lambda ws: _steps(ws).alive)
register("lone_moment", "SELECT * FROM c_lone")(lambda ws: _steps(ws).lone)
register("last_survivor", "SELECT * FROM c_survivor")(lambda ws: _steps(ws).survivors)
_SITUATION_SQL = """
SELECT match_id, round_num, side, steamid, nome, CAST(inimigos_vivos AS BIGINT) AS inimigos_vivos FROM c_situation"""
register("clutch_situations", _SITUATION_SQL)(lambda ws: _steps(ws).situations)
register("clutch_outcomes", """
SELECT match_id, round_num, side, steamid, nome, CAST(inimigos_vivos AS BIGINT) AS inimigos_vivos, venceu
FROM c_outcome""")(lambda ws: _steps(ws).outcomes)
register("clutch_aggregate", "SELECT * FROM g_clutches")(lambda ws: _steps(ws).result)

# ================================================================ joins (2.4)

# the same rules as last_survivor and clutch_situations, as running totals over probes and events
register("anti_range", "SELECT * FROM c_survivor")(
    lambda ws: C.survivors_asof(_steps(ws).lone, _steps(ws).roster_names, ws.silver.table("kills")))
register("correlated_scalar", _SITUATION_SQL)(
    lambda ws: C.situations_asof(_steps(ws).lone, _steps(ws).roster, _steps(ws).roster_names, _steps(ws).deaths, ws.silver.table("kills")))


@register("inner_using", """
SELECT t.match_id, count(*) AS n_ticks, r.taxa_de_tick
FROM s_ticks t JOIN o_rate r USING (match_id) GROUP BY t.match_id, r.taxa_de_tick""")
def q_inner_using(ws):
    per = ws.silver.table("ticks").groupBy("match_id").agg(F.count(F.lit(1)).alias("n_ticks"))
    return per.join(ws.silver.rate, "match_id").select("match_id", "n_ticks", "taxa_de_tick")


@register("inner_on_multi", """
SELECT a.match_id, a.round_num, a.side, a.tam_time, b.tam_time AS tam_op
FROM c_roster a JOIN c_roster b ON b.match_id = a.match_id AND b.round_num = a.round_num
  AND b.side = CASE WHEN a.side = 'ct' THEN 't' ELSE 'ct' END""")
def q_inner_on_multi(ws):
    r = _steps(ws).roster
    a, b = r.alias("a"), r.alias("b")
    cond = ((F.col("a.match_id") == F.col("b.match_id")) & (F.col("a.round_num") == F.col("b.round_num"))
            & (F.col("b.side") == opposite_side(F.col("a.side"))))
    return a.join(b, cond).select("a.match_id", "a.round_num", "a.side", "a.tam_time",
                                  F.col("b.tam_time").alias("tam_op"))


@register("left_using", """
SELECT j.match_id, j.steamid, j.nome, CAST(COALESCE(k.n, 0) AS BIGINT) AS abates
FROM g_players j LEFT JOIN (SELECT match_id, attacker_steamid AS steamid, count(*) AS n FROM s_kills
  WHERE attacker_steamid IS NOT NULL GROUP BY 1, 2) k USING (match_id, steamid)""")
def q_left_using(ws):
    k = (ws.silver.table("kills").where(F.col("attacker_steamid").isNotNull())
         .groupBy("match_id", F.col("attacker_steamid").alias("steamid")).agg(F.count(F.lit(1)).alias("n")))
    return (ws.gold.players.join(k, ["match_id", "steamid"], "left")
            .select("match_id", "steamid", "nome", F.coalesce("n", F.lit(0).cast("bigint")).alias("abates")))


@register("left_on_expr", """
SELECT b.match_id, NULLIF(TRIM(b.round_num), '')::INTEGER AS round_num, NULLIF(TRIM(b.tick), '')::INTEGER AS tick,
  rs.round_start_tick
FROM bronze_bomb b LEFT JOIN o_round_start rs ON rs.match_id = b.match_id
  AND rs.round_num = NULLIF(TRIM(b.round_num), '')::INTEGER""")
def q_left_on_expr(ws):
    b = ws.bronze.table("bomb").select("match_id", to_int(blank("round_num")).alias("round_num"),
                                        to_int(blank("tick")).alias("tick"))
    return b.join(S.round_start(ws.bronze.table("rounds")), ["match_id", "round_num"], "left")


@register("anti_left_null", """
SELECT b.match_id, NULLIF(TRIM(b.round_num), '')::INTEGER AS round_num, NULLIF(TRIM(b.tick), '')::INTEGER AS tick,
  NULLIF(TRIM(b.victim_steamid), '')::BIGINT AS victim_steamid
FROM bronze_kills b LEFT JOIN o_restart r ON r.match_id = b.match_id
  AND r.round_num = NULLIF(TRIM(b.round_num), '')::INTEGER AND r.tick = NULLIF(TRIM(b.tick), '')::INTEGER
WHERE r.match_id IS NULL""")
def q_anti_left_null(ws):
    k = ws.bronze.table("kills").select("match_id", to_int(blank("round_num")).alias("round_num"),
                                         to_int(blank("tick")).alias("tick"),
                                         to_bigint(blank("victim_steamid")).alias("victim_steamid"))
    art = S.restart_artifacts(ws.bronze.table("kills")).select("match_id", "round_num", "tick")
    return k.join(art, ["match_id", "round_num", "tick"], "left_anti")


@register("not_in_subquery", """
SELECT match_id, NULLIF(TRIM(map_name), '') AS map_name FROM bronze_header
WHERE match_id NOT IN (SELECT DISTINCT match_id FROM bronze_cvars)""")
def q_not_in_subquery(ws):
    seen = ws.bronze.table("cvars").select("match_id").where(F.col("match_id").isNotNull()).distinct()
    return (ws.bronze.table("header").join(seen, "match_id", "left_anti")
            .select("match_id", blank("map_name").alias("map_name")))


# ================================================================ aggregations (2.5)


@register("count_star", "SELECT match_id, count(*) AS n_kills FROM s_kills GROUP BY match_id")
def q_count_star(ws):
    return ws.silver.table("kills").groupBy("match_id").agg(F.count(F.lit(1)).alias("n_kills"))


@register("count_filter", """
SELECT match_id, count(*) FILTER (WHERE headshot) AS n_hs, count(*) FILTER (WHERE weapon = 'world') AS n_world
FROM s_kills GROUP BY match_id""")
def q_count_filter(ws):
    k = ws.silver.table("kills")
    return k.groupBy("match_id").agg(F.count_if(F.col("headshot")).alias("n_hs"),
                                     F.count_if(F.col("weapon") == "world").alias("n_world"))


@register("count_distinct", "SELECT match_id, side, count(DISTINCT steamid) AS jogadores FROM s_ticks GROUP BY 1, 2")
def q_count_distinct(ws):
    return ws.silver.table("ticks").groupBy("match_id", "side").agg(F.count_distinct("steamid").alias("jogadores"))


@register("sum_int", """
SELECT match_id, CAST(sum(dmg_health_real) AS BIGINT) AS dano, CAST(sum(dmg_health) AS BIGINT) AS dano_bruto
FROM s_damages GROUP BY match_id""")
def q_sum_int(ws):
    return ws.silver.table("damages").groupBy("match_id").agg(F.sum("dmg_health_real").alias("dano"),
                                                               F.sum("dmg_health").alias("dano_bruto"))


@register("sum_double", "SELECT steamid, sum(segundos_no_local) AS segundos FROM g_posicionamento GROUP BY steamid")
def q_sum_double(ws):
    return (ws.gold.table("posicionamento_jogador_partida").groupBy("steamid")
            .agg(F.sum("segundos_no_local").alias("segundos")))


@register("min", "SELECT match_id, steamid, min(round_num) AS primeiro_round FROM s_ticks GROUP BY 1, 2")
def q_min(ws):
    return ws.silver.table("ticks").groupBy("match_id", "steamid").agg(F.min("round_num").alias("primeiro_round"))


@register("any_value", "SELECT * FROM g_players")
def q_any_value(ws):
    return ws.gold.players


@register("mode", "SELECT * FROM o_freeze")
def q_mode(ws):
    r = ws.bronze.table("rounds")
    return (r.select("match_id", (to_int(blank("freeze_end")) - to_int(blank("start"))).alias("d"))
            .groupBy("match_id").agg(F.mode("d", True).alias("ticks_de_freeze")))


@register("having", """
SELECT match_id, round_num, count(*) AS n FROM s_kills GROUP BY 1, 2 HAVING count(*) > 3""")
def q_having(ws):
    return (ws.silver.table("kills").groupBy("match_id", "round_num").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 3))


_CATEGORY_SQL = """CASE WHEN grenade_type LIKE '%HEGrenade%' THEN 'HE' WHEN grenade_type LIKE '%Flashbang%' THEN 'Flash'
  WHEN grenade_type LIKE '%SmokeGrenade%' THEN 'Smoke' WHEN grenade_type LIKE '%Molotov%' THEN 'Molotov'
  WHEN grenade_type LIKE '%Incendiary%' THEN 'Incendiary' WHEN grenade_type LIKE '%Decoy%' THEN 'Decoy'
  ELSE grenade_type END"""


@register("group_by_alias", f"SELECT {_CATEGORY_SQL} AS categoria, count(*) AS n FROM s_grenades GROUP BY 1")
def q_group_by_alias(ws):
    return (ws.silver.table("grenades").withColumn("categoria", grenade_category("grenade_type"))
            .groupBy("categoria").agg(F.count(F.lit(1)).alias("n")))


@register("dedup_group", f"""
SELECT match_id, count(*) AS granadas FROM (SELECT match_id, entity_id, round_num, thrower_steamid, {_CATEGORY_SQL} AS c
  FROM s_grenades GROUP BY 1, 2, 3, 4, 5) u GROUP BY match_id""")
def q_dedup_group(ws):
    g = ws.silver.table("grenades")
    return (g.groupBy("match_id", "entity_id", "round_num", "thrower_steamid",
                      grenade_category("grenade_type").alias("c")).agg(F.count(F.lit(1)).alias("_n"))
            .groupBy("match_id").agg(F.count(F.lit(1)).alias("granadas")))


# ================================================================ scalar groups (2.2)


@register("blank_to_null", """
SELECT DISTINCT place AS bruto, NULLIF(TRIM(place), '') AS limpo FROM bronze_ticks""")
def q_blank_to_null(ws):
    return ws.bronze.table("ticks").select(F.col("place").alias("bruto"), blank("place").alias("limpo")).distinct()


@register("scalar_casts", """
SELECT match_id, NULLIF(TRIM(tick), '')::INTEGER AS tick_i, NULLIF(TRIM(victim_steamid), '')::BIGINT AS vitima,
  NULLIF(TRIM(distance), '')::DOUBLE AS distancia, NULLIF(TRIM(weapon_fauxitemid), '')::DECIMAL(20,0) AS faux,
  LOWER(NULLIF(TRIM(headshot), ''))::BOOLEAN AS hs, NULLIF(TRIM(assister_steamid), '')::BIGINT AS assistente
FROM bronze_kills""")
def q_scalar_casts(ws):
    k = ws.bronze.table("kills")
    return k.select("match_id", to_int(blank("tick")).alias("tick_i"), to_bigint(blank("victim_steamid")).alias("vitima"),
                    to_double(blank("distance")).alias("distancia"), to_u64(blank("weapon_fauxitemid")).alias("faux"),
                    to_bool(blank("headshot")).alias("hs"), to_bigint(blank("assister_steamid")).alias("assistente"))


@register("tick_to_seconds", """
SELECT match_id, round_num, tick, segundos_desde_inicio_round FROM s_shots""")
def q_tick_to_seconds(ws):
    return _silver(ws, "shots").select("match_id", "round_num", "tick", "segundos_desde_inicio_round")


@register("scalar_case_coalesce", """
SELECT match_id, steamid, CASE WHEN kills > 0 THEN 'ativo' ELSE 'sem_kills' END AS perfil,
  COALESCE(hs_pct, 0.0) AS hs_pct_zero, headshots::DOUBLE / NULLIF(kills, 0) AS razao,
  CASE WHEN team_kills > 0 THEN 'ct' ELSE 't' END AS lado, CASE WHEN team_kills > 0 THEN 't' ELSE 'ct' END AS oposto
FROM g_combate""")
def q_scalar_case_coalesce(ws):
    c = ws.gold.table("combate_jogador_partida")
    lado = F.when(F.col("team_kills") > 0, "ct").otherwise("t")
    return c.select("match_id", "steamid",
                    F.when(F.col("kills") > 0, "ativo").otherwise("sem_kills").alias("perfil"),
                    F.coalesce("hs_pct", F.lit(0.0)).alias("hs_pct_zero"),
                    safe_ratio("headshots", "kills").alias("razao"), lado.alias("lado"),
                    opposite_side(lado).alias("oposto"))


@register("scalar_predicates", """
SELECT match_id, round_num, tick, weapon, victim_side,
  attacker_steamid IS NULL AS sem_atacante, attacker_side = victim_side AS mesmo_lado,
  attacker_side <> victim_side AS lados_diferentes, weapon IN ('world', 'planted_c4') AS nao_arma,
  tick <= 20000 AS ate_r1, NOT headshot AS sem_hs, (headshot OR weapon = 'world') AS hs_ou_mundo
FROM s_kills WHERE weapon NOT IN ('planted_c4') OR attacker_steamid IS NULL""")
def q_scalar_predicates(ws):
    k = ws.silver.table("kills")
    return (k.where(~F.col("weapon").isin("planted_c4") | F.col("attacker_steamid").isNull())
            .select("match_id", "round_num", "tick", "weapon", "victim_side",
                    F.col("attacker_steamid").isNull().alias("sem_atacante"),
                    (F.col("attacker_side") == F.col("victim_side")).alias("mesmo_lado"),
                    (F.col("attacker_side") != F.col("victim_side")).alias("lados_diferentes"),
                    F.col("weapon").isin("world", "planted_c4").alias("nao_arma"),
                    (F.col("tick") <= 20000).alias("ate_r1"), (~F.col("headshot")).alias("sem_hs"),
                    (F.col("headshot") | (F.col("weapon") == "world")).alias("hs_ou_mundo")))


@register("scalar_strings", """
SELECT match_id, split_part(match_id, '/', 1) AS p1, split_part(match_id, '/', 3) AS p3,
  split_part(match_id, '/', 4) AS p4, replace(map_name, 'de_', '') AS slug,
  regexp_extract(match_id, '-m([0-9]+)-', 1) AS jogo, regexp_replace(match_id, '-' || replace(map_name, 'de_', '') || '$', '') AS sem_mapa,
  match_id || '#' || map_name AS chave
FROM s_header""")
def q_scalar_strings(ws):
    h = ws.silver.table("header")
    slug = F.replace(F.col("map_name"), F.lit("de_"), F.lit(""))
    mid = F.col("match_id")
    return h.select("match_id", F.split_part(mid, F.lit("/"), F.lit(1)).alias("p1"),
                    F.split_part(mid, F.lit("/"), F.lit(3)).alias("p3"),
                    F.split_part(mid, F.lit("/"), F.lit(4)).alias("p4"), slug.alias("slug"),
                    F.regexp_extract(mid, "-m([0-9]+)-", 1).alias("jogo"),
                    F.regexp_replace(mid, F.concat(F.lit("-"), slug, F.lit("$")), F.lit("")).alias("sem_mapa"),
                    F.concat(mid, F.lit("#"), F.col("map_name")).alias("chave"))


@register("not_in_list", """
SELECT grenade_type, count(*) AS n FROM bronze_grenades
WHERE NULLIF(TRIM(grenade_type), '') NOT IN ('CKnife', 'CWeaponGlock', 'CWeaponHKP2000', 'CC4') GROUP BY 1""")
def q_not_in_list(ws):
    g = ws.bronze.table("grenades")
    return (g.where(~blank("grenade_type").isin(S.NON_GRENADE_ENTITIES)).groupBy("grenade_type")
            .agg(F.count(F.lit(1)).alias("n")))


@register("distinct_rows", "SELECT DISTINCT match_id FROM s_bomb")
def q_distinct_rows(ws):
    return ws.silver.table("bomb").select("match_id").distinct()


# ---------------------------------------------------------------- one key per scalar primitive (2.2)


def _scalar(key: str, table: str, layer: str, cols) -> None:
    """Register a projection of single-column primitives over one table;
    ``cols`` = [(alias, spark column factory, SQL expression)]."""
    src = f"bronze_{table}" if layer == "bronze" else f"s_{table}"
    sql = "SELECT match_id, " + ", ".join(f"{e} AS {a}" for a, _, e in cols) + f" FROM {src}"

    def build(ws):
        df = ws.bronze.table(table) if layer == "bronze" else ws.silver.table(table)
        return df.select("match_id", *[fn().alias(a) for a, fn, _ in cols])
    register(key, sql)(build)


def _nt(c):
    return f"NULLIF(TRIM({c}), '')"


_scalar("cast_int", "ticks", "bronze", [("health", lambda: to_int(blank("health")), f"{_nt('health')}::INTEGER"),
                                        ("tick", lambda: to_int(blank("tick")), f"{_nt('tick')}::INTEGER")])
_scalar("cast_bigint", "ticks", "bronze", [("steamid", lambda: to_bigint(blank("steamid")), f"{_nt('steamid')}::BIGINT")])
_scalar("cast_double", "ticks", "bronze", [("x", lambda: to_double(blank("X")), f"{_nt('X')}::DOUBLE"),
                                           ("y", lambda: to_double(blank("Y")), f"{_nt('Y')}::DOUBLE"),
                                           ("z", lambda: to_double(blank("Z")), f"{_nt('Z')}::DOUBLE")])
_scalar("cast_string", "bomb", "bronze", [("name", lambda: blank("name").cast("string"), f"{_nt('name')}::VARCHAR")])
_scalar("cast_ubigint", "kills", "bronze", [("faux", lambda: to_u64(blank("weapon_fauxitemid")),
                                             f"{_nt('weapon_fauxitemid')}::DECIMAL(20,0)")])
_scalar("text_to_bool", "header", "bronze", [
    ("entities", lambda: to_bool(blank("allow_clientside_entities")), f"LOWER({_nt('allow_clientside_entities')})::BOOLEAN"),
    ("particles", lambda: to_bool(blank("allow_clientside_particles")), f"LOWER({_nt('allow_clientside_particles')})::BOOLEAN")])
_scalar("text_to_timestamp", "header", "bronze", [
    ("carregado_em", lambda: blank("_carregado_em").cast("timestamp_ntz").cast("string"),
     f"{_nt('_carregado_em')}::TIMESTAMP::VARCHAR")])
_scalar("now_stamp", "header", "bronze", [("carimbado", lambda: F.current_timestamp().isNotNull(), "now() IS NOT NULL")])
_scalar("const_column", "header", "bronze", [("camada", lambda: F.lit("silver"), "'silver'")])
_scalar("in_list", "bomb", "silver", [("plant_ou_defuse", lambda: F.col("event").isin("plant", "defuse"),
                                       "event IN ('plant', 'defuse')")])
_scalar("eq", "kills", "silver", [("suicidio", lambda: F.col("attacker_steamid") == F.col("victim_steamid"),
                                   "attacker_steamid = victim_steamid")])
_scalar("neq", "kills", "silver", [("lados_diferentes", lambda: F.col("attacker_side") != F.col("victim_side"),
                                    "attacker_side <> victim_side")])
_scalar("is_null", "kills", "silver", [("sem_atacante", lambda: F.col("attacker_steamid").isNull(),
                                        "attacker_steamid IS NULL")])
_scalar("is_not_null", "kills", "silver", [("com_assistente", lambda: F.col("assister_steamid").isNotNull(),
                                            "assister_steamid IS NOT NULL")])
_scalar("le", "kills", "silver", [("ate_tick", lambda: F.col("tick") <= F.col("round_num") * 10000 + 2000,
                                   "tick <= round_num * 10000 + 2000")])
_scalar("ge", "kills", "silver", [("desde_tick", lambda: F.col("tick") >= F.col("round_num") * 10000 + 2000,
                                   "tick >= round_num * 10000 + 2000")])
_scalar("and", "kills", "silver", [("hs_inimigo", lambda: F.col("headshot") & (F.col("attacker_side") != F.col("victim_side")),
                                    "headshot AND attacker_side <> victim_side")])
_scalar("or", "kills", "silver", [("hs_ou_mundo", lambda: F.col("headshot") | (F.col("weapon") == "world"),
                                   "headshot OR weapon = 'world'")])
_scalar("not", "kills", "silver", [("sem_hs", lambda: ~F.col("headshot"), "NOT headshot")])
_scalar("like_bucket", "grenades", "silver", [("categoria", lambda: grenade_category("grenade_type"), _CATEGORY_SQL)])
_scalar("case_when", "ticks", "silver", [
    ("oposto", lambda: opposite_side("side"), "CASE WHEN side = 'ct' THEN 't' ELSE 'ct' END"),
    ("equipe", lambda: F.when(F.col("side") == "ct", "team_a").otherwise("team_b"),
     "CASE WHEN side = 'ct' THEN 'team_a' ELSE 'team_b' END")])
_scalar("coalesce", "kills", "silver", [("assistente_ou_zero", lambda: F.coalesce("assister_steamid", F.lit(0).cast("bigint")),
                                         "COALESCE(assister_steamid, 0)")])
_scalar("safe_ratio", "damages", "silver", [("razao", lambda: safe_ratio("dmg_health_real", "dmg_health"),
                                             "dmg_health_real::DOUBLE / NULLIF(dmg_health, 0)")])
_scalar("split_part", "header", "silver", [
    (f"parte_{i}", (lambda i=i: F.split_part(F.col("match_id"), F.lit("/"), F.lit(i))), f"split_part(match_id, '/', {i})")
    for i in range(1, 5)])
_scalar("replace", "header", "silver", [("slug", lambda: F.replace(F.col("map_name"), F.lit("de_"), F.lit("")),
                                         "replace(map_name, 'de_', '')")])
_scalar("regexp_extract", "header", "silver", [
    ("prefixo", lambda: F.regexp_extract(F.split_part(F.col("match_id"), F.lit("/"), F.lit(3)), G.SERIES_RE, 1),
     "regexp_extract(split_part(match_id, '/', 3), '^(.*)-m[0-9]+-.*$', 1)"),
    ("jogo", lambda: F.regexp_extract(F.split_part(F.col("match_id"), F.lit("/"), F.lit(3)), G.GAME_NUM_RE, 1),
     "regexp_extract(split_part(match_id, '/', 3), '^.*-m([0-9]+)-.*$', 1)")])
_scalar("regexp_replace_dyn", "header", "silver", [
    ("sem_mapa", lambda: F.regexp_replace(F.split_part(F.col("match_id"), F.lit("/"), F.lit(3)),
                                          F.concat(F.lit("-"), F.replace(F.col("map_name"), F.lit("de_"), F.lit("")),
                                                   F.lit("$")), F.lit("")),
     "regexp_replace(split_part(match_id, '/', 3), '-' || replace(map_name, 'de_', '') || '$', '')")])
_scalar("concat_op", "header", "silver", [
    ("chave", lambda: F.concat(F.split_part(F.col("match_id"), F.lit("/"), F.lit(1)), F.lit("/"), F.col("map_name")),
     "split_part(match_id, '/', 1) || '/' || map_name")])


# ================================================================ rankings / pages (2.8)

for _name, _spec in R.ranking_specs().items():
    register(_name, O._ranking_sql(_spec))(
        lambda ws, _spec=_spec: R.rank(ws.gold.table(_spec.fact), _spec, ws.gold.table("dim_partida")))

# (key, page endpoint, filters, page, page size)
PAGE_CASES = [
    ("page_combate", "page_combate", {"mapa": "de_mirage"}, 1, 50),
    ("page_granadas", "page_granadas", {"categoria_granada": "Smoke"}, 1, 50),
    ("page_posicionamento", "page_posicionamento", {"place": "BombsiteA"}, 2, 20),
    ("page_bomba", "page_bomba", {}, 1, 50),
    ("page_partidas", "page_partidas", {"formato": "MD3"}, 1, 50),
    ("page_query", "page_combate", {"evento": "cup-a", "fase": "final"}, 2, 10),
]
for _key, _ep, _flt, _pg, _sz in PAGE_CASES:
    register(_key, O._page_sql(_ep, _flt, _pg, _sz))(
        lambda ws, _ep=_ep, _flt=_flt, _pg=_pg, _sz=_sz: P.page_rows(
            ws.gold.table(P.PAGES[_ep].table), ws.gold.table("dim_partida"), P.PAGES[_ep], _flt, _pg, _sz))


@register("page_deep", O._page_sql("page_granadas", {"fase": "final"}, 3, 20))
def q_page_deep(ws):
    """A numbered page through range counts, as pages far from the start are read."""
    spec = P.PAGES["page_granadas"]
    base = P.whitelist_filter(P.page_base(ws.gold.table(spec.table), ws.gold.table("dim_partida"), spec.join_dim), {"fase": "final"}, spec.filters)
    return P.deep_page(base, spec, 40, 20)


@register("page_keyset", O._page_sql("page_granadas", {"fase": "final"}, 3, 20))
def q_page_keyset(ws):
    """The page that follows the last row of page 2."""
    spec, args = P.PAGES["page_granadas"], (ws.gold.table("granadas_jogador_partida"), ws.gold.table("dim_partida"))
    last = P.page_rows(*args, spec, {"fase": "final"}, 2, 20).collect()[-1:]       # one row of at most one page
    return P.page_after(*args, spec, {"fase": "final"}, last[0].asDict() if last else None, 20)


@register("filter_whitelist", O._page_sql("page_combate", {"mapa": "de_nuke"}, 1, 500))
def q_filter_whitelist(ws):
    # 'kills' and 'bogus' are not filterable columns of this page: ignored
    return P.page_rows(ws.gold.table("combate_jogador_partida"), ws.gold.table("dim_partida"),
                       P.PAGES["page_combate"], {"mapa": "de_nuke", "kills": "3", "bogus": "x"}, 1, 500)


@register("page_envelope", """
SELECT CAST(n AS BIGINT) AS count, 2 AS page, 20 AS page_size,
  CAST(CASE WHEN n > 0 THEN ceil(n / 20.0) ELSE 0 END AS BIGINT) AS total_pages,
  CASE WHEN 2 < CASE WHEN n > 0 THEN ceil(n / 20.0) ELSE 0 END THEN 3 END AS next_page,
  1 AS previous_page
FROM (SELECT count(*) AS n FROM g_combate f JOIN g_dim_partida d ON d.match_id = f.match_id WHERE d.mapa = 'de_mirage') x""")
def q_page_envelope(ws):
    return P.page_envelope(ws.gold.table("combate_jogador_partida"), ws.gold.table("dim_partida"),
                           P.PAGES["page_combate"], {"mapa": "de_mirage"}, 2, 20)


# ================================================================ quality (2.10)

register("dq_report", O._dq_report_sql())(
    lambda ws: Q.generic_report({k: v.drop("_carregado_em") if "_carregado_em" in v.columns else v
                                 for k, v in Q.model_frames(ws.silver, ws.gold).items()}))

_INVARIANT_SQL = {
    "dq_restart_gone": """SELECT match_id, round_num, tick, count(*) AS qtd FROM s_kills
WHERE weapon = 'world' AND attacker_steamid = victim_steamid GROUP BY 1, 2, 3 HAVING count(*) > 1""",
    "dq_rounds_ordered": """SELECT match_id, round_num, start, freeze_end, "end", official_end FROM s_rounds
WHERE NOT (start <= freeze_end AND freeze_end <= "end" AND "end" <= official_end)""",
    "dq_rounds_unique": "SELECT match_id, round_num, count(*) AS qtd FROM s_rounds GROUP BY 1, 2 HAVING count(*) > 1",
    "dq_grenade_xyz": """SELECT grenade_type, count(*) AS linhas_fora_do_padrao FROM s_grenades
WHERE (grenade_type LIKE '%Projectile' AND X IS NULL) OR (grenade_type NOT LIKE '%Projectile' AND X IS NOT NULL)
GROUP BY grenade_type""",
    "dq_combate_unique": "SELECT match_id, steamid, count(*) AS qtd FROM g_combate GROUP BY 1, 2 HAVING count(*) > 1",
    "dq_dim_jogador_unique": "SELECT match_id, steamid, count(*) AS qtd FROM g_dim_jogador GROUP BY 1, 2 HAVING count(*) > 1",
    "dq_granadas_unique": """SELECT match_id, steamid, categoria_granada, count(*) AS qtd FROM g_granadas
GROUP BY 1, 2, 3 HAVING count(*) > 1""",
}


def _invariants(ws):
    if not hasattr(ws, "_inv"):
        ws._inv = Q.invariant_frames(ws.silver, ws.gold)
    return ws._inv


for _name in Q.INVARIANTS:
    register(_name, _INVARIANT_SQL[_name])(lambda ws, _name=_name: _invariants(ws)[_name])

register("dq_invariants", "SELECT * FROM (" + "\nUNION ALL\n".join(
    f"SELECT '{n}' AS model, 'invariant' AS test, CAST(NULL AS VARCHAR) AS column_name, count(*) AS failures "
    f"FROM ({sql}) x" for n, sql in _INVARIANT_SQL.items()) + ") r")(
    lambda ws: Q.invariant_report(_invariants(ws)))


def _null_rate_sql(table: str = "kills") -> str:
    cols = ([c for c, _ in COLUMNS[table]] + ["segundos_desde_inicio_round"] * (table in CLOCKED_TABLES)
            + ["match_id", "_arquivo_origem"] + ["duracao_segundos"] * (table == "rounds"))
    parts = [f"SELECT 'silver_{table}' AS model, '{c}' AS column_name, count(*) FILTER (WHERE \"{c}\" IS NULL) AS nulos, "
             f"count(*) AS linhas FROM s_{table}" for c in cols]
    return ("SELECT model, column_name, CAST(nulos AS BIGINT) AS nulos, CAST(linhas AS BIGINT) AS linhas, "
            "CASE WHEN linhas = 0 THEN NULL ELSE nulos::DOUBLE / linhas::DOUBLE END AS taxa_nulos FROM (\n"
            + "\nUNION ALL\n".join(parts) + "\n) r")


register("dq_null_rate", _null_rate_sql())(lambda ws: Q.dq_null_rate(_silver(ws, "kills"), "silver_kills"))
for _t in ALL_TABLES:
    if _t != "kills":
        register(f"dq_null_rate_{_t}", _null_rate_sql(_t))(lambda ws, _t=_t: Q.dq_null_rate(_silver(ws, _t), f"silver_{_t}"))


# ================================================================ landing (2.1)

_WS = "[ \t\n\r\x0b\x0c]"
_STEM = r"regexp_replace(caminho, '^((?:.*/)?\.*[^./][^/]*?)\.[^./]*$', '\1')"
_IDENT_SQL = f"""
SELECT item_id, caminho, CASE WHEN regexp_matches(stem, '^(.+)-p([0-9]+)$') THEN regexp_extract(stem, '^(.+)-p([0-9]+)$', 1)
    ELSE stem END AS match_id,
  CASE WHEN regexp_matches(stem, '^(.+)-p([0-9]+)$') THEN CAST(regexp_extract(stem, '^(.+)-p([0-9]+)$', 2) AS INTEGER)
    ELSE 1 END AS parte
FROM (SELECT item_id, caminho, {_STEM} AS stem FROM (SELECT item_id, concat_ws('/', evento, fase, arquivo) AS caminho FROM manifest) a) b"""


@register("match_identity", _IDENT_SQL)
def q_match_identity(ws):
    m = B.with_identity(B.manifest_paths(ws.fixtures.manifest()))
    return m.select("item_id", "caminho", "match_id", "parte")


@register("match_parts", f"""
SELECT match_id, parte, caminho, count(*) OVER (PARTITION BY match_id) AS n_partes,
  row_number() OVER (PARTITION BY match_id ORDER BY parte, caminho) AS ordem
FROM ({_IDENT_SQL}) i WHERE caminho LIKE '%.dem'""")
def q_match_parts(ws):
    return B.match_parts(ws.fixtures.manifest())


@register("manifest_validate", f"""
SELECT item_id, evento, fase, arquivo,
  CASE WHEN evento IS NULL OR evento = '' THEN 'required' WHEN NOT regexp_matches(evento, '^[A-Za-z0-9_-]+$') THEN 'invalid_name' END AS erro_evento,
  CASE WHEN fase IS NULL OR fase = '' THEN 'required' WHEN NOT regexp_matches(fase, '^[A-Za-z0-9_-]+$') THEN 'invalid_name' END AS erro_fase,
  CASE WHEN arquivo IS NULL OR arquivo = '' THEN 'required'
       WHEN NOT (lower(arquivo) LIKE '%.zip' OR regexp_matches(arquivo, '^[A-Za-z0-9_-]+\\.dem$')) THEN 'invalid_file' END AS erro_arquivo,
  (erro_evento IS NULL AND erro_fase IS NULL AND erro_arquivo IS NULL) AS aceito,
  CASE WHEN lower(arquivo) LIKE '%.zip' THEN 'zip' ELSE 'dem' END AS tipo
FROM (SELECT item_id, regexp_replace(evento, '^{_WS}+|{_WS}+$', '', 'g') AS evento,
        regexp_replace(fase, '^{_WS}+|{_WS}+$', '', 'g') AS fase, arquivo FROM manifest) m""")
def q_manifest_validate(ws):
    return B.manifest_validate(ws.fixtures.manifest())


@register("batch_members", """
SELECT f.item_id, f.lote, f.entrada, s.n_entradas, regexp_extract(f.entrada, '([^/]*)$', 1) AS nome_base,
  CASE WHEN s.n_entradas > 200 THEN 'batch_refused'
       WHEN NOT lower(regexp_extract(f.entrada, '([^/]*)$', 1)) LIKE '%.dem' THEN 'ignored'
       WHEN NOT regexp_matches(regexp_extract(f.entrada, '([^/]*)$', 1), '^[A-Za-z0-9_-]+\\.dem$') THEN 'rejected'
       ELSE 'accepted' END AS status
FROM (SELECT item_id, evento AS lote, concat_ws('/', fase, arquivo) AS entrada FROM manifest) f
JOIN (SELECT evento AS lote, count(*) AS n_entradas FROM manifest WHERE NOT concat_ws('/', fase, arquivo) LIKE '%/'
      GROUP BY 1) s ON s.lote = f.lote
WHERE NOT f.entrada LIKE '%/'""")
def q_batch_members(ws):
    e = ws.fixtures.manifest().select("item_id", F.col("evento").alias("lote"),
                                      F.concat_ws("/", "fase", "arquivo").alias("entrada"))
    return B.batch_members(e, max_entries=200).select("item_id", "lote", "entrada", "n_entradas", "nome_base", "status")


@register("skip_loaded", f"""
SELECT c.match_id, c.origem FROM (
  SELECT DISTINCT match_id, 'upload' AS origem FROM ({_IDENT_SQL}) i WHERE caminho LIKE '%.dem'
  UNION ALL SELECT match_id, 'reenvio' AS origem FROM bronze_header WHERE allow_clientside_entities = 'True') c
WHERE NOT EXISTS (SELECT 1 FROM bronze_header h WHERE h.match_id = c.match_id)""")
def q_skip_loaded(ws):
    up = (B.with_identity(B.manifest_paths(ws.fixtures.manifest())).where(F.col("caminho").endswith(".dem"))
          .select("match_id", F.lit("upload").alias("origem")).distinct())
    again = ws.bronze.table("header").select("match_id", F.lit("reenvio").alias("origem"))
    return B.skip_loaded(up.unionByName(again), ws.bronze.table("header").select("match_id"))


@register("stitch_parts", """
SELECT p.match_id, p.parte, CAST(p.round_num + o.round_offset AS BIGINT) AS round_num,
  CAST(p.start + o.tick_offset AS BIGINT) AS start, CAST(p.official_end + o.tick_offset AS BIGINT) AS official_end,
  CAST(p.bomb_plant + o.tick_offset AS BIGINT) AS bomb_plant
FROM parts_rounds p JOIN (
  SELECT match_id, parte,
    CAST(COALESCE(sum(r_max) OVER w, 0) AS BIGINT) AS round_offset,
    CAST(COALESCE(sum(t_max + 1) OVER w, 0) AS BIGINT) AS tick_offset
  FROM (SELECT match_id, parte, max(round_num) AS r_max, max(official_end) AS t_max FROM parts_rounds GROUP BY 1, 2) s
  WINDOW w AS (PARTITION BY match_id ORDER BY parte ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) o
  ON o.match_id = p.match_id AND o.parte = p.parte""")
def q_stitch_parts(ws, every: bool = False):
    pr = ws.fixtures.parts_rounds(every)
    offsets = ST.part_offsets(pr)
    shifted = ST.shift_table(pr, offsets, "rounds")
    return shifted.select("match_id", "parte", *[F.col(c).cast("bigint").alias(c)
                                                 for c in ["round_num", "start", "official_end", "bomb_plant"]])


_OFFSETS_SQL = """
SELECT match_id, parte,
  CAST(COALESCE(sum(r_max) OVER w, 0) AS BIGINT) AS round_offset,
  CAST(COALESCE(sum(t_max + 1) OVER w, 0) AS BIGINT) AS tick_offset
FROM (SELECT match_id, parte, max(round_num) AS r_max, max(official_end) AS t_max FROM parts_rounds GROUP BY 1, 2) s
WINDOW w AS (PARTITION BY match_id ORDER BY parte ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""


def _split_parts(ws, every: bool = False):
    """(match_id, parte) of the split recordings of the fixture."""
    return ws.fixtures.parts_rounds(every).select("match_id", "parte").distinct()


@register("stitch_cvars", f"""
SELECT c.match_id, p.parte, NULLIF(TRIM(c.name), '') AS name,
  CAST(CASE WHEN NULLIF(TRIM(c.tick), '')::INTEGER <> -1 THEN NULLIF(TRIM(c.tick), '')::INTEGER + o.tick_offset
            ELSE NULLIF(TRIM(c.tick), '')::INTEGER END AS BIGINT) AS tick
FROM bronze_cvars c JOIN (SELECT DISTINCT match_id, parte FROM parts_rounds) p ON p.match_id = c.match_id
JOIN ({_OFFSETS_SQL}) o ON o.match_id = p.match_id AND o.parte = p.parte""")
def q_stitch_cvars(ws, every: bool = False):
    """Each split match's settings report repeated in every part: the
    sentinel tick -1 is never shifted, other ticks move by the part offset."""
    offsets = ST.part_offsets(ws.fixtures.parts_rounds(every))
    parts = (ws.bronze.table("cvars").join(_split_parts(ws, every), "match_id")
             .select("match_id", "parte", blank("name").alias("name"), to_int(blank("tick")).alias("tick")))
    return ST.shift_table(parts, offsets, "cvars").withColumn("tick", F.col("tick").cast("bigint"))


_HEADER_PARTS_SQL = """
SELECT b.match_id, p.parte, b.match_id || '-p' || CAST(p.parte AS VARCHAR) || '.dem' AS src,
  CASE WHEN p.parte = 1 THEN NULLIF(TRIM(b.map_name), '') ELSE 'de_other' END AS map_name
FROM bronze_header b JOIN (SELECT DISTINCT match_id, parte FROM parts_rounds) p ON p.match_id = b.match_id"""


@register("stitch_header", f"""
SELECT f.match_id, f.map_name, a._arquivo_origem
FROM (SELECT match_id, map_name FROM ({_HEADER_PARTS_SQL}) h
      WHERE parte = (SELECT min(parte) FROM parts_rounds r WHERE r.match_id = h.match_id)) f
JOIN (SELECT match_id, string_agg(src, ', ' ORDER BY parte, src) AS _arquivo_origem
      FROM ({_HEADER_PARTS_SQL}) h GROUP BY match_id) a ON a.match_id = f.match_id""")
def q_stitch_header(ws, every: bool = False):
    """First part's header; lineage lists every part's source in order.
    (Later parts carry a different map name to show which header wins.)"""
    hp = (ws.bronze.table("header").join(_split_parts(ws, every), "match_id")
          .select("match_id", "parte",
                  F.when(F.col("parte") == 1, blank("map_name")).otherwise(F.lit("de_other")).alias("map_name"),
                  F.concat("match_id", F.lit("-p"), F.col("parte").cast("string"), F.lit(".dem")).alias("_arquivo_origem")))
    return ST.stitch_header(hp)


_TICK_PARTS = """SELECT match_id, CASE WHEN r <= 10 THEN 1 ELSE 2 END AS parte, tick - CASE WHEN r <= 10 THEN 0 ELSE 100000 END AS tick
FROM (SELECT match_id, CAST(NULLIF(TRIM(round_num), '') AS INTEGER) AS r, CAST(NULLIF(TRIM(tick), '') AS INTEGER) AS tick FROM bronze_ticks) t"""


@register("stitch_rounds", f"""
SELECT p.match_id, p.parte, CAST(p.round_num + o.round_offset AS BIGINT) AS round_num, CAST(p.start + o.tick_offset AS BIGINT) AS start,
  CAST(p.start + 1280 + o.tick_offset AS BIGINT) AS freeze_end, CAST(p.official_end - 448 + o.tick_offset AS BIGINT) AS "end",
  CAST(p.official_end + o.tick_offset AS BIGINT) AS official_end, CAST(p.bomb_plant + o.tick_offset AS BIGINT) AS bomb_plant
FROM ({PARTS_OF_EVERY.strip()}) p JOIN (
  SELECT s.match_id, s.parte, COALESCE(sum(r_max) OVER w, 0) AS round_offset, COALESCE(sum(greatest(t_max, k_max) + 1) OVER w, 0) AS tick_offset
  FROM (SELECT match_id, parte, max(round_num) AS r_max, max(official_end) AS t_max FROM ({PARTS_OF_EVERY.strip()}) x GROUP BY 1, 2) s
  LEFT JOIN (SELECT match_id, parte, max(tick) AS k_max FROM ({_TICK_PARTS}) y GROUP BY 1, 2) k ON k.match_id = s.match_id AND k.parte = s.parte
  WINDOW w AS (PARTITION BY s.match_id ORDER BY s.parte ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) o
  ON o.match_id = p.match_id AND o.parte = p.parte""")
def q_stitch_rounds(ws):
    """Rounds of every match with all five tick columns; the offsets come from rounds and ticks."""
    rounds = ws.fixtures.parts_rounds(True).select("*", (F.col("start") + 1280).alias("freeze_end"), (F.col("official_end") - 448).alias("end"))
    r, t = to_int(blank("round_num")), to_int(blank("tick"))
    first = r <= 10
    ticks = ws.bronze.table("ticks").select("match_id", F.when(first, 1).otherwise(2).alias("parte"), (t - F.when(first, 0).otherwise(100000)).alias("tick"))
    moved = ST.shift_table(rounds, ST.part_offsets(rounds, ticks), "rounds")
    return moved.select("match_id", "parte", *[F.col(c).cast("bigint").alias(c) for c in ["round_num", *ST.ROUND_TICK_COLUMNS]])


# the same over every match, each split into parts
for _n, _q in (("stitch_parts", q_stitch_parts), ("stitch_cvars", q_stitch_cvars), ("stitch_header", q_stitch_header)):
    register(f"{_n}_every", f"SELECT * FROM (WITH parts_rounds AS ({PARTS_OF_EVERY.strip()}) {ORACLE[_n].strip()}) q")(
        lambda ws, _q=_q: _q(ws, every=True))


@register("match_layout", """
SELECT match_id, 'kills/' || match_id || '.parquet' AS caminho_arquivo,
  'kills/evento=' || split_part(match_id, '/', 1) || '/fase=' || split_part(match_id, '/', 2) || '/match_id='
    || replace(match_id, '/', '%2F') AS caminho_particao
FROM bronze_header""")
def q_match_layout(ws):
    flat, part = B.layout_paths("kills", F.col("match_id"))
    return ws.bronze.table("header").select("match_id", flat.alias("caminho_arquivo"), part.alias("caminho_particao"))


@register("lineage_columns", """
SELECT match_id, NULLIF(TRIM(round_num), '') AS round_num, match_id || '.dem' AS _arquivo_origem, 'bronze' AS _camada,
  '2026-01-02T03:04:05' AS _carregado_em FROM bronze_kills""")
def q_lineage_columns(ws):
    """Lineage of one load: source file per row, layer, one load stamp."""
    k = ws.bronze.table("kills").select("match_id", blank("round_num").alias("round_num"))
    return B.with_lineage(k, F.col("match_id"), F.concat("match_id", F.lit(".dem")), "2026-01-02T03:04:05")


@register("bronze_scan", "SELECT * FROM s_kills")
def q_bronze_scan(ws):
    """Silver kills computed from bronze that was landed as partitioned
    Parquet and scanned back (by-name union, identity from the path)."""
    from .build import land_fixture_bronze
    from .catalog import LandedBronze
    root = land_fixture_bronze(ws.spark, ws.sf_dir)
    landed = Workspace(ws.spark, bronze=LandedBronze(ws.spark, root))
    return _silver(landed, "kills")




# ================================================================ write side (2.1, 2.9)

from . import write_queries as W  # noqa: E402

for _name, (_sql, _fn) in W.QUERIES.items():
    register(_name, _sql)(_fn)


# ================================================================ public


def build(name: str, spark, sf_dir: str, ws: Workspace | None = None) -> DataFrame:
    return REGISTRY[name](ws or Workspace(spark, sf_dir))


def oracle_texts() -> dict[str, str]:
    return {k: O.with_all(v) for k, v in ORACLE.items()}
