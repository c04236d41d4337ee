from pyspark.sql import functions as F

from ticksmith.operators import facts as G

from .conftest import SF_MID, rows

TICKS = "match_id string, round_num int, side string, steamid bigint, place string, name string, tick int"
KILLS = ("match_id string, attacker_steamid bigint, attacker_side string, victim_steamid bigint, victim_side string, "
         "assister_steamid bigint, headshot boolean")
DMG = "match_id string, attacker_steamid bigint, victim_steamid bigint, dmg_health_real int"


def test_combate_rules(spark):
    t = spark.createDataFrame([("m", 1, "ct", 1, "A", "a", 1), ("m", 1, "t", 2, "A", "b", 1),
                               ("m", 1, "t", None, "A", "ghost", 1)], TICKS)
    k = spark.createDataFrame([
        ("m", 1, "ct", 2, "t", None, True),      # kill + headshot
        ("m", 1, "ct", 1, "ct", None, None),     # lone self-kill: team kill and death
        ("m", None, None, 2, "t", 1, None),      # bomb: death for 2, assist for 1
        ("m", 3, "t", 2, "t", None, False),      # friendly kill by a player not in ticks
    ], KILLS)
    d = spark.createDataFrame([("m", 1, 2, 40), ("m", None, 1, 10), ("m", 2, 2, 5)], DMG)
    digest = G.tick_digest(t)
    out = {r.steamid: r for r in G.combate(G.players(digest), k, d).collect()}
    a, b, ghost = out[1], out[2], out[None]
    assert (a.kills, a.headshots, a.hs_pct, a.team_kills, a.mortes, a.assistencias) == (1, 1, 1.0, 1, 1, 1)
    assert (a.dano_causado, a.dano_recebido) == (40, 10)
    assert (b.kills, b.hs_pct, b.mortes, b.dano_causado, b.dano_recebido) == (0, None, 3, 5, 45)
    assert (ghost.kills, ghost.mortes, ghost.dano_recebido) == (0, 0, 0)
    assert 3 not in out                                     # not in the roster -> no row


def test_granadas_counts_physical_grenades(spark):
    g = spark.createDataFrame([
        ("m", 7, 1, 1, "x", "CHEGrenade"), ("m", 7, 1, 1, "x", "CHEGrenadeProjectile"), ("m", 7, 1, 1, "x", "CHEGrenade"),
        ("m", 7, 2, 1, "x", "CHEGrenade"), ("m", 8, 1, 1, "y", "CSmokeGrenade"), ("m", 9, 1, None, "z", "CFlashbang"),
    ], "match_id string, entity_id bigint, round_num int, thrower_steamid bigint, thrower string, grenade_type string")
    assert rows(G.granadas(g)) == [("m", 1, "x", "HE", 2), ("m", 1, "y", "Smoke", 1)]


def test_posicionamento_needs_rate(spark):
    t = spark.createDataFrame([("m", 1, "ct", 1, "A", "a", 1), ("m", 1, "ct", 1, "A", "a", 2),
                               ("m", 1, "ct", 1, None, "a", 3), ("n", 1, "ct", 1, "A", "a", 1)], TICKS)
    rate = spark.createDataFrame([("m", 64.0)], "match_id string, taxa_de_tick double")
    got = rows(G.posicionamento(G.tick_digest(t), rate), ["match_id", "place", "qtd_ticks", "segundos_no_local"])
    assert got == [("m", "A", 2, 2 / 64), ("m", None, 1, 1 / 64)]


def test_dim_jogador_first_round_side(spark):
    t = spark.createDataFrame([("m", 2, "t", 1, "A", "a", 1), ("m", 3, "ct", 1, "A", "a", 1),
                               ("m", 1, None, 2, "A", "b", 1), ("m", 1, "ct", 2, "A", "b", 1),
                               ("m", None, "ct", 3, "A", "c", 1), ("m", 1, "ct", None, "A", "d", 1)], TICKS)
    assert rows(G.dim_jogador(G.tick_digest(t))) == [("m", 1, "a", "team_b"), ("m", 2, "b", "team_a")]


def test_dim_partida_formats(spark):
    h = spark.createDataFrame([
        ("cup/final/furia-vs-navi-m2-mirage", "de_mirage"),
        ("cup/semi/a-vs-b-m1-nuke", "de_nuke"),
        ("cup/group/faze-vs-mibr-ancient", "de_ancient"),
        ("cup/group", "de_x"),
    ], "match_id string, map_name string")
    got = {r.match_id: r for r in G.dim_partida(h).collect()}
    r = got["cup/final/furia-vs-navi-m2-mirage"]
    assert (r.formato, r.jogo_num, r.time_1, r.time_2, r.confronto_id) == ("MD5", 2, "furia", "navi", "cup/final/furia-vs-navi")
    assert got["cup/semi/a-vs-b-m1-nuke"].formato == "MD3"
    r = got["cup/group/faze-vs-mibr-ancient"]
    assert (r.formato, r.jogo_num, r.time_1, r.time_2) == ("MD1", 1, "faze", "mibr")
    r = got["cup/group"]
    assert (r.fase, r.time_1, r.confronto_id) == ("group", "", "cup/group/")


def test_algebraic_invariants_mid_scale(spark):
    """kills + team kills <= kill rows; deaths of roster players = kill rows
    whose victim is in the roster; won <= attempted; sum of 1vN <= won;
    seconds by place = ticks / rate."""
    from ticksmith.plans.catalog import Workspace
    ws = Workspace(spark, SF_MID)
    k = ws.silver.table("kills")
    c = ws.gold.table("combate_jogador_partida")
    tot = c.agg(F.sum("kills").alias("k"), F.sum("team_kills").alias("tk"), F.sum("mortes").alias("d"),
                F.sum("assistencias").alias("a"), F.count_if(F.col("hs_pct").isNull()).alias("nohs")).collect()[0]
    n_kills = k.count()
    assert tot.k + tot.tk <= n_kills
    in_roster = k.join(ws.gold.players.withColumnRenamed("steamid", "victim_steamid"),
                       ["match_id", "victim_steamid"], "left_semi").count()
    assert tot.d == in_roster
    cl = ws.gold.table("clutches_jogador_partida").agg(
        F.sum("clutches_tentados").alias("t"), F.sum("clutches_vencidos").alias("v"),
        *[F.sum(f"clutches_1v{n}_vencidos").alias(f"v{n}") for n in range(1, 6)]).collect()[0]
    assert cl.v <= cl.t and sum(cl[f"v{n}"] for n in range(1, 6)) <= cl.v
    # figures measured when the fixtures were designed
    assert (cl.t, cl.v, [cl[f"v{n}"] for n in range(1, 6)]) == (458, 237, [57, 69, 53, 45, 13])
    assert (tot.k, tot.tk, tot.a, tot.nohs) == (1383, 1415, 999, 12)
    assert n_kills == 3280
    p = ws.gold.table("posicionamento_jogador_partida").groupBy("match_id").agg(F.sum("segundos_no_local").alias("s"))
    t = (ws.silver.table("ticks").groupBy("match_id").count().join(ws.silver.rate, "match_id")
         .select("match_id", (F.col("count") / F.col("taxa_de_tick")).alias("s")))
    assert rows(p) == rows(t)
