"""Data-quality checks.

Generic column tests (not_null / unique / accepted_values) are declared
per model and evaluated with ONE aggregate pass per model (every
``count_if`` side by side), plus one grouped pass per uniqueness test.
Failure counts follow the usual test convention: not_null = NULL rows,
unique = distinct values occurring more than once, accepted_values =
distinct non-NULL values outside the list.  Invariant checks return the
violating rows (empty = pass).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: accepted value domains
SIDES = ["t", "ct"]
REASONS = ["t_killed", "ct_killed", "bomb_defused", "bomb_exploded", "time_ran_out"]
BOMB_SITES = ["bombsite_a", "bombsite_b", "not_planted"]
HITGROUPS = ["head", "chest", "stomach", "left_arm", "right_arm", "left_leg", "right_leg", "neck",
             "generic", "-1"]
BOMB_EVENTS = ["pickup", "drop", "plant", "defuse", "detonate"]
GRENADE_TYPES = ["CHEGrenade", "CHEGrenadeProjectile", "CFlashbang", "CFlashbangProjectile", "CSmokeGrenade",
                 "CSmokeGrenadeProjectile", "CMolotovGrenade", "CMolotovProjectile", "CIncendiaryGrenade",
                 "CDecoyGrenade", "CDecoyProjectile"]
FORMATS = ["MD1", "MD3", "MD5"]
TEAMS = ["team_a", "team_b"]

# fixed values: declared column tests per model
# (model, not_null columns, unique columns, {column: accepted values})
GENERIC_TESTS = [
    ("silver_header", ["match_id", "map_name"], ["match_id"], {}),
    ("silver_rounds", ["round_num", "start", "end", "official_end", "winner", "reason", "bomb_site",
                       "duracao_segundos", "match_id"], [],
     {"winner": SIDES, "reason": REASONS, "bomb_site": BOMB_SITES}),
    ("silver_kills", ["victim_steamid", "victim_side", "tick", "round_num", "weapon", "headshot", "match_id"], [],
     {"attacker_side": SIDES, "victim_side": SIDES, "hitgroup": HITGROUPS}),
    ("silver_damages", ["victim_steamid", "dmg_health_real", "match_id"], [], {}),
    ("silver_shots", ["player_steamid", "weapon", "match_id"], [], {}),
    ("silver_bomb", ["tick", "round_num", "event", "match_id"], [], {"event": BOMB_EVENTS}),
    ("silver_ticks", ["health", "steamid", "side", "match_id"], [], {"side": SIDES}),
    ("silver_cvars", ["tick", "name", "value", "match_id"], [], {}),
    ("silver_grenades", ["entity_id", "thrower_steamid", "match_id"], [], {"grenade_type": GRENADE_TYPES}),
    ("dim_partida", ["match_id"], ["match_id"], {"formato": FORMATS}),
    ("dim_jogador_partida", ["match_id", "steamid"], [], {"equipe": TEAMS}),
    ("combate_jogador_partida", ["match_id", "steamid"], [], {}),
    ("granadas_jogador_partida", ["match_id", "steamid"], [], {}),
    ("posicionamento_jogador_partida", ["match_id", "steamid"], [], {}),
    ("bomba_jogador_partida", ["match_id", "steamid"], [], {}),
    ("clutches_jogador_partida", ["match_id", "steamid"], [], {}),
]

REPORT_SCHEMA = "model string, test string, column_name string, failures bigint"


def model_tests(df: DataFrame, model: str, not_null: list[str], unique: list[str],
                accepted: dict[str, list]) -> DataFrame:
    """Failure counts of one model's generic tests, one row per test.

    Null and value tests share one pass: a row gives one entry per test that
    it fails, so a clean row gives none and what is grouped are failures."""
    bad = [F.when(F.col(c).isNull(), F.struct(F.lit("not_null").alias("test"), F.lit(c).alias("column_name"), F.lit(None).cast("string").alias("value")))
           for c in not_null]
    bad += [F.when(~F.col(c).isin(vals), F.struct(F.lit("accepted_values").alias("test"), F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")))
            for c, vals in accepted.items()]
    parts = []
    if bad:
        failing = df.select(F.inline(F.array_compact(F.array(*bad)))).groupBy("test", "column_name", "value").agg(F.count(F.lit(1)).alias("n"))
        # rows for not_null, distinct values for accepted_values
        failing = failing.groupBy("test", "column_name").agg(
            F.sum(F.when(F.col("test") == "not_null", F.col("n")).otherwise(F.lit(1))).cast("bigint").alias("found"))
        labels = [("not_null", c) for c in not_null] + [("accepted_values", c) for c in accepted]
        stack = ", ".join(f"'{t}', '{c}'" for t, c in labels)
        declared = df.sparkSession.range(1).selectExpr(f"stack({len(labels)}, {stack}) as (test, column_name)")
        parts.append(declared.join(failing, ["test", "column_name"], "left")
                     .select("test", "column_name", F.coalesce("found", F.lit(0).cast("bigint")).alias("failures")))
    for c in unique:
        dup = (df.where(F.col(c).isNotNull()).groupBy(c).count().where(F.col("count") > 1)
               .agg(F.count(F.lit(1)).alias("failures")))
        parts.append(dup.select(F.lit("unique").alias("test"), F.lit(c).alias("column_name"), "failures"))
    out = reduce(DataFrame.unionByName, parts)
    return out.select(F.lit(model).alias("model"), "test", "column_name", "failures")


def generic_report(models: dict[str, DataFrame]) -> DataFrame:
    """All declared column tests over the given model frames."""
    parts = [model_tests(models[m], m, nn, un, av) for m, nn, un, av in GENERIC_TESTS if m in models]
    return reduce(DataFrame.unionByName, parts)


# ---------------------------------------------------------------- invariants


def dq_restart_gone(silver_kills: DataFrame) -> DataFrame:
    """No (match, round, tick) may keep two or more world self-kills."""
    return (silver_kills.where((F.col("weapon") == "world") & (F.col("attacker_steamid") == F.col("victim_steamid")))
            .groupBy("match_id", "round_num", "tick").agg(F.count(F.lit(1)).alias("qtd"))
            .where(F.col("qtd") > 1))


def dq_rounds_ordered(silver_rounds: DataFrame) -> DataFrame:
    ok = ((F.col("start") <= F.col("freeze_end")) & (F.col("freeze_end") <= F.col("end"))
          & (F.col("end") <= F.col("official_end")))
    return silver_rounds.where(~ok).select("match_id", "round_num", "start", "freeze_end", "end", "official_end")


def duplicated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("qtd")).where(F.col("qtd") > 1)


def dq_rounds_unique(silver_rounds: DataFrame) -> DataFrame:
    return duplicated_keys(silver_rounds, ["match_id", "round_num"])


def dq_grenade_xyz(silver_grenades: DataFrame) -> DataFrame:
    """Position is NULL exactly while a grenade is held (type without the
    ``Projectile`` suffix) and present while in flight."""
    gt = F.col("grenade_type")
    bad = (gt.like("%Projectile") & F.col("X").isNull()) | (~gt.like("%Projectile") & F.col("X").isNotNull())
    return silver_grenades.where(bad).groupBy("grenade_type").agg(F.count(F.lit(1)).alias("linhas_fora_do_padrao"))


def dq_combate_unique(combate: DataFrame) -> DataFrame:
    return duplicated_keys(combate, ["match_id", "steamid"])


def dq_dim_jogador_unique(dim_jogador: DataFrame) -> DataFrame:
    return duplicated_keys(dim_jogador, ["match_id", "steamid"])


def dq_granadas_unique(granadas: DataFrame) -> DataFrame:
    return duplicated_keys(granadas, ["match_id", "steamid", "categoria_granada"])


def dq_null_rate(df: DataFrame, model: str) -> DataFrame:
    """Share of NULLs per column (one aggregate pass, then unpivoted)."""
    cols = df.columns
    row = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)])
    stack = ", ".join(f"'{c}', n{i}" for i, c in enumerate(cols))
    return (row.selectExpr("__n", f"stack({len(cols)}, {stack}) as (column_name, nulos)")
            .select(F.lit(model).alias("model"), "column_name", F.col("nulos").cast("bigint").alias("nulos"),
                    F.col("__n").alias("linhas"),
                    F.try_divide(F.col("nulos").cast("double"), F.col("__n").cast("double")).alias("taxa_nulos")))


INVARIANTS = ["dq_restart_gone", "dq_rounds_ordered", "dq_rounds_unique", "dq_grenade_xyz",
              "dq_combate_unique", "dq_dim_jogador_unique", "dq_granadas_unique"]


def invariant_frames(silver, gold) -> dict[str, DataFrame]:
    return {
        "dq_restart_gone": dq_restart_gone(silver.table("kills")),
        "dq_rounds_ordered": dq_rounds_ordered(silver.table("rounds")),
        "dq_rounds_unique": dq_rounds_unique(silver.table("rounds")),
        "dq_grenade_xyz": dq_grenade_xyz(silver.table("grenades")),
        "dq_combate_unique": dq_combate_unique(gold.table("combate_jogador_partida")),
        "dq_dim_jogador_unique": dq_dim_jogador_unique(gold.table("dim_jogador_partida")),
        "dq_granadas_unique": dq_granadas_unique(gold.table("granadas_jogador_partida")),
    }


def invariant_report(frames: dict[str, DataFrame]) -> DataFrame:
    """Violation count per invariant, one row each."""
    parts = [df.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(name).alias("model"),
                                                                 F.lit("invariant").alias("test"),
                                                                 F.lit(None).cast("string").alias("column_name"),
                                                                 "failures")
             for name, df in frames.items()]
    return reduce(DataFrame.unionByName, parts)


def model_frames(silver, gold) -> dict[str, DataFrame]:
    frames = {f"silver_{t}": silver.table(t) for t in
              ["header", "rounds", "kills", "damages", "shots", "bomb", "ticks", "cvars", "grenades"]}
    for g in ["dim_partida", "dim_jogador_partida", "combate_jogador_partida", "granadas_jogador_partida",
              "posicionamento_jogador_partida", "bomba_jogador_partida", "clutches_jogador_partida"]:
        frames[g] = gold.table(g)
    return frames
