"""Silver layer: typed, cleaned tables from bronze.

Every bronze column goes through blank-to-NULL and its typed cast.  Event
tables receive ``segundos_desde_inicio_round`` from the per-round clock
(round start tick + the match's tick rate), joined once; kills lose the
round-restart artefacts; grenades lose non-grenade entities.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import (blank, cast_code, not_in_list, tick_to_seconds, to_double, to_int,
                                 to_ts)
from ..schemas import CLOCKED_TABLES, COLUMNS

SECONDS = "segundos_desde_inicio_round"

# fixed values: entity classes the parser reports in the grenade stream that
# are not grenades
NON_GRENADE_ENTITIES = ["CKnife", "CWeaponGlock", "CWeaponHKP2000", "CC4"]
FREEZE_CVAR = "mp_freezetime"


# ---------------------------------------------------------------- rate / clock


def tick_rate(bronze_rounds: DataFrame, bronze_cvars: DataFrame) -> DataFrame:
    """Ticks per second of each match: the most frequent freeze length (in
    ticks, ties -> smallest) over the configured freeze time in seconds.
    A match without the freeze-time setting has no rate."""
    freeze = (bronze_rounds
              .select("match_id", (to_int(blank("freeze_end")) - to_int(blank("start"))).alias("d"))
              .groupBy("match_id")
              .agg(F.mode("d", True).alias("ticks_de_freeze")))
    secs = (bronze_cvars.where(blank("name") == F.lit(FREEZE_CVAR))
            .groupBy("match_id")
            .agg(to_double(F.min(blank("value"))).alias("freezetime_segundos")))
    return (freeze.join(secs, "match_id")
            .select("match_id", F.try_divide(F.col("ticks_de_freeze"), F.col("freezetime_segundos"))
                    .alias("taxa_de_tick")))


def tick_rate_first_round(silver_rounds: DataFrame, silver_cvars: DataFrame) -> DataFrame:
    """Variant: freeze length of the first round over the first reported
    freeze-time value (no mode)."""
    first = (silver_rounds.where(F.col("round_num").isNotNull())
             .groupBy("match_id")
             .agg(F.min_by(F.col("freeze_end") - F.col("start"), F.col("round_num")).alias("ticks_de_freeze")))
    value = (silver_cvars.where((F.col("name") == FREEZE_CVAR) & F.col("tick").isNotNull())
             .groupBy("match_id")
             .agg(F.min_by(F.col("value"), F.struct("tick", "value")).alias("v")))
    return (first.join(value, "match_id")
            .select("match_id", F.try_divide(F.col("ticks_de_freeze"), to_double(F.col("v")))
                    .alias("taxa_de_tick")))


def round_start(bronze_rounds: DataFrame) -> DataFrame:
    """(match, round) -> start tick, straight from bronze (not deduplicated:
    a repeated round fans out, which the uniqueness check reports)."""
    return bronze_rounds.select("match_id", to_int(blank("round_num")).alias("round_num"),
                                to_int(blank("start")).alias("round_start_tick"))


def round_clock(bronze_rounds: DataFrame, rate: DataFrame) -> DataFrame:
    """Round start joined with the match rate, so event tables need one
    lookup join instead of two.  (Same rows as joining the two separately:
    the rate has one row per match.)"""
    return round_start(bronze_rounds).join(rate, "match_id", "left")


# ---------------------------------------------------------------- typing


def _typed_columns(table: str, prefix: str | None = None):
    return [cast_code(F.col(c), t).alias(c) for c, t in COLUMNS[table]]


def _lineage():
    return [F.col("match_id"), F.col("_arquivo_origem"), to_ts(F.col("_carregado_em")).alias("_carregado_em")]


def typed(bronze: DataFrame, table: str) -> DataFrame:
    """Blank-to-NULL + cast of every declared column, plus lineage."""
    return bronze.select(*_typed_columns(table), *_lineage())


def _with_seconds(df: DataFrame, clock: DataFrame, table: str) -> DataFrame:
    joined = df.join(clock, ["match_id", "round_num"], "left")
    cols = []
    for c, _ in COLUMNS[table]:
        cols.append(F.col(c))
        if c == "round_num":
            cols.append(tick_to_seconds("tick", "round_start_tick", "taxa_de_tick").alias(SECONDS))
    return joined.select(*cols, "match_id", "_arquivo_origem", "_carregado_em")


# ---------------------------------------------------------------- tables


def silver_header(bronze_header: DataFrame) -> DataFrame:
    return typed(bronze_header, "header")


def silver_rounds(bronze_rounds: DataFrame, rate: DataFrame) -> DataFrame:
    t = typed(bronze_rounds, "rounds").join(rate, "match_id", "left")
    cols = [F.col(c) for c, _ in COLUMNS["rounds"]]
    dur = F.try_divide(F.col("end") - F.col("start"), F.col("taxa_de_tick")).alias("duracao_segundos")
    return t.select(*cols, dur, "match_id", "_arquivo_origem", "_carregado_em")


def restart_artifacts(bronze_kills: DataFrame) -> DataFrame:
    """(match, round, tick) where two or more players 'killed themselves'
    with the world at the same instant: a server round restart, not play.
    A single such death is real and stays."""
    self_world = (blank("weapon") == F.lit("world")) & (blank("attacker_steamid") == blank("victim_steamid"))
    return (bronze_kills.where(self_world)
            .groupBy("match_id", to_int(blank("round_num")).alias("round_num"),
                     to_int(blank("tick")).alias("tick"))
            .agg(F.count(F.lit(1)).alias("qtd"))
            .where(F.col("qtd") > 1))


def silver_kills(bronze_kills: DataFrame, clock: DataFrame) -> DataFrame:
    t = typed(bronze_kills, "kills")
    artefacts = restart_artifacts(bronze_kills).select("match_id", "round_num", "tick")
    # NULL keys never match, exactly like the equality anti-join they replace
    clean = t.join(artefacts, ["match_id", "round_num", "tick"], "left_anti")
    return _with_seconds(clean, clock, "kills")


def silver_events(bronze: DataFrame, clock: DataFrame, table: str) -> DataFrame:
    """damages / shots / bomb / ticks: typed + seconds since round start."""
    assert table in CLOCKED_TABLES
    return _with_seconds(typed(bronze, table), clock, table)


def silver_damages(bronze_damages: DataFrame, clock: DataFrame) -> DataFrame:
    return silver_events(bronze_damages, clock, "damages")


def silver_shots(bronze_shots: DataFrame, clock: DataFrame) -> DataFrame:
    return silver_events(bronze_shots, clock, "shots")


def silver_bomb(bronze_bomb: DataFrame, clock: DataFrame) -> DataFrame:
    return silver_events(bronze_bomb, clock, "bomb")


def silver_ticks(bronze_ticks: DataFrame, clock: DataFrame) -> DataFrame:
    return silver_events(bronze_ticks, clock, "ticks")


def silver_grenades(bronze_grenades: DataFrame) -> DataFrame:
    """Typed grenade track without non-grenade entities; a NULL entity type
    is dropped as well (SQL NOT IN)."""
    return typed(bronze_grenades, "grenades").where(not_in_list("grenade_type", NON_GRENADE_ENTITIES))


def silver_cvars(bronze_cvars: DataFrame) -> DataFrame:
    return typed(bronze_cvars, "cvars")


class Silver:
    """The silver tables of one bronze source, built lazily and shared (the
    rate and clock are computed once per instance)."""

    def __init__(self, bronze):
        self.bronze = bronze
        self._cache: dict[str, DataFrame] = {}

    def _memo(self, key, fn):
        if key not in self._cache:
            self._cache[key] = fn()
        return self._cache[key]

    @property
    def rate(self) -> DataFrame:
        return self._memo("rate", lambda: tick_rate(self.bronze.table("rounds"), self.bronze.table("cvars")))

    @property
    def clock(self) -> DataFrame:
        return self._memo("clock", lambda: round_clock(self.bronze.table("rounds"), self.rate))

    def table(self, name: str) -> DataFrame:
        b = self.bronze.table
        builders = {
            "header": lambda: silver_header(b("header")),
            "rounds": lambda: silver_rounds(b("rounds"), self.rate),
            "kills": lambda: silver_kills(b("kills"), self.clock),
            "damages": lambda: silver_damages(b("damages"), self.clock),
            "shots": lambda: silver_shots(b("shots"), self.clock),
            "bomb": lambda: silver_bomb(b("bomb"), self.clock),
            "ticks": lambda: silver_ticks(b("ticks"), self.clock),
            "grenades": lambda: silver_grenades(b("grenades")),
            "cvars": lambda: silver_cvars(b("cvars")),
        }
        return self._memo(name, builders[name])
