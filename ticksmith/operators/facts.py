"""Gold facts (player x match) and dimensions.

The ticks table is by far the largest input.  It is read once into a
*digest* at grain (match, round, side, player, place) with a tick count
and a name; the partial (map-side) aggregation collapses it before any
shuffle, and the roster, positioning, player dimension and clutch roster
are all derived from the digest instead of rescanning ticks.

Names: where several names exist for a player (renames happen) the
smallest non-NULL one is taken, so results are reproducible.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import grenade_category, safe_ratio

PLAYER_KEY = ["match_id", "steamid"]


# ---------------------------------------------------------------- tick digest / rosters


def tick_digest(silver_ticks: DataFrame) -> DataFrame:
    """One row per (match, round, side, steamid, place): tick count + name."""
    return (silver_ticks.groupBy("match_id", "round_num", "side", "steamid", "place")
            .agg(F.count(F.lit(1)).alias("qtd_ticks"), F.min("name").alias("nome")))


def players(digest: DataFrame) -> DataFrame:
    """Roster of a match: everyone seen in ticks (a NULL id is a row too)."""
    return digest.groupBy(*PLAYER_KEY).agg(F.min("nome").alias("nome"))


# ---------------------------------------------------------------- combat


COUNTERS = ("kills", "headshots", "mortes", "assistencias", "team_kills")
DAMAGE = ("dano_causado", "dano_recebido")


def _role(steamid: str, **counters) -> "F.Column":
    """One player's part in an event, as a struct of every counter."""
    zeros = [F.coalesce(counters[c], F.lit(0)).cast("int").alias(c) if c in counters else F.lit(0).alias(c) for c in COUNTERS]
    damage = [(counters[c] if c in counters else F.lit(None)).cast("bigint").alias(c) for c in DAMAGE]
    return F.struct(F.col(steamid).alias("steamid"), *zeros, *damage)


def _kill_roles(silver_kills: DataFrame) -> DataFrame:
    """Every kill as its attacker, victim and assister, from one scan."""
    known = F.col("attacker_steamid").isNotNull()
    flag = lambda cond: F.when(cond, F.lit(1)).otherwise(F.lit(0))
    enemy, friendly = (known & (F.col("attacker_side") != F.col("victim_side")), known & (F.col("attacker_side") == F.col("victim_side")))
    roles = F.array(_role("attacker_steamid", kills=flag(enemy), headshots=flag(enemy & F.col("headshot")), team_kills=flag(friendly)),
                    _role("victim_steamid", mortes=F.lit(1)), _role("assister_steamid", assistencias=F.lit(1)))
    return silver_kills.select("match_id", F.inline(roles))


def _damage_roles(silver_damages: DataFrame) -> DataFrame:
    """Every damage as dealt and as received, from one scan."""
    d = F.col("dmg_health_real")
    return silver_damages.select("match_id", F.inline(F.array(_role("attacker_steamid", dano_causado=d), _role("victim_steamid", dano_recebido=d))))


def combate(player_roster: DataFrame, silver_kills: DataFrame, silver_damages: DataFrame) -> DataFrame:
    """kills / headshots / hs_pct / deaths / assists / team kills / damage
    dealt and received per roster player (zero when absent).

    kills exclude friendly kills (sides must differ, attacker known); a
    friendly kill, including a lone self-kill, counts as team kill; every
    kill row counts a death for its victim; damage has no side filter."""
    melted = _kill_roles(silver_kills).unionAll(_damage_roles(silver_damages))
    stats = (melted.where(F.col("steamid").isNotNull())
             .groupBy(*PLAYER_KEY)
             .agg(*[F.sum(c).alias(c) for c in COUNTERS + DAMAGE]))
    z = lambda c: F.coalesce(F.col(c), F.lit(0).cast("bigint"))
    return (player_roster.join(stats, PLAYER_KEY, "left")
            .select("match_id", "steamid", "nome", z("kills").alias("kills"), z("headshots").alias("headshots"),
                    safe_ratio(z("headshots"), z("kills")).alias("hs_pct"),
                    z("mortes").alias("mortes"), z("assistencias").alias("assistencias"),
                    z("team_kills").alias("team_kills"), z("dano_causado").alias("dano_causado"),
                    z("dano_recebido").alias("dano_recebido")))


# ---------------------------------------------------------------- grenades


def granadas(silver_grenades: DataFrame) -> DataFrame:
    """Grenades thrown per player and category: a physical grenade is one
    (entity, round, thrower, category); its per-tick track rows collapse."""
    per_grenade = (silver_grenades.where(F.col("thrower_steamid").isNotNull())
                   .groupBy("match_id", "entity_id", "round_num", "thrower_steamid",
                            grenade_category("grenade_type").alias("categoria_granada"))
                   .agg(F.min("thrower").alias("nome")))
    return (per_grenade.groupBy("match_id", "thrower_steamid", "categoria_granada")
            .agg(F.min("nome").alias("nome"), F.count(F.lit(1)).alias("granadas_lancadas"))
            .select("match_id", F.col("thrower_steamid").alias("steamid"), "nome", "categoria_granada",
                    "granadas_lancadas"))


# ---------------------------------------------------------------- positioning


def posicionamento(digest: DataFrame, rate: DataFrame) -> DataFrame:
    """Ticks and seconds per player and map callout (NULL callout is its own
    group).  Matches without a tick rate have no rows."""
    per_place = (digest.groupBy("match_id", "steamid", "place")
                 .agg(F.min("nome").alias("nome"), F.sum("qtd_ticks").alias("qtd_ticks")))
    return (per_place.join(rate, "match_id")
            .select("match_id", "steamid", "nome", "place", "qtd_ticks",
                    F.try_divide(F.col("qtd_ticks"), F.col("taxa_de_tick")).alias("segundos_no_local")))


# ---------------------------------------------------------------- bomb


def bomba(silver_bomb: DataFrame) -> DataFrame:
    """Plants and defuses per player (only players with at least one)."""
    ev = F.col("event")
    return (silver_bomb.where(ev.isin("plant", "defuse") & F.col("steamid").isNotNull())
            .groupBy(*PLAYER_KEY)
            .agg(F.min("name").alias("nome"), F.count_if(ev == "plant").alias("plants"),
                 F.count_if(ev == "defuse").alias("defuses")))


# ---------------------------------------------------------------- dimensions


def dim_jogador(digest: DataFrame) -> DataFrame:
    """Team label per player and match: team_a if the player's side in the
    first round they appear in is ct, else team_b.  One aggregate: the
    minimum of (round, side-is-null, side) picks the first round's side,
    preferring a known side."""
    first = F.min(F.when(F.col("round_num").isNotNull(),
                         F.struct(F.col("round_num").alias("r"), F.col("side").isNull().alias("n"),
                                  F.col("side").alias("s"))))
    agg = (digest.where(F.col("steamid").isNotNull())
           .groupBy(*PLAYER_KEY)
           .agg(F.min("nome").alias("nome"), first.alias("first")))
    return (agg.where(F.col("first").isNotNull())
            .select("match_id", "steamid", "nome",
                    F.when(F.col("first.s") == "ct", F.lit("team_a")).otherwise(F.lit("team_b")).alias("equipe")))


# fixed values: marks in the words of a series name
# ("<team>-vs-<team>-m<N>-<map>" for a multi-map series, "<team>-vs-<team>-<map>" otherwise)
SERIES_RE = r"^(.*)-m[0-9]+-.*$"
GAME_NUM_RE = r"^.*-m([0-9]+)-.*$"
GAME_WORD = "^m[0-9]+$"
VERSUS_WORD = "vs"
MAP_PREFIX = "de_"


def last_inner_word(words: Column, is_mark) -> Column:
    """Place (from 1) of the last marked word with words on both sides, else 0."""
    places = F.transform(words, lambda w, k: F.when((k > 0) & (k < F.size(words) - 1) & is_mark(w), k + 1).otherwise(0))
    return F.coalesce(F.array_max(places), F.lit(0))


def words_before(words: Column, place: Column) -> Column:
    return F.array_join(F.slice(words, F.lit(1), F.greatest(place - 1, F.lit(0))), "-")


def series_of(name: Column, map_name: Column) -> Column:
    """struct(series, game, team_1, team_2) of a series name.  A game word
    ends the series; without one, series and game are null and the map's
    name is cut off the end before the teams are read."""
    words = F.split(name, "-", -1)
    game = last_inner_word(words, lambda w: w.rlike(GAME_WORD))
    series = F.nullif(words_before(words, game), F.lit(""))
    number = F.when(game > 0, F.substring(F.element_at(words, F.nullif(game, F.lit(0))), 2, 20).cast("int"))
    tail = F.concat(F.lit("-"), F.replace(map_name, F.lit(MAP_PREFIX), F.lit("")))
    single = F.when(F.endswith(name, tail), F.left(name, F.length(name) - F.length(tail))).when(tail.isNotNull(), name)
    teams = F.split(F.coalesce(series, single), "-", -1)
    versus = last_inner_word(teams, lambda w: w == VERSUS_WORD)
    team = lambda text: F.when(teams.isNotNull(), F.when(versus > 0, text).otherwise(""))
    return F.struct(series.alias("series"), number.alias("game"), team(words_before(teams, versus)).alias("team_1"),
                    team(F.array_join(F.slice(teams, versus + 1, F.size(teams)), "-")).alias("team_2"))


def dim_partida(silver_header: DataFrame) -> DataFrame:
    """Match dimension read from the identity ``evento/fase/confronto`` and
    the map: a series of several maps is best of five in the final, else best
    of three; any other match is game 1 of one."""
    part = lambda k: F.split_part(F.col("match_id"), F.lit("/"), F.lit(k))
    read = silver_header.select("match_id", part(1).alias("evento"), part(2).alias("fase"), part(3).alias("name"),
                                F.col("map_name").alias("mapa"), series_of(part(3), F.col("map_name")).alias("s"))
    several = F.col("s.series").isNotNull()
    return read.select(
        "match_id", "evento", "fase", "mapa",
        F.concat(F.col("evento"), F.lit("/"), F.col("fase"), F.lit("/"), F.coalesce("s.series", "name")).alias("confronto_id"),
        F.coalesce("s.game", F.lit(1)).alias("jogo_num"),
        F.when(several & (F.col("fase") == "final"), "MD5").when(several, "MD3").otherwise("MD1").alias("formato"),
        F.col("s.team_1").alias("time_1"), F.col("s.team_2").alias("time_2"))


# ---------------------------------------------------------------- headline question


def headshots_by_place(silver_kills: DataFrame, dim: DataFrame, steamid=None, place=None, mapa=None,
                       fases=None) -> DataFrame:
    """Headshot kills by attacker, attacker callout, map and stage ("how
    many headshots did player X get at callout B on map M in the playoffs").
    Filters are optional and pushed below the aggregation."""
    k = silver_kills.where(F.col("headshot") & F.col("attacker_steamid").isNotNull()
                           & (F.col("attacker_side") != F.col("victim_side")))
    if steamid is not None:
        k = k.where(F.col("attacker_steamid") == F.lit(steamid).cast("bigint"))
    if place is not None:
        k = k.where(F.col("attacker_place") == F.lit(place))
    d = dim.select("match_id", "evento", "fase", "mapa")
    if mapa is not None:
        d = d.where(F.col("mapa") == F.lit(mapa))
    if fases is not None:
        d = d.where(F.col("fase").isin(list(fases)))
    return (k.join(d, "match_id")
            .groupBy("evento", "fase", "mapa", F.col("attacker_steamid").alias("steamid"),
                     F.col("attacker_place").alias("place"))
            .agg(F.count(F.lit(1)).alias("headshots")))


class Gold:
    """Gold tables over one :class:`Silver`, built lazily and shared."""

    def __init__(self, silver):
        self.silver = silver
        self._cache: dict[str, DataFrame] = {}

    def _memo(self, key, fn):
        if key not in self._cache:
            self._cache[key] = fn()
        return self._cache[key]

    @property
    def digest(self) -> DataFrame:
        return self._memo("digest", lambda: tick_digest(self.silver.table("ticks")))

    def materialize_digest(self) -> DataFrame:
        """Write the digest once to the shared checkpoint folder so every
        fact built afterwards reads it instead of rescanning ticks (each
        consumer prunes different columns, so plan-level exchange reuse
        would not kick in)."""
        self._cache["digest"] = self.digest.checkpoint()
        self._cache.pop("players", None)
        return self._cache["digest"]

    @property
    def players(self) -> DataFrame:
        return self._memo("players", lambda: players(self.digest))

    def table(self, name: str) -> DataFrame:
        s = self.silver.table
        from . import clutch  # local import: clutch builds on this module

        builders = {
            "combate_jogador_partida": lambda: combate(self.players, s("kills"), s("damages")),
            "granadas_jogador_partida": lambda: granadas(s("grenades")),
            "posicionamento_jogador_partida": lambda: posicionamento(self.digest, self.silver.rate),
            "bomba_jogador_partida": lambda: bomba(s("bomb")),
            "clutches_jogador_partida": lambda: clutch.clutches(self.digest, self.players, s("kills"), s("rounds")),
            "dim_jogador_partida": lambda: dim_jogador(self.digest),
            "dim_partida": lambda: dim_partida(s("header")),
        }
        return self._memo(name, builders[name])
