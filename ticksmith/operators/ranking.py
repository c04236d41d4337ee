"""Rankings: totals of a fact metric per player, overall or per
tournament / stage / map, highest first.  No rank number and no limit;
ties are ordered by the grain columns so the order is reproducible."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# fixed values: (fact, metric, total column, extra grain) of each ranking
FACTS = {
    "kills": ("combate_jogador_partida", "kills", "kills_totais", []),
    "granadas": ("granadas_jogador_partida", "granadas_lancadas", "granadas_totais", []),
    "tempo_por_local": ("posicionamento_jogador_partida", "segundos_no_local", "segundos_totais", ["place"]),
}
SCOPES = {"": [], "_por_evento": ["evento"], "_por_fase": ["evento", "fase"], "_por_mapa": ["mapa"]}


@dataclass(frozen=True)
class RankingSpec:
    name: str
    fact: str
    metric: str
    total: str
    scope: tuple[str, ...]
    extra: tuple[str, ...]
    positive_only: bool = False


def ranking_specs() -> dict[str, RankingSpec]:
    specs = {}
    for key, (fact, metric, total, extra) in FACTS.items():
        for suffix, scope in SCOPES.items():
            name = f"ranking_{key}{suffix}"
            specs[name] = RankingSpec(name, fact, metric, total, tuple(scope), tuple(extra))
    specs["ranking_team_kills"] = RankingSpec("ranking_team_kills", "combate_jogador_partida", "team_kills",
                                              "team_kills_totais", (), (), positive_only=True)
    return specs


def rank(fact: DataFrame, spec: RankingSpec, dim: DataFrame | None = None) -> DataFrame:
    """Sum ``spec.metric`` per (scope..., steamid, extra...)."""
    src = fact
    if spec.scope:
        d = dim.select("match_id", *spec.scope)
        src = fact.join(d, "match_id")
    keys = [*spec.scope, "steamid", *spec.extra]
    out = src.groupBy(*keys).agg(F.min("nome").alias("nome"), F.sum(spec.metric).alias(spec.total))
    if spec.positive_only:
        out = out.where(F.col(spec.total) > 0)
    cols = [*spec.scope, "steamid", "nome", *spec.extra, spec.total]
    order = ([F.col(c).asc_nulls_last() for c in spec.scope] + [F.col(spec.total).desc_nulls_last()]
             + [F.col("steamid").asc_nulls_last()] + [F.col(c).asc_nulls_last() for c in spec.extra])
    return out.select(*cols).orderBy(*order)
