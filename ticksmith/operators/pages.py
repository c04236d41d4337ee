"""Paged reads over published gold tables.

A page is: fact (optionally joined with the match dimension for
tournament / stage / map / series / format / teams) -> equality filters
on whitelisted columns -> fixed order -> OFFSET/LIMIT.  The total count
uses the same filters.  Catalyst pushes the filters into the Parquet
scans and plans the ordered page as one TakeOrderedAndProject; the
dimension is broadcast only when its size is proven small.
"""

from __future__ import annotations

from dataclasses import dataclass, field
import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# fixed values: paging limits of the read API
DEFAULT_PAGE_SIZE = 50
MAX_PAGE_SIZE = 500
DIM_COLUMNS = ["evento", "fase", "mapa", "confronto_id", "formato", "time_1", "time_2"]


@dataclass(frozen=True)
class PageSpec:
    table: str
    filters: tuple[str, ...]
    order: tuple[tuple[str, bool], ...]       # (column, descending)
    join_dim: bool = True
    tiebreak: tuple[str, ...] = field(default=("match_id", "steamid"))


# fixed values: the five published page endpoints
PAGES = {
    "page_combate": PageSpec("combate_jogador_partida",
                             ("match_id", "steamid", "evento", "fase", "mapa", "confronto_id"),
                             (("kills", True),)),
    "page_granadas": PageSpec("granadas_jogador_partida",
                              ("match_id", "steamid", "categoria_granada", "evento", "fase", "mapa", "confronto_id"),
                              (("granadas_lancadas", True),), tiebreak=("match_id", "steamid", "categoria_granada")),
    "page_posicionamento": PageSpec("posicionamento_jogador_partida",
                                    ("match_id", "steamid", "place", "evento", "fase", "mapa", "confronto_id"),
                                    (("segundos_no_local", True),), tiebreak=("match_id", "steamid", "place")),
    "page_bomba": PageSpec("bomba_jogador_partida", ("match_id", "steamid", "evento", "fase", "mapa", "confronto_id"),
                           (("plants", True),)),
    "page_partidas": PageSpec("dim_partida",
                              ("match_id", "evento", "fase", "mapa", "confronto_id", "formato", "time_1", "time_2"),
                              (("match_id", False),), join_dim=False, tiebreak=()),
}


def _number(text, otherwise: int, least: int, most: int | None = None) -> int:
    """Whole number in ``text`` moved into its bounds; ``otherwise`` for
    anything that is none."""
    digits = str(text).strip().replace("_", "") if isinstance(text, (str, int)) and not isinstance(text, bool) else ""
    if not re.fullmatch(r"[+-]?[0-9]+", digits):
        return otherwise
    return max(least, int(digits) if most is None else min(int(digits), most))


def page_params(page=None, page_size=None) -> tuple[int, int]:
    """Page from 1 (default 1), page size from 1 to 500 (default 50)."""
    return _number(page, 1, 1), _number(page_size, DEFAULT_PAGE_SIZE, 1, MAX_PAGE_SIZE)


def page_base(fact: DataFrame, dim: DataFrame | None, join_dim: bool) -> DataFrame:
    if not join_dim:
        return fact
    # a fact read with its partition column keeps it, so a tournament filter prunes folders
    d = dim.select("match_id", *[c for c in DIM_COLUMNS if c not in fact.columns])
    return fact.join(d, "match_id").select([c for c in fact.columns if c not in DIM_COLUMNS] + DIM_COLUMNS)


def whitelist_filter(df: DataFrame, filters: dict, allowed) -> DataFrame:
    """Equality filters on allowed columns only (others are ignored); each
    value is bound as a literal cast to the column's type, never spliced
    into SQL text.  Conditions are ANDed."""
    types = dict(df.dtypes)
    conds: list[Column] = [F.col(c) == F.lit(v).cast(types[c]) for c, v in filters.items()
                           if c in allowed and c in types]
    return df.where(reduce(lambda a, b: a & b, conds)) if conds else df


def _ordering(spec: PageSpec) -> list[Column]:
    cols = [F.col(c).desc_nulls_last() if desc else F.col(c).asc_nulls_last() for c, desc in spec.order]
    return cols + [F.col(c).asc_nulls_last() for c in spec.tiebreak]


DEEP_OFFSET = 10_000        # rows before a page; from here whole ranges are skipped by their counts


def page_rows(fact: DataFrame, dim: DataFrame | None, spec: PageSpec, filters: dict | None = None,
              page=1, page_size=DEFAULT_PAGE_SIZE) -> DataFrame:
    """One numbered page.  Near the start a top-n, further on ``deep_page``."""
    p, s = page_params(page, page_size)
    base = whitelist_filter(page_base(fact, dim, spec.join_dim), filters or {}, spec.filters)
    if (p - 1) * s >= DEEP_OFFSET:
        return deep_page(base, spec, (p - 1) * s, s)
    return base.orderBy(*_ordering(spec)).offset((p - 1) * s).limit(s)


def deep_page(base: DataFrame, spec: PageSpec, offset: int, size: int) -> DataFrame:
    """Rows ``offset`` to ``offset + size`` of the order without sorting what
    comes before: the rows are dealt into ranges of the order, the ranges
    (one number each) are counted, and only those that the page touches are
    sorted."""
    ranges = int(base.sparkSession.conf.get("spark.sql.shuffle.partitions"))     # stated, so that they are not merged
    ranged = base.repartitionByRange(ranges, *_ordering(spec)).withColumn("_faixa", F.spark_partition_id()).checkpoint()
    counts = {r["_faixa"]: r["count"] for r in ranged.groupBy("_faixa").count().collect()}     # one row per range
    first, wanted, skipped = 0, [], 0
    for k in sorted(counts):
        if first < offset + size and first + counts[k] > offset:
            wanted.append(k)
        elif first + counts[k] <= offset:
            skipped = first + counts[k]
        first += counts[k]
    rows = ranged.where(F.col("_faixa").isin(wanted)).drop("_faixa")
    return rows.orderBy(*_ordering(spec)).offset(offset - skipped).limit(size)


def page_after(fact: DataFrame, dim: DataFrame | None, spec: PageSpec, filters: dict | None = None,
               last: dict | None = None, page_size=DEFAULT_PAGE_SIZE) -> DataFrame:
    """The page that follows a row (``last``: its order and tie-break
    columns; None for the first page).  The start is a filter, so the cost
    of a page does not depend on how deep it lies."""
    _, s = page_params(1, page_size)
    base = whitelist_filter(page_base(fact, dim, spec.join_dim), filters or {}, spec.filters)
    if last:
        types = dict(base.dtypes)
        follows, equal = F.lit(False), F.lit(True)
        for c, desc in [*spec.order, *((t, False) for t in spec.tiebreak)]:
            value = F.lit(last[c]).cast(types[c])
            if last[c] is not None:              # nulls come last, nothing follows them
                beyond = (F.col(c) < value if desc else F.col(c) > value) | F.col(c).isNull()
                follows = follows | (equal & beyond)
            equal = equal & F.col(c).eqNullSafe(value)
        base = base.where(follows)
    return base.orderBy(*_ordering(spec)).limit(s)


def page_envelope(fact: DataFrame, dim: DataFrame | None, spec: PageSpec, filters: dict | None = None,
                  page=1, page_size=DEFAULT_PAGE_SIZE) -> DataFrame:
    """count, page, page_size, total_pages, next/previous page numbers
    (NULL when absent) -- computed by one Spark aggregate."""
    p, s = page_params(page, page_size)
    base = whitelist_filter(page_base(fact, dim, spec.join_dim), filters or {}, spec.filters)
    total = F.col("count")
    pages = F.when(total > 0, F.floor((total + F.lit(s - 1)) / F.lit(s)).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
    return (base.agg(F.count(F.lit(1)).alias("count"))
            .select("count", F.lit(p).alias("page"), F.lit(s).alias("page_size"), pages.alias("total_pages"))
            .select("*",
                    F.when(F.lit(p) < F.col("total_pages"), F.lit(p + 1)).alias("next_page"),
                    F.when(F.lit(p) > 1, F.lit(p - 1)).alias("previous_page")))
