"""Stitch split recordings of one match into a continuous match.

Round numbers and ticks restart in every part.  Part k+1 is shifted so it
continues where part k stopped:

* round offset = sum of the previous parts' highest round number
* tick offset  = sum over previous parts of (last tick + 1), where a part's
  last tick is max(rounds.official_end, ticks.tick)

The sequential rule is an exclusive prefix sum over the parts of a match,
so all matches are stitched at once: per-part spans (partial aggregate),
prefix sums in blocks of parts, then a join of the offsets onto every
table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import blank, to_bigint


ROUND_TICK_COLUMNS = ["start", "freeze_end", "end", "official_end", "bomb_plant"]
NO_TICK = -1   # cvar reported before recording started: never shifted


def part_offsets(rounds: DataFrame, ticks: DataFrame | None = None) -> DataFrame:
    """(match_id, parte) -> round_offset, tick_offset."""
    spans = rounds.groupBy("match_id", "parte").agg(F.max("round_num").alias("r_max"),
                                                    F.max("official_end").alias("t_max"))
    if ticks is not None:
        tmax = ticks.groupBy("match_id", "parte").agg(F.max("tick").alias("k_max"))
        spans = (spans.join(tmax, ["match_id", "parte"], "full")
                 .select("match_id", "parte", "r_max", F.greatest("t_max", "k_max").alias("t_max")))
    spans = spans.select("match_id", "parte", F.col("r_max").alias("rounds"), (F.col("t_max") + 1).alias("ticks"))
    return (blocked_prefix(spans, "match_id", "parte", {"rounds": "round_offset", "ticks": "tick_offset"})
            .select("match_id", "parte", "round_offset", "tick_offset"))


PART_BLOCK = 1_024        # parts of a match that one window partition orders


def blocked_prefix(df: DataFrame, key: str, order: str, sums: dict[str, str], ties: tuple[str, ...] = ()) -> DataFrame:
    """Exclusive prefix sums of columns per key in the order of a whole
    number (then ``ties``): totals per block of ``PART_BLOCK`` numbers, a
    window over the blocks of a key, and a window inside each block.  No
    window partition holds all rows of a key."""
    df = df.withColumn("_block", F.floor(F.col(order) / PART_BLOCK))
    blocks = df.groupBy(key, "_block").agg(*[F.sum(c).alias(f"_{c}") for c in sums])
    earlier = Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    blocks = blocks.select(F.col(key).alias("_key"), F.col("_block").alias("_of"),
                           *[F.coalesce(F.sum(f"_{c}").over(earlier), zero).alias(f"_{c}") for c in sums])
    inside = Window.partitionBy(key, "_block").orderBy(order, *ties).rowsBetween(Window.unboundedPreceding, -1)
    own = df.select("*", *[F.coalesce(F.sum(c).over(inside), zero).alias(n) for c, n in sums.items()])
    joined = own.join(blocks, F.col(key).eqNullSafe(F.col("_key")) & F.col("_block").eqNullSafe(F.col("_of")))
    return joined.select(*df.drop("_block").columns, *[(F.col(n) + F.col(f"_{c}")).cast("bigint").alias(n) for c, n in sums.items()])


def shift_table(df: DataFrame, offsets: DataFrame, table: str) -> DataFrame:
    """One table's rounds and ticks moved by the offsets of their part.
    Typed columns are added to; text columns (bronze) are parsed, moved and
    written back as text, and blank ones stay."""
    kinds = dict(df.dtypes)
    ticks = ROUND_TICK_COLUMNS if table == "rounds" else [] if table == "header" else ["tick"]
    rounds = [] if table in ("header", "cvars") else ["round_num"]

    def moved(c: str, offset: str) -> Column:
        text = kinds[c] == "string"
        v = to_bigint(blank(c)) if text else F.col(c)
        out = v + F.coalesce(F.col(offset), F.lit(0))
        if table == "cvars":
            out = F.when(v == NO_TICK, v).otherwise(out)
        return F.when(v.isNull(), F.col(c)).otherwise(out.cast("string")) if text else out

    own = {c: moved(c, o) for cols, o in ((rounds, "round_offset"), (ticks, "tick_offset")) for c in cols if c in kinds}
    return df.join(offsets, ["match_id", "parte"], "left").withColumns(own).select(*df.columns)


def stitch_header(headers: DataFrame) -> DataFrame:
    """Header of the first part; ``_arquivo_origem`` lists every part's
    source in part order, joined by ', '.  (Parts per match are few.)"""
    first = headers.groupBy("match_id").agg(F.min_by(F.struct(*[c for c in headers.columns if c != "match_id"]),
                                                     F.col("parte")).alias("h"))
    srcs = (headers.groupBy("match_id")
            .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("parte", "_arquivo_origem"))),
                                          lambda s: s["_arquivo_origem"]), ", ").alias("_arquivo_origem")))
    cols = [F.col(f"h.{c}").alias(c) for c in headers.columns if c not in ("match_id", "_arquivo_origem", "parte")]
    return first.join(srcs, "match_id").select("match_id", *cols, "_arquivo_origem")


def stitch(parts: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Typed per-part tables (each with ``match_id`` and ``parte``) ->
    stitched tables (``parte`` dropped)."""
    offsets = part_offsets(parts["rounds"], parts.get("ticks"))
    out = {}
    for name, df in parts.items():
        if name == "header":
            out[name] = stitch_header(df)
        else:
            out[name] = shift_table(df, offsets, name).drop("parte")
    return out

