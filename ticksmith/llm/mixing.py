"""Mixing sources to target weights: pivotal dependent rounding, natively.

Every document of a source is wanted ``target / source size`` times.  The
whole part of that is copied at once.  The fractional parts are rounded by
the pivotal method: two documents with fractional parts p and q move mass
between them, in words (``size * p + size' * q`` stays as it is), by one of
two randomly chosen steps until one part is 0 or 1; the chance of either step keeps every
expected copy number.  Documents above the mean size of their source are
rounded first; the words by which that misses are shared by the smaller
ones as a change of their rate (its expectation is zero), which are rounded
next.  So a source misses its target by less than one document of mean size,
unless its smaller documents cannot make up for a larger one.

The pairs form a reduction tree.  Level by level, the fractional documents
of a source are dealt to small blocks by a seeded hash; a block is folded to
at most one fractional document (SQL ``aggregate`` over an array of bounded
expected size); what is left goes to the next level.  A source with a third
of all rows is just more blocks.  Everything is DataFrame work.

Defined results: null and blank texts have size 0 and are taken 0 times;
repeated rows are told apart by an ordinal and rounded each; a null source
is a source, the last one; an empty table gives no rows; the seed and the
rows alone fix the result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

WEIGHTS = (5, 2, 1)      # by rank of the source, repeating
MOST_COPIES = 3
BLOCK = 64               # expected documents of a block
SEED = 7_919
NEAR = 1e-9              # a part this near to 0 or 1 is whole

WORD = r"[^\x20\x09-\x0D]+"
STATE = ("struct<left: struct<row:string, size:bigint, p:double>, done: array<struct<row:string, up:boolean>>>")


def sized(docs: DataFrame) -> DataFrame:
    """One light row per document: row (its identity), doc_id, source, size."""
    light = docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
                        F.xxhash64("text").alias("text_hash"))
    return light.withColumn("row", row_identity())


def row_identity() -> Column:
    """Identity of a row; equal rows are numbered.  Needs doc_id, source,
    size and text_hash."""
    same = Window.partitionBy("doc_id", "source", "size", "text_hash").orderBy("text_hash")
    return F.concat_ws("/", row_key(F.col("size"), F.col("text_hash")), F.row_number().over(same).cast("string"))


def row_key(size: Column, text_hash: Column) -> Column:
    """What equal rows share of their identity.  Needs doc_id and source."""
    return F.concat_ws("/", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")),
                       F.hex(F.xxhash64(F.coalesce("source", F.lit("")), F.col("source").isNull(), size, text_hash)))


def targets(rows: DataFrame, weights: tuple = WEIGHTS, most: float = MOST_COPIES) -> DataFrame:
    """source, source_size, target.  Weights go round over the sources in
    code-point order, null last.  A target stops at ``most`` times its
    source's size and the excess is shared again by weight: the level at
    which ``sum(min(most * size, level * weight))`` is the whole size.  The
    windows run over one row per source."""
    by = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.greatest(F.count_if(F.col("size") > 0), F.lit(1)).alias("sized"))
    turn = F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(weights)))
    by = by.withColumn("weight", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (turn + 1).cast("int")))
    by = by.withColumn("most", F.lit(float(most)) * F.col("source_size"))
    up = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    all_rows = Window.partitionBy()
    by = by.withColumns({
        "level": ((F.sum("source_size").over(all_rows) - F.sum("most").over(up.rowsBetween(Window.unboundedPreceding, -1)))
                  / F.sum("weight").over(up.rowsBetween(0, Window.unboundedFollowing))),
        "plain": F.sum("source_size").over(all_rows) / F.sum("weight").over(all_rows)})
    # sources in rising order of most/weight; levels fall, and the first that does not fill its source holds
    by = by.withColumn("level", F.coalesce("level", "plain"))
    by = by.withColumn("level", F.max(F.when(F.col("level") * F.col("weight") <= F.col("most"), F.col("level"))).over(all_rows))
    return by.select("source", "source_size", "sized",
                     F.least(F.col("most"), F.coalesce(F.col("level") * F.col("weight"), F.col("most"))).alias("target"))


def _chance(*of) -> Column:
    """A number in [0, 1) from a hash."""
    return F.shiftrightunsigned(F.xxhash64(*of), 11).cast("double") / F.lit(float(1 << 53))


def _fold(items: Column, seed: int) -> Column:
    """Pivotal rounding along an array of (row, size, p): state ``left`` is
    the one fractional document carried, ``done`` the decided ones."""
    start = F.lit(None).cast("struct<row:string, size:bigint, p:double>")

    def step(state: Column, x: Column) -> Column:
        a = state["left"]
        # mass moves in words: from a to x until a is 0 or x is 1, or back until a is 1 or x is 0
        to_x = F.least(a["p"] * a["size"], (1 - x["p"]) * x["size"])
        to_a = F.least((1 - a["p"]) * a["size"], x["p"] * x["size"])
        forward = _chance(F.lit(seed), a["row"], x["row"]) < to_a / (to_x + to_a)
        moved = F.when(forward, to_x).otherwise(-to_a)
        pa = a["p"] - moved / a["size"]
        px = x["p"] + moved / x["size"]
        whole_a, whole_x = (pa < NEAR) | (pa > 1 - NEAR), (px < NEAR) | (px > 1 - NEAR)
        pair = lambda row, up: F.struct(row.alias("row"), up.alias("up"))
        done = F.filter(F.array(F.when(whole_a, pair(a["row"], pa > 0.5)), F.when(whole_x, pair(x["row"], px > 0.5))),
                        lambda d: d.isNotNull())
        keep = lambda src, p: F.struct(src["row"].alias("row"), src["size"].alias("size"), p.alias("p"))
        left = F.when(~whole_x, keep(x, px)).when(~whole_a, keep(a, pa)).otherwise(start)
        go = F.struct(left.alias("left"), F.concat(state["done"], done).alias("done")).cast(STATE)
        first = F.struct(keep(x, x["p"]).alias("left"), state["done"].alias("done")).cast(STATE)
        return F.when(a.isNull(), first).otherwise(go)

    empty = F.struct(start.alias("left"), F.array().cast("array<struct<row:string, up:boolean>>").alias("done")).cast(STATE)
    return F.aggregate(items, empty, step)


def round_parts(parts: DataFrame, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """``parts(source, row, size, p)`` with 0 < p < 1 and size > 0 ->
    ``(row, up)``.  One pass per level of the reduction tree."""
    decided: list[DataFrame] = []
    most = parts.groupBy("source").count().agg(F.max("count").alias("n")).first().n or 0
    left, level = parts, 0
    while most:
        counts = left.groupBy("source").agg(F.count(F.lit(1)).alias("n")) if level == 0 else None
        if counts is not None:
            blocks = F.ceil(F.col("n") / block)
            left = left.join(counts.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
        else:
            blocks = F.ceil(F.col("blocks") / block)
        dealt = left.withColumn("blocks", blocks.cast("long"))
        dealt = dealt.withColumn("at", F.pmod(F.xxhash64(F.lit(seed + level), "row"), F.col("blocks")))
        folded = (dealt.groupBy("source", "blocks", "at")
                  .agg(F.array_sort(F.collect_list(F.struct("size", "row", "p"))).alias("items"))
                  .select("source", "blocks", _fold(F.transform("items", lambda i: F.struct(i["row"].alias("row"), i["size"].alias("size"), i["p"].alias("p"))),
                                          seed + level).alias("state")))
        folded = materialise(folded.select("source", "blocks", "state.left", "state.done"), "mix")
        decided.append(folded.select(F.explode("done").alias("d")).select("d.*"))
        left = folded.where("left is not null").select("source", "blocks", "left.row", "left.size", "left.p")
        most, level = math.ceil(most / block), level + 1
        if most <= 1:
            break
    if not decided:
        return parts.select("row", F.lit(False).alias("up")).limit(0)
    last = left.select("row", (_chance(F.lit(seed - 1), F.col("row")) < F.col("p")).alias("up"))
    return _union([*decided, last])


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def plan(docs: DataFrame, weights: tuple = WEIGHTS, most: float = MOST_COPIES, seed: int = SEED) -> DataFrame:
    """Per document row: row, doc_id, source, size, text_hash, source_size,
    target, copies, taken (words, repeats counted)."""
    rows = materialise(sized(docs), "mix-rows")
    share = targets(rows, weights, most).withColumnRenamed("source", "s")
    wanted = rows.join(F.broadcast(share) if _few(share) else share, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    wanted = wanted.withColumns({"rate": rate, "large": F.col("size") > F.col("source_size") / F.col("sized")})

    def with_parts(rows: DataFrame) -> DataFrame:
        base = F.floor(F.col("rate") + NEAR)
        return rows.withColumns({"base": base, "p": F.greatest(F.col("rate") - base, F.lit(0.0))})

    def rounded(rows: DataFrame, level_seed: int) -> DataFrame:
        ups = round_parts(rows.where((F.col("size") > 0) & (F.col("p") > NEAR)).select("source", "row", "size", "p"), seed=level_seed)
        copies = F.when(F.col("size") > 0, F.col("base") + F.coalesce(F.col("up"), F.lit(False)).cast("long")).otherwise(0)
        return rows.join(ups, "row", "left").withColumn("copies", copies.cast("long")).drop("base", "p", "up")

    large = materialise(rounded(with_parts(wanted.where("large")), seed), "mix-large")
    missed = large.groupBy("source").agg(F.sum(F.col("copies") * F.col("size") - F.col("rate") * F.col("size")).alias("missed"))
    room = wanted.where(~F.col("large")).groupBy("source").agg(F.sum("size").alias("room"))
    shift = (missed.join(room, missed["source"].eqNullSafe(room["source"]))
             .select(missed["source"].alias("s"), F.when(F.col("room") > 0, -F.col("missed") / F.col("room")).alias("shift")))
    small = (wanted.where(~F.col("large")).join(shift, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
             .withColumn("rate", F.greatest(F.lit(0.0), F.least(F.lit(float(most)), F.col("rate") + F.coalesce("shift", F.lit(0.0)))))
             .drop("shift"))
    out = large.unionByName(rounded(with_parts(small), seed + 1000))
    return (out.withColumn("taken", (F.col("copies") * F.col("size")).cast("long")).drop("rate", "large", "sized"))


FEW_SOURCES = 10_000     # a table of more sources is joined by shuffle


def _few(share: DataFrame) -> bool:
    return share.limit(FEW_SOURCES + 1).count() <= FEW_SOURCES


def mix(docs: DataFrame, weights: tuple = WEIGHTS, most: float = MOST_COPIES, seed: int = SEED) -> DataFrame:
    """The mix itself: each document as many times as its copies; the
    columns of ``docs``.

    Whole documents are shuffled once, by their identity without its ordinal.
    Repeated rows (equal in it) have equal texts and sources: they share the
    copies of all of them evenly, numbered in the same partitions."""
    own = plan(docs, weights, most, seed).select(F.substring_index("row", "/", 2).alias("key"), "copies")
    own = own.groupBy("key").agg(F.sum("copies").alias("all"), F.count(F.lit(1)).alias("rows")).where(F.col("all") > 0)
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc")
    keyed = docs.select(whole, row_key(F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"), F.xxhash64("text")).alias("key"))
    taken = keyed.join(own.hint("shuffle_hash"), "key")
    turn = F.row_number().over(Window.partitionBy("key").orderBy("rows"))
    copies = F.floor(F.col("all") / F.col("rows")) + (turn <= F.col("all") % F.col("rows")).cast("long")
    return (taken.withColumn("copies", copies).where("copies > 0")
            .select("doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("doc.*"))
