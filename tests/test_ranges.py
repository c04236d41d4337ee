"""Paging by key and by counted ranges, as-of totals, prefix sums in blocks, value tests in one pass."""

import random

import pytest
from pyspark.sql import functions as F

from ticksmith.operators import clutch as C
from ticksmith.operators import pages as P
from ticksmith.operators import quality as Q
from ticksmith.plans import build as BLD
from ticksmith.sources import stitch as ST

SPEC = P.PageSpec("fact", ("match_id", "evento"), (("kills", True),), join_dim=False, tiebreak=("match_id", "steamid"))


def fact(spark, n=400):
    rng = random.Random(2)
    data = [(f"e{rng.randrange(3)}/f/m{rng.randrange(30)}", rng.choice([None, *range(6)]), rng.choice([None, *range(5)])) for _ in range(n)]
    return spark.createDataFrame(sorted(set(data), key=str), "match_id string, steamid long, kills long")


def listed(df):
    return [tuple(r) for r in df.select("match_id", "steamid", "kills").collect()]


def test_keyset_pages_walk_the_whole_order(spark):
    df = fact(spark)
    whole = listed(df.orderBy(*P._ordering(SPEC)))
    got, last = [], None
    while rows := P.page_after(df, None, SPEC, {}, last, 97).collect():
        got += [(r.match_id, r.steamid, r.kills) for r in rows]
        last = rows[-1].asDict()
    assert got == whole and len(whole) > 150


@pytest.mark.parametrize("offset,size", [(0, 7), (60, 50), (149, 3), (10_000, 5)])
def test_deep_page_equals_offset(spark, offset, size):
    df = fact(spark).repartition(5)
    assert listed(P.deep_page(df, SPEC, offset, size)) == listed(df.orderBy(*P._ordering(SPEC)))[offset:offset + size]


def test_deep_numbered_page_has_no_large_offset(spark, monkeypatch):
    monkeypatch.setattr(P, "DEEP_OFFSET", 100)
    df = fact(spark)
    page = P.page_rows(df, None, SPEC, {}, 15, 10)
    assert listed(page) == listed(df.orderBy(*P._ordering(SPEC)))[140:150]
    plan = page._jdf.queryExecution().optimizedPlan().toString()
    assert "Offset 140" not in plan


def test_tournament_filter_prunes_folders(spark, tmp_root):
    lake = BLD.Lake(spark, tmp_root)
    own = spark.createDataFrame([(f"e{k % 3}/f/m{k}", k) for k in range(30)], "match_id string, steamid long").withColumns(
        {c: F.lit(k).cast("bigint") for k, c in enumerate(["plants", "defuses"])}).withColumn("nome", F.lit("x"))
    BLD.upsert_by_match(own, lake.gold_path("bomba_jogador_partida"))
    dim = own.select("match_id", F.split_part("match_id", F.lit("/"), F.lit(1)).alias("evento"), *[F.lit("y").alias(c) for c in P.DIM_COLUMNS[1:]]).distinct()
    page = P.page_rows(lake.read_gold_by_evento("bomba_jogador_partida"), dim, P.PAGES["page_bomba"], {"evento": "e1"})
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "evento" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert page.count() == 10 and page.columns == P.page_rows(lake.read_gold("bomba_jogador_partida"), dim, P.PAGES["page_bomba"], {}).columns


def test_losses_until_equals_plain_sums(spark):
    rng = random.Random(6)
    draw = lambda values: rng.choice([None, *values])
    probes = [(i, draw("ab"), draw(range(6))) for i in range(60)]
    events = [(draw("ab"), draw(range(6)), rng.randint(1, 3)) for _ in range(80)]
    got = C.losses_until(spark.createDataFrame(probes, "id int, k string, at int"), spark.createDataFrame(events, "k string, tick int, n int"), ["k"], "at", "total")
    want = {i: sum(n for k2, t, n in events if k == k2 and k is not None and t is not None and at is not None and t <= at) for i, k, at in probes}
    assert {r.id: r.total for r in got.collect()} == want and got.columns == ["id", "k", "at", "total"]


def test_blocked_prefix_equals_running_sums(spark, monkeypatch):
    """One match holds a third of all parts; blocks of four."""
    monkeypatch.setattr(ST, "PART_BLOCK", 4)
    rng = random.Random(8)
    rows = [("hot", p, rng.randint(0, 9), None if p % 7 == 0 else p) for p in range(1, 41)]
    rows += [(f"m{k}", p, rng.randint(0, 9), 1) for k in range(20) for p in rng.sample(range(1, 30), 4)]
    got = ST.blocked_prefix(spark.createDataFrame(rows, "m string, p int, a long, b long"), "m", "p", {"a": "x", "b": "y"})
    want = {(m, p): (sum(r[2] for r in rows if r[0] == m and r[1] < p), sum(r[3] or 0 for r in rows if r[0] == m and r[1] < p)) for m, p, _, _ in rows}
    assert {(r.m, r.p): (r.x, r.y) for r in got.collect()} == want


def test_column_tests_in_one_pass(spark):
    df = spark.createDataFrame([(None, "a"), (1, "z"), (2, "z"), (None, "y"), (3, None)], "x int, s string")
    report = Q.model_tests(df, "m", ["x", "s"], [], {"s": ["a"]})
    assert sorted((r.test, r.column_name, r.failures) for r in report.collect()) == [("accepted_values", "s", 2), ("not_null", "s", 1), ("not_null", "x", 2)]
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan
    clean = Q.model_tests(df.where("x = 1"), "m", ["x"], [], {"s": ["z"]})
    assert [r.failures for r in clean.collect()] == [0, 0]


def test_page_params_bounds():
    assert [P.page_params(*a) for a in [(), ("2", "10"), ("0", "9999"), ("x", ""), (-3, -1), (None, "+7"), ("2.5", "1e3")]] == [
        (1, 50), (2, 10), (1, 500), (1, 50), (1, 1), (1, 7), (1, 50)]
