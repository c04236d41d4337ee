from pyspark.sql import functions as F

from ticksmith.operators import silver as S
from ticksmith.sources.bronze import conform_bronze

from .conftest import rows


def bronze(spark, table, data, cols):
    df = spark.createDataFrame(data, ", ".join(f"{c} string" for c in cols))
    return conform_bronze(df, table)


def test_tick_rate_mode_ties_smallest_and_needs_cvar(spark):
    r = bronze(spark, "rounds", [
        ("m1", "1", "0", "128"), ("m1", "2", "1000", "1128"), ("m1", "3", "2000", "2064"), ("m1", "4", "3000", "3064"),
        ("m2", "1", "0", "640"),
    ], ["match_id", "round_num", "start", "freeze_end"])
    c = bronze(spark, "cvars", [("m1", "-1", "mp_freezetime", " 1 ")], ["match_id", "tick", "name", "value"])
    got = rows(S.tick_rate(r, c))
    assert got == [("m1", 64.0)]        # 64 and 128 tie twice each -> 64; m2 has no freeze-time setting


def test_zero_freezetime_gives_null_rate(spark):
    r = bronze(spark, "rounds", [("m1", "1", "0", "128")], ["match_id", "round_num", "start", "freeze_end"])
    c = bronze(spark, "cvars", [("m1", "-1", "mp_freezetime", "0")], ["match_id", "tick", "name", "value"])
    assert rows(S.tick_rate(r, c)) == [("m1", None)]


def test_restart_artifacts_drop_whole_tick_keep_single(spark):
    cols = ["match_id", "round_num", "tick", "attacker_steamid", "victim_steamid", "weapon"]
    k = bronze(spark, "kills", [
        ("m1", "1", "10", "1", "1", "world"),     # restart burst: two self-kills by the world
        ("m1", "1", "10", "2", "2", "world"),
        ("m1", "1", "10", "3", "4", "ak47"),      # same tick: dropped with the burst
        ("m1", "1", "20", "5", "5", "world"),     # a single one is a real death
        ("m1", "", "30", "6", "6", "world"),      # unknown round never matches an artefact
        ("m1", "", "30", "7", "7", "world"),
    ], cols)
    clock = spark.createDataFrame([("m1", 1, 0, 64.0)], "match_id string, round_num int, round_start_tick int, taxa_de_tick double")
    out = S.silver_kills(k, clock)
    assert rows(out.select("tick", "victim_steamid")) == [(20, 5), (30, 6), (30, 7)]
    assert rows(out.where("tick = 20").select(S.SECONDS)) == [(20 / 64.0,)]


def test_duplicate_round_fans_out(spark):
    r = bronze(spark, "rounds", [("m1", "1", "0", "64"), ("m1", "1", "0", "64")],
               ["match_id", "round_num", "start", "freeze_end"])
    rate = spark.createDataFrame([("m1", 64.0)], "match_id string, taxa_de_tick double")
    clock = S.round_clock(r, rate)
    t = bronze(spark, "ticks", [("m1", "1", "64", "1")], ["match_id", "round_num", "tick", "steamid"])
    assert S.silver_ticks(t, clock).count() == 2


def test_grenades_filter_entities_and_null_type(spark):
    g = bronze(spark, "grenades", [("m1", "CKnife"), ("m1", "CC4"), ("m1", " "), ("m1", "CFlashbang"),
                                   ("m1", "CWeaponGlock")], ["match_id", "grenade_type"])
    assert rows(S.silver_grenades(g).select("grenade_type")) == [("CFlashbang",)]


def test_missing_columns_are_null_and_typed(spark):
    h = bronze(spark, "header", [("m1", "de_nuke", "True")], ["match_id", "map_name", "allow_clientside_entities"])
    out = S.silver_header(h)
    r = out.collect()[0]
    assert r.map_name == "de_nuke" and r.allow_clientside_entities is True and r.fullpackets_version is None
    assert dict(out.dtypes)["fullpackets_version"] == "bigint"


def test_event_without_round_keeps_null_seconds(spark):
    clock = spark.createDataFrame([("m1", 1, 0, 64.0)], "match_id string, round_num int, round_start_tick int, taxa_de_tick double")
    s = bronze(spark, "shots", [("m1", "2", "100"), ("m2", "1", "5")], ["match_id", "round_num", "tick"])
    out = S.silver_shots(s, clock)
    assert rows(out.select("match_id", S.SECONDS)) == [("m1", None), ("m2", None)]


def test_silver_plan_broadcasts_small_clock_and_prunes_columns(spark):
    from ticksmith.plans.catalog import Workspace
    from .conftest import SF_SMALL
    ws = Workspace(spark, SF_SMALL)
    plan = ws.silver.table("ticks")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_bounded_broadcast_respects_budget(spark):
    from ticksmith.operators.joins import bounded_broadcast, max_broadcast_rows, row_bytes
    clock = spark.createDataFrame([("m", 1, 0, 64.0)] * 10,
                                  "match_id string, round_num int, round_start_tick int, taxa_de_tick double")
    assert row_bytes(clock.schema) == 16 + 48 + 4 + 4 + 8
    assert max_broadcast_rows(clock) == (1 << 30) // 80          # ~13M clock rows fit the default budget
    big = spark.range(100).withColumnRenamed("id", "round_num")
    plan = lambda df: df._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in plan(bounded_broadcast(clock)).lower()
    assert "broadcast" not in plan(bounded_broadcast(big, max_rows=10)).lower()
