"""Incremental build: two batches equal one full build; gated publish;
model selection; schema append."""

import pytest
from pyspark.sql import functions as F

from ticksmith.plans import build as BLD
from ticksmith.sources.bronze import write_bronze
from ticksmith.sources.fixtures import FixtureBronze

from .conftest import SF_SMALL, rows

AUDIT = ["_camada", "_carregado_em", "_transformado_em", "_gerado_em"]


def land(spark, root, fx, matches_filter=None):
    for t in BLD.ALL_TABLES:
        df = fx.table(t)
        if matches_filter is not None:
            df = df.where(matches_filter)
        write_bronze(df, f"{root}/bronze", t, mode="append")


def _sorted_cols(df):
    df = df.drop(*AUDIT)
    return df.select(*sorted(df.columns))


def snapshot(lake):
    out = {}
    for t in BLD.ALL_TABLES:
        out[f"silver_{t}"] = rows(_sorted_cols(lake.read_silver(t)))
    for g in BLD.GOLD_FACTS:
        out[g] = rows(_sorted_cols(lake.read_gold(g)))
    return out


def test_two_batches_equal_one_build(spark, tmp_root):
    fx = FixtureBronze(spark, SF_SMALL)
    first = F.col("match_id").startswith("cup-a")
    # incremental: batch 1 then batch 2
    inc = BLD.Lake(spark, f"{tmp_root}/inc")
    land(spark, inc.root, fx, first)
    BLD.build(inc)
    land(spark, inc.root, fx, ~first)
    inc._bronze = None
    BLD.build(inc)
    # full build in one go
    full = BLD.Lake(spark, f"{tmp_root}/full")
    land(spark, full.root, fx)
    BLD.build(full)
    a, b = snapshot(inc), snapshot(full)
    for k in b:
        assert a[k] == b[k], k
    # a third run adds nothing
    BLD.build(inc)
    assert snapshot(inc)["silver_kills"] == b["silver_kills"]


def test_model_select_and_full_refresh(spark, tmp_root):
    fx = FixtureBronze(spark, SF_SMALL)
    lake = BLD.Lake(spark, f"{tmp_root}/lake")
    land(spark, lake.root, fx)
    built = BLD.build(lake, select=["silver_header"])
    assert built == ["silver_header"]
    assert not BLD.path_exists(spark, lake.silver_path("kills"))
    n = lake.read_silver("header").count()
    BLD.build(lake, select=["silver_header"], full_refresh=True)
    assert lake.read_silver("header").count() == n


def test_schema_append_gives_null_for_old_rows(spark, tmp_root):
    path = f"{tmp_root}/t"
    a = spark.createDataFrame([("e/f/m1", 1)], "match_id string, x int")
    b = spark.createDataFrame([("e/f/m2", 2, "new")], "match_id string, x int, y string")
    BLD.append_new_matches(a, path, "silver")
    BLD.append_new_matches(b, path, "silver")
    got = rows(spark.read.option("mergeSchema", "true").parquet(path).select("match_id", "x", "y"))
    assert got == [("e/f/m1", 1, None), ("e/f/m2", 2, "new")]


def test_gold_upsert_replaces_match_rows(spark, tmp_root):
    path = f"{tmp_root}/g"
    v1 = spark.createDataFrame([("e/f/m1", 1, 5), ("e/f/m1", 2, 6), ("e/g/m2", 1, 7)], "match_id string, steamid long, kills long")
    BLD.upsert_by_match(v1, path)
    v2 = spark.createDataFrame([("e/f/m1", 1, 9)], "match_id string, steamid long, kills long")
    BLD.upsert_by_match(v2, path)
    got = rows(spark.read.parquet(path).select("match_id", "steamid", "kills"))
    assert got == [("e/f/m1", 1, 9), ("e/g/m2", 1, 7)]


def test_gated_publish(spark, tmp_root):
    fx = FixtureBronze(spark, SF_SMALL)
    lake = BLD.Lake(spark, f"{tmp_root}/lake")
    land(spark, lake.root, fx)
    BLD.build(lake)
    report = BLD.quality_report(lake)
    assert report.where("failures > 0").count() == 0          # sf0.001 has no rate-less matches
    names = BLD.gated_publish(lake, f"{tmp_root}/pub")
    assert set(names) == set(BLD.GOLD_FACTS) | set(BLD.GOLD_VIEWS)
    assert BLD.gold_scan(spark, f"{tmp_root}/pub", "ranking_kills").count() > 0
    bad = report.union(spark.createDataFrame([("x", "not_null", "c", 3)], report.schema))
    with pytest.raises(BLD.QualityGateFailed):
        BLD.gated_publish(lake, f"{tmp_root}/pub2", tests=bad)
    assert not BLD.path_exists(spark, f"{tmp_root}/pub2")


def test_refresh_matches_propagates_a_reload(spark, tmp_root):
    """A forced bronze reload (here: one match loses its odd-round kills)
    reaches silver and gold; the result equals a full rebuild."""
    from ticksmith.sources.bronze import replace_match
    fx = FixtureBronze(spark, SF_SMALL)
    target = fx.table("header").select("match_id").orderBy("match_id").limit(1).collect()[0].match_id
    lake = BLD.Lake(spark, f"{tmp_root}/lake")
    land(spark, lake.root, fx)
    BLD.build(lake)
    before = snapshot(lake)
    new_tables = {t: fx.table(t).where(F.col("match_id") == target) for t in BLD.ALL_TABLES}
    new_tables["kills"] = new_tables["kills"].where(F.col("round_num").cast("int") % 2 == 0)
    replace_match(spark, f"{lake.root}/bronze", new_tables, [target])
    lake._bronze = None
    BLD.refresh_matches(lake, spark.createDataFrame([(target,)], "match_id string"))
    after = snapshot(lake)
    full = BLD.Lake(spark, f"{tmp_root}/full", bronze_root=f"{lake.root}/bronze")
    BLD.build(full)
    expected = snapshot(full)
    for k in expected:
        assert after[k] == expected[k], k
    assert after["silver_kills"] != before["silver_kills"]
    assert after["combate_jogador_partida"] != before["combate_jogador_partida"]


def test_incremental_reads_only_new_matches(spark, tmp_root):
    import glob
    fx = FixtureBronze(spark, SF_SMALL)
    lake = BLD.Lake(spark, f"{tmp_root}/lake")
    first = F.col("match_id").startswith("cup-a")
    land(spark, lake.root, fx, first)
    BLD.build(lake, select=["silver_kills", "combate_jogador_partida", "silver_ticks", "silver_damages"])
    land(spark, lake.root, fx, ~first)
    lake._bronze = None
    done = BLD.processed_ids(lake, "silver_kills", lake.silver_path("kills"))
    ids = BLD.new_ids(lake.bronze.table("kills").select("match_id"), done)
    from ticksmith.operators.joins import restrict
    plan = restrict(lake.bronze.table("kills"), ids)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "match_id" in plan.split("PartitionFilters")[1][:300]
    BLD.build(lake, select=["silver_kills", "silver_ticks", "silver_damages", "combate_jogador_partida"])
    files = sorted(glob.glob(f"{lake.root}/silver/kills/**/*.parquet", recursive=True))
    BLD.build(lake, select=["silver_kills"])                       # nothing new: nothing written
    assert sorted(glob.glob(f"{lake.root}/silver/kills/**/*.parquet", recursive=True)) == files
    assert (BLD.processed_ids(lake, "silver_kills", "").count()
            == fx.table("kills").select("match_id").distinct().count())
