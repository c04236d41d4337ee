import random

from pyspark.sql import functions as F

from ticksmith.sources import bronze as B
from ticksmith.sources import stitch as ST

from .conftest import rows


def test_identity_parsing(spark):
    df = spark.createDataFrame([("a/b/g2-vs-spirit-m3-mirage-p1.dem",), ("a/b/x-p10.dem",), ("a/b/x.dem",),
                                ("a/b/y-p2-p3.dem",), ("a/b.c/z",), ("a/b/w.tar.gz",), ("a/b/.dem",)], "caminho string")
    got = [(r.caminho, r.match_id, r.parte) for r in B.with_identity(df).collect()]
    assert got == [("a/b/g2-vs-spirit-m3-mirage-p1.dem", "a/b/g2-vs-spirit-m3-mirage", 1),
                   ("a/b/x-p10.dem", "a/b/x", 10), ("a/b/x.dem", "a/b/x", 1), ("a/b/y-p2-p3.dem", "a/b/y-p2", 3),
                   ("a/b.c/z", "a/b.c/z", 1), ("a/b/w.tar.gz", "a/b/w.tar", 1), ("a/b/.dem", "a/b/.dem", 1)]


def test_match_parts_numeric_order(spark):
    m = spark.createDataFrame([(1, "e", "f", "x-p10.dem"), (2, "e", "f", "x-p2.dem"), (3, "e", "f", "x.dem"),
                               (4, "e", "f", "x-p1.dem"), (5, "e", "f", "x-p3.zip")],
                              "item_id long, evento string, fase string, arquivo string")
    got = [(r.ordem, r.caminho) for r in B.match_parts(m).orderBy("ordem").collect()]
    assert got == [(1, "e/f/x-p1.dem"), (2, "e/f/x.dem"), (3, "e/f/x-p2.dem"), (4, "e/f/x-p10.dem")]


def test_manifest_validate(spark):
    m = spark.createDataFrame([(1, " cup ", "final", "a-b.dem"), (2, "c/d", "", "x.zip"), (3, "cup", "f", "a b.dem"),
                               (4, "cup", "f", "A.ZIP"), (5, None, "f", "r.txt")],
                              "item_id long, evento string, fase string, arquivo string")
    got = {r.item_id: (r.erro_evento, r.erro_fase, r.erro_arquivo, r.aceito) for r in B.manifest_validate(m).collect()}
    assert got == {1: (None, None, None, True), 2: ("invalid_name", "required", None, False),
                   3: (None, None, "invalid_file", False), 4: (None, None, None, True),
                   5: ("required", None, "invalid_file", False)}


def test_batch_members_refuses_large_batch(spark):
    entries = [("big", f"d/x{i}.dem") for i in range(201)] + [("ok", "d/"), ("ok", "d/a.dem"), ("ok", "README"),
                                                                ("ok", "z/bad name.dem")]
    df = spark.createDataFrame(entries, "lote string, entrada string")
    got = B.batch_members(df)
    st = {r.entrada: r.status for r in got.where("lote = 'ok'").collect()}
    assert st == {"d/a.dem": "accepted", "README": "ignored", "z/bad name.dem": "rejected"}
    assert {r.status for r in got.where("lote = 'big'").collect()} == {"batch_refused"}


def test_write_scan_roundtrip_and_reload(spark, tmp_root):
    root = f"{tmp_root}/bronze"
    k = spark.createDataFrame([("cup/final/a-vs-b-m1-nuke", "1", "5"), ("cup/semi/c-vs-d-nuke", "2", "7")],
                              "match_id string, round_num string, tick string")
    B.write_bronze(k, root, "kills")
    h = spark.createDataFrame([("cup/final/a-vs-b-m1-nuke", "de_nuke"), ("cup/semi/c-vs-d-nuke", "de_nuke")],
                              "match_id string, map_name string")
    B.write_bronze(h, root, "header")
    back = B.bronze_scan(spark, root, "kills")
    assert rows(back.select("match_id", "tick")) == [("cup/final/a-vs-b-m1-nuke", "5"), ("cup/semi/c-vs-d-nuke", "7")]
    assert set(back.columns) >= {"attacker_name", "weapon", "_arquivo_origem"}
    # skip already loaded
    cand = spark.createDataFrame([("cup/final/a-vs-b-m1-nuke",), ("new/x/y",)], "match_id string")
    assert rows(B.skip_loaded(cand, B.loaded_matches(spark, root))) == [("new/x/y",)]
    # forced reload: the new load has no kills for the match -> the old kills must go (not linger)
    B.replace_match(spark, root, {"header": h.limit(1).where("match_id like 'cup/final%'")},
                    ["cup/final/a-vs-b-m1-nuke"])
    assert rows(B.bronze_scan(spark, root, "kills").select("match_id")) == [("cup/semi/c-vs-d-nuke",)]
    assert B.clear_layer(spark, root) is True and B.clear_layer(spark, root) is False


def test_files_with_different_columns_union_by_name(spark, tmp_root):
    root = f"{tmp_root}/bronze"
    B.write_bronze(spark.createDataFrame([("e/f/m1", "1")], "match_id string, tick string"), root, "cvars")
    B.write_bronze(spark.createDataFrame([("e/f/m2", "x", "2")], "match_id string, name string, tick string"),
                   root, "cvars")
    assert rows(B.bronze_scan(spark, root, "cvars").select("match_id", "name", "tick")) == [
        ("e/f/m1", None, "1"), ("e/f/m2", "x", "2")]


def sequential_offsets(parts):
    """The part-by-part rule: offsets grow by the previous part's shifted
    maxima."""
    out, r_off, t_off = {}, 0, 0
    for p in sorted(parts):
        rounds, ticks = parts[p]
        out[p] = (r_off, t_off)
        r_off = max(r + r_off for r, _ in rounds)
        t_off = max(max(oe + t_off for _, oe in rounds), max((t + t_off for t in ticks), default=-10**9)) + 1
    return out


def test_stitch_prefix_sum_equals_sequential(spark):
    rng = random.Random(3)
    rr, tt, expected = [], [], {}
    for m in range(20):
        parts = {}
        for p in range(1, rng.randint(2, 5)):
            rounds = [(r, r * 100 + rng.randint(0, 90)) for r in range(1, rng.randint(2, 6))]
            ticks = [rng.randint(0, 700) for _ in range(rng.randint(0, 4))]
            parts[p] = (rounds, ticks)
            rr += [(f"m{m}", p, r, oe) for r, oe in rounds]
            tt += [(f"m{m}", p, t) for t in ticks]
        for p, v in sequential_offsets(parts).items():
            expected[(f"m{m}", p)] = v
    r = spark.createDataFrame(rr, "match_id string, parte int, round_num int, official_end int")
    t = spark.createDataFrame(tt, "match_id string, parte int, tick int")
    got = {(x.match_id, x.parte): (x.round_offset, x.tick_offset) for x in ST.part_offsets(r, t).collect()}
    assert got == expected


def test_stitch_tables(spark):
    rounds = spark.createDataFrame([("m", 1, 1, 0, 90, None), ("m", 2, 1, 0, 50, 20)],
                                   "match_id string, parte int, round_num int, start int, official_end int, bomb_plant int")
    cvars = spark.createDataFrame([("m", 1, -1), ("m", 2, -1), ("m", 2, 5)], "match_id string, parte int, tick int")
    hdr = spark.createDataFrame([("m", 2, "de_b", "e/f/x-p2.dem"), ("m", 1, "de_a", "e/f/x-p1.dem")],
                                "match_id string, parte int, map_name string, _arquivo_origem string")
    out = ST.stitch({"rounds": rounds, "cvars": cvars, "header": hdr})
    assert rows(out["rounds"]) == [("m", 1, 0, 90, None), ("m", 2, 91, 141, 111)]
    assert rows(out["cvars"]) == [("m", -1), ("m", -1), ("m", 96)]
    assert rows(out["header"]) == [("m", "de_a", "e/f/x-p1.dem, e/f/x-p2.dem")]


def test_default_input_is_first_of_sorted_recursive_listing(spark, tmp_root):
    import os
    for rel in ["b/final/z.dem", "a/semi/y.dem", "a/semi/readme.txt", "a/group/x-p2.dem"]:
        os.makedirs(os.path.dirname(f"{tmp_root}/demos/{rel}"), exist_ok=True)
        with open(f"{tmp_root}/demos/{rel}", "wb") as f:
            f.write(b"DEMO")
    listing = B.list_recordings(spark, f"{tmp_root}/demos")
    assert listing.count() == 3
    assert B.first_pending(listing).collect()[0].path.endswith("a/group/x-p2.dem")


def test_layout_paths_match_written_folders(spark, tmp_root):
    import os
    from urllib.parse import unquote
    mid = "cup-a/final/t0-vs-u0-m1-mirage"
    B.write_bronze(spark.createDataFrame([(mid, "1")], "match_id string, tick string"), f"{tmp_root}/b", "kills")
    flat, part = B.layout_paths("kills", F.lit(mid))
    r = spark.range(1).select(flat.alias("f"), part.alias("p")).collect()[0]
    assert r.f == "kills/cup-a/final/t0-vs-u0-m1-mirage.parquet"
    assert os.path.isdir(f"{tmp_root}/b/{r.p}")
    assert unquote(r.p.split("match_id=")[1]) == mid


def test_stitch_null_rate_and_skip_over_whole_input(spark):
    from ticksmith.plans import queries as Q
    from ticksmith.plans.catalog import Workspace
    from ticksmith.schemas import ALL_TABLES
    from .conftest import SF_SMALL
    ws = Workspace(spark, SF_SMALL)
    want = {(r.match_id, int(r.round_num)) for r in ws.bronze.table("rounds").select("match_id", "round_num").collect()}
    got = Q.REGISTRY["stitch_parts_every"](ws).collect()
    assert {(r.match_id, r.round_num) for r in got} == want and len(got) == len(want)       # rounds 1..20 again
    headers = {r.match_id for r in ws.bronze.table("header").select("match_id").collect()}
    assert {r.match_id for r in Q.REGISTRY["stitch_header_every"](ws).collect()} == headers == {m for m, _ in want}
    assert ({r.match_id for r in Q.REGISTRY["stitch_cvars_every"](ws).collect()}
            == {r.match_id for r in ws.bronze.table("cvars").select("match_id").collect()} & headers)
    plan = Q.REGISTRY["skip_loaded"](ws)._jdf.queryExecution().analyzed().toString()
    assert not [x for x in plan.splitlines() if "Filter" in x and "allow_clientside" in x]     # no header is left out
    for t in ALL_TABLES:
        silver = ws.silver.table(t).drop("_carregado_em")
        n = silver.count()
        rate = {r.column_name: (r.model, r.nulos, r.linhas) for r in Q.REGISTRY["dq_null_rate" + ("" if t == "kills" else f"_{t}")](ws).collect()}
        assert set(rate) == set(silver.columns)
        assert all(rate[c] == (f"silver_{t}", silver.where(F.col(c).isNull()).count(), n) for c in ("match_id", "_arquivo_origem"))
