"""Failing sequences of the write side: reloads, crashes, archives, builds without news, publishing."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from ticksmith.plans import build as BLD
from ticksmith.sources import bronze as B
from ticksmith.streaming import landing as L

from .conftest import rows

MATCHES = ["cup-a/final/t1-vs-t2-m1", "cup-a/final/t3-vs-t4-m1", "cup-b/semi/t1-vs-t2-m1"]
MODELS = ["silver_bomb", "silver_rounds", "bomba_jogador_partida"]


def tables(spark, matches, events=3):
    """Small bronze tables: one round a match, ``events`` plants of one player."""
    head = spark.createDataFrame([(m, "de_nuke") for m in matches], "match_id string, map_name string")
    rnd = spark.createDataFrame([(m, "1", "0", "64", "900", "1000", "ct") for m in matches],
                                "match_id string, round_num string, start string, freeze_end string, `end` string, official_end string, winner string")
    cvar = spark.createDataFrame([(m, "-1", "mp_freezetime", "1") for m in matches], "match_id string, tick string, name string, value string")
    bomb = spark.createDataFrame([(m, "1", str(100 + i), "plant", "7") for m in matches for i in range(events)],
                                 "match_id string, round_num string, tick string, event string, steamid string")
    return {"header": head, "rounds": rnd, "cvars": cvar, "bomb": bomb}


def land(spark, root, own):
    for t in B.header_last(own):
        B.write_bronze(own[t], root, t)


def ticks(df):
    return sorted((r.match_id, int(r.tick)) for r in df.select("match_id", "tick").collect())


def bomb(spark, root):
    return ticks(B.bronze_scan(spark, root, "bomb"))


def plants(lake):
    return sorted((r.match_id, r.plants) for r in lake.read_gold("bomba_jogador_partida").select("match_id", "plants").collect())


def test_files_at_any_depth_are_read(spark, tmp_root):
    """Partition folders, the recording layout, a plain file deeper down and one without its own match id."""
    own = tables(spark, MATCHES)["bomb"]
    B.write_bronze(own.where(F.col("match_id") == MATCHES[0]), tmp_root, "bomb")
    B.write_flat_bronze(own.where(F.col("match_id") == MATCHES[1]), tmp_root, "bomb")
    assert os.path.isdir(f"{tmp_root}/bomb/{MATCHES[1]}.parquet")
    own.where(F.col("match_id") == MATCHES[2]).drop("match_id").coalesce(1).write.parquet(f"{tmp_root}/one")
    os.makedirs(f"{tmp_root}/bomb/cup-b/semi")
    os.rename(glob.glob(f"{tmp_root}/one/*.parquet")[0], f"{tmp_root}/bomb/{MATCHES[2]}.parquet")
    for discover in (False, True):
        assert ticks(B.bronze_scan(spark, tmp_root, "bomb", discover)) == ticks(own)
    # the recording layout alone builds too, and a later landing beside it
    lake = BLD.Lake(spark, f"{tmp_root}/lake")
    for t, df in tables(spark, MATCHES[:1]).items():
        B.write_flat_bronze(df, f"{lake.root}/bronze", t)
    BLD.build(lake, MODELS)
    assert plants(lake) == [(MATCHES[0], 3)]
    land(spark, f"{lake.root}/bronze", tables(spark, MATCHES[1:2]))
    BLD.build(lake, MODELS)
    assert plants(lake) == [(MATCHES[0], 3), (MATCHES[1], 3)]
    # a reload of the flat match replaces its file
    B.replace_match(spark, f"{lake.root}/bronze", tables(spark, MATCHES[:1], 1), [MATCHES[0]])
    BLD.build(lake, MODELS)
    assert plants(lake) == [(MATCHES[0], 1), (MATCHES[1], 3)]


def test_reload_that_fails_leaves_the_match_whole(spark, tmp_root, monkeypatch):
    land(spark, tmp_root, tables(spark, MATCHES))
    before = bomb(spark, tmp_root)
    nothing = {t: df.limit(0) for t, df in tables(spark, MATCHES).items()}
    with pytest.raises(B.NothingStaged):
        B.replace_match(spark, tmp_root, nothing, [MATCHES[0]])
    broken = tables(spark, MATCHES[:1], 1)
    broken["rounds"] = broken["rounds"].withColumn("start", F.raise_error(F.lit("bad recording")).cast("string"))
    with pytest.raises(Exception, match="bad recording"):
        B.replace_match(spark, tmp_root, broken, [MATCHES[0]])
    assert bomb(spark, tmp_root) == before
    B.recover_swaps(spark, tmp_root)
    assert bomb(spark, tmp_root) == before and not glob.glob(f"{tmp_root}/_staging/*")
    assert rows(B.landed_loads(spark, tmp_root)) == [(m, 1) for m in MATCHES]


def test_swap_cut_short_is_finished(spark, tmp_root, monkeypatch):
    """A crash at any rename: the next writer finishes the swap from its journal."""
    whole = B._rename
    want = None
    for crash_at in (0, 2, 3, 5):
        root = f"{tmp_root}/r{crash_at}"
        land(spark, root, tables(spark, MATCHES))
        done = []

        def rename(fs, source, target, at=crash_at, done=done):
            if len(done) == at:
                raise OSError("lost")
            done.append(1)
            whole(fs, source, target)
        monkeypatch.setattr(B, "_rename", rename)
        new = tables(spark, MATCHES[:1], 1)
        new["shots"] = new.pop("rounds").select("match_id", F.lit("5").alias("tick"))     # rounds: no rows any more
        try:
            B.replace_match(spark, root, new, [MATCHES[0]])
        except OSError:
            pass
        monkeypatch.setattr(B, "_rename", whole)
        B.recover_swaps(spark, root)
        got = (bomb(spark, root), ticks(B.bronze_scan(spark, root, "shots")),
               rows(B.bronze_scan(spark, root, "rounds").select("match_id")), rows(B.loaded_matches(spark, root)))
        want = want or got
        assert got == want and not glob.glob(f"{root}/_staging/*")
        assert rows(B.landed_loads(spark, root)) == [(MATCHES[0], 2), (MATCHES[1], 1), (MATCHES[2], 1)]
    assert want == ([(MATCHES[0], 100)] + [(m, 100 + i) for m in MATCHES[1:] for i in range(3)], [(MATCHES[0], 5)],
                    [(m,) for m in MATCHES[1:]], [(m,) for m in MATCHES])


def test_plain_build_shows_a_reload_and_rewrites_one_bucket(spark, tmp_root):
    lake = BLD.Lake(spark, tmp_root)
    many = [f"cup-a/final/t{i}-vs-x-m1" for i in range(24)]
    land(spark, f"{tmp_root}/bronze", tables(spark, many))
    BLD.build(lake, MODELS)
    folders = lambda: {d: sorted(glob.glob(f"{d}/*.parquet")) for d in glob.glob(f"{tmp_root}/*/bom*/evento=*/balde=*")}
    before = folders()
    B.replace_match(spark, f"{tmp_root}/bronze", tables(spark, many[:1], 1), [many[0]])
    BLD.build(lake, MODELS)
    assert plants(lake) == sorted([(many[0], 1)] + [(m, 3) for m in many[1:]])
    assert ticks(lake.read_silver("bomb")) == bomb(spark, f"{tmp_root}/bronze")
    after = folders()
    assert set(after) == set(before) and len(before) > 8
    changed = [d for d in before if before[d] != after[d]]
    assert len(changed) == 2 and {d.split("/")[-4] for d in changed} == {"silver", "gold"}       # one bucket of each table


def test_build_without_news_opens_no_bronze_file(spark, tmp_root):
    lake = BLD.Lake(spark, tmp_root)
    land(spark, f"{tmp_root}/bronze", tables(spark, MATCHES))
    BLD.build(lake, MODELS)
    for path in glob.glob(f"{tmp_root}/bronze/*/evento=*/**/*.parquet", recursive=True):
        with open(path, "wb") as f:
            f.write(b"not parquet")
    BLD.build(BLD.Lake(spark, tmp_root), MODELS)
    assert plants(lake) == [(m, 3) for m in MATCHES]


def test_refresh_after_matches_left_and_came(spark, tmp_root):
    """Delete then refresh; land then refresh then build: no lost and no doubled rows."""
    lake = BLD.Lake(spark, tmp_root)
    land(spark, f"{tmp_root}/bronze", tables(spark, MATCHES[:2]))
    BLD.build(lake, MODELS)
    B.drop_matches(spark, f"{tmp_root}/bronze", [MATCHES[0]])
    BLD.build(lake, MODELS, full_refresh=True)
    assert plants(lake) == [(MATCHES[1], 3)]
    land(spark, f"{tmp_root}/bronze", tables(spark, MATCHES[2:]))
    BLD.refresh_matches(lake, spark.createDataFrame([(MATCHES[2],)], "match_id string"))
    BLD.build(lake, MODELS)
    assert plants(lake) == [(MATCHES[1], 3), (MATCHES[2], 3)]
    assert ticks(lake.read_silver("bomb")) == bomb(spark, f"{tmp_root}/bronze")


def test_landing_cut_short_before_the_header_is_repeated(spark, tmp_root):
    lake = BLD.Lake(spark, tmp_root)
    own = tables(spark, MATCHES[:1])
    for t in ("rounds", "bomb"):
        B.write_bronze(own[t], f"{tmp_root}/bronze", t)
    B.write_bronze(tables(spark, MATCHES[1:2])["header"], f"{tmp_root}/bronze", "header")
    assert rows(B.loaded_matches(spark, f"{tmp_root}/bronze")) == [(MATCHES[1],)]
    assert rows(BLD.land_new_matches(spark, tables(spark, MATCHES[:2]), f"{tmp_root}/bronze")) == [(MATCHES[0],)]
    assert bomb(spark, f"{tmp_root}/bronze") == [(MATCHES[0], 100 + i) for i in range(3)]
    BLD.build(lake, MODELS)
    assert plants(lake) == [(MATCHES[0], 3)]


# ------------------------------------------------------------------ landing

def stage(own, base):
    for t, df in own.items():
        df.withColumn("caminho", F.concat("match_id", F.lit(".dem"))).write.mode("append").parquet(f"{base}/staged/{t}")


def ask(spark, base, requests, epoch):
    df = spark.createDataFrame([("r", *r) for r in requests], "request_file string, evento string, fase string, arquivo string, forcar boolean")
    L.land_requests(df, epoch, f"{base}/staged", f"{base}/bronze", f"{base}/status")
    return L.read_status(spark, f"{base}/status").where(F.col("epoch") == epoch)


def test_forced_landing_without_staged_rows_keeps_the_match(spark, tmp_root):
    land(spark, f"{tmp_root}/bronze", tables(spark, MATCHES))
    before = bomb(spark, f"{tmp_root}/bronze")
    stage(tables(spark, [MATCHES[1]], 1), tmp_root)
    got = ask(spark, tmp_root, [("cup-a", "final", f"t{i}-vs-t{i + 1}-m1.dem", True) for i in (1, 3)], 0)
    assert sorted((r.match_id, r.status, r.erro) for r in got.collect()) == [
        (MATCHES[0], "error", "no rows landed"), (MATCHES[1], "loaded", None)]
    assert bomb(spark, f"{tmp_root}/bronze") == [x for x in before if x[0] != MATCHES[1]][:3] + [(MATCHES[1], 100)] + before[-3:]
    got = ask(spark, tmp_root, [("cup-a", "final", "t3-vs-t4-m1.dem", False)], 1)
    assert [r.status for r in got.collect()] == ["skipped"]


def test_archive_lands_match_by_match(spark, tmp_root):
    """An archive with two parts of one match, a bad match, a bad name and other files; one too large; one without members."""
    good, bad = "cup-a/final/good", "cup-a/final/bad"
    parts = [(f"{good}-p1.dem", "1", "90"), (f"{good}-p2.dem", "1", "50"), (f"{bad}.dem", "x1", "90")]
    spark.createDataFrame(parts, "caminho string, round_num string, official_end string").write.parquet(f"{tmp_root}/staged/rounds")
    spark.createDataFrame([(p[0], "de_nuke") for p in parts], "caminho string, map_name string").write.parquet(f"{tmp_root}/staged/header")
    members = [("cup-a/final/week.zip", e) for e in ("demos/", "demos/good-p1.dem", "demos/good-p2.dem", "bad.dem", "read.me", "not ok.dem")]
    members += [("cup-a/final/huge.zip", f"m{i}.dem") for i in range(201)]
    spark.createDataFrame(members, "caminho string, entrada string").write.parquet(f"{tmp_root}/staged/members")
    status = ask(spark, tmp_root, [("cup-a", "final", f"{n}.zip", None) for n in ("week", "huge", "void")], 0)
    got = {(r.arquivo, r.match_id, r.membro): (r.status, r.membros) for r in status.collect()}
    assert got == {("week.zip", good, None): ("loaded", 2), ("week.zip", bad, None): ("error", 1), ("week.zip", None, "read.me"): ("ignored", None),
                   ("week.zip", None, "not ok.dem"): ("rejected", None), ("huge.zip", None, None): ("rejected", None),
                   ("void.zip", None, None): ("error", None)}
    report = {r.arquivo: (r.partidas_carregadas, r.partidas_com_erro, r.membros_aceitos, r.membros_rejeitados, r.membros_ignorados, r.recusa)
              for r in L.batch_report(status).collect()}
    assert report == {"week.zip": (1, 1, 3, 1, 1, None), "huge.zip": (0, 0, 0, 0, 0, "too many entries"), "void.zip": (0, 0, 0, 0, 0, "no members staged")}
    assert rows(B.bronze_scan(spark, f"{tmp_root}/bronze", "rounds").select("match_id", "round_num", "official_end")) == [(good, "1", "90"), (good, "2", "141")]


# ------------------------------------------------------------------ publishing

def test_crash_while_publishing_leaves_the_old_version(spark, tmp_root, monkeypatch):
    lake = BLD.Lake(spark, tmp_root)
    land(spark, f"{tmp_root}/bronze", tables(spark, MATCHES[:1]))
    BLD.build(lake, MODELS)
    out, names = f"{tmp_root}/publish", ["bomba_jogador_partida"]
    read = lambda: rows(BLD.gold_scan(spark, out, names[0]).select("match_id"))
    BLD.publish(lake, out, names)
    land(spark, f"{tmp_root}/bronze", tables(spark, MATCHES[1:2]))
    BLD.build(lake, MODELS)
    whole = BLD._rename
    with monkeypatch.context() as m:
        m.setattr(BLD, "_point_at", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            BLD.publish(lake, out, names)
    assert read() == [(MATCHES[0],)]
    with monkeypatch.context() as m:                 # between the old pointer's end and the new one's place
        m.setattr(BLD, "_rename", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            BLD.publish(lake, out, names)
    assert read() == [(m,) for m in MATCHES[:2]]
    BLD.publish(lake, out, names)
    assert read() == [(m,) for m in MATCHES[:2]] and whole is BLD._rename
    assert len(glob.glob(f"{out}/_versions/*")) <= 2


def test_written_rows_must_be_the_rows_seen(spark, tmp_root):
    spark.range(3).write.parquet(f"{tmp_root}/t")
    BLD._check_written(spark, f"{tmp_root}/t", 3, "t")
    with pytest.raises(BLD.QualityGateFailed):
        BLD._check_written(spark, f"{tmp_root}/t", 4, "t")


def test_changed_inputs_are_landed_anew(spark, tmp_root):
    """The fixture landing is keyed by the state of its input files."""
    import shutil
    for t in ("events", "lineitem", "part"):
        shutil.copy(f"/root/testdata/sf0.001/{t}.parquet", f"{tmp_root}/{t}.parquet")
    first = BLD.land_fixture_bronze(spark, tmp_root)
    assert BLD.land_fixture_bronze(spark, tmp_root) == first
    os.utime(f"{tmp_root}/events.parquet", (1, 1))
    assert BLD.land_fixture_bronze(spark, tmp_root) != first


def test_json_requests_of_archives_in_the_stream(spark, tmp_root):
    own = tables(spark, [MATCHES[0]])
    stage(own, tmp_root)
    spark.createDataFrame([("cup-a/final/a.zip", "t1-vs-t2-m1.dem")], "caminho string, entrada string").write.parquet(f"{tmp_root}/staged/members")
    os.makedirs(f"{tmp_root}/in")
    with open(f"{tmp_root}/in/r.json", "w") as f:
        f.write(json.dumps({"evento": "cup-a", "fase": "final", "arquivo": "a.zip"}))
    L.ingest_stream(spark, f"{tmp_root}/in", f"{tmp_root}/staged", f"{tmp_root}/bronze", f"{tmp_root}/status", f"{tmp_root}/ckpt").awaitTermination(300)
    assert [(r.match_id, r.status, r.membros) for r in L.read_status(spark, f"{tmp_root}/status").collect()] == [(MATCHES[0], "loaded", 1)]
