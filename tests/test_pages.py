from ticksmith.operators import pages as P
from ticksmith.operators import ranking as R
from ticksmith.plans.catalog import Workspace

from .conftest import SF_SMALL


def test_page_params():
    assert P.page_params() == (1, 50)
    assert P.page_params("0", "9999") == (1, 500)
    assert P.page_params("x", "y") == (1, 50)
    assert P.page_params(3, 0) == (3, 1)


def test_page_plan_is_pushed_down_and_bounded(spark):
    ws = Workspace(spark, SF_SMALL)
    df = P.page_rows(ws.gold.table("combate_jogador_partida"), ws.gold.table("dim_partida"),
                     P.PAGES["page_combate"], {"mapa": "de_mirage", "steamid": "76561198000000001"}, 2, 5)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    assert df.count() <= 5


def test_whitelist_ignores_unknown_and_binds_values(spark):
    df = spark.createDataFrame([("m", 1, 3), ("m", 2, 4)], "match_id string, steamid long, kills long")
    out = P.whitelist_filter(df, {"steamid": "2", "kills": "3", "x; drop table": "1"}, ["steamid"])
    assert [r.steamid for r in out.collect()] == [2]


def test_envelope(spark):
    df = spark.createDataFrame([("m", i, i) for i in range(45)], "match_id string, steamid long, kills long")
    spec = P.PageSpec("t", ("steamid",), (("kills", True),), join_dim=False)
    e = P.page_envelope(df, None, spec, {}, 2, 20).collect()[0]
    assert (e["count"], e.page, e.page_size, e.total_pages, e.next_page, e.previous_page) == (45, 2, 20, 3, 3, 1)
    e = P.page_envelope(df, None, spec, {"steamid": "99"}, 1, 20).collect()[0]
    assert (e["count"], e.total_pages, e.next_page, e.previous_page) == (0, 0, None, None)


def test_ranking_specs_cover_thirteen_views():
    specs = R.ranking_specs()
    assert len(specs) == 13 and specs["ranking_team_kills"].positive_only
