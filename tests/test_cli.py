import json

from ticksmith.__main__ import main
from ticksmith.plans import build as BLD
from ticksmith.sources.bronze import write_bronze
from ticksmith.sources.fixtures import FixtureBronze

from .conftest import SF_SMALL


def test_cli_build_page_clear(spark, tmp_root, capsys):
    fx = FixtureBronze(spark, SF_SMALL)
    for t in BLD.ALL_TABLES:
        write_bronze(fx.table(t), f"{tmp_root}/bronze", t, mode="append")
    assert main(["--root", tmp_root, "build", "--select", "silver_header"]) == 0
    capsys.readouterr()
    assert main(["--root", tmp_root, "page", "page_partidas", "--page-size", "2"]) == 0
    env = json.loads(capsys.readouterr().out)
    assert env["count"] == 3 and env["total_pages"] == 2 and len(env["results"]) == 2
    assert main(["--root", tmp_root, "clear", "--layer", "gold"]) == 0
    assert "nothing to remove" in capsys.readouterr().out
    assert not spark.sparkContext._jsc.sc().isStopped()
