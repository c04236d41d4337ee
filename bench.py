"""Benchmark: the full build and the headline reads at one scale factor.

    BENCH_SF_DIR   test-data directory   (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores           (default 8)

Stages, each timed:
  land_bronze      project the test tables into the nine bronze tables and
                   land them as partitioned Parquet
  build_silver     bronze -> nine typed silver tables (written)
  build_gold       silver -> six player x match facts (written)
  <query>          headline reads over the built lake (rankings, pages,
                   the headline question, quality report) and a few
                   registry queries straight from the raw test tables
Every query is forced with the no-op sink (full computation, nothing
collected).  Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import uuid
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ticksmith.session import build_session, scratch_path  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2))

    from ticksmith.operators import facts as G
    from ticksmith.operators import pages as P
    from ticksmith.plans import build as BLD
    from ticksmith.plans import queries as QR
    from ticksmith.plans.catalog import Workspace
    from ticksmith.sources.bronze import write_bronze
    from ticksmith.sources.fixtures import FixtureBronze

    root = scratch_path(spark, f"bench-{uuid.uuid4().hex[:12]}")   # under the shared checkpoint folder
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.time()
        fn()
        times[name] = round(time.time() - t0, 3)

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    fx = FixtureBronze(spark, sf_dir)
    detail: dict[str, float] = {}

    def land_one(t):
        t0 = time.time()                   # fresh root: plain append, no partition-overwrite staging
        write_bronze(fx.table(t), f"{root}/bronze", t, mode="append")
        detail[f"land_{t}"] = round(time.time() - t0, 3)

    def land_all():                        # nine independent jobs, submitted side by side
        BLD.run_concurrently(spark, [lambda t=t: land_one(t) for t in BLD.ALL_TABLES])

    timed("land_bronze", land_all)
    lake = BLD.Lake(spark, root)
    timed("build_silver", lambda: BLD.build_silver(lake))
    timed("build_gold", lambda: BLD.build_gold(lake))

    dim = BLD.gold_view(lake, "dim_partida")
    for name in ["ranking_kills", "ranking_kills_por_fase", "ranking_granadas_por_mapa",
                 "ranking_tempo_por_local_por_evento", "ranking_team_kills"]:
        timed(name, lambda n=name: noop(BLD.gold_view(lake, n)))
    timed("page_combate", lambda: noop(P.page_rows(lake.read_gold("combate_jogador_partida"), dim,
                                                   P.PAGES["page_combate"], {"mapa": "de_mirage"}, 1, 50)))
    timed("page_posicionamento", lambda: noop(P.page_rows(lake.read_gold("posicionamento_jogador_partida"), dim,
                                                          P.PAGES["page_posicionamento"], {"place": "BombsiteA"},
                                                          2, 20)))
    timed("headshots_by_place", lambda: noop(G.headshots_by_place(lake.read_silver("kills"), dim,
                                                                  mapa="de_mirage", fases=["semi-final", "final"])))
    timed("quality_report", lambda: noop(BLD.quality_report(lake)))

    # registry queries straight from the raw test tables (fixtures -> silver -> gold in one plan)
    ws = Workspace(spark, sf_dir)
    for name in ["combate_jogador_partida", "clutches_jogador_partida", "posicionamento_jogador_partida"]:
        timed(f"raw_{name}", lambda n=name: noop(QR.REGISTRY[n](ws)))

    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "build_and_headline_queries_total", "value": total, "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir).replace("sf", ""), "cpus": cpus,
                      "detail": detail}))
    spark.stop()


if __name__ == "__main__":
    main()
