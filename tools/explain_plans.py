"""Build a lake at one scale factor and print the physical plan of every
headline job with a summary of shuffles / broadcasts / windows / nested
loops.  Usage: python tools/explain_plans.py [sf_dir] > docs/PLANS.txt"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys
import uuid

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def summary(text: str) -> str:
    def n(pat):
        return len(re.findall(pat, text))
    return (f"shuffles={n(r'Exchange hashpartitioning|Exchange rangepartitioning|Exchange RoundRobin|Exchange SinglePartition')} "
            f"broadcasts={n(r'BroadcastExchange')} windows={n(r'Window \[')} "
            f"sort_merge_joins={n(r'SortMergeJoin')} broadcast_hash_joins={n(r'BroadcastHashJoin')} "
            f"nested_loop={n(r'NestedLoopJoin|CartesianProduct')} scans={n(r'FileScan parquet')}")


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from ticksmith.operators import facts as G
    from ticksmith.operators import pages as P
    from ticksmith.operators.silver import Silver, tick_rate
    from ticksmith.plans import build as B
    from ticksmith.session import build_session, scratch_path
    from ticksmith.sources.bronze import write_bronze
    from ticksmith.sources.fixtures import FixtureBronze

    spark = build_session("local[8]", 8)
    root = scratch_path(spark, f"plans-{uuid.uuid4().hex[:8]}")
    fx = FixtureBronze(spark, sf_dir)
    for t in B.ALL_TABLES:
        write_bronze(fx.table(t), f"{root}/bronze", t, mode="append")
    lake = B.Lake(spark, root)
    B.build_silver(lake)
    silver = Silver(lake.bronze)
    rate = tick_rate(lake.bronze.table("rounds"), lake.bronze.table("cvars"))
    gold = G.Gold(B._StoredSilver(lake, rate))
    gold.materialize_digest()
    B.build_gold(lake)
    dim = B.gold_view(lake, "dim_partida")
    jobs = {
        "silver_ticks (bronze -> silver)": silver.table("ticks"),
        "silver_kills (bronze -> silver)": silver.table("kills"),
        "tick_digest (silver ticks -> digest)": G.tick_digest(lake.read_silver("ticks")),
        "combate_jogador_partida": gold.table("combate_jogador_partida"),
        "clutches_jogador_partida": gold.table("clutches_jogador_partida"),
        "posicionamento_jogador_partida": gold.table("posicionamento_jogador_partida"),
        "granadas_jogador_partida": gold.table("granadas_jogador_partida"),
        "ranking_kills_por_fase": B.gold_view(lake, "ranking_kills_por_fase"),
        "page_combate (mapa filter, page 2)": P.page_rows(lake.read_gold("combate_jogador_partida"), dim,
                                                          P.PAGES["page_combate"], {"mapa": "de_mirage"}, 2, 20),
        "headshots_by_place (playoffs, one map)": G.headshots_by_place(lake.read_silver("kills"), dim,
                                                                       mapa="de_mirage", fases=["final"]),
    }
    print(f"# physical plans at {sf_dir} (digest checkpointed as in the build)\n")
    for name, df in jobs.items():
        text = plan_text(df)
        print(f"## {name}\n{summary(text)}\n")
        print(text)
    spark.stop()


if __name__ == "__main__":
    main()
