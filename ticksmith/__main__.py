"""Command line: ``python -m ticksmith <command> --root <lake root> ...``

  ingest   --staged DIR --landing DIR   run the landing stream once (availableNow)
  clear    --layer bronze|silver|gold   remove a layer (no-op when absent)
  refresh  MATCH_ID ...                 push forced bronze reloads through silver and gold
  build    [--select a,b] [--full-refresh]
  publish  [--target DIR] [--no-gate]   quality-gated export of every gold table / view
  page     ENDPOINT [--filter k=v ...] [--page N] [--page-size N]
  quality                               print the quality report
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import functions as F


def _page(lake, args):
    from .operators import pages as P
    from .plans import build as B
    spec = P.PAGES[args.endpoint]
    dim = B.gold_view(lake, "dim_partida")
    fact = dim if spec.table == "dim_partida" else lake.read_gold(spec.table)
    filters = dict(kv.split("=", 1) for kv in args.filter or [])
    env = P.page_envelope(fact, dim, spec, filters, args.page, args.page_size).collect()[0].asDict()
    page_rows = P.page_rows(fact, dim, spec, filters, args.page, args.page_size)
    env["results"] = [r.asDict() for r in page_rows.collect()]   # one page: at most 500 rows
    print(json.dumps(env, default=str, indent=1))


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="ticksmith")
    ap.add_argument("--root", required=True, help="lake root (bronze/silver/gold below it)")
    ap.add_argument("--master", default=None)
    sub = ap.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("ingest")
    s.add_argument("--staged", required=True)
    s.add_argument("--landing", required=True)
    s = sub.add_parser("clear")
    s.add_argument("--layer", required=True, choices=["bronze", "silver", "gold"])
    s = sub.add_parser("refresh")
    s.add_argument("match_ids", nargs="+")
    s = sub.add_parser("build")
    s.add_argument("--select", default=None)
    s.add_argument("--full-refresh", action="store_true")
    s = sub.add_parser("publish")
    s.add_argument("--target", default=None)
    s.add_argument("--no-gate", action="store_true")
    s = sub.add_parser("page")
    s.add_argument("endpoint")
    s.add_argument("--filter", action="append")
    s.add_argument("--page", default="1")
    s.add_argument("--page-size", default="50")
    sub.add_parser("quality")
    args = ap.parse_args(argv)

    from .plans import build as B
    from .session import build_session
    from .sources.bronze import clear_layer
    from .streaming.landing import ingest_stream

    from pyspark.sql import SparkSession
    owned = SparkSession.getActiveSession() is None      # stop only a session this command started
    spark = build_session(args.master)
    lake = B.Lake(spark, args.root.rstrip("/"))
    if args.cmd == "ingest":
        q = ingest_stream(spark, args.landing, args.staged, f"{lake.root}/bronze", f"{lake.root}/_status",
                          f"{lake.root}/_checkpoints/landing")
        q.awaitTermination()
        print(json.dumps(q.lastProgress, default=str))
    elif args.cmd == "clear":
        done = clear_layer(spark, f"{lake.root}/{args.layer}")
        print(f"{args.layer}: {'removed' if done else 'nothing to remove'}")
    elif args.cmd == "refresh":
        B.refresh_matches(lake, spark.createDataFrame([(m,) for m in args.match_ids], "match_id string"))
    elif args.cmd == "build":
        select = args.select.split(",") if args.select else None
        print("built:", ", ".join(B.build(lake, select, args.full_refresh)))
    elif args.cmd == "publish":
        names = B.publish(lake, args.target) if args.no_gate else B.gated_publish(lake, args.target)
        print("published:", ", ".join(names))
    elif args.cmd == "page":
        _page(lake, args)
    elif args.cmd == "quality":
        B.quality_report(lake).where(F.col("failures") > 0).show(200, truncate=False)
    if owned:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
