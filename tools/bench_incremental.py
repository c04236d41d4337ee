"""Full build of ~90% of the matches, then an incremental build after the
remaining ~10% land.  Prints one JSON line with both timings.
Usage: python tools/bench_incremental.py [sf_dir]"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from pyspark.sql import functions as F

    from ticksmith.plans import build as B
    from ticksmith.session import build_session, scratch_path
    from ticksmith.sources.bronze import write_bronze
    from ticksmith.sources.fixtures import FixtureBronze

    spark = build_session("local[8]", 16)
    root = scratch_path(spark, f"incr-{uuid.uuid4().hex[:8]}")
    fx = FixtureBronze(spark, sf_dir)
    late = F.abs(F.xxhash64("match_id")) % 10 == 0          # ~10% of the matches arrive later

    def land(cond):
        B.run_concurrently(spark, [lambda t=t: write_bronze(fx.table(t).where(cond), f"{root}/bronze", t, mode="append")
                                   for t in B.ALL_TABLES])

    out = {}
    land(~late)
    lake = B.Lake(spark, root)
    t0 = time.time()
    B.build(lake)
    out["full_build_90pct"] = round(time.time() - t0, 3)
    land(late)
    lake._bronze = None
    t0 = time.time()
    B.build(lake)
    out["incremental_build_10pct"] = round(time.time() - t0, 3)
    t0 = time.time()
    B.build(lake)
    out["no_op_build"] = round(time.time() - t0, 3)
    print(json.dumps({"sf": sf_dir, **out}))
    spark.stop()


if __name__ == "__main__":
    main()
