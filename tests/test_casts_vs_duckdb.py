"""Cast strictness (hazard H1) checked against DuckDB on random text:
integers, fractions (including .5 ties), negatives, exponents and
17-digit ids must give the same typed value in both engines."""

import random

import duckdb
from pyspark.sql import functions as F

from ticksmith.functions.columns import blank, to_bigint, to_double, to_int


def samples(n=300, seed=11):
    rng = random.Random(seed)
    out = set()
    while len(out) < n:
        kind = rng.randrange(6)
        if kind == 0:
            out.add(str(rng.randint(-10**6, 10**6)))
        elif kind == 1:
            out.add(f"{rng.randint(-999, 999)}.{rng.choice(['0', '5', '49', '51', '25', '75'])}")
        elif kind == 2:
            out.add(f" {rng.randint(0, 99)} ")
        elif kind == 3:
            out.add(f"{rng.randint(1, 9)}e{rng.randint(0, 3)}")
        elif kind == 4:
            out.add(str(76561198000000000 + rng.randint(0, 10**8)))
        else:
            out.add(f"{rng.randint(-50, 50)}.{rng.randint(0, 9999):04d}")
    return sorted(out)


def test_casts_match_duckdb(spark):
    vals = samples()
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = {r.v: (r.i, r.l, r.d) for r in df.select(
        "v",
        F.when(blank("v").cast("double").between(-2**31, 2**31 - 1), to_int(blank("v"))).alias("i"),
        to_bigint(blank("v")).alias("l"), to_double(blank("v")).alias("d")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t(v VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?)", [(v,) for v in vals])
    expected = {v: (i, l, d) for v, i, l, d in con.execute(
        "SELECT v, CASE WHEN TRY_CAST(NULLIF(TRIM(v), '') AS DOUBLE) BETWEEN -2147483648 AND 2147483647 "
        "THEN NULLIF(TRIM(v), '')::INTEGER END, NULLIF(TRIM(v), '')::BIGINT, NULLIF(TRIM(v), '')::DOUBLE FROM t"
    ).fetchall()}
    diff = {v: (got[v], expected[v]) for v in vals if got[v] != expected[v]}
    assert not diff, list(diff.items())[:5]
