"""Embedding near-duplicates: what a vector costs on its way, and links all the same."""

import numpy as np

from ticksmith.llm import neardup as N


def sphere(n, d=64, seed=3):
    return N.unit(np.random.default_rng(seed).normal(size=(n, d)))


def test_places_of_a_vector_stay_few():
    for n, most in ((5_000, 40), (60_000, 40), (500_000, 80)):
        index = N.Index({}, n, N.COSINE)
        x = sphere(400)
        row, table, _ = index.keys(x)
        assert len(row) / len(x) < most and len(set(table.tolist())) == len(N.table_slices(64, n))


def test_every_near_pair_meets_in_its_place():
    x = sphere(300)
    near = N.unit(x + 0.024 * np.random.default_rng(5).normal(size=x.shape))
    own = (x * near).sum(1) >= N.COSINE
    x, near = x[own], near[own]
    assert len(x) > 50
    for n in (5_000, 500_000):
        index = N.Index({}, n, N.COSINE)
        places = [set(zip(*(k.tolist() for k in index.keys(v)))) for v in (x, near)]
        turned = [v @ index.rotation(64) for v in (x, near)]
        for i, (t, z) in enumerate(zip(*(k.tolist() for k in index.met_at(*turned)))):
            assert (i, t, z) in places[0] and (i, t, z) in places[1]


def test_floats_travel_as_floats(spark):
    rows = [(i, v.tolist(), 1) for i, v in enumerate(sphere(20, 8))] + [(20, (2 * sphere(20, 8)[0]).tolist(), 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    assert dict(N.classes(df)[0].dtypes)["embedding"] == "array<float>"
    got = {r.vec_id: (r.n_links, r.component_id) for r in N.near_duplicates(df).collect()}
    assert got[0] == got[20] == (1, 0) and got[1] == (0, 1)
