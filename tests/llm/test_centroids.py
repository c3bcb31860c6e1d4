import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sessionlens.llm import centroids as C

KIND = "vec_id long, embedding array<float>, label int, cluster string, v string"


def brute(rows, k, rounds, dimensions):
    kept = []
    for r in rows:
        e = r["embedding"]
        if e is not None and len(e) == dimensions and all(x is not None and math.isfinite(x) for x in e):
            kept.append((r["vec_id"], [math.floor(64 * x) for x in e]))
    mark = lambda x: hashlib.sha256(f"1:{'' if x[0] is None else x[0]}".encode()).hexdigest()
    now = [v for _, v in sorted(kept, key=lambda x: (mark(x), x[0] is not None, x[0] or 0, x[1]))[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(now)) for _, v in kept]
    for _ in range(rounds):
        got = assign()
        for j in range(len(now)):
            mine = [v for (_, v), (_, at) in zip(kept, got) if at == j]
            if mine:
                now[j] = [sum(x) // len(mine) for x in zip(*mine)]
    got = assign()
    inertia = {j: sum(d for d, at in got if at == j) for j in range(len(now))}
    return sorted(((v, j, d, inertia[j], sum(inertia.values()), tuple(now[j])) for (v, _), (d, j) in zip(kept, got)), key=str)


def run(df, **how):
    got = C.cluster(df, **how)
    assert got.columns == ["vec_id", "cluster", "distance", "compared", "cluster_inertia", "inertia", "centroid"]
    return sorted(((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, tuple(r.centroid)) for r in got.collect()), key=str)


def frame(spark, vectors):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, "x", "y")
                                  for i, v in vectors], KIND)


def test_given_table_matches_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    assert run(df) == brute(df.collect(), 16, 3, 64)


def test_bounds_save_comparisons(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    row = C.cluster(df).agg(F.sum("compared").alias("met"), F.count(F.lit(1)).alias("n")).first()
    assert row.met < 12 * row.n


def test_edges(spark):
    rng = np.random.default_rng(1)
    some = [(i, rng.normal(size=4)) for i in range(30)]
    odd = [(90, None), (91, []), (92, [1, 2, 3]), (93, [1, 2, 3, None]), (94, [1, 2, 3, math.nan]), (95, [1, 2, math.inf, 0]),
           (None, [5, 5, 5, 5]), (3, [9, 9, 9, 9]), (3, [9, 9, 9, 9]), (96, [0, 0, 0, 0]), (97, [-0.001, 0, 0, 0])]
    df = frame(spark, some + odd + [(200 + i, [1, 1, 1, 1]) for i in range(50)])
    for k in (1, 3, 16, 200):
        how = {"k": k, "rounds": 2, "pivots": 5, "dimensions": 4}
        assert run(df.repartition(5), **how) == brute(df.collect(), k, 2, 4)
    assert run(df.limit(0), dimensions=4) == []
    assert run(frame(spark, [(1, [1, 2, math.nan, 0])]), dimensions=4) == []


def test_huge_components_are_left_out(spark):
    assert [r[0] for r in run(frame(spark, [(1, [1e30, 0]), (2, [1, 0])]), dimensions=2)] == [2]


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 6), st.integers(0, 2 ** 32 - 1), st.sampled_from([1, 50, 10 ** 7]))
def test_bounds_hold_and_nearest_is_exact(size, seed, spread):
    rng = np.random.default_rng(seed)
    v = rng.integers(-spread, spread + 1, (40, size))
    c = np.vstack([v[:6], rng.integers(-spread, spread + 1, (6, size))])
    simplex = C.Simplex(C.far_apart(c, 5))
    low, high = C.bounds(simplex.apexes(simplex.distances(v)), simplex.apexes(simplex.distances(c)))
    true = C.squared(v, c)
    slack = C.SLACK * (1 + high.max())
    assert (low <= np.sqrt(true) + slack).all() and (high >= np.sqrt(true) - slack).all()
    cluster, best, met = C.nearest(v, simplex.distances(v), c, simplex)
    assert (best == true.min(axis=1)).all() and (cluster == true.argmin(axis=1)).all()
    assert met <= true.size


def test_dependent_pivots_are_left_out():
    line = np.array([[0, 0], [2, 2], [4, 4], [0, 0], [0, 3]])
    assert len(C.Simplex(line).pivots) == 3


@pytest.mark.parametrize("negative", [-7, -1, 1])
def test_means_are_floored(spark, negative):
    df = frame(spark, [(1, [0, 0]), (2, [negative / 64, 0])])
    assert run(df, k=1, rounds=1, dimensions=2) == brute(df.collect(), 1, 1, 2)
