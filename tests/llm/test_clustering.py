import hashlib
import math
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import bag
from tidemark.llm import clustering
from tidemark.llm.clustering import cluster, cluster_report, falls, scanned


def brute(rows, k=8, rounds=10, size=64, scale=1024, seed=3):
    kept = [
        (i, [math.floor(scale * x) for x in v])
        for i, v in rows
        if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)
    ]
    if not kept:
        return []
    start = sorted(kept, key=lambda r: (sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in start[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        for c in range(len(centroids)):
            mine = [v for (_, v), k in zip(kept, own) if k == c]
            if mine:
                centroids[c] = [sum(column) // len(mine) for column in zip(*mine)]
    found = [(i, nearest(v)) for i, v in kept]
    inertia = [sum(d for _, (d, k) in found if k == c) for c in range(len(centroids))]
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, k, d, inertia[k], sum(inertia), digests[k]) for i, (d, k) in found]


def table(spark, rows, kind="float"):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], f"vec_id long, embedding array<{kind}>, cluster int, own string")
    return df.repartition(3), [(r.vec_id, r.embedding) for r in df.collect()]


@pytest.mark.parametrize("size,k,rounds,kind", [(2, 3, 4, "float"), (5, 8, 10, "double"), (64, 8, 10, "float")])
def test_like_brute_force(spark, monkeypatch, size, k, rounds, kind):
    monkeypatch.setattr(clustering, "BLOCK", 50)
    rng = np.random.default_rng(size)
    centres = rng.normal(size=(6, size))
    rows = [(i, (centres[i % 6] + rng.normal(size=size) * 0.4).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(20)] + [(3, rows[4][1])]
    df, rows = table(spark, rows, kind)
    found = cluster_report(df, k, rounds, size)
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert bag(found.collect()) == bag(brute(rows, k, rounds, size))


def test_ties_and_rows_that_are_left_out(spark):
    rows = [
        (1, [0.0, 0.0]), (2, [0.0, 4.0]), (3, [0.0, 2.0]), (4, [0.0, 2.0]), (5, None), (6, []), (7, [1.0]), (8, [1.0, 2.0, 3.0]), (9, [1.0, None]),
        (10, [math.nan, 1.0]), (11, [math.inf, 1.0]), (None, [0.5, 0.5]), (None, [0.5, 0.5]), (1, [0.0, 0.0]), (12, [-0.0001, -7.0]), (13, [1e-300, 4.0]),
    ]
    for k in (1, 2, 3, 20):
        df, own = table(spark, rows, "double")
        assert bag(cluster_report(df, k, 3, 2, scale=10).collect()) == bag(brute(own, k, 3, 2, 10))


def test_nothing_to_cluster(spark):
    for rows in ([], [(1, None), (2, [1.0])]):
        df, _ = table(spark, rows)
        found, centroids = cluster(df)
        assert centroids == [] and found.count() == 0 and cluster_report(df).count() == 0


def test_large_components(spark):
    df, rows = table(spark, [(i, [float(i * 1000), -1e5 + i]) for i in range(40)], "double")
    assert bag(cluster_report(df, 4, 5, 2).collect()) == bag(brute(rows, 4, 5, 2))
    df, _ = table(spark, [(1, [1e300, 0.0])], "double")
    with pytest.raises(Exception, match="squared distances would not fit"):
        cluster_report(df, 1, 1, 2)


def test_bounds_spare_scans(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(8, 16)) * 5
    rows = [(i, (centres[i % 8] + rng.normal(size=16) * 0.3).tolist()) for i in range(800)]
    df, _ = table(spark, rows)
    scans = []
    cluster(df, 8, 10, 16, scans=scans)
    assert scans[0] == 800 and len(scans) == 11 and scans[-1] == 0 and sum(scans[1:]) < 4000


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 10**6), st.integers(2, 6), st.floats(0, 3), st.floats(0, 3))
def test_no_distance_falls_further_than_the_bound(seed, size, spread, way):
    rng = np.random.default_rng(seed)
    old = rng.normal(size=(3, size))
    new = old + rng.normal(size=(3, size)) * way
    points = old[0] + rng.normal(size=(200, size)) * spread
    far = np.linalg.norm(points - old[0], axis=1)
    bound = falls(old, new, np.array([far.max(), -1.0, -1.0]))
    drift = np.linalg.norm(new - old, axis=1)
    assert bound[0] <= drift[1:].max() + 1e-12 and bound[1] == bound[2] == 0
    for j in (1, 2):
        fell = np.linalg.norm(points - old[j], axis=1) - np.linalg.norm(points - new[j], axis=1)
        assert fell.max() <= bound[0] + 1e-9


def test_bound_is_below_the_drift_where_the_sphere_lies_aside():
    old, new = np.array([[0.0, 0.0], [10.0, 0.0]]), np.array([[0.0, 0.0], [10.0, 1.0]])
    assert falls(old, new, np.array([1.0, 1.0]))[0] < 0.2  # drift 1
    assert falls(old, new + [[0, 0], [5, -1]], np.array([1.0, 1.0]))[0] == 0  # moves straight away


def test_scan_takes_the_first_of_equals():
    best, first, second = scanned(np.array([[0, 0], [4, 0], [9, 0]]), np.array([[2, 0], [-2, 0], [6, 0], [6, 0]]))
    assert best.tolist() == [0, 0, 2] and first.tolist() == [4, 4, 9] and second.tolist() == [4, 4, 9]
