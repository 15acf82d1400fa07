"""Clustering with bounds against comparing every vector with every centroid."""

import hashlib
import math
import random

import numpy as np
import pytest

from trafficlake.llm.centroid_clustering import cluster, described, loosenings, squared_distances
from trafficlake.llm import centroid_clustering
from trafficlake.llm.common import table
from tests.llm.helpers import one_scratch_folder
from tests.llm.test_queries import SF_DIR

ROWS = "vec_id bigint, embedding array<float>"


def plain(rows, k=8, rounds=10):
    """[(vec_id, cluster, distance)] and centroids, in Python's whole numbers."""
    kept = [
        (i, [math.floor(1024 * x) for x in v])
        for i, v in rows
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)
    ]
    named = [(hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None]
    centroids = [v for _, v in sorted(named)[:k]]
    if not centroids:
        return [], []

    def assigned():
        out = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
            out.append((min(d), d.index(min(d))))
        return out

    for _ in range(rounds):
        near = assigned()
        for c in range(len(centroids)):
            own = [v for (_, v), (_, a) in zip(kept, near) if a == c]
            if own:
                centroids[c] = [sum(x) // len(own) for x in zip(*own)]
    return [(i, c, d) for (i, _), (d, c) in zip(kept, assigned())], centroids


def key(row):
    return tuple((x is not None, x) for x in row)


def check(spark, rows, **limits):
    found = cluster(spark.createDataFrame(rows, ROWS), **limits)
    expected, centroids = plain(rows, **limits)
    assert sorted(map(tuple, found.vectors.collect()), key=key) == sorted(expected, key=key)
    assert found.centroids.tolist() == centroids
    return found


def as_floats(vectors):
    return [[float(x) for x in np.float32(v)] for v in vectors]


def test_random_vectors(spark):
    rng = np.random.default_rng(1)
    middles = rng.normal(size=(6, 64))
    vectors = np.concatenate([m + 0.3 * rng.normal(size=(60, 64)) for m in middles])
    found = check(spark, list(enumerate(as_floats(vectors))))
    # Later rounds leave most vectors unscanned.
    assert found.scanned[0] == 360 and found.scanned[-1] < 120


def test_ties_and_copies(spark):
    """Vectors on a coarse grid, many of them equal or equally far from two centroids."""
    rng = random.Random(2)
    rows = [(i, [rng.choice([-1.0, 0.0, 1.0]) if d < 3 else 0.0 for d in range(64)]) for i in range(200)]
    rows += [(1000 + i, [1.0] + [0.0] * 63) for i in range(200)]
    check(spark, rows)


def test_edges(spark):
    """Null, short, long and broken vectors go; repeated ids and rows without id stay; fewer vectors than clusters."""
    good = [(i % 4, [i / 7 + d / 100 for d in range(64)]) for i in range(6)]
    bad = [(20, None), (21, []), (22, [1.0] * 63), (23, [1.0] * 65), (24, [None] + [1.0] * 63)]
    bad += [(25, [float("nan")] + [1.0] * 63), (26, [float("inf")] * 64)]
    nameless = [(None, [0.5] * 64), (None, [-0.5] * 64)]
    rows = [(i, [float(np.float32(x)) if x is not None else None for x in v] if v is not None else None) for i, v in good + bad + nameless]
    check(spark, rows)
    check(spark, rows, rounds=0)
    check(spark, rows, k=1, rounds=2)


def test_empty(spark):
    for rows in ([], [(1, [1.0] * 63)], [(None, [1.0] * 64)]):
        found = cluster(spark.createDataFrame(rows, ROWS))
        assert described(found).collect() == []


def test_too_large_components_are_an_error(spark):
    with pytest.raises(Exception, match="too large"):
        cluster(spark.createDataFrame([(1, [1e9] * 64)], ROWS))


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(3)
    vectors = np.float32(rng.uniform(-130_000, 130_000, size=(60, 64)))
    check(spark, list(enumerate(as_floats(vectors))), rounds=3)


def test_other_columns_do_not_matter(spark):
    schema = "cluster string, vec_id int, embedding array<double>, distance string, components int"
    rows = [("x", i, [i + d / 64 for d in range(64)], "y", 1) for i in range(20)]
    out = described(cluster(spark.createDataFrame(rows, schema)))
    assert set(out.columns) == {"vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"}
    assert out.count() == 20


def test_loosening_bounds_every_point_of_the_sphere():
    """No point of a cluster's sphere comes closer to another centroid than by its loosening, which is below the
    largest drift where centroids move sideways or away."""
    rng = np.random.default_rng(4)
    smaller = 0
    for _ in range(200):
        before = rng.normal(size=(4, 3)) * 50
        after = before + rng.normal(size=(4, 3)) * rng.choice([0, 0.1, 5, 40])
        radii = rng.uniform(0, 40, size=4)
        loose = loosenings(before, after, radii)
        drift = np.sqrt(((after - before) ** 2).sum(1))
        for own in range(4):
            way = rng.normal(size=(500, 3))
            way *= (radii[own] * rng.uniform(0, 1, size=500) ** 0.2 / np.sqrt((way**2).sum(1)))[:, None]
            points = before[own] + way
            for other in set(range(4)) - {own}:
                closer = np.sqrt(((points - before[other]) ** 2).sum(1)) - np.sqrt(((points - after[other]) ** 2).sum(1))
                assert closer.max() <= loose[own] + 1e-6
            others = max(drift[x] for x in range(4) if x != own)
            assert loose[own] <= others + 1e-9
            smaller += loose[own] < 0.9 * others
    assert smaller > 100


def test_squared_distances_are_exact():
    rng = random.Random(5)
    for largest in (10, 1 << 20, 1 << 27):
        v = [[rng.randint(-largest, largest) for _ in range(64)] for _ in range(20)]
        c = [[rng.randint(-largest, largest) for _ in range(64)] for _ in range(5)]
        expected = [[sum((a - b) ** 2 for a, b in zip(x, y)) for y in c] for x in v]
        assert squared_distances(np.array(v), np.array(c)).tolist() == expected


def test_generations_are_removed(spark, tmp_path, monkeypatch):
    """After the rounds only the result is left of what was written; after a failure nothing is."""
    left = one_scratch_folder(monkeypatch, tmp_path / "scratch", centroid_clustering)
    docs = table(spark, SF_DIR, "embeddings")
    assert cluster(docs, rounds=3).vectors.count() == 500
    assert left() == ["clusters"]

    def dies(state, before):
        raise RuntimeError("killed")

    monkeypatch.setattr(centroid_clustering, "_moved", dies)
    with pytest.raises(RuntimeError):
        cluster(docs, rounds=3)
    assert left() == ["clusters"]
