"""Centroid clustering against plain rounds over all vectors and centroids."""

import hashlib
import math
import random

import numpy as np
import pytest

from millrace.llm import centroids
from millrace.llm.centroids import Clustering, assignments, clustered, squared_distances

SCHEMA = "vec_id long, embedding array<float>, cluster int, distance string, vec int, gap double"


def plain(rows, how):
    """Sorted result rows by exact Python integers."""
    kept = [(i, v) for i, v in rows if v is not None and len(v) == how.dims and all(x is not None and math.isfinite(x) for x in v)]
    kept = [(i, [math.floor(how.scale * float(x)) for x in v]) for i, v in kept]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"{how.seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    middles = [v for _, v in order[: how.k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(middles))

    for _ in range(how.rounds):
        members = {}
        for _, v in kept:
            members.setdefault(nearest(v)[1], []).append(v)
        middles = [[sum(x) // len(x) for x in zip(*members[j])] if j in members else c for j, c in enumerate(middles)]
    found = [(i, *nearest(v)) for i, v in kept]
    inertia = {}
    for _, d, j in found:
        inertia[j] = inertia.get(j, 0) + d
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in middles]
    return sorted((str(i), j, d, inertia[j], sum(inertia.values()), shas[j]) for i, d, j in found)


def ours(spark, rows, how):
    table = spark.createDataFrame([(i, v, 1, "x", 2, 0.5) for i, v in rows], SCHEMA)
    found = clustered(table, how).collect()
    return sorted((str(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in found)


def spread(seed, n, dims, around):
    """Vectors around a few points, as floats that a column of floats holds as they are."""
    rng = random.Random(seed)
    middles = [[rng.uniform(-1, 1) for _ in range(dims)] for _ in range(around)]
    return [[float(np.float32(rng.gauss(x, 0.1))) for x in rng.choice(middles)] for _ in range(n)]


@pytest.mark.parametrize("k,dims,around", [(1, 3, 2), (5, 4, 5), (12, 6, 4), (40, 2, 3)])
def test_equals_plain_rounds(spark, k, dims, around):
    how = Clustering(k=k, rounds=5, dims=dims)
    rows = list(enumerate(spread(k, 400, dims, around)))
    assert ours(spark, rows, how) == plain(rows, how)


def test_ties_repeated_rows_and_rows_that_do_not_count(spark):
    how = Clustering(k=6, rounds=4, dims=2, scale=1)
    grid = [(10 * x + y, [float(x), float(y)]) for x in range(10) for y in range(10)]
    hot = [(500, [3.0, 3.0])] * 60 + [(500 + i, [3.0, 3.0]) for i in range(60)] + [(None, [-1.0, 2.0]), (None, [4.0, 1.5])]
    odd = [(700, None), (701, []), (702, [1.0]), (703, [1.0, None]), (704, [1.0, math.nan]), (705, [math.inf, 1.0]), (706, [1.0] * 3)]
    for rows in (grid, grid + hot + odd, hot + odd, grid[:3] + odd):
        assert ours(spark, rows, how) == plain(rows, how)
    assert ours(spark, odd, how) == []
    assert ours(spark, [], how) == []


def test_large_components_are_exact_and_too_large_ones_raise(spark):
    how = Clustering(k=4, rounds=3, dims=3, scale=1)
    rng = random.Random(1)
    rows = [(i, [float(rng.randrange(-(1 << 24), 1 << 24)) for _ in range(3)]) for i in range(80)]
    assert ours(spark, rows, how) == plain(rows, how)
    vecs = np.array([[1 << 24, -(1 << 24)], [0, 1]])
    assert squared_distances(vecs, -vecs).tolist() == [[2 * (1 << 50), (1 << 48) + (1 << 48) - (1 << 25) + 1], [(1 << 49) + (1 << 25) * -1 + 1, 4]]
    with pytest.raises(Exception, match="out of range"):
        ours(spark, rows + [(99, [1e30, 0.0, 0.0])], how)


def test_only_expired_vectors_are_compared_again(spark, monkeypatch):
    """Well separated groups: after the first run few vectors are written again."""
    sizes = []
    plain_run = centroids._run

    def counted(*args):
        run = plain_run(*args)
        sizes.append(run.count())
        return run

    monkeypatch.setattr(centroids, "_run", counted)
    vecs = spread(3, 2000, 8, 3)
    table = spark.createDataFrame(list(enumerate(vecs)), "vec_id long, embedding array<float>")
    found, _ = assignments(table, Clustering(k=3, rounds=5, dims=8))
    assert found.count() == 2000 and sizes[0] == 2000
    assert sizes[-1] < 200, sizes


def test_expired_entries_are_ranges_that_the_reader_gets(spark):
    path = centroids.work_path(spark, "run")
    spark.createDataFrame([(1, [1, 2], None, 0, 0.5)], centroids.ENTRIES).write.parquet(path)
    run = spark.read.schema(centroids.ENTRIES).parquet(path)
    popped = centroids._expired(run, np.array([0.0, 1.0]), np.array([0.7, 2.0]))
    plan = popped._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(And(And(EqualTo(cluster,0),GreaterThanOrEqual(gap,0.0)),LessThan(gap,0.7))" in plan
    assert popped.count() == 1
