from __future__ import annotations

import math
import random
from hashlib import sha256

import numpy as np
import pytest

from tidemart.llm import mean_search

SCHEMA = "vec_id long, embedding array<double>, cluster string, total long"


def plain(rows, k=16, rounds=3, dim=64):
    """The contract in plain loops over Python integers."""
    kept = [(i, e) for i, e in rows if e is not None and len(e) == dim and all(x is not None and math.isfinite(x) for x in e)]
    exact = [(i, [math.floor(x * 64) if abs(x) < 2**53 else int(x) * 64 for x in e]) for i, e in kept]
    order = sorted(range(len(kept)), key=lambda n: (sha256(f"1:{'' if kept[n][0] is None else kept[n][0]}".encode()).hexdigest(), kept[n][1]))
    centroids = [exact[n][1] for n in order[:k]]

    def labels():
        found = []
        for _, v in exact:
            d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
            found.append((d.index(min(d)), min(d)))
        return found

    for _ in range(rounds):
        chosen = labels()
        for c in range(len(centroids)):
            mine = [v for (_, v), (n, _) in zip(exact, chosen) if n == c]
            if mine:
                centroids[c] = [sum(column) // len(mine) for column in zip(*mine)]
    chosen = labels()

    def long(n):
        return n if n < 2**63 else None

    inertia = sum(d for _, d in chosen)
    own = [sum(d for n, d in chosen if n == c) for c in range(len(centroids))]
    return sorted(((i, c, long(d), long(own[c]), long(inertia), sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
                   for (i, _), (c, d) in zip(exact, chosen)), key=str)


def check(spark, rows):
    frame = spark.createDataFrame([(i, e, "x", 1) for i, e in rows], SCHEMA).repartition(3)
    result = mean_search.cluster_report(frame)
    assert result.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted((tuple(r) for r in result.collect()), key=str) == plain(rows)


def vectors(seed, n, size=1.0):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, size) for _ in range(64)] for _ in range(5)]
    return [(i, [x + rng.gauss(0, size / 4) for x in rng.choice(centres)]) for i in range(n)]


def test_random_vectors(spark):
    check(spark, vectors(1, 400))


def test_ties_and_repeats(spark):
    rng = random.Random(2)
    rows = [(i % 40, [float(rng.randrange(2))] * 32 + [0.0] * 32) for i in range(120)]
    check(spark, rows + rows)


def test_odd_rows(spark):
    rows = vectors(3, 30)
    rows += [(100, None), (101, []), (102, [1.0] * 63), (103, [1.0] * 65), (104, [None, *[1.0] * 63]), (105, [float("nan"), *[1.0] * 63]),
             (106, [float("inf"), *[1.0] * 63]), (None, [0.5] * 64), (None, [-0.5] * 64), (107, [-0.0] * 64)]
    check(spark, rows)


@pytest.mark.parametrize("n", [0, 1, 5])
def test_few_vectors(spark, n):
    check(spark, vectors(4, n))


def test_huge_components_stay_exact(spark):
    rows = vectors(5, 60)
    rows += [(200, [1e9] * 64), (201, [-3e7, *[0.1] * 63]), (202, [1.7e308, *[0.0] * 63]), (203, [-1e300] * 64), (204, [2.0**53 + 2] * 64)]
    check(spark, rows)


@pytest.mark.parametrize("size", [3, 300, 1 << 23])
def test_bounds_reject_nothing_that_is_nearest(size):
    rng = np.random.default_rng(size)
    for k in (1, 2, 7, 40):
        points = rng.integers(-size, size + 1, (200, 8))
        centroids = [tuple(int(x) for x in row) for row in rng.integers(-size, size + 1, (k, 8))]
        distance = ((points[:, None, :] - np.array(centroids)[None]) ** 2).sum(axis=2)
        chosen, best = mean_search.nearest(points, centroids)
        assert chosen.tolist() == distance.argmin(axis=1).tolist()
        assert best.tolist() == distance.min(axis=1).tolist()


def test_roots_at_the_edges():
    values = [0, 1, 2, 3, 4, (1 << 30) ** 2, (1 << 30) ** 2 - 1, (1 << 60) - 1, (94906267) ** 2 - 1, (94906267) ** 2]
    assert mean_search.roots(np.array(values, dtype=np.int64)).tolist() == [math.isqrt(v) for v in values]


def test_digits():
    for value in (0, 1, -1, (1 << 40) - 1, 1 << 40, -(1 << 90) - 5):
        assert sum(d * mean_search.DIGIT**i for i, d in enumerate(mean_search.digits(value))) == value
