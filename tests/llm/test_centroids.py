import hashlib
import math
import random
from fractions import Fraction

import numpy as np
import pytest

from tidemark.llm import centroids


def plain(rows, dims, scale, k, rounds):
    """[(id, cluster, distance)], cluster inertias, centroids."""
    kept = [(i, [math.floor(Fraction(x) * scale) for x in v], v) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    ranked = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[2]))
    centres = [r[1] for r in ranked[:k]]

    def assign():
        out = []
        for i, v, _ in kept:
            far = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centres]
            out.append((i, far.index(min(far)), min(far), v))
        return out

    for _ in range(rounds):
        found = assign()
        for c in range(len(centres)):
            mine = [v for _, f, _, v in found if f == c]
            if mine:
                centres[c] = [sum(x) // len(mine) for x in zip(*mine)]
    return assign(), centres


def check(spark, rows, dims=6, k=5, scale=64, rounds=3):
    table = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, cluster int, id string")
    got = centroids.cluster(table, dims=dims, k=k, scale=scale, rounds=rounds).collect()
    want, centres = plain(rows, dims, scale, k, rounds)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or 0)
    small = lambda x: x if x < 1 << 63 else None
    assert sorted([(r.id, r.cluster, r.distance) for r in got], key=key) == sorted([(i, c, small(f)) for i, c, f, _ in want], key=key)
    for r in got:
        assert r.inertia == small(sum(f for _, _, f, _ in want))
        assert r.cluster_inertia == small(sum(f for _, c, f, _ in want if c == r.cluster))
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centres[r.cluster])).encode()).hexdigest()
    return got


def vectors(seed, n, dims=6):
    pick = random.Random(seed)
    return [(i, [round(pick.gauss(pick.choice([-1, 0, 2]), 0.3), 2) for _ in range(dims)]) for i in range(n)]


def test_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(centroids, "BLOCK", 70)
    rows = vectors(1, 400)
    rows += [(500 + i, rows[3][1]) for i in range(150)]  # a very common vector
    rows += [(7, rows[7][1]), (7, rows[9][1]), (None, rows[11][1]), (None, rows[12][1])]
    rows += [(600, None), (601, [1.0] * 5), (602, [1.0] * 5 + [None]), (603, [1.0] * 5 + [math.nan]), (604, [math.inf] * 6), (605, [])]
    assert len(check(spark, rows)) == len(rows) - 6


def test_ties_go_to_the_smaller_number_and_empty_clusters_stay(spark):
    rows = [(i, [float(x)] * 2) for i, x in enumerate([0, 0, 0, 0, 1, 1, -1, 3, 3, 3])]
    check(spark, rows, dims=2, k=6, scale=1)


def test_large_components_are_exact(spark):
    rows = vectors(2, 60) + [(100 + i, [x * 1e8 for x in v]) for i, v in vectors(3, 20)] + [(200, [3e38] * 6), (201, [-1.7e308] * 6), (202, [1.7e308] * 6)]
    assert {r.distance for r in check(spark, rows) if r.id in (201, 202)} & {None, 0}


@pytest.mark.parametrize("rows", [[], [(1, None)], vectors(4, 3)])
def test_no_or_few_vectors(spark, rows):
    assert len(check(spark, rows)) == sum(v is not None for _, v in rows)


def test_dictionaries_lose_nothing():
    values = np.random.default_rng(1).integers(-5, 5, (300, 7))
    tables, codes = centroids.subvectors(values)
    assert (np.concatenate([t[codes[:, b]] for b, t in enumerate(tables)], axis=1) == values).all()
    assert [len(t) for t in tables] == [len({tuple(r) for r in values[:, b : b + 2].tolist()}) for b in range(0, 7, 2)]
