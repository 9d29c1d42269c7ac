import math
import random

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import slices


def brute(rows, k=5):
    kept = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(256 * x) for x in v]))
    out = []
    for q in {i for i, _ in kept if i % 50 == 0}:
        scores = [(-sum(x * y for x, y in zip(a, b)), i) for j, a in kept if j == q for i, b in kept if i != q]
        scores = sorted(s for s in scores if -(1 << 63) < s[0] <= 1 << 63)
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def run(spark, rows):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"id": F.lit(1), "codes": F.lit("x"), "score": F.lit(2)})
    return sorted(tuple(r) for r in slices.search(table, F.col("id") % 50 == 0).collect())


def test_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(slices, "BLOCK", 100)
    monkeypatch.setattr(slices, "GROUP", 3)
    pick = random.Random(1)
    value = lambda: float(np.float32(pick.choice([0, 1, -1, 0.5, pick.gauss(0, 0.3), pick.gauss(0, 300)])))
    rows = [(i, [value() for _ in range(12)]) for i in range(400)]
    rows += [(400 + i, rows[7][1]) for i in range(60)]  # ties
    rows += [(500, None), (550, [1.0, None]), (None, [1.0] * 12), (600, [math.nan] * 12), (650, [math.inf] * 12), (700, []), (750, [0.0] * 12), (800, [2.0, 3.0])]
    rows += [rows[3], (3, [9.0] * 12), rows[50]]
    assert run(spark, rows) == brute(rows)


def test_repeated_ids_and_large_components(spark, monkeypatch):
    monkeypatch.setattr(slices, "BLOCK", 40)
    pick = random.Random(4)
    value = lambda: float(np.float32(pick.choice([0, 1, 3e-3, 1e8, -1e8, 4e7, 1e14, -1e15]) * pick.random()))
    rows = [(i % 120, [value() for _ in range(5)]) for i in range(260)] + [(2, [4e7] * 5), (50, [1e-2] * 5), (7, [1e8] * 5), (100, [1e8] * 5), (100, [-1e8] * 5)]
    rows += [(9, rows[0][1])] * 90
    want = brute(rows)
    assert max(s for *_, s in want) > 1 << 61
    assert run(spark, rows) == want


def test_few_rows_and_none(spark):
    assert run(spark, [(0, [1.0, 2.0])]) == []
    assert run(spark, [(0, [1.0, 2.0]), (1, [-1.0, 0.25])]) == [(0, 1, 1, -65536 + 512 * 64)]
    assert run(spark, []) == []


def test_slices_add_to_the_inner_product():
    pick = np.random.default_rng(2)
    codes = pick.integers(-300, 300, (130, 9))
    index = slices.Index(np.arange(130), codes)
    for query in pick.integers(-40, 40, (20, 9)):
        parts, constant = index.sums(query)
        total = sum((np.unpackbits(s.view(np.uint8), bitorder="little")[:130].astype(np.int64) << w for w, s in enumerate(parts)), np.zeros(130, np.int64))
        assert (total + constant == codes @ query).all()
