import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.brute import near_groups
from tidemark.llm import minhash
from tidemark.llm.graph import components


@pytest.fixture(scope="module")
def docs():
    pick = random.Random(5)
    word = lambda: "".join(pick.choice("abcdef") for _ in range(pick.randint(1, 4)))
    bases = [[word() for _ in range(pick.choice([3, 12, 60, 200, 900]))] for _ in range(30)]
    rows = []
    for base in bases:
        for _ in range(pick.randint(1, 9)):
            copy = list(base)
            for _ in range(pick.choice([0, 0, 1, 1, 2, 3, 8])):
                copy[pick.randrange(len(copy))] = word()
            rows.append(pick.choice([" ", "  ", "\n", "\t "]).join(copy))
    rows += ["", " \n", "one", "One", "a b c d", "a b c d e", "A  B c d e", "x y z", None, "é É", "e f", "e f"]
    return list(enumerate(rows))


def table(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, text string").withColumns({"label": F.lit(1), "node": F.lit(2), "k1": F.lit("x")})


def test_groups_match_brute_force(spark, docs):
    want = near_groups(docs)
    assert len({c for _, c in want.values()}) < len(docs) - 40
    for r in minhash.groups(table(spark, docs)).collect():
        assert (r.n_shingles, r.component_id, r.kept) == (*want[r.id], want[r.id][1] == r.id), docs[r.id]


def test_chain_of_links_beyond_the_leader(spark):
    words = [f"w{i}" for i in range(400)]
    docs = [(i, " ".join(words[8 * i : 8 * i + 100])) for i in range(35)]
    want = near_groups(docs)
    assert {c for _, c in want.values()} == {0}
    assert {r.component_id for r in minhash.groups(table(spark, docs)).collect()} == {0}


def test_family_of_copies_of_copies(spark):
    pick = random.Random(8)
    words = lambda n: ["".join(pick.choice("abcdefgh") for _ in range(5)) for _ in range(n)]
    family = [words(150)]
    for _ in range(90):
        copy = list(pick.choice(family))
        for _ in range(pick.randint(1, 9)):
            at = pick.randrange(len(copy))
            copy[at : at + pick.choice([1, 1, 1, 4])] = words(pick.choice([0, 1, 1, 2]))
        family.append(copy)
    docs = [(i, " ".join(w)) for i, w in enumerate(family)]
    want = near_groups(docs)
    assert 5 < len({c for _, c in want.values()}) < 85
    assert {r.id: (r.n_shingles, r.component_id) for r in minhash.groups(table(spark, docs)).collect()} == want


def test_null_ids_repeated_rows_and_empty_tables(spark):
    t = "one two three four five six seven"
    got = minhash.groups(table(spark, [(None, t), (4, t), (4, t), (3, t + " eight"), (None, "alone"), (None, None), (9, None)])).collect()
    assert sorted((r.id or -1, r.component_id or -1, r.kept) for r in got) == sorted(
        [(-1, 3, False), (4, 3, False), (4, 3, False), (3, 3, True), (-1, -1, True), (-1, -1, True), (9, 9, True)])
    assert minhash.groups(table(spark, docs=[]).limit(0)).collect() == []


def test_signature_estimates_similarity_better_than_independent_hashes():
    pick = np.random.default_rng(1)
    error = []
    for _ in range(200):
        pool = pick.integers(0, 1 << 63, 300, dtype=np.uint64)
        a, b = minhash.signatures([np.sort(pool[:200]), np.sort(pool[100:])])
        error.append((a == b).mean() - 1 / 3)
    assert abs(np.mean(error)) < 0.01 and np.std(error) < np.sqrt(2 / 9 / 128)
    small = minhash.signatures([pool[:1], pool[:3]])
    assert (small < (128 << 48)).all()


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (100, 100), (7, 7), (200, 5), (300, 300)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 200: 0}
