import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import variants


def vocabulary(docs, misspelt, length, often):
    counts = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{low}".encode())
            if h % misspelt == 0:
                low = low[: h % len(low)] + low[h % len(low) + 1 :]
            if len(low) >= length:
                counts[low] += 1
    return {w: n for w, n in counts.items() if n >= often}


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(known, times=5):
    forms, out = {}, {}
    for w, n in known.items():
        others = [o for o in known if near(w, o)]
        best = min(others, key=lambda o: (-known[o], o), default=None)
        if best and known[best] >= times * n:
            forms[w] = best
        out[w] = [n, len(others)]
    for w, row in out.items():
        root = w
        while root in forms:
            root = forms[root]
        row += [forms.get(w), root, known.get(forms.get(w))]
    return out


def rows_of(frame):
    return {r.word: [r.n, r.n_near, r.form, r.root, r.form_n] for r in frame.collect()}


def documents(seed):
    pick = random.Random(seed)
    base = ["".join(pick.choice("abcÉé÷") for _ in range(pick.randint(5, 9))) for _ in range(25)]
    docs = []
    for i in range(300):
        made = []
        for _ in range(30):
            w = base[min(int(pick.expovariate(0.2)), 24)]
            if pick.random() < 0.3:
                at = pick.randrange(len(w))
                w = w[:at] + pick.choice(["", "a", "B", "é"]) + w[at + pick.randint(0, 1) :]
            made.append(w if pick.random() < 0.9 else w.capitalize())
        docs.append((i, pick.choice([" ", "-", "\n"]).join(made)))
    return docs + [(5, None), (6, ""), (None, "letters letters"), (7, docs[7][1]), (7, docs[7][1]), (400, "abcabca " * 40_000), (401, "Straße straße STRASSE " * 9)]


@pytest.mark.parametrize("seed,pairs", [(1, 4096), (2, 4096), (2, 3)])
def test_matches_brute_force(spark, monkeypatch, seed, pairs):
    monkeypatch.setattr(variants.near, "__defaults__", (pairs,))
    docs = documents(seed)
    table = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, word string, n int")
    known = vocabulary(docs, 7, 6, 3)
    got = rows_of(variants.group(table, misspelt=7, length=6, often=3))
    want = plain(known)
    assert sum(w[2] is not None for w in want.values()) > 20 and any(w[2] and w[2] != w[3] for w in want.values())
    assert got == want


def test_production_parameters(spark):
    docs = documents(4)
    table = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows_of(variants.group(table)) == plain(vocabulary(docs, 199, 6, 5))


@pytest.mark.parametrize("pairs", [1, 8, 4096])
def test_every_pair_of_short_and_long_words(spark, pairs):
    pick = random.Random(9)
    made = {"".join(pick.choice("ab") for _ in range(pick.randint(1, 7))) for _ in range(150)}
    made |= {"suffix" * 3 + x for x in "abcdefghij"} | {x + "suffix" * 3 for x in "abcdefghij"} | {"long" * 500 + x + "word" * 500 for x in ("", "a", "b", "ab")}
    got = variants.near(spark.createDataFrame([(w, 1) for w in made], "word string, n long"), pairs)
    assert sorted((r.word, r.other) for r in got.collect()) == sorted((a, b) for a in made for b in made if near(a, b))


def test_a_shared_chunk_is_cut_finer(spark):
    made = ["prefix" + "".join(random.Random(i).choices("abcdefghijkl", k=6)) for i in range(2000)]
    frame = spark.createDataFrame([(w, 1) for w in set(made)], "word string, n long")
    got = variants.near(frame, 500)
    assert {(r.word, r.other) for r in got.collect()} == {(r.word, r.other) for r in variants.near(frame, 10**9).collect()}


def test_chains_of_forms(spark):
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(11)] + [("x", "w5"), ("y", "z")], "word string, form string")
    assert {r.word: r.root for r in variants._roots(forms).collect()} == {**{f"w{i}": "w11" for i in range(11)}, "x": "w11", "y": "z"}


def test_no_words(spark):
    table = spark.createDataFrame([(1, None), (2, ""), (3, "too few")], "doc_id long, text string").withColumn("h", F.lit(1))
    assert variants.group(table).collect() == [] and variants.group(table.limit(0)).collect() == []
