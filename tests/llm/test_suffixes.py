import dataclasses
import random
import sys

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.brute import cut_repeats, cut_words
from tidemark.llm import suffixes


def made(seed, window):
    pick = random.Random(seed)
    letters = "abcdefgh éü\n\0"
    fresh = lambda n: "".join(pick.choice(letters) for _ in range(n))
    shared = [fresh(pick.randint(window // 2, 4 * window)) for _ in range(8)]
    docs = []
    for _ in range(120):
        parts = []
        for _ in range(pick.randint(0, 5)):
            parts.append(pick.choice([fresh(pick.randint(0, 2 * window)), pick.choice(shared), pick.choice(shared)[pick.randint(0, 30):]]))
        docs.append("".join(parts))
    edited = list(docs[5] + docs[6] + fresh(100))
    for _ in range(25):  # copies with single edits: many kinds of surroundings
        copy = list(edited)
        copy[pick.randrange(len(copy))] = "#"
        docs.append("".join(copy))
    docs += ["", None, "a" * (5 * window), "ab" * (3 * window), "a" * window, "x" * (window - 1), "x" * (window - 1), shared[0], shared[0]]
    return list(enumerate(docs))


def unit(window, gram):
    return suffixes.Unit(1, suffixes._byte_tokens, window, gram)


def check(spark, docs, window, gram):
    table = spark.createDataFrame(docs, "doc_id long, text string").withColumns(
        {"k1": F.lit("x"), "lead": F.lit(2), "start": F.lit(None).cast("int"), "_text": F.lit("y"), "_k1": F.lit(3), "_removed": F.lit(4)})
    want = cut_repeats(docs, window)
    rows = suffixes.remove(table, unit=unit(window, gram)).collect()
    assert all((r.k1, r.lead, r._text, r._k1) == ("x", 2, "y", 3) for r in rows)
    assert len(rows) == len(docs)
    for r in rows:
        size, gone, spans, kept = want[r.doc_id]
        assert (bytes(r._kept), len(r._removed), size - len(r._kept)) == (kept, spans, gone), r.doc_id


@pytest.mark.parametrize("window,gram", [(40, 8), (100, 30)])
def test_matches_brute_force(spark, window, gram):
    check(spark, made(window, window), window, gram)


def test_hot_leads_are_cut_finer(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "HOT", 3)
    monkeypatch.setattr(suffixes, "BLOCK", 16)
    check(spark, made(9, 40), 40, 8)


def test_no_rows_nulls_and_repeated_rows(spark):
    t = "".join(random.Random(1).choices("abcdefghijklmnop", k=90)) + "z" * 9
    table = spark.createDataFrame([(None, t), (1, None), (2, t[:50] + "éé"), (3, "short"), (4, "y" * 3 + "é" * 30), (4, "y" * 3 + "é" * 30)], "doc_id long, text string")
    rows = suffixes.remove(table, unit=unit(40, 8)).collect()
    assert sorted((r.doc_id or 0, len(r._kept)) for r in rows) == [(0, 49), (1, 0), (2, 4), (3, 5), (4, 0), (4, 0)]
    whole = suffixes.remove(table, unit=unit(40, 8), whole_characters=True).collect()
    assert all(bytes(r._kept).decode() is not None for r in whole)
    assert suffixes.remove(table.limit(0), unit=unit(40, 8)).collect() == []


def test_multikey_order_and_common_prefixes():
    pick = random.Random(2)
    rows = [bytes(pick.choice(b"ab\0") for _ in range(pick.randint(0, 30))) for _ in range(400)]
    strings, sizes = suffixes._matrix(rows, 30)
    order, common = suffixes.multikey(strings, sizes)
    got = [rows[i] for i in order]
    assert [g.ljust(32, b"\0") for g in got] == sorted(g.ljust(32, b"\0") for g in rows)
    for a, b, n in zip(got, got[1:], common[1:]):
        assert a[:n] == b[:n] and (n == min(len(a), len(b)) or a[n] != b[n])


def test_a_long_text_has_the_same_anchors_in_pieces():
    raw = np.random.default_rng(4).integers(97, 101, 30_000).astype(np.uint8)
    values = suffixes._byte_tokens(raw, None)[0]
    for a, b in zip(suffixes._long(values, 100, 30, 7000), suffixes.anchors(values, np.array([0, len(raw)]), 100, 30), strict=True):
        assert (a == b).all()


def prose(seed, window):
    pick = random.Random(seed)
    fresh = lambda n: ["".join(pick.choice("abcdefé") for _ in range(pick.randint(1, 5))) for _ in range(n)]
    passages = [fresh(n) for n in (*range(window - 2, window + 22), 2 * window, 3 * window)]
    docs = []
    for _ in range(150):
        words = []
        for _ in range(pick.randint(0, 4)):
            words += pick.choice([fresh(pick.randint(0, 2 * window)), pick.choice(passages), pick.choice(passages)[pick.randint(0, 9):]])
        docs.append("".join(w + pick.choice([" ", " ", "\n", " \t "]) for w in words))
    docs += ["", None, "a " * 5 * window, "A " * window, " ".join(passages[8]), " ".join(passages[8]).upper(), " ".join(fresh(40_000) + passages[12] + fresh(40_000))]
    return list(enumerate(docs))


@pytest.mark.parametrize("window,gram,hot", [(50, 8, None), (20, 4, None), (20, 4, 3)])
def test_passages_of_words_match_brute_force(spark, monkeypatch, window, gram, hot):
    if hot:
        monkeypatch.setattr(suffixes, "HOT", hot)
        monkeypatch.setattr(suffixes, "BLOCK", 16)
    docs = prose(window, window)
    want = cut_words(docs, window)
    assert sum(bool(s) for s, _ in want.values()) > 60
    words = dataclasses.replace(suffixes.WORDS, window=window, gram=gram)
    table = spark.createDataFrame(docs, "doc_id long, text string")
    for r in suffixes.remove(table, unit=words).collect():
        assert ([(x.start, x.stop) for x in r._removed], bytes(r._kept), r._also) == (*want[r.doc_id], None), r.doc_id
    if not hot:
        for r in suffixes.remove(table, unit=unit(100, 30), other=words).collect():
            assert [(x.start, x.stop) for x in r._also] == want[r.doc_id][0]


def test_runs_of_all_bodies_are_found_at_once(monkeypatch):
    n, window, gram = 600, 40, 8
    span = window - gram
    hits = np.random.default_rng(3).random((n, span + 1)) < 0.5
    hits[0, 0] = hits[7, -1] = hits[8, 0] = True
    hits[9] = False
    lone = np.arange(n) % 5 > 0
    lone[:1] = lone[7:10] = True
    monkeypatch.setattr(suffixes, "repeats", lambda *_: hits)
    batch = pa.record_batch({
        "k1": pa.array(range(n)), "k2": pa.array(range(n, 2 * n)), "at": pa.array(range(100, 100 + n)), "left": pa.array([span] * n), "body": pa.array([b"x" * 80] * n),
        "lone": pa.array(lone), "first": pa.array([b"x"] * n), "moved": pa.array([0] * n)})
    want = []
    for i in np.flatnonzero(lone).tolist():
        edge = np.flatnonzero(np.diff(np.concatenate([[0], hits[i].astype(int), [0]])))
        want += [(i, n + i, 100 + i - (b - 1), 100 + i - a + window) for a, b in zip(edge[::2].tolist(), edge[1::2].tolist())]
    calls = []
    sys.setprofile(lambda frame, event, what: calls.append(event) if event in ("call", "c_call") else None)
    try:
        out = list(suffixes._sorted_blocks(unit(window, gram), span)(iter([batch])))
    finally:
        sys.setprofile(None)
    assert [tuple(r.values()) for b in out for r in b.to_pylist()] == want
    assert len(calls) < n  # was some twenty calls for each body


def test_blocks_end_between_two_leads(monkeypatch):
    monkeypatch.setattr(suffixes, "BLOCK", 4)
    seen = []
    monkeypatch.setattr(suffixes, "repeats", lambda bodies, *_: seen.append(bodies) or np.zeros((len(bodies), 33), bool))
    firsts = [b"a", b"b", b"b", b"b", b"b", b"b", b"c", b"c", b"d", b"d", b"d", b"e", b"e", b"f"]
    rows = pa.record_batch({
        "k1": pa.array(range(14)), "k2": pa.array(range(14)), "at": pa.array(range(14)), "left": pa.array([0] * 14), "body": pa.array(firsts),
        "lone": pa.array([True] * 14), "first": pa.array(firsts), "moved": pa.array([0] * 14)})
    for cut in range(1, 14):
        seen.clear()
        list(suffixes._sorted_blocks(unit(40, 8), 32)(iter([rows.slice(0, cut), rows.slice(0, 0), rows.slice(cut)])))
        assert seen == [firsts[:6], firsts[6:11], firsts[11:]]
    assert list(suffixes._sorted_blocks(unit(40, 8), 32)(iter([rows.slice(0, 0)]))) == []


def test_spans_of_a_batch_are_merged_row_by_row():
    pick = random.Random(5)
    rows = [None, [], *[[{"start": (a := pick.randint(0, 60)), "stop": a + pick.randint(1, 9)} for _ in range(pick.randint(0, 12))] for _ in range(80)], None]
    want = []
    for row in rows:
        marked = {x for p in row or [] for x in range(2 * p["start"], 2 * p["stop"] + 1)}  # spans that touch are one
        begins, ends = sorted(x for x in marked if x - 1 not in marked), sorted(x for x in marked if x + 1 not in marked)
        want.append([[a // 2, b // 2] for a, b in zip(begins, ends)])
    lists = pa.array(rows, suffixes._SPANS)
    assert suffixes._merged(lists) == want
    assert suffixes._merged(lists[30:60]) == want[30:60]
    assert suffixes._merged(pa.nulls(3, suffixes._SPANS)) == [[], [], []]
