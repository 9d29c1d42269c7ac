import itertools
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import language, mixing, packing

# --- language -----------------------------------------------------------------------------

WORDS = {"en": "the and of with this from house water that have", "de": "der und von mit dies aus haus wasser dass haben", "fr": "le et de avec ceci depuis maison eau que avoir"}


def sentence(pick, lang, n=40):
    return " ".join(pick.choice(WORDS[lang].split()) for _ in range(n))


@pytest.fixture(scope="module")
def model(spark):
    pick = random.Random(1)
    rows = [(sentence(pick, lang), lang) for lang in WORDS for _ in range(40)] + [(None, "en"), ("x", None)]
    return language.fit(spark.createDataFrame(rows, "text string, label string"))


def test_text_beats_a_wrong_tag_and_priors_settle_what_text_leaves_open(spark, model):
    pick = random.Random(2)
    rows = [(i, sentence(pick, lang), f"http://www.site-{lang}.{'de' if lang == 'de' else 'org'}/x", lang) for i, lang in enumerate(sorted(WORDS) * 20)]
    rows += [(100, sentence(pick, "fr"), "http://site-en.org/", "de"), (101, "d", "http://new.de/", None), (102, "d", "http://site-fr.org/", None),
             (103, "d", None, "de-AT"), (104, "  7 !", "http://site-fr.org/", "fr"), (105, None, None, None), (106, "", None, None), (0, rows[0][1], None, None)]
    docs = spark.createDataFrame(rows, "id long, text string, url string, label string").withColumns({"language": F.lit("x"), "n": F.lit(1), "_host": F.lit("h"), "_text": F.lit("t"), "_post": F.lit(3)})
    found = language.identify(docs, model, declared=docs.label, name=language.host(docs.url))
    got = defaultdict(list)
    for r in found.collect():
        got[r.id].append(r)
    assert sum(map(len, got.values())) == len(rows) and all((r._host, r._text, r._post) == ("h", "t", 3) for g in got.values() for r in g)
    assert all(got[i][0]._language == lang and got[i][0]._accepted for i, _, _, lang in rows[1:60])
    assert got[100][0]._language == "fr"  # the text against tag and host
    assert [got[i][0]._language for i in (101, 102, 103)] == ["de", "fr", "de"]  # suffix, host, tag
    assert all(got[i][0]._language == "und" and not got[i][0]._accepted for i in (104, 105, 106))
    some = language.identify(docs, model, accepted=["fr"]).where("_accepted").select("_language").distinct().collect()
    assert [r._language for r in some] == ["fr"]


def plain_posteriors(rows, languages, logs):
    """(language, confidence) of rows (text, tag, host), one after another by Bayes' rule."""
    n = len(languages)
    posts, letters = [], []
    for text_, tag, _ in rows:
        raw = np.frombuffer((text_ or "").encode(), np.uint8)
        bucket, _ = language.grams(raw, np.array([0, len(raw)]))
        like = [language.TEMPER * sum(logs[b, j] for b in bucket) for j in range(n)]
        told = [0.0 if tag not in languages else math.log(language.TRUST if tag == x else (1 - language.TRUST) / (n - 1)) for x in languages]
        odds = [math.exp(a - max(like) + b) for a, b in zip(like, told)]
        posts.append([o / sum(odds) if len(bucket) else 0.0 for o in odds])
        letters.append(len(bucket))
    suffix = lambda h: h.rsplit(".", 1)[1] if "." in h else ""
    hosts, suffixes = defaultdict(lambda: [0.0] * n), defaultdict(lambda: [0.0] * n)
    for (_, _, h), post in zip(rows, posts):
        for table, key in ((hosts, h or ""), (suffixes, suffix(h or ""))):
            table[key] = [a + b for a, b in zip(table[key], post)]
    whole = [sum(s[j] for s in suffixes.values()) for j in range(n)]
    top = [(x + 1) / (sum(whole) + n) for x in whole]
    out = []
    for (_, _, h), post, count in zip(rows, posts, letters):
        prior = top
        for level in (suffixes[suffix(h or "")], hosts[h or ""]):
            rest = [max(0.0, a - b) for a, b in zip(level, post)]
            prior = [(r + language.WEIGHT * p) / (sum(rest) + language.WEIGHT) for r, p in zip(rest, prior)]
        fused = [a * b for a, b in zip(post, prior)] if count else prior
        best = max(range(n), key=lambda j: fused[j])
        out.append((languages[best], fused[best] / sum(fused)) if count else ("und", 0.0))
    return out


def test_posteriors_match_a_plain_computation(spark, model):
    pick = random.Random(7)
    rows = []
    for i in range(220):
        lang = pick.choice(sorted(WORDS))
        words = " ".join(pick.choice(WORDS[pick.choice([lang, lang, *sorted(WORDS)])].split()) for _ in range(pick.choice([0, 1, 2, 3, 9])))
        host = pick.choice([None, "plain", f"a.{lang}", "b.org", f"site{pick.randint(0, 5)}.{pick.choice(['de', 'org', 'fr'])}"])
        rows.append((pick.choice([words, words, None, "7"]) if i % 9 == 0 else words, pick.choice([None, lang, "de", "xx"]), host))
    want = plain_posteriors(rows, *model)
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, text string, tag string, host string")
    found = {r.id: r for r in language.identify(docs, model, declared=docs.tag, name=docs.host).collect()}
    assert {x for x, _ in want} >= {*WORDS, "und"}
    for i, (name, sure) in enumerate(want):
        assert found[i]._language == name and found[i]._confidence == pytest.approx(sure, abs=1e-9), rows[i]


def test_hidden_tags_are_found_again(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("length(text) > 80")
    hidden = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    model = language.fit(docs.where(~hidden).select("text", language.tag(docs.lang).alias("label")))
    rows = language.identify(docs, model, declared=F.when(~hidden, docs.lang)).where(hidden).select("lang", "_language").collect()
    assert len(rows) > 40 and sum(r.lang == r._language for r in rows) >= 0.95 * len(rows)


def test_language_of_empty_tables(spark, model):
    docs = spark.createDataFrame([], "text string")
    assert language.identify(docs, model).collect() == []
    none = language.fit(docs.select("text", F.lit("en").alias("label")))
    assert none[0] == [] and language.identify(spark.createDataFrame([("a",)], "text string"), none).first()._language == "und"


def test_rare_languages_of_a_large_table_are_known(spark):
    rare = [(f"zorg{i} zorg{i} kwyx", f"r{i:02}") for i in range(20)]
    docs = spark.range(60_000).select(F.concat(F.lit("the house "), F.col("id").cast("string")).alias("text"), F.lit("en").alias("label"))
    docs = docs.union(spark.createDataFrame(rare, "text string, label string")).repartition(5)
    languages, logs = language.fit(docs)
    assert languages == ["en", *[x for _, x in rare]]
    sums = np.full(language.BUCKETS, language.SMOOTH)
    raw = np.frombuffer(b"the house ", np.uint8)
    np.add.at(sums, language.grams(raw, np.array([0, len(raw)]))[0], 60_000)
    assert np.allclose(logs[:, 0], np.log(sums / sums.sum()))


def test_parts_of_addresses_and_markup(spark):
    rows = spark.createDataFrame([("https://u@WWW.A.Example.de:80/x", '<HTML class="a" lang="de-AT">'), (None, None), ("no address", "<p>")], "u string, h string")
    host = language.host(F.col("u"))
    got = rows.select(host.alias("h1"), language.suffix(host).alias("s"), language.tag(language.markup(F.col("h"))).alias("t")).collect()
    assert [tuple(r) for r in got] == [("a.example.de", "de", "de"), (None, None, None), ("", "", None)]


# --- mixing -------------------------------------------------------------------------------

def shares(weights: dict[str, float], turn: int) -> dict[str, int]:
    """Whole slots of each source in one turn, one at least, by largest remainders."""
    turn = max(turn, 4 * len(weights))
    total = sum(weights.values())
    if any(w <= 0 for w in weights.values()):
        raise ValueError("weights must be positive")
    exact = {s: w / total * turn for s, w in weights.items()}
    slots = {s: max(1, int(x)) for s, x in exact.items()}
    for s in sorted(exact, key=lambda s: (int(exact[s]) - exact[s], s))[: max(0, turn - sum(slots.values()))]:
        slots[s] += 1
    return slots


def schedule(slots: dict[str, int]) -> list[str]:
    """The source of every slot of a turn, in which each source has its whole slots."""
    return [s for _, s, *_ in mixing.blocks_in_order(slots, slots)]


def test_schedule_meets_every_deadline_with_less_than_a_block_deviation():
    pick = random.Random(3)
    for _ in range(20):
        slots = shares({f"s{i}": pick.choice([1, 2, 5, 50, 0.3]) for i in range(pick.randint(1, 30))}, 256)
        order = schedule(slots)
        turn, seen = len(order), Counter()
        assert turn == sum(slots.values()) and Counter(order) == slots
        for at, s in enumerate(order):
            j = seen[s]
            assert j * turn // slots[s] <= at < -(-(j + 1) * turn // slots[s])
            seen[s] += 1
            assert all(abs(seen[x] - (at + 1) * slots[x] / turn) < 1 for x in slots)


def test_mix_keeps_every_row_and_its_weights(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BIN", 50)
    rows = [(i, s) for i, s in enumerate(["a"] * 700 + ["b"] * 300 + [None] * 90 + ["c"] * 5)] + [(5, "a"), (None, "b"), (None, "b")]
    docs = spark.createDataFrame(rows, "id long, source string").withColumns({"slot": F.lit(1), "rank": F.lit("x"), "_bin": F.lit(100), "_nth": F.lit(101), "_order": F.lit(102), "_source": F.lit(103)})
    weights = {"a": 5, "b": 3, "": 1, "c": 1}
    got = mixing.mix(docs, weights, docs.source, F.xxhash64("id"), block=4, turn=10).collect()
    assert Counter((r.id, r.source) for r in got) == Counter(rows) and {(r._bin, r._nth, r._order) for r in got} == {(100, 101, 102)}
    places = sorted((r._slot, r._rank, r._source) for r in got)
    assert len({p[:2] for p in places}) == len(rows) and len({(s, x) for s, _, x in places}) == len({s for s, _, _ in places})
    for s in weights:
        assert sorted(r._rank for r in got if r._source == s) == list(range(sum(1 for r in rows if (r[1] or "") == s)))
    turn = sum(shares(weights, 10).values())
    on = sorted({(r._slot, r._source) for r in got if r._on_target})
    share = shares(weights, 10)
    for n in range(1, len(on) + 1):
        count = Counter(s for _, s in on[:n])
        assert all(abs(count[s] - n * share[s] / turn) < 1 for s in weights)
    assert all(r._release <= r._slot < r._deadline for r in got)
    with pytest.raises(ValueError):
        mixing.mix(docs, {"a": 1}, docs.source, F.xxhash64("id"))
    assert mixing.mix(docs.limit(0), weights, docs.source, F.xxhash64("id")).collect() == []


def test_blocks_follow_the_given_weights_over_many_turns():
    for weights in ({f"s{i:02}": 1.0 for i in range(20)}, {"hot": 3000**0.5, **{f"s{i}": (20 + i) ** 0.5 for i in range(30)}}, {"a": 1.0, "b": 0.3, "rare": 1e-4}):
        share = mixing.parts(weights)
        total, n = sum(weights.values()), 30_000
        whole, seen = sum(share.values()), Counter()
        assert all(abs(share[s] / whole - w / total) < 1e-12 for s, w in weights.items())
        for at, (slot, s, j, release, due) in enumerate(itertools.islice(mixing.blocks_in_order(share, dict.fromkeys(share, n)), n)):
            assert slot == at and j == seen[s] and release <= slot < due
            seen[s] += 1
            if at % 97 == 0:
                assert all(abs(seen[x] - (at + 1) * w / total) < 1.001 for x, w in weights.items())
        assert all(abs(seen[x] - n * w / total) < 1.001 for x, w in weights.items())


def test_mix_holds_the_given_weights_to_its_end(spark):
    names = [f"s{i:02}" for i in range(20)]
    docs = spark.range(40_000).select("id", F.concat(F.lit("s"), F.lpad((F.col("id") % 20).cast("string"), 2, "0")).alias("source"))
    got = mixing.mix(docs, dict.fromkeys(names, 1.0), docs.source, F.xxhash64("id"), block=1).select("_source", "_slot", "_on_target").collect()
    assert sorted(r._slot for r in got) == list(range(40_000)) and all(r._on_target for r in got)
    seen = Counter()
    for r in sorted(got, key=lambda r: r._slot):
        seen[r._source] += 1
        assert abs(seen[r._source] - (r._slot + 1) / 20) < 1
    late = mixing.mix(docs.where("source = 's00'"), {"s00": 1, "none": 1}, docs.source, F.xxhash64("id")).select("_slot", "_on_target").collect()
    assert not any(r._on_target for r in late)


# --- packing ------------------------------------------------------------------------------


def test_capacities_find_the_fullest_bin_that_has_room():
    pick = random.Random(4)
    for _ in range(200):
        sizes = [pick.randint(1, 20) for _ in range(pick.randint(0, 40))]
        room, bins = [], []
        for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
            fits = [(r, b) for b, r in enumerate(room) if r >= sizes[i]]
            if fits:
                least = min(fits)[0]
                room[next(b for r, b in fits if r == least)] -= sizes[i]
            else:
                room.append(20 - sizes[i])
        bins = packing.best_fit(sizes, 20)
        assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
        assert all(sum(sizes[i] for i in b) <= 20 for b in bins)
        assert sorted(20 - sum(sizes[i] for i in b) for b in bins) == sorted(room)


@pytest.mark.parametrize("pool", [64, 1 << 20])
def test_packing_loses_nothing(spark, pool):
    pick = random.Random(5)
    texts = ["".join(pick.choice("abé ") for _ in range(pick.choice([0, 3, 15, 16, 31, 32, 33, 200]))) for _ in range(120)] + [None, "same", "same"]
    docs = spark.createDataFrame([(i if i != 3 else None, t) for i, t in enumerate(texts)], "doc_id long, text string").withColumns({"id": F.lit(1), "ids": F.lit("x")})
    rows = packing.pack(docs, length=32, pool=pool).collect()
    assert len({r.sequence for r in rows}) == len(rows)
    parts = defaultdict(dict)
    for r in rows:
        ids, places, cu = np.frombuffer(r.ids, "<u2"), np.frombuffer(r.positions, "<u2"), r.cu_seqlens
        assert len(ids) == len(places) == 32 and cu[0] == 0 and (ids[cu[-1]:] == packing.FILL).all() and not places[cu[-1]:].any()
        for s, a, b in zip(r.segments, cu, cu[1:]):
            assert b - a == s.length and places[a:b].tolist() == list(range(b - a))
            parts[s.id][s.start] = ids[a:b]
    for i, t in enumerate(texts):
        whole = np.concatenate([p for _, p in sorted(parts[i if i != 3 else None].items())])
        assert bytes(whole[:-1].astype(np.uint8)).decode() == (t or "") and whole[-1] == packing.END
    assert packing.pack(docs.limit(0)).collect() == []
