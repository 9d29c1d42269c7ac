import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import imatch, toxicity


def made(n=200, seed=1):
    pick = random.Random(seed)
    lexicon = ["".join(pick.choice("abcdefghij") for _ in range(6)) for _ in range(4000)]
    return [" ".join(pick.choice(lexicon) for _ in range(pick.choice([5, 40, 200, 600]))) for _ in range(n)]


def test_edited_texts_and_likeness(spark):
    texts = made()
    texts += [None, "", "é" * 9, "x", texts[0], texts[0]]
    docs = [(3 * i, t) for i, t in enumerate(texts)]
    table = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"id": F.lit("x"), "bucket": F.lit(1), "f": F.lit(2)}).repartition(7)
    rows = sorted(imatch.compare(table, common=0.2).collect(), key=lambda r: r.id)
    assert [r.id for r in rows] == [i for i, _ in docs]
    for r, (_, t), (_, after) in zip(rows, docs, docs[1:] + docs[:1]):
        t, after = t or "", after or ""
        q = len(t) // 4
        assert (r.n_chars, r.edited) == (len(t), t[: len(t) - q] + after[:q])
        assert (r.near_edited == 1.0) == (r.fingerprint == r.edited_fingerprint) and 0 <= r.near_next <= 1
    by_text = {}
    for r, (_, t) in zip(rows, docs):
        assert by_text.setdefault(t or "", r.fingerprint) == r.fingerprint
    long = [r for r in rows[:200] if r.n_chars > 250]
    assert np.median([r.near_edited for r in long]) > 0.3 and max(r.near_next for r in long) < 0.2
    assert rows[-1].near_next == rows[0].near_edited or rows[-1].fingerprint == rows[0].fingerprint


WORD = (1 << 64) - 1


def spread(x):
    """The 64-bit finaliser on a Python integer."""
    x ^= x >> 33
    x = x * 0xFF51AFD7ED558CCD & WORD
    x ^= x >> 33
    x = x * 0xC4CEB9FE1A85EC53 & WORD
    return x ^ x >> 33


def plain_fingerprints(texts, common):
    """Term by term and lexicon by lexicon."""
    def hashes(t):
        raws = [np.frombuffer(w, np.uint8) for w in set(re.findall(rb"[a-z\x80-\xff]+", (t or "").encode().lower()))]
        return {int(imatch.text.words(r, np.array([0, len(r)]), imatch.text.NOT_LETTER)[0][0]) for r in raws}

    sets = [hashes(t) for t in texts]
    often = Counter(h for s, t in zip(sets, texts) if t is not None for h in s)
    most = max(imatch.RARE, math.floor(common * sum(t is not None for t in texts)))
    step, seeds = int(imatch._STEP), [spread((k + 1) * 0xA0761D6478BD642F & WORD) for k in range(imatch.LEXICONS)]

    def one(t):
        inside = sorted(h for h in hashes(t) if imatch.RARE <= often[h] <= most)
        if not inside:
            return "text:" + hashlib.sha256((t or "").encode()).hexdigest()
        scale, parts = max(0, math.floor(math.log2(len(inside) / imatch.TERMS))), []
        for e in (scale, scale + 1):
            shown = []
            for seed in seeds:
                kept = [h for h in inside if spread(h * step & WORD ^ seed) <= WORD >> e]
                total = sum(spread((h + 1) * step + place * seed & WORD) for place, h in enumerate(kept)) & WORD
                shown.append(f"{(spread(total) | 1) >> 32 | 1:08x}" if kept else "-")
            parts.append(f"{e}:" + ",".join(shown))
        return "|".join(parts)

    return one


def test_fingerprints_match_a_plain_computation(spark):
    texts = made(120, seed=5) + [None, "", "Émile é x", "ünique", "123 !!"]
    rows = imatch.compare(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), common=0.1).collect()
    plain = plain_fingerprints(texts, 0.1)
    for r in rows:
        assert r.fingerprint == plain(texts[r.id]) and r.edited_fingerprint == plain(r.edited), r.id

        def share(a, b):
            if a == b:
                return 1.0
            a, b = ({p.split(":")[0]: p.split(":")[1].split(",") for p in f.split("|") if not f.startswith("text")} for f in (a, b))
            pairs = [(x, y) for e in a.keys() & b.keys() for x, y in zip(a[e], b[e]) if (x, y) != ("-", "-")]
            return sum(x == y for x, y in pairs) / len(pairs) if pairs else 0.0

        assert r.near_edited == pytest.approx(share(r.fingerprint, r.edited_fingerprint))
        assert r.near_next == pytest.approx(share(r.fingerprint, plain(texts[(r.id + 1) % len(texts)])))


def test_order_of_null_and_repeated_ids(spark):
    rows = [(None, "cccc"), (None, "bbbb"), (2, "aaaa"), (2, "aaaa"), (7, "dddd")]
    got = imatch.compare(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.id or -1), r.edited) for r in got) == [(-1, "bbbc"), (-1, "ccca"), (2, "aaaa"), (2, "aaad"), (7, "dddb")]
    one = imatch.compare(spark.createDataFrame([(1, "only")], "doc_id long, text string")).collect()
    assert [(r.edited, r.near_next) for r in one] == [("onlo", 1.0)]
    assert imatch.compare(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_lexicon_counts_all_texts(spark):
    texts = ["aa bb cc", "aa bb", "aa dd dd", "aa ee", None, ""]
    kept = imatch.lexicon(spark.createDataFrame([(t,) for t in texts], "text string"), common=0.5)
    import pyarrow as pa

    inside = {w: bool(kept[imatch.terms(pa.array([w]))[0][0]]) for w in ("aa", "bb", "cc", "dd", "ee")}
    assert inside == {"aa": False, "bb": True, "cc": False, "dd": False, "ee": False}


def test_terms_in_one_text_stay_out_of_a_large_vocabulary(spark):
    # 120,000 terms in one text each, 5,000 in two texts each
    letters = F.translate(F.lpad(F.col("id").cast("string"), 7, "0"), "0123456789", "abcdefghij")
    once = spark.range(120_000).groupBy(F.floor(F.col("id") / 400)).agg(F.concat_ws(" ", F.collect_list(letters)).alias("text")).select("text")
    twice = spark.range(2).crossJoin(spark.range(5_000).select(F.concat(F.lit("z"), letters).alias("w"))).groupBy("id").agg(F.concat_ws(" ", F.collect_list("w")).alias("text")).select("text")
    docs = once.union(twice).repartition(3)
    kept = imatch.lexicon(docs)
    texts = [r.text for r in docs.collect()]
    import pyarrow as pa

    inside = [int(np.sum(kept[imatch.terms(pa.array([t]))[0]])) for t in texts]
    assert sorted(inside) == [0] * 300 + [5_000] * 2
    assert len(kept.kept) == 5_000


def test_toxicity_is_learned_from_training_rows_only(spark):
    pick = random.Random(2)
    texts = made(1200, seed=3)
    toxic = [i for i in range(1200) if pick.random() < 0.15]
    for i in toxic:
        words = texts[i].split()
        for _ in range(4):
            words[pick.randrange(len(words))] = pick.choice(["Vilezorn!", "vilekrat", "grumpfad", "hatemush"])
        texts[i] = " ".join(words)
    texts += [None, ""]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(None, "vilekrat", "y")], "doc_id long, text string, score string")
    known = [(i, int(i in toxic)) for i in range(1200) if pick.random() < 0.5]
    held = {i for i in range(1202) if zlib.crc32(str(i).encode()) % 4 == 2}
    labels = spark.createDataFrame([*known, (None, 1), (4, None)], "doc_id long, toxic int").withColumn("text", F.lit(0))
    model = toxicity.fit(docs, labels)
    got = {r.id: r.score for r in toxicity.score(docs, model).collect()}
    assert len(got) == 1203 and all(0 <= s <= 1 for s in got.values())
    right = [(got[i] >= 0.3) == (i in toxic) for i in held if i < 1200]
    assert np.mean(right) > 0.97 and got[None] >= 0.3 and got[1200] == got[1201] < 0.3
    # labels of held-out rows change nothing
    other = spark.createDataFrame([(i, v if i not in held else 1 - v) for i, v in known], "doc_id long, toxic int")
    assert {r.id: r.score for r in toxicity.score(docs, toxicity.fit(docs, other)).collect()} == got
    rows = docs.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("h")).collect()
    assert {r.doc_id for r in rows if r.h} == held


def test_toxicity_without_labels_and_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r.score < 0.3 for r in toxicity.score(docs, model).collect()} == {True}
    assert toxicity.score(docs.limit(0), model).collect() == []


@pytest.mark.parametrize("there", [1, 10_000, 10_001, 4 * 10**10, 10**11, 10**13])
def test_the_drawn_share_holds_at_any_size(there):
    share = (toxicity.bound(10_000, there) + (1 << 63) + 1) / (1 << 64)
    assert share == pytest.approx(min(1, 10_000 / there), rel=1e-6)
