"""The stages one after another over a small corpus, each held to a plain version of itself."""

import hashlib
import random

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.brute import cut_words, near_groups

KINDS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = {"en": "the and of with this from house water that have been were when stone river field light", "de": "der und von mit dies aus haus wasser dass haben wurde wenn stein fluss feld licht auch"}


def corpus():
    pick = random.Random(6)
    text = lambda lang, n: " ".join(pick.choice(WORDS[lang].split()) + pick.choice(["", "", "er", "ing", "en"]) for _ in range(n))
    rows = []
    for i in range(60):
        lang = pick.choice(["en", "de"])
        rows.append((i, text(lang, pick.choice([30, 90, 200])), lang, f"s{i % 3}"))
    passage = "ä" + text("de", 90)
    for i in (3, 9, 20):
        words = rows[i][1].split()
        rows[i] = (i, " ".join(words[:20]) + passage + " ".join(words[20:]), *rows[i][2:])
    short = text("en", 55)  # under 400 bytes
    for i in (30, 41):
        words = rows[i][1].split()
        rows[i] = (i, " ".join([*words[:30], short, *words[30:]]), *rows[i][2:])
    rows.append((60, rows[5][1], "en", "s0"))  # exact copy
    near = rows[7][1].split()
    near[3] = "changed"
    rows.append((61, " ".join(near), rows[7][2], None))
    rows += [(62, None, "en", "s1"), (63, "", None, "s1"), (64, "123 !!", "de", "s2"), rows[11], (None, text("en", 50), None, None)]
    return [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows]


def test_stages(spark, tmp_path):
    rows = corpus()
    spark.createDataFrame(rows, KINDS).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept.append({r.doc_id: r for r in docs.collect()} | {"n": docs.count()})
    language, near, cut, mixed = kept
    assert language["n"] == len(rows) - 3 and not {62, 63, 64} & language.keys()
    assert all(language[i].text == t for i, t, *_ in rows if i in language and i is not None)
    # one of each group, and of repeated rows one
    groups = near_groups([(-1 if i is None else i, t) for i, t in {(r[0], r[1]) for r in rows} if i not in (62, 63, 64)])
    want = {c for _, c in groups.values()} - {-1}
    assert near.keys() - {"n", None} == want and near["n"] == len(want) + 1
    plain = cut_words([(i, near[i].text) for i in near if i != "n"], 50)
    assert sum(bool(spans) for spans, _ in plain.values()) == 5  # two of them hold the passage of 55 words
    for i, (spans, left) in plain.items():
        assert cut[i].text == left.decode() and cut[i].n_chars == len(cut[i].text)
    assert not any(spans for spans, _ in cut_words([(i, cut[i].text) for i in cut if i != "n"], 50).values())
    assert {i: (r.text, r.source) for i, r in mixed.items() if i != "n"} == {i: (r.text, r.source) for i, r in cut.items() if i != "n"} and mixed["n"] == cut["n"]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    last = {r.doc_id: r for r in corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()}
    assert last.keys() == mixed.keys() - {"n"}
    for i, r in last.items():
        ids = library.encode(mixed[i].text, add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in ids)).hexdigest()


def test_empty_corpus(spark, tmp_path):
    spark.createDataFrame([], KINDS).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
