import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from tidemark.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
POOL = "abcdeABC 12  \n\t'sllé É ßΣςİñ́\x1c\x1f\u0085  ©漢字😀‍​\x00½²٣ǅﬁ_-▁<s>"


@pytest.fixture(scope="module")
def texts():
    pick = random.Random(3)
    made = ["".join(pick.choice(POOL) for _ in range(pick.randint(0, 60))) for _ in range(1500)]
    words = ["the international organisation", "ihre Zusammenarbeit", "l'éducation nationale", "return self._value", "    def f(x):\n\t\treturn x"]
    made += ["".join(pick.choice(words)[: pick.randint(1, 40)] + pick.choice(["", " ", "   ", "\n"]) for _ in range(9)) for _ in range(300)]
    return [None, "", " ", "      ", "a" * 30_000, "ab cd " * 250_000, "<s>Hi</s> <unk> <0x41>", "same", "same", "▁▁ ▁x", *made]


def test_matches_the_library(spark, texts):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    docs = spark.createDataFrame([(i if i != 8 else None, t, "x", "y") for i, t in enumerate(texts)], "doc_id long, text string, ids string, decoded string")
    rows = pieces.digests(pieces.encode(docs, PATH, check=True)).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode(texts[8 if row.doc_id is None else row.doc_id] or "")
        assert row.n_tokens == len(ids) and row.agrees, row
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_round_trip_and_empty_table(spark, texts):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    back = {r.doc_id: r.decoded for r in pieces.encode(docs, PATH).collect()}
    assert all(back[i] == (t or "").replace("▁", " ") for i, t in enumerate(texts))
    assert pieces.encode(docs.limit(0), PATH, check=True).collect() == []


@pytest.mark.parametrize("few", [0, 32])
def test_agenda_takes_the_best_score_then_the_leftmost(monkeypatch, few):
    monkeypatch.setattr(pieces, "FEW", few)
    own = pieces.Pieces(open(PATH, "rb").read())
    score = {s: x for s, x, kind in own.pieces if kind == pieces._NORMAL}
    for part in ("▁theththethan", "aaaaaaaaa", "▁▁▁▁▁▁▁in", "▁▁▁", "▁international" * 3):
        symbols = list(part)
        while True:
            ranked = [(-score[a + b], i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if a + b in score]
            if not ranked:
                break
            i = min(ranked)[1]
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
        assert own.merge(part) == [own.ids[s] for s in symbols]


def test_decoding_any_ids():
    own, library = pieces.Pieces(open(PATH, "rb").read()), sentencepiece.SentencePieceProcessor(model_file=PATH)
    pick = random.Random(1)
    for _ in range(300):
        ids = [i for _ in range(20) for i in [pick.choice([pick.randrange(259, 32_000), 1, 2, 0, 68, 259])]]
        assert own.decode(ids) == library.decode(ids), ids


def test_other_types_are_refused():
    spec = pieces.sentencepiece_model_pb2.ModelProto.FromString(open(PATH, "rb").read())
    spec.trainer_spec.model_type = spec.trainer_spec.UNIGRAM
    with pytest.raises(ValueError):
        pieces.Pieces(spec.SerializeToString())
