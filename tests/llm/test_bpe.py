import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
POOL = "abcdeABC 12 \n\t'sllé É ßΣςİñ́\x1c\x1f\u0085  ©漢字😀‍​\x00½²٣ǅﬁ_-"


@pytest.fixture(scope="module")
def texts():
    pick = random.Random(3)
    made = ["".join(pick.choice(POOL) for _ in range(pick.randint(0, 50))) for _ in range(1500)]
    return [None, "", " ", "a" * 30000, "it's I'LL we've", "<|endoftext|>Hi<|startoftext|> <|endoftext|", "same", "same", *made]


def test_matches_the_library(spark, texts):
    library = Tokenizer.from_file(PATH)
    docs = spark.createDataFrame([(i if i != 7 else None, t, "x", "y") for i, t in enumerate(texts)], "doc_id long, text string, ids string, decoded string")
    rows = bpe.digests(bpe.encode(docs, PATH)).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode(texts[7 if row.doc_id is None else row.doc_id] or "", add_special_tokens=False).ids
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.digests(bpe.encode(docs, PATH)).collect() == []


def test_queue_merges_lowest_rank_first_and_skips_stale_entries():
    model = bpe.Bpe(open(PATH, encoding="utf-8").read())
    for word in ("theththethan", "aaaaaaa", "inininin", "thrathran" * 9):
        ids = [model.vocab[c] for c in word[:-1]] + [model.vocab[word[-1] + "</w>"]]
        while len(ids) > 1:
            ranked = [(model.ranks.get(p, 1 << 60), i) for i, p in enumerate(zip(ids, ids[1:]))]
            rank, i = min(ranked)
            if rank == 1 << 60:
                break
            ids[i : i + 2] = [model.made[rank]]
        assert model.merge(word) == ids
