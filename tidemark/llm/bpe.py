"""BPE encoding by a queue of merge ranks over a doubly linked symbol list, and decoding by concatenation."""

from __future__ import annotations

import heapq
import json
import struct
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import chunks

#: Words remembered by a worker, and the longest word remembered.
MEMORY, LONGEST = 400_000, 64
#: Signs at which str.split cuts though they are no white space to Unicode.
SEPARATORS = "\x1c\x1d\x1e\x1f"
_LOADED: dict[str, "Bpe"] = {}


def _byte_signs() -> list[str]:
    """The printable sign that byte-level vocabularies use for each byte."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class Bpe:
    """A vocabulary file of the tokenizers library: BPE with word ends over byte signs."""

    def __init__(self, definition: str):
        spec = json.loads(definition)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        pairs = [p if isinstance(p, list) else p.split(" ") for p in model["merges"]]
        self.ranks = {(self.vocab[a], self.vocab[b]): rank for rank, (a, b) in enumerate(pairs)}
        self.made = [self.vocab[a + b] for a, b in pairs]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: s for s, i in self.vocab.items()} | {i: s for s, i in self.special.items()}
        self.steps = spec["normalizer"]["normalizers"] if spec["normalizer"] else []
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        # \s of these files is Unicode white space; the information separators 1C-1F are none
        white = r"\p{White_Space}"
        self.pieces = regex.compile(split["pattern"]["Regex"].replace(r"[^\s", rf"[^{white}")).findall
        self.white = regex.compile(rf"{white}+").split
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")").split if self.special else None
        self.signs = _byte_signs()
        self.ascii = dict(enumerate(self.signs[:128]))
        self.known: dict[str, tuple[bytes, str]] = {}

    def normal(self, text: str) -> str:
        for step in self.steps:
            if step["type"] == "NFC":
                text = unicodedata.normalize("NFC", text)
            elif step["type"] == "Replace":
                if step["content"] != " " or step["pattern"].get("Regex") != r"\s+":
                    raise ValueError(f"normalizer {step} is not supported")
                # runs of white space turn into one space: no piece holds any, so nothing to do
            elif step["type"] == "Lowercase":  # letter by letter, so without a final sigma
                text = text.replace("Σ", "σ").lower()
            else:
                raise ValueError(f"normalizer {step['type']} is not supported")
        return text

    def merge(self, piece: str) -> list[int]:
        """Ids of one piece.

        The queue holds rank and place in one integer. An entry is stale if the pair that now
        stands at its place has another rank.
        """
        signs = piece.translate(self.ascii) if piece.isascii() else "".join([self.signs[b] for b in piece.encode()])
        ids = [self.vocab[s] for s in signs[:-1]]
        ids.append(self.vocab[signs[-1] + self.suffix])
        n = len(ids)
        if n == 1:
            return ids
        ranks, made, push, pop = self.ranks, self.made, heapq.heappush, heapq.heappop
        rank_of = ranks.get
        queue = [r << 40 | i for i, pair in enumerate(zip(ids, ids[1:])) if (r := rank_of(pair)) is not None]
        heapq.heapify(queue)
        before, after = list(range(-1, n - 1)), [*range(1, n), n]
        ids.append(-1)  # stands beyond the last symbol
        while queue:
            entry = pop(queue)
            i, rank = entry & 0xFFFFFFFFFF, entry >> 40
            j = after[i]
            if rank_of((ids[i], ids[j])) != rank:
                continue
            ids[i] = new = made[rank]
            ids[j] = -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := rank_of((new, ids[k]))) is not None:
                    push(queue, r << 40 | i)
            if (h := before[i]) >= 0 and (r := rank_of((ids[h], new))) is not None:
                push(queue, r << 40 | h)
        return [i for i in ids if i >= 0]

    def word(self, word: str) -> tuple[bytes, str]:
        """Ids and decoded text of what stands between white space."""
        pieces = self.pieces(word)
        if len(pieces) > 1:
            found = [self.known.get(p) or self.word(p) for p in pieces]
            out = b"".join([x[0] for x in found]), " ".join([x[1] for x in found])
        else:
            ids = self.merge(word) if pieces else []
            out = struct.pack(f"<{len(ids)}I", *ids), self.decode(ids)
        if len(word) <= LONGEST:
            if len(self.known) >= MEMORY:
                self.known.clear()
            self.known[word] = out
        return out

    def decode(self, ids: list[int]) -> str:
        """Vocabulary strings put together; these files name no decoder, so a space stands between them."""
        return " ".join(self.strings[i] for i in ids)

    def encode(self, text: str) -> tuple[bytes, str]:
        """Ids as little-endian unsigned 32-bit integers, and the text they decode to."""
        parts = self.cut(text) if self.cut else [text]
        found: list[tuple[bytes, str]] = []
        get, make = self.known.get, self.word
        for part in parts:
            if part in self.special:
                found.append((self.special[part].to_bytes(4, "little"), part))
            elif part:
                part = self.normal(part)
                odd = any(s in part for s in SEPARATORS)
                found += [get(w) or make(w) for w in (self.white(part) if odd else part.split()) if w]
        return b"".join([x[0] for x in found]), " ".join([x[1] for x in found if x[1]])


def _loaded(key: str, definition: str) -> Bpe:
    if key not in _LOADED:
        _LOADED[key] = Bpe(definition)
    return _LOADED[key]


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token ids of every whole text, and the text they decode to.

    ``vocabulary`` is the path of the file on the driver; its content (a few MB, fixed) is
    broadcast. Returns the id column, ``ids`` (binary, little-endian unsigned 32-bit) and
    ``decoded``, one row per input row: null text counts as empty, null ids and repeated rows
    stay, other columns are not read, and an empty table gives no rows.
    """
    with open(vocabulary, encoding="utf-8") as file:
        sent = docs.sparkSession.sparkContext.broadcast(file.read())
    kind = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(vocabulary, sent.value)
        for batch in batches:
            for part in chunks(batch):
                rows = [bpe.encode(t or "") for t in part.column("text").to_pylist()]
                ids = pa.array([r[0] for r in rows], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("id"), ids, pa.array([r[1] for r in rows], pa.string())], ["id", "ids", "decoded"])

    narrow = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    return narrow.mapInArrow(run, f"id {kind.simpleString()}, ids binary, decoded string").withColumnRenamed("id", id_col)


def digests(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and digests of the encoder's rows."""
    return encoded.select(
        encoded[id_col], (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
