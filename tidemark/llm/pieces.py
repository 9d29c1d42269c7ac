"""SentencePiece encoding of merge-type vocabularies by a score-ordered agenda, and decoding.

Every two neighbouring symbols whose joint string is a piece stand on an agenda, the best score first, of
equal scores the leftmost first. Joining two symbols makes at most two new entries; an entry whose
symbols have grown since is stale and is skipped. The ids of each batch can be held against
the library's own.
"""

from __future__ import annotations

import heapq
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from tidemark.llm.text import chunks

#: The sign that stands for a space in pieces.
SPACE = "▁"
#: What an unknown piece decodes to.
UNKNOWN = " ⁇ "
#: Parts of texts remembered by a worker, the longest part remembered, and the longest whose agenda is a plain list.
MEMORY, LONGEST, FEW = 500_000, 64, 32
_NEVER = 1 << 62
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6
_LOADED: dict[str, tuple[Pieces, sentencepiece.SentencePieceProcessor]] = {}


class Pieces:
    """A model file: pieces with scores, merged by the best score; unknown characters fall back to bytes.

    Raises ValueError for what it doesn't do: vocabularies of another type than merges, with
    normalisation rules, with user-defined or unused pieces, or that trim white space.
    """

    def __init__(self, model: bytes):
        spec = sentencepiece_model_pb2.ModelProto.FromString(model)
        rules = spec.normalizer_spec
        kinds = {p.type for p in spec.pieces}
        if spec.trainer_spec.model_type != spec.trainer_spec.BPE or not kinds <= {_NORMAL, _UNKNOWN, _CONTROL, _BYTE}:
            raise ValueError("only merge-type vocabularies of normal, control and byte pieces are supported")
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces or spec.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("normalisation rules are not supported")
        self.start = SPACE if rules.add_dummy_prefix else ""
        self.pieces = [(p.piece, p.score, p.type) for p in spec.pieces]
        self.ids = {s: i for i, (s, _, kind) in enumerate(self.pieces) if kind == _NORMAL}
        self.bytes = {int(s[3:5], 16): i for i, (s, _, kind) in enumerate(self.pieces) if kind == _BYTE}
        # an id that no piece has stands for a character that is none
        self.none, self.unknown = len(self.pieces), next((i for i, p in enumerate(self.pieces) if p[2] == _UNKNOWN), 0)
        self.base = self.none + 1
        scores = sorted({score for _, score, _ in self.pieces}, reverse=True)
        place = {x: i for i, x in enumerate(scores)}
        #: two neighbours that make a piece, as first * base + second: the place of the piece's score, then its id
        self.pairs = {
            self.ids[s[:cut]] * self.base + self.ids[s[cut:]]: place[score] << 20 | i
            for i, (s, score, kind) in enumerate(self.pieces) if kind == _NORMAL
            for cut in range(1, len(s)) if s[:cut] in self.ids and s[cut:] in self.ids}
        # what an id decodes to; a byte that is no character by itself stands as the sign that UTF-8 keeps for it
        shown = {_CONTROL: lambda s: "", _UNKNOWN: lambda s: UNKNOWN, _NORMAL: lambda s: s.replace(SPACE, " "),
                 _BYTE: lambda s: bytes([int(s[3:5], 16)]).decode("utf-8", "surrogateescape")}
        self.shown = [shown[kind](s) for s, _, kind in self.pieces]
        # if no piece holds a space after another sign, nothing is ever merged across the beginning of a run of spaces
        apart = not any(SPACE in s.lstrip(SPACE) for s in self.ids)
        self.parts = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+" if apart else "(?s).+").findall
        self.known: dict[str, bytes] = {}

    def merge(self, part: str) -> list[int]:
        """Ids of a part of a text across whose borders nothing is merged."""
        own, none = self.ids, self.none
        ids = [own.get(c, none) for c in part]
        if len(ids) > 1:
            ids = self._few(ids) if len(ids) <= FEW else self._many(ids)
        if none not in ids:
            return ids
        # characters that are no piece are never merged, so they follow each other as in the part
        strange = iter([c for c in part if c not in own])
        return [x for i in ids for x in (([self.bytes[b] for b in next(strange).encode()] if self.bytes else [self.unknown]) if i == none else [i])]

    def _few(self, ids: list[int]) -> list[int]:
        """The agenda as a list with a place for each pair, of which the least comes first: no entry gets stale."""
        base, get, never = self.base, self.pairs.get, _NEVER
        agenda = [get(a * base + b, never) for a, b in zip(ids, ids[1:])]
        while agenda and (best := min(agenda)) != never:
            i = agenda.index(best)
            ids[i : i + 2] = [new] = [best & 0xFFFFF]
            del agenda[i]
            if i < len(agenda):
                agenda[i] = get(new * base + ids[i + 1], never)
            if i:
                agenda[i - 1] = get(ids[i - 1] * base + new, never)
        return ids

    def _many(self, ids: list[int]) -> list[int]:
        """The agenda as a heap over a doubly linked list of symbols; entries that no longer hold are skipped."""
        n, base, get = len(ids), self.base, self.pairs.get
        entry = lambda pair, i: (pair >> 20) << 60 | i << 20 | pair & 0xFFFFF
        agenda = [entry(p, i) for i, (a, b) in enumerate(zip(ids, ids[1:])) if (p := get(a * base + b)) is not None]
        heapq.heapify(agenda)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        while agenda:
            top = heapq.heappop(agenda)
            i, new = (top >> 20) & 0xFFFFFFFFFF, top & 0xFFFFF
            j = after[i]
            # symbols only grow: another piece from here on means that one of the two has grown or gone
            if ids[i] < 0 or j >= n or (p := get(ids[i] * base + ids[j])) is None or p & 0xFFFFF != new:
                continue
            ids[i], ids[j] = new, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (p := get(new * base + ids[k])) is not None:
                    heapq.heappush(agenda, entry(p, i))
            if (h := before[i]) >= 0 and (p := get(ids[h] * base + new)) is not None:
                heapq.heappush(agenda, entry(p, h))
        return [i for i in ids if i >= 0]

    def decode(self, ids: list[int]) -> str:
        """The text of ids, without the space that encoding put before it; control pieces are no text."""
        shown = self.shown
        text = "".join([shown[i] for i in ids])
        if not text.isascii():
            text = text.encode("utf-8", "surrogateescape").decode("utf-8", "replace")
        if self.start and text[:1] == " ":
            first = next(i for i in ids if self.pieces[i][2] != _CONTROL)
            return text[1:] if self.pieces[first][0].startswith(SPACE) else text
        return text

    def part(self, part: str) -> bytes:
        out = struct.pack(f"<{len(ids)}i", *ids) if (ids := self.merge(part)) else b""
        if len(part) <= LONGEST:
            if len(self.known) >= MEMORY:
                self.known.clear()
            self.known[part] = out
        return out

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit integers."""
        if not text:
            return b""
        get, make = self.known.get, self.part
        return b"".join([get(p) or make(p) for p in self.parts(self.start + text.replace(" ", SPACE))])


def _loaded(key: str, model: bytes) -> tuple[Pieces, sentencepiece.SentencePieceProcessor]:
    if key not in _LOADED:
        _LOADED[key] = Pieces(model), sentencepiece.SentencePieceProcessor(model_proto=model)
    return _LOADED[key]


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", check: bool = False) -> DataFrame:
    """Piece ids of every whole text, and the text they decode to.

    ``model`` is the path of the file on the driver; its content (under a MB, fixed) is broadcast.
    Returns the id column, ``ids`` (array of int), ``decoded`` and, with ``check``, ``agrees``: whether
    the library gives the same ids and the same decoded text (null without it). One row per input row:
    null text counts as empty and has no ids, null ids and repeated rows stay, other columns are
    not read, and an empty table gives no rows.
    """
    with open(model, "rb") as file:
        sent = docs.sparkSession.sparkContext.broadcast(file.read())
    kind = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, library = _loaded(model, sent.value)
        for batch in batches:
            for part in chunks(batch):
                texts = [t or "" for t in part.column("text").to_pylist()]
                rows = [own.encode(t) for t in texts]
                ends = np.cumsum([0, *[len(r) // 4 for r in rows]])
                flat = np.frombuffer(b"".join(rows), "<i4")
                numbers = flat.tolist()
                decoded = [own.decode(numbers[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
                agrees = [None] * len(rows)
                if check:
                    theirs = library.encode(texts, num_threads=1)
                    agrees = [np.array(t, "<i4").tobytes() == r and d == o for t, d, r, o in zip(theirs, library.decode(theirs, num_threads=1), rows, decoded)]
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
                yield pa.RecordBatch.from_arrays([part.column("id"), ids, pa.array(decoded, pa.string()), pa.array(agrees, pa.bool_())], ["id", "ids", "decoded", "agrees"])

    narrow = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    return narrow.mapInArrow(run, f"id {kind.simpleString()}, ids array<int>, decoded string, agrees boolean").withColumnRenamed("id", id_col)


def digests(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and digests of the encoder's rows."""
    return encoded.select(
        encoded[id_col], F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), "agrees")
