"""Vectorised words and byte hashes over Arrow text columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text handled at once: bounds the numpy arrays of one step.
CHUNK = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POWERS: dict[str, np.ndarray] = {}


def chunks(batch: pa.RecordBatch, column: str = "text", limit: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` bytes of text each; a longer text comes alone."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0).cast(pa.int64()))
    if not len(sizes):
        return
    ends, start = np.cumsum(sizes), 0
    while start < len(sizes):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + limit, "right")))
        yield batch.slice(start, stop - start)
        start = stop
    # workers live on: what the batch needed goes back before the next one comes
    pa.default_memory_pool().release_unused()


def buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins (with the end at last); null is empty."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if texts.null_count:
        texts = pc.fill_null(texts, b"")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over 64 bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


_TABLE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


def lower_ascii() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


LOWER = lower_ascii()
#: Words are runs of bytes other than space and the controls 9 to 13.
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
#: Words are runs of ASCII letters and of bytes beyond ASCII.
NOT_LETTER = np.ones(256, bool)
NOT_LETTER[65:91] = NOT_LETTER[97:123] = NOT_LETTER[128:] = False


def words(raw: np.ndarray, offsets: np.ndarray, gap: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of every text in order, and how many words lie before each text.

    A-Z count as a-z. Words are hashed by differences of one running polynomial sum.
    """
    (hashes,), at = beginnings(raw, offsets, gap)
    return hashes, at


def places(raw: np.ndarray, offsets: np.ndarray, gap: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of all texts begin and end; no word goes on into the next text."""
    n, inside = len(raw), ~gap[raw]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < n)]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def beginnings(raw: np.ndarray, offsets: np.ndarray, gap: np.ndarray = SPACE, cuts: tuple[int, ...] = ()) -> tuple[list[np.ndarray], np.ndarray]:
    """As ``words``, and for each cut the hashes of the words' first bytes, so many at most."""
    n = len(raw)
    if not n:
        return [np.empty(0, np.uint64)] * (1 + len(cuts)), np.zeros(len(offsets), np.int64)
    starts, ends = places(raw, offsets, gap)
    up, down = _powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_TABLE[LOWER[raw]] * up[:n], out=total[1:])
    hashed = lambda stops: mix((total[stops] - total[starts]) * down[starts])
    return [hashed(ends), *[hashed(np.minimum(ends, starts + c)) for c in cuts]], np.searchsorted(starts, offsets)


def row_key(*columns: Column) -> list[Column]:
    """Two longs that stand for a row's content; equal rows have equal keys, null is a value of its own."""
    mark = [F.coalesce(c.cast("string"), F.lit("")) for c in columns] + [c.isNull() for c in columns]
    return [F.xxhash64(F.lit(1), *mark).alias("k1"), F.xxhash64(*reversed(mark), F.lit(2)).alias("k2")]


def flat(df: DataFrame, **columns: str | Column) -> DataFrame:
    """Only the named columns, so that other columns of any name can't clash."""
    return df.select(*[(df[c] if isinstance(c, str) else c).alias(n) for n, c in columns.items()])


def renamed(docs: DataFrame) -> tuple[list[str], list[Column], list[Column]]:
    """Names that clash with none of an operator's own, the caller's columns under them, and back under their own."""
    safe = [f"own{i}" for i in range(len(docs.columns))]
    # a name may hold dots, and two columns may differ in case alone
    return safe, [F.col(f"`{c.replace('`', '``')}`").alias(n) for c, n in zip(docs.columns, safe)], [F.col(n).alias(c) for c, n in zip(docs.columns, safe)]
