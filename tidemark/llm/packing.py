"""Documents packed into sequences of equal length: best fit decreasing over a tree of capacities."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tidemark.llm import text

#: Ids of a sequence, and ids that a task packs together.
LENGTH, POOL = 4096, 4 << 20
#: Byte ids are 0-255; then the end of a document and the filling.
END, FILL = 256, 257


def byte_ids(raw: np.ndarray) -> np.ndarray:
    return raw.astype(np.uint16)


class Capacities:
    """Open bins by free room: finds the one with the least room that suffices, in log(length) steps."""

    def __init__(self, length: int):
        self.size = 1 << length.bit_length()
        self.filled = [0] * (2 * self.size)
        self.bins: list[list[int]] = [[] for _ in range(length + 1)]

    def _count(self, room: int, change: int) -> None:
        at = room + self.size
        while at:
            self.filled[at] += change
            at >>= 1

    def put(self, room: int, bin_: int) -> None:
        self.bins[room].append(bin_)
        self._count(room, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """(room, bin) with the least room of at least ``least``, taken out; None if there is none."""
        at = least + self.size
        if not self.filled[at]:
            while at > 1 and (at & 1 or not self.filled[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.size:
                at = 2 * at if self.filled[2 * at] else 2 * at + 1
        room = at - self.size
        self._count(room, -1)
        return room, self.bins[room].pop()


def best_fit(sizes: list[int], length: int = LENGTH) -> list[list[int]]:
    """Bins of pieces (by number), each piece 1..length long: longest first, into the fullest bin with room."""
    tree, bins = Capacities(length), []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        found = tree.take(sizes[i])
        if found is None:
            bins.append([i])
            room, at = length, len(bins) - 1
        else:
            room, at = found
            bins[at].append(i)
        if room > sizes[i]:
            tree.put(room - sizes[i], at)
    return bins


_PACKED = ("sequence long, ids binary, cu_seqlens array<int>, positions binary, "
           "segments array<struct<id:long,start:long,length:int>>")
_SEGMENT = pa.list_(pa.struct([("id", pa.int64()), ("start", pa.int64()), ("length", pa.int32())]))


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, pool: int = POOL,
         encode: Callable[[np.ndarray], np.ndarray] = byte_ids, end: int = END, fill: int = FILL) -> DataFrame:
    """Sequences of ``length`` ids of all whole texts, each followed by ``end``.

    A text longer than a sequence is split at every ``length`` ids; each piece is a segment.
    Every task packs its rows in pools of about ``pool`` ids, so no text moves between
    machines and memory is bounded by a pool and the longest text. Returns ``sequence`` (unique), ``ids``
    (little-endian unsigned 16-bit, filled up by ``fill``), ``cu_seqlens`` (where segments
    begin and the last ends), ``positions`` (as ids, but of 32 bits if ``length`` is over 65,536; from 0 in every segment, 0 in the filling) and
    ``segments`` (id, start within the text's ids, length). Null and empty texts are one
    ``end``; null ids and repeated rows stay; other columns are not read; an empty table gives
    no rows. ``encode`` maps bytes to ids under 65,536.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 40
        pieces: list[tuple[int | None, int, np.ndarray]] = []
        held = 0

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal number
            bins = best_fit([len(p[2]) for p in pieces], length)
            for at in range(0, len(bins), 512):
                some = bins[at : at + 512]
                matrix = np.full((len(some), length), fill, "<u2")
                places = np.zeros((len(some), length), "<u2" if length <= 1 << 16 else "<u4")
                starts, segments = [], []
                for row, members in enumerate(some):
                    edge = [0]
                    for i in members:
                        ids = pieces[i][2]
                        matrix[row, edge[-1] : edge[-1] + len(ids)] = ids
                        places[row, edge[-1] : edge[-1] + len(ids)] = np.arange(len(ids))
                        edge.append(edge[-1] + len(ids))
                    starts.append(edge)
                    segments.append([{"id": pieces[i][0], "start": pieces[i][1], "length": len(pieces[i][2])} for i in members])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(number, number + len(some))), pa.array([r.tobytes() for r in matrix], pa.binary()), pa.array(starts, pa.list_(pa.int32())),
                     pa.array([r.tobytes() for r in places], pa.binary()), pa.array(segments, _SEGMENT)],
                    ["sequence", "ids", "cu_seqlens", "positions", "segments"])
                number += len(some)

        for batch in batches:
            for part in text.chunks(batch):
                raw, offsets = text.buffer(part.column("text"))
                for id_, a, b in zip(part.column("id").to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist()):
                    ids = np.append(encode(raw[a:b]), np.uint16(end)).astype("<u2")
                    for start in range(0, len(ids), length):
                        pieces.append((id_, start, ids[start : start + length]))
                    held += len(ids)
                    if held >= pool:
                        yield from close()
                        pieces, held = [], 0
        if pieces:
            yield from close()

    narrow = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))
    return narrow.mapInArrow(run, _PACKED)
