"""Exact top-k by inner product on a bit-sliced index."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Vectors of an index block and queries of a group; a task holds one of each.
BLOCK, GROUP = 16_384, 512
#: Bound of the integers: slices of differences have 62 bits at most. A score beyond ``LONG`` is no long.
LARGEST, LONG = 1 << 61, 1 << 63


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: float = 256.0) -> DataFrame:
    """(id, codes): floor(scale * x) of every component as double; rows that can take part only.

    Rows without id or vector, or with a null, NaN or infinite component, take no part; nor do those
    with a component of which the integer is beyond ``LARGEST``. Rows with the same id all take part.
    """
    codes = F.transform(vectors[vector_col], lambda x: F.floor(x.cast("double") * F.lit(scale)))
    sound = F.forall(vectors[vector_col], lambda x: x.isNotNull() & (F.abs(x.cast("double") * F.lit(scale)) < float(LARGEST)))
    return vectors.where(vectors[id_col].isNotNull() & vectors[vector_col].isNotNull() & sound) \
        .select(vectors[id_col].cast("long").alias("id"), codes.alias("codes"))


def _codes(column: pa.ChunkedArray, width: int | None = None) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(np.asarray(lists.offsets))
    out = np.zeros((len(lists), max([width or 0, *sizes.tolist()])), np.int64)
    out[np.arange(out.shape[1])[None, :] < sizes[:, None]] = np.asarray(lists.flatten())
    return out


class Index:
    """Slices of one block: bit b of component d of all rows is one bitmap."""

    def __init__(self, ids: np.ndarray, codes: np.ndarray):
        order = np.argsort(ids)
        self.ids, codes = ids[order], codes[order]
        self.words = -(-len(ids) // 64)
        self.low = codes.min(axis=0)
        above = (codes - self.low).astype(np.uint64)
        self.bits = np.array([int(x).bit_length() for x in above.max(axis=0)], np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.bits)])
        self.slices = np.zeros((int(self.first[-1]), self.words), np.uint64)
        for d, n in enumerate(self.bits):
            for b in range(n):
                self.slices[self.first[d] + b] = self._bitmap(above[:, d] >> np.uint64(b) & np.uint64(1))
        self.present = self._bitmap(np.ones(len(ids), bool))

    def _bitmap(self, flags: np.ndarray) -> np.ndarray:
        packed = np.zeros(self.words * 8, np.uint8)
        got = np.packbits(flags.astype(bool), bitorder="little")
        packed[: len(got)] = got
        return packed.view("<u8")

    def sums(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Slices of the inner product less a constant, lowest first, and the constant.

        Negative factors take the complements of slices. Slices of one weight are added three
        by three into a sum and a carry of the next weight.
        """
        size, negative = np.abs(query), query < 0
        full = (np.uint64(1) << self.bits.astype(np.uint64)) - np.uint64(1)
        exact = lambda a, b: sum(x * y for x, y in zip(a.tolist(), b.tolist()))
        constant = exact(query, self.low) - exact(size, full * negative)
        terms: dict[int, list[np.ndarray]] = {}
        for j in range(int(size.max(initial=0)).bit_length()):
            dims = np.flatnonzero((size >> j & 1).astype(bool) & (self.bits > 0))
            for b in range(int(self.bits[dims].max(initial=0))):
                with_b = dims[self.bits[dims] > b]
                flip = np.where(negative[with_b], ~np.uint64(0), np.uint64(0))
                terms.setdefault(b + j, []).append(self.slices[self.first[with_b] + b] ^ flip[:, None])
        out, w = [], 0
        while terms:
            rows = np.concatenate(terms.pop(w)) if w in terms else np.zeros((1, self.words), np.uint64)
            while len(rows) > 1:
                if len(rows) == 2:
                    carry, rows = rows[:1] & rows[1:], rows[:1] ^ rows[1:]
                else:
                    k = len(rows) // 3
                    a, b, c = rows[:k], rows[k : 2 * k], rows[2 * k : 3 * k]
                    half = a ^ b
                    carry = (a & b) | (half & c)
                    rows = np.concatenate([half ^ c, rows[3 * k :]])
                terms.setdefault(w + 1, []).append(carry)
            out.append(rows[0])
            w += 1
        return out, constant

    def _at_least(self, slices: list[np.ndarray], least: int) -> np.ndarray:
        """Bitmap of the rows of which the sum of slices is at least ``least``."""
        if least <= 0:
            return self.present
        if least >> len(slices):
            return np.zeros(self.words, np.uint64)
        above, equal = np.zeros(self.words, np.uint64), self.present.copy()
        for w in reversed(range(len(slices))):
            if least >> w & 1:
                equal &= slices[w]
            else:
                above |= equal & slices[w]
                equal &= ~slices[w]
        return above | equal

    def top(self, query: np.ndarray, k: int, own: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the block's best ``k`` rows without those of id ``own``; ties to smaller ids.

        Rows whose score doesn't fit a long are left out.
        """
        slices, constant = self.sums(query)
        open_, sure = self.present.copy(), np.zeros(self.words, np.uint64)
        if own is not None:
            first, last = np.searchsorted(self.ids, [own, own + 1])
            if first < last:
                mine = np.zeros(len(self.ids), bool)
                mine[first:last] = True
                open_ &= ~self._bitmap(mine)
        if constant + (1 << len(slices)) > LONG or constant < -LONG:
            open_ &= self._at_least(slices, -LONG - constant) & ~self._at_least(slices, LONG - constant)
        wanted = k
        for s in reversed(slices):
            ones = open_ & s
            n = int(np.bitwise_count(ones).sum())
            if n <= wanted:  # all of them are in; the rest is sought among the zeros
                sure |= ones
                wanted -= n
                open_ &= ~s
                if not wanted:
                    break
            else:
                open_ = ones
        places = np.unpackbits(sure.view(np.uint8), bitorder="little").nonzero()[0]
        if wanted:  # rows still open have equal scores, and stand in order of ids
            places = np.concatenate([places, np.unpackbits(open_.view(np.uint8), bitorder="little").nonzero()[0][:wanted]])
        bits = np.zeros((len(places), len(slices)), np.uint64)
        for w, s in enumerate(slices):
            bits[:, w] = (s[places >> 6] >> (places & 63).astype(np.uint64)) & np.uint64(1)
        if len(slices) < 62 and abs(constant) < LONG >> 1:
            scores = constant + (bits.astype(np.int64) << np.arange(len(slices))).sum(axis=1)
        else:
            scores = np.array([constant + sum(1 << w for w in np.flatnonzero(row).tolist()) for row in bits], np.int64)
        return self.ids[places], scores


def _pack(table: pa.Table) -> pa.Table:
    """A block or group as one row of plain buffers."""
    codes = _codes(table.column("codes"))
    return pa.table({
        "part": table.column("part")[:1], "ids": pa.array([np.asarray(table.column("id")).tobytes()], pa.binary()),
        "codes": pa.array([codes.tobytes()], pa.binary()), "width": pa.array([codes.shape[1]], pa.int32())})


_PACKED = "part long, ids binary, codes binary, width int"


def _unpack(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(table.column("ids")[0].as_buffer(), np.int64)
    return ids, np.frombuffer(table.column("codes")[0].as_buffer(), np.int64).reshape(len(ids), table.column("width")[0].as_py())


def _numbers(n: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


def search(vectors: DataFrame, queries: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 256.0) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` highest inner products of each query with all other rows.

    ``queries`` is a condition on ``id``. Every block of vectors meets every group of queries in one task, so
    memory is bounded by both; a block gives at most ``k`` rows for each query, and those of
    all blocks are ranked by score and then smaller id. Rows are compared as ``quantised``
    says; a shorter vector counts as padded by zeros, and a pair whose score doesn't fit a long is no candidate. Rows
    with a query's id are none of its candidates; query rows with one id are one query, of which each pair counts. An empty table gives no rows, and a
    query without other rows none either. Other columns are not read.
    """
    rows = quantised(vectors, id_col, vector_col, scale)
    total = rows.count()
    asked = rows.where(queries)
    groups = max(1, -(-asked.count() // GROUP))
    blocks = max(1, -(-total // BLOCK))
    # repeated ids and vectors spread as others do: the row's place in the scan tells them apart
    spread = lambda df, n: df.withColumn("part", F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(n))).groupBy("part").applyInArrow(_pack, _PACKED)
    # each block is copied to every group, each group to every block
    left = spread(rows, blocks).withColumn("other", F.explode(_numbers(groups))).withColumnRenamed("part", "block").withColumnRenamed("other", "group")
    right = spread(asked, groups).withColumn("other", F.explode(_numbers(blocks))).withColumnRenamed("part", "group").withColumnRenamed("other", "block")

    def meet(block: pa.Table, group: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        if len(block) and len(group):
            (ids, codes), (query_ids, query_codes) = _unpack(block), _unpack(group)
            width = max(codes.shape[1], query_codes.shape[1])
            wide = lambda m: np.pad(m, ((0, 0), (0, width - m.shape[1])))
            index = Index(ids, wide(codes))
            for query, code in zip(query_ids.tolist(), wide(query_codes)):
                found, scores = index.top(code, k, query)
                out.append((np.full(len(found), query), found, scores))
        return pa.table({n: np.concatenate([o[j] for o in out]) if out else np.empty(0, np.int64) for j, n in enumerate(("query_id", "vec_id", "score"))})

    best = left.groupBy("block", "group").cogroup(right.groupBy("block", "group")).applyInArrow(meet, "query_id long, vec_id long, score long")
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
