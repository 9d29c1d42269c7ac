"""Centroid clustering over subvector dictionaries.

Vectors are written once as blocks of rows. In a block each pair of dimensions is replaced by codes
of a dictionary of the distinct subvectors that stand there, which loses nothing. A round computes
the exact squared distance of every dictionary entry to every centroid once, adds up the entries'
distances by code to get those of the vectors, and sums each cluster by counting codes. Only counts and
sums of each cluster leave a block, so a round moves as little for a third of all vectors being
equal as for none.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from tidemark.llm.work import fresh

DIMENSIONS, SCALE, CLUSTERS, ROUNDS = 64, 64, 16, 3
#: Dimensions of a subvector, and vectors of a block at most.
WIDTH, BLOCK = 2, 32_768
#: Integers below it have distances and sums of a block in 64 bits; larger ones are computed as Python integers.
SAFE = 1 << 23
#: Sums travel as digits of this base, so they add up exactly at any size.
LIMB = 40
_LONG = 1 << 63


def scaled(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of finite doubles as exact integers; an array of objects if some are large."""
    with np.errstate(over="ignore"):
        near = np.floor(values * scale)
    if not len(values) or np.abs(near).max() < SAFE:
        return near.astype(np.int64)
    out = np.empty(values.shape, object)
    out.ravel()[:] = [math.floor(Fraction(x) * scale) for x in values.ravel().tolist()]
    return out


def subvectors(vectors: np.ndarray, width: int = WIDTH) -> tuple[list[np.ndarray], np.ndarray]:
    """For each run of ``width`` dimensions its distinct subvectors in order, and the code of every vector there."""
    tables, codes = [], np.empty((len(vectors), -(-vectors.shape[1] // width)), np.int32)
    for b in range(codes.shape[1]):
        part = vectors[:, b * width : (b + 1) * width]
        order = np.lexsort(part.T[::-1])
        ranked = part[order]
        new = np.ones(len(part), bool)
        new[1:] = (ranked[1:] != ranked[:-1]).any(axis=1)
        codes[order, b] = np.cumsum(new) - 1
        tables.append(ranked[new])
    return tables, codes


def nearest(tables: list[np.ndarray], codes: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each vector, of equally near ones the first, and its squared distance."""
    total, width = np.zeros((len(codes), len(centroids)), centroids.dtype), len(tables[0][0])
    for b, table in enumerate(tables):
        apart = table[:, None, :] - centroids[None, :, b * width : b * width + table.shape[1]]
        total += (apart * apart).sum(axis=2)[codes[:, b]]
    found = total.argmin(axis=1)
    return found, total[np.arange(len(codes)), found]


def sums(tables: list[np.ndarray], codes: np.ndarray, found: np.ndarray, k: int) -> np.ndarray:
    """The sum of each cluster's vectors, from how often each code stands in it."""
    out = []
    for b, table in enumerate(tables):
        often = np.bincount(found * len(table) + codes[:, b], minlength=k * len(table)).reshape(k, len(table))
        out.append(often.astype(table.dtype) @ table)
    return np.concatenate(out, axis=1)


def _whole(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    column = batch.column("vector")
    return np.asarray(column.flatten(), np.float64).reshape(len(column), dims)


def _blocks(dims: int, scale: int, block: int):
    """Blocks of rows, each with its dictionaries; integers travel as text if some are large."""

    def packed(ids: list, values: np.ndarray) -> pa.RecordBatch:
        vectors = scaled(values, scale)
        large = vectors.dtype == object
        tables, codes = subvectors(vectors)
        small = [None if large else t.ravel() for t in tables]
        text = [[str(x) for x in t.ravel()] if large else None for t in tables]
        return pa.RecordBatch.from_arrays(
            [pa.array([pa.concat_arrays(ids).to_pylist()], pa.list_(pa.int64())), pa.array([small], pa.list_(pa.list_(pa.int64()))),
             pa.array([text], pa.list_(pa.list_(pa.string()))), pa.array([codes.astype("<u2").tobytes()], pa.binary())],
            ["ids", "small", "large", "codes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, values, held = [], [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, block):
                part = batch.slice(start, block)
                if held and held + part.num_rows > block:
                    yield packed(ids, np.concatenate(values))
                    ids, values, held = [], [], 0
                ids.append(part.column("id"))
                values.append(_whole(part, dims))
                held += part.num_rows
        if held:
            yield packed(ids, np.concatenate(values))

    return run


def _opened(batch: pa.RecordBatch, dims: int) -> Iterator[tuple[list, list[np.ndarray], np.ndarray]]:
    width = [min(WIDTH, dims - at) for at in range(0, dims, WIDTH)]
    for ids, small, large, codes in zip(*[batch.column(c) for c in ("ids", "small", "large", "codes")]):
        plain = [np.asarray(t.values) for t in small.values] if small.values[0].is_valid else [np.array([int(x) for x in t], object) for t in large.as_py()]
        yield ids.values, [t.reshape(-1, w) for t, w in zip(plain, width)], np.frombuffer(codes.as_buffer(), "<u2").reshape(-1, len(width)).astype(np.int64)


def _matched(tables: list[np.ndarray], centroids: list[list[int]]) -> tuple[list[np.ndarray], np.ndarray]:
    """Dictionaries and centroids as 64-bit integers, or both as Python integers."""
    small = tables[0].dtype != object and max(abs(x) for c in centroids for x in c) < SAFE
    kind = np.int64 if small else object
    return [t.astype(kind) for t in tables], np.array(centroids, kind)


def _moments(centroids: list[list[int]], dims: int):
    """For each cluster and dimension the digits of the sum; dimension -1 counts vectors, -2 sums their distances."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], int] = {}
        for batch in batches:
            for _, tables, codes in _opened(batch, dims):
                tables, centres = _matched(tables, centroids)
                found, far = nearest(tables, codes, centres)
                each = sums(tables, codes, found, len(centres))
                for c in np.unique(found).tolist():
                    here = found == c
                    rows = [(-1, int(here.sum())), (-2, sum(far[here].tolist())), *enumerate(each[c].tolist())]
                    for d, x in rows:
                        total[c, d] = total.get((c, d), 0) + x
        out = []
        for (c, d), x in total.items():
            sign, x, limb = (-1 if x < 0 else 1), abs(x), 0
            while x or not limb:
                out.append((c, d, limb, sign * (x & ((1 << LIMB) - 1))))
                x, limb = x >> LIMB, limb + 1
        yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in out], pa.int64()) for j in range(4)], ["cluster", "dim", "limb", "digit"])

    return run


def moments(blocks: DataFrame, centroids: list[list[int]], dims: int) -> dict[tuple[int, int], int]:
    """The exact sums of ``_moments`` over all blocks: a fixed number of rows for any input."""
    parts = blocks.mapInArrow(_moments(centroids, dims), "cluster long, dim long, limb long, digit long")
    total: dict[tuple[int, int], int] = {}
    for r in parts.groupBy("cluster", "dim", "limb").agg(F.sum("digit").alias("digit")).collect():
        total[r.cluster, r.dim] = total.get((r.cluster, r.dim), 0) + (r.digit << LIMB * r.limb)
    return total


def _assigned(centroids: list[list[int]], dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, tables, codes in _opened(batch, dims):
                tables, centres = _matched(tables, centroids)
                found, far = nearest(tables, codes, centres)
                fits = pa.array([x if x < _LONG else None for x in far.tolist()], pa.int64())
                yield pa.RecordBatch.from_arrays([ids, pa.array(found, pa.int32()), fits], ["id", "cluster", "distance"])

    return run


def start(kept: DataFrame, scale: int, k: int) -> list[list[int]]:
    """The integers of the k vectors that come first by the hash of their id; of one id by components, null ids last."""
    first = kept.orderBy(F.sha2(F.concat(F.lit("1:"), F.col("id").cast("string")), 256).asc_nulls_last(), "vector").limit(k).select("vector")
    return [scaled(np.array(r.vector, np.float64), scale).tolist() for r in first.collect()]


def cluster(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = DIMENSIONS,
            scale: int = SCALE, k: int = CLUSTERS, rounds: int = ROUNDS) -> DataFrame:
    """Every kept vector with its cluster: id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Kept are vectors of exactly ``dims`` components, none null or non-finite, each taken as floor(scale * x).
    The first centroids are ``k`` kept vectors (fewer, if there are no more), see ``start``. Each of
    ``rounds`` rounds assigns every vector to its nearest centroid by exact squared distance, of equally
    near ones to the one with the smaller number, and replaces each centroid that has vectors by their
    floored mean. Then vectors are assigned once more. A distance or inertia beyond 64 bits is null, though
    it is compared exactly. Null and repeated ids stay, a row for each. Other columns are not read; an
    empty table, or one without a kept vector, gives no rows.
    """
    spark = vectors.sparkSession
    double = F.transform(vectors[vector_col], lambda x: x.cast("double"))
    bad = F.exists(double, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = vectors.select(vectors[id_col].cast("long").alias("id"), double.alias("vector")).where((F.size("vector") == dims) & ~bad)
    centroids = start(kept, scale, k)
    path = fresh(spark, "centroids")
    kept.mapInArrow(_blocks(dims, scale, BLOCK), "ids array<long>, small array<array<long>>, large array<array<string>>, codes binary").write.parquet(path)
    blocks = spark.read.parquet(path)
    if not centroids:
        return spark.createDataFrame([], "id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    for _ in range(rounds):
        total = moments(blocks, centroids, dims)
        centroids = [[total[c, d] // total[c, -1] for d in range(dims)] if (c, -1) in total else old for c, old in enumerate(centroids)]
    total = moments(blocks, centroids, dims)
    fits = lambda x: x if x < _LONG else None
    inertia = fits(sum(x for (_, d), x in total.items() if d == -2))
    known = spark.createDataFrame(
        [Row(cluster=c, cluster_inertia=fits(total.get((c, -2), 0)), inertia=inertia, centroid_sha256=hashlib.sha256(",".join(map(str, centre)).encode()).hexdigest())
         for c, centre in enumerate(centroids)], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # one row for each of the k centroids
    rows = blocks.mapInArrow(_assigned(centroids, dims), "id long, cluster int, distance long")
    return rows.join(F.broadcast(known), "cluster").select("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle(table: str = "embeddings", id_col: str = "vec_id", vector_col: str = "embedding", dims: int = DIMENSIONS, scale: int = SCALE, k: int = CLUSTERS, rounds: int = ROUNDS) -> str:
    """The same in SQL: vectors and centroids as rows of one component each."""
    steps = [f"""kept AS (SELECT row_number() OVER (ORDER BY sha256('1:' || {id_col}) NULLS LAST, {vector_col}) - 1 AS r, {id_col} AS id, {vector_col} AS e FROM {table}
      WHERE len({vector_col}) = {dims} AND len(list_filter({vector_col}, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
             f"v AS (SELECT r, id, unnest(range({dims})) AS d, CAST(floor({scale} * CAST(unnest(e) AS DOUBLE)) AS BIGINT) AS x FROM kept)",
             f"c0 AS (SELECT CAST(r AS INTEGER) AS c, d, x FROM v WHERE r < {k})"]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS (SELECT r, id, c, far FROM (SELECT r, id, c, CAST(sum((v.x - c{i}.x) * (v.x - c{i}.x)) AS BIGINT) AS far FROM v JOIN c{i} USING (d) GROUP BY r, id, c)
      QUALIFY row_number() OVER (PARTITION BY r ORDER BY far, c) = 1)""")
        if i < rounds:
            steps.append(f"m{i} AS (SELECT c, d, sum(x) AS s, count(*) AS n FROM a{i} JOIN v USING (r) GROUP BY c, d)")
            steps.append(f"c{i + 1} AS (SELECT c, d, coalesce(CAST((s - ((s % n) + n) % n) / n AS BIGINT), x) AS x FROM c{i} LEFT JOIN m{i} USING (c, d))")
    return f"""WITH {', '.join(steps)},
named AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256 FROM c{rounds} GROUP BY c)
SELECT id AS {id_col}, c AS cluster, far AS distance, CAST(sum(far) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(far) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{rounds} JOIN named USING (c)"""
