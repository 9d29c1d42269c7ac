"""I-Match fingerprints: terms of an idf band, sorted and hashed under several randomised lexicons."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import text

#: Terms, each once a text, that a task counts at a time.
PENDING = 1 << 21
#: A term is kept if it is in at least two texts and at most this share of all.
RARE, COMMON = 2, 0.02
#: Lexicons of a scale, and the terms that a lexicon keeps of a text at its own scale.
LEXICONS, TERMS = 24, 1.0
_SEEDS = text.mix(np.arange(1, LEXICONS + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
_STEP = np.uint64(0xE7037ED1A0B428DB)


def terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit hashes of each text's distinct terms in ascending order, and the number of the text they are in."""
    term, at = text.words(*text.buffer(texts), text.NOT_LETTER)
    owner = np.repeat(np.arange(len(texts)), np.diff(at))
    order = np.lexsort((term, owner))
    term, owner = term[order], owner[order]
    new = np.ones(len(term), bool)
    new[1:] = (term[1:] != term[:-1]) | (owner[1:] != owner[:-1])
    return term[new], owner[new]


class Lexicon:
    """The terms inside the band, as sorted 64-bit hashes: ``kept[terms]`` tells which are among them."""

    def __init__(self, kept: np.ndarray):
        self.kept = np.sort(kept)

    def __getitem__(self, term: np.ndarray) -> np.ndarray:
        if not len(self.kept):
            return np.zeros(np.shape(term), bool)
        at = np.searchsorted(self.kept, term)
        return self.kept[np.minimum(at, len(self.kept) - 1)] == term


def lexicon(docs: DataFrame, text_col: str = "text", rare: int = RARE, common: float = COMMON) -> Lexicon:
    """The terms inside the band, from the counts of every term over all documents.

    Terms are counted by their full 64-bit hashes, so the band doesn't change with the size of
    the vocabulary. A task sums its own texts first, at most ``PENDING`` terms at a time; the
    sums are added by Spark. The driver and each worker hold 8 bytes for a term of the band.
    """
    total = docs.where(docs[text_col].isNotNull()).count()
    most = max(rare, math.floor(common * total))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def sums() -> Iterator[pa.RecordBatch]:
            term, n = np.unique(np.concatenate(held), return_counts=True)
            for i in range(0, len(term), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(term[i : i + 100_000].view(np.int64)), pa.array(n[i : i + 100_000])], ["term", "n"])

        for batch in batches:
            for part in text.chunks(batch):
                held.append(terms(part.column("text"))[0])
                if sum(map(len, held)) >= PENDING:
                    yield from sums()
                    held.clear()
        if held:
            yield from sums()

    counts = docs.select(docs[text_col].cast("string").alias("text")).mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    inside = counts.where(F.col("n").between(rare, most)).select("term").toArrow()
    return Lexicon(np.asarray(inside.column("term"), np.int64).view(np.uint64))


def fingerprints(texts: pa.Array, kept: Lexicon) -> list[str]:
    """One fingerprint a text: scale, and the hash of what each lexicon keeps, at two scales.

    Lexicon k at scale e keeps a term with probability 2^-e, by a hash of its own. A text
    with m terms in the band takes the scale at which a lexicon keeps about one of them, and the next.
    ``-`` stands for no term kept. Texts without terms in the band are hashed whole.
    """
    term, owner = terms(texts)
    inside = kept[term]
    term, owner = term[inside], owner[inside]
    m = np.bincount(owner, minlength=len(texts))
    scale = np.maximum(0, np.floor(np.log2(np.maximum(m, 1) / TERMS))).astype(np.int64)
    table: dict[int, np.ndarray] = {}
    for shift in (0, 1):
        bound = (np.iinfo(np.uint64).max >> (scale + shift).astype(np.uint64))[owner]
        out = np.zeros((len(texts), LEXICONS), np.uint64)
        for k, seed in enumerate(_SEEDS):
            chosen = text.mix(term * _STEP ^ seed) <= bound
            own, t = owner[chosen], term[chosen]
            if not len(own):
                continue
            first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            place = np.arange(len(own)) - np.repeat(first, np.diff(np.append(first, len(own))))
            mixed = text.mix((t + np.uint64(1)) * _STEP + place.astype(np.uint64) * seed)
            out[own[first], k] = text.mix(np.add.reduceat(mixed, first)) | np.uint64(1)
        table[shift] = (out >> np.uint64(32)).astype(np.uint32) | (out != 0).astype(np.uint32)
    done = []
    for i, t in enumerate(texts):
        if m[i]:
            done.append("|".join(f"{scale[i] + s}:" + ",".join(f"{h:08x}" if h else "-" for h in table[s][i].tolist()) for s in (0, 1)))
        else:
            done.append("text:" + hashlib.sha256(t.as_buffer() if t.is_valid else b"").hexdigest())
    return done


def likeness(one: str, other: str) -> float:
    """Share of equal hashes among the lexicons that keep a term of either text, at the scales both have."""
    if one == other:
        return 1.0
    a, b = (dict(part.split(":") for part in f.split("|")) for f in (one, other))
    same = of = 0
    for s in a.keys() & b.keys() - {"text"}:
        for x, y in zip(a[s].split(","), b[s].split(",")):
            if x != "-" or y != "-":
                of += 1
                same += x == y
    return same / of if of else 0.0


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(bucket, guard, id, text): rows in ascending order of id within buckets of an id range.

    A row with ``guard`` 1 ends each bucket: a copy of the next bucket's first row (after the
    last bucket: of the first's). So every row's successor is in its own bucket, after one
    shuffle. Ties of id follow the text; null ids come first.
    """
    spark = docs.sparkSession
    narrow = docs.select(docs[id_col].cast("long").alias("id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    size = narrow.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("b")).first()
    buckets = max(1, min(size.n, max(2 * spark.sparkContext.defaultParallelism, (size.b or 0) >> 24)))
    cuts = narrow.agg(F.percentile_approx("id", [i / buckets for i in range(1, buckets)] or [0.5], 100 * buckets).alias("c")).first().c or []
    cuts = np.unique(np.array(cuts, np.int64))

    @F.pandas_udf("long")
    def bucket(ids: pd.Series) -> pd.Series:
        return pd.Series(np.where(ids.isna(), 0, np.searchsorted(cuts, ids.fillna(0).to_numpy(np.int64), "left")), dtype="int64")

    ranged = narrow.withColumn("bucket", bucket("id"))
    # struct order: null ids first
    firsts = sorted((r.bucket, r.f.id) for r in narrow.select("id").withColumn("bucket", bucket("id")).groupBy("bucket").agg(F.min(F.struct("id")).alias("f")).collect())
    before = {b: firsts[i - 1][0] for i, (b, _) in enumerate(firsts)}
    last = max(before, default=0)
    starts = spark.createDataFrame([(b, i, before[b], last) for b, i in firsts], "b long, first long, before long, last long")
    ranged = ranged.join(F.broadcast(starts), F.col("bucket") == F.col("b")).withColumn("copies", F.when(
        F.col("id").eqNullSafe(F.col("first")), F.array(F.struct(F.col("bucket"), F.lit(0).alias("guard")), F.struct(F.col("before").alias("bucket"), F.lit(1).alias("guard"))))
        .otherwise(F.array(F.struct(F.col("bucket"), F.lit(0).alias("guard")))))
    copied = ranged.select(F.explode("copies").alias("c"), "id", "text").select("c.bucket", "c.guard", "id", "text")
    return copied.repartition(buckets, "bucket").sortWithinPartitions("bucket", "guard", F.asc_nulls_first("id"), "text")


def compare(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rare: int = RARE, common: float = COMMON) -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likeness.

    Returns id, n_chars, edited (the text whose last quarter is replaced by the next one's
    beginning), fingerprint, edited_fingerprint, near_edited, near_next. Null texts are
    empty; null ids are the lowest; ties follow the text; repeated rows are each other's next.
    A single row is its own next. Other columns are not read; an empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(lexicon(docs, text_col, rare, common))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = sent.value
        held: list[tuple] = []  # rows of one bucket in order; the last waits for its successor

        def done(rows: list[tuple]) -> pa.RecordBatch:
            """All but the last row, with the next of each."""
            texts = [r[3] for r in rows]
            edited = []
            for a, b in zip(texts, texts[1:]):
                q = len(a) // 4
                edited.append(a[: len(a) - q] + b[:q])
            own = fingerprints(pa.array(texts, pa.large_string()), kept)
            other = fingerprints(pa.array(edited, pa.large_string()), kept)
            return pa.RecordBatch.from_arrays(
                [pa.array([r[2] for r in rows[:-1]], pa.int64()), pa.array([len(t) for t in texts[:-1]], pa.int64()), pa.array(edited, pa.string()),
                 pa.array(own[:-1], pa.string()), pa.array(other, pa.string()), pa.array([likeness(x, y) for x, y in zip(own, other)], pa.float64()),
                 pa.array([likeness(x, y) for x, y in zip(own, own[1:])], pa.float64())],
                ["id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

        size, over = 0, None
        for part in (p for batch in batches for p in text.chunks(batch)):
            for row in zip(*[part.column(c).to_pylist() for c in ("bucket", "guard", "id", "text")]):
                if row[0] == over:  # further copies of the next bucket's first row
                    continue
                held.append(row)
                size += len(row[3])
                if row[1]:
                    yield done(held)
                    held, size, over = [], 0, row[0]
                elif size >= text.CHUNK and len(held) > 1:
                    yield done(held)
                    held, size = held[-1:], len(row[3])

    return with_next(docs, id_col, text_col).mapInArrow(
        run, "id long, n_chars long, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
