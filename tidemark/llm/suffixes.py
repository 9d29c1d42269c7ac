"""Repeated passages by a sparse suffix array: sampled splitters, multikey sorting, common prefixes.

Texts are rows of tokens: bytes, or words as 64-bit hashes. A suffix is kept where it begins with an anchor: the place of the least hash among all grams
of some window. Equal windows hold equal anchors at equal offsets, so two equal strings of
``window`` tokens always have a pair of anchors in the same place of the order. Suffixes whose
leading gram occurs once are dropped, those with equal surroundings counted and kept once.
The rest is dealt by ranges of leading tokens (splitters from Spark's sample); a range ends
between two grams, so no run of equal leading tokens lies across two buckets. Each bucket
sorts its suffixes, and the reversed texts left of them, by multikey quicksort on words of
eight bytes. Windows ``s`` tokens left of two anchors are equal just if no common prefix
between them in the one order is under window - s and none in the other order under s.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import text
from tidemark.llm.work import discard, fresh
from tidemark.session import cut_lineage

WINDOW, GRAM = 400, 64
#: Suffixes sorted together at least, and those that a bucket has on average.
BLOCK, BUCKET = 4096, 20_000
#: A leading gram of more suffixes than a bucket has its windows cut to so many finer ranges.
HOT, PARTS = BUCKET, 8
_NEVER = np.iinfo(np.uint64).max
#: Bytes of text handled at once, and those whose anchors are sought at once (the arrays stay in a core's cache).
STEP, SCAN = 1 << 18, 1 << 16


@dataclass(frozen=True)
class Unit:
    """What texts are made of: ``bytes`` of a token in a body, a token's value to hash, and its bytes."""

    bytes: int
    #: of the bytes of texts and where each begins: values of all tokens, where each text's tokens begin, where tokens start and end
    tokens: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray | None, np.ndarray | None]]
    #: tokens of one window, and of the gram that an anchor stands for
    window: int
    gram: int


def _byte_tokens(raw: np.ndarray, offsets: np.ndarray):
    return text._TABLE[raw], offsets, None, None


def _word_tokens(raw: np.ndarray, offsets: np.ndarray):
    values, at = text.words(raw, offsets)
    return values, at, *text.places(raw, offsets)


BYTES = Unit(1, _byte_tokens, WINDOW, GRAM)
#: Words as runs of bytes other than white space, A-Z as a-z.
WORDS = Unit(8, _word_tokens, 50, 8)


def _sliding(values: np.ndarray, width: int, pick: np.ufunc, fill: int) -> np.ndarray:
    """``pick`` over values[i : i + width] for every i; ``fill`` stands beyond the end."""
    out = np.concatenate([values, np.full(width - 1, fill, np.uint64)])
    span = 1
    while 2 * span <= width:
        out = pick(out[:-span], out[span:])
        span *= 2
    if width > span:
        out = pick(out[: len(out) - (width - span)], out[width - span :])
    return out[: len(values)]


def anchors(values: np.ndarray, offsets: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Places of all grams of tokens that are the least of some window within a text, and the grams' hashes."""
    n = len(values)
    if n < window:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    up, down = text._powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(values * up[:n], out=total[1:])
    grams = np.full(n, _NEVER, np.uint64)
    grams[: n - gram + 1] = text.mix((total[gram:] - total[:-gram]) * down[: n - gram + 1])
    span = window - gram + 1
    least = _sliding(grams, span, np.minimum, _NEVER)
    for first, end in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        least[max(first, end - window + 1) : end] = 0  # no window begins here
    # of the windows over a place, the largest least is its own hash just if it is the least of one
    most = _sliding(np.concatenate([np.zeros(span - 1, np.uint64), least]), span, np.maximum, 0)[:n]
    at = np.flatnonzero(most == grams)
    at = at[at + gram <= offsets[np.searchsorted(offsets, at, "right")]]
    return at, grams[at]


def _long(values: np.ndarray, window: int, gram: int, step: int = 4 * STEP) -> tuple[np.ndarray, np.ndarray]:
    """Anchors of one text of any length, piece by piece."""
    found = []
    for s in range(0, max(1, len(values)), step):
        part = values[s : s + step + window]
        at, grams = anchors(part, np.array([0, len(part)]), window, gram)
        found.append((s + at, grams))
    at, first = np.unique(np.concatenate([f[0] for f in found]), return_index=True)
    return at, np.concatenate([f[1] for f in found])[first]


def _hash(data: bytes, seed: int = 0) -> int:
    return xxhash.xxh3_64_intdigest(data, seed)


def _longs(values) -> pa.Array:
    return pa.array(values, pa.int64())


def _hashes(values: list[int] | np.ndarray) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def _bodies(unit: Unit, raw: np.ndarray, values: np.ndarray) -> bytes:
    """The tokens as bytes that sort and compare as tokens do."""
    return raw.tobytes() if unit.bytes == 1 else values.astype(">u8").tobytes()


def _scan(unit: Unit):
    window, gram, w = unit.window, unit.gram, unit.bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for part in text.chunks(batch, limit=SCAN):
                raw, ends = text.buffer(part.column("text"))
                values, offsets, _, _ = unit.tokens(raw, ends)
                at, lead = anchors(values, offsets, window, gram) if len(values) <= 4 * STEP else _long(values, window, gram)
                row = np.searchsorted(offsets, at, "right") - 1
                first, last = offsets[row], offsets[row + 1]
                left = np.minimum(at - first, window - gram)
                stop = np.minimum(at + window, last)
                data = _bodies(unit, raw, values)
                whole = [_hash(data[w * (a - b) : w * c], b) for a, b, c in zip(at.tolist(), left.tolist(), stop.tolist())]
                found.append(pa.RecordBatch.from_arrays(
                    [part.column("k1").take(pa.array(row)), part.column("k2").take(pa.array(row)), _longs(at - first),
                     _longs(left), _longs(stop - at + left), _hashes(lead), _hashes(whole)],
                    ["k1", "k2", "at", "left", "size", "lead", "whole"]))
            if found:
                yield pa.concat_batches(found)

    return run


def multikey(strings: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of rows of bytes (zero-padded to whole words), and the common prefix of each with the one before.

    Sorts by one word of eight bytes, then each run of equals by the next, as long as runs remain.
    """
    n = len(strings)
    words = strings.view(">u8").astype(np.uint64).reshape(n, -1)
    order, run = np.arange(n), np.zeros(n, np.int64)  # run: number of the run of equals at each place
    active = np.arange(n)
    for d in range(words.shape[1] + 1):
        if len(active) < 2:
            break
        key = words[order[active], d] if d < words.shape[1] else sizes[order[active]].astype(np.uint64)
        sorted_ = np.lexsort((key, run[active]))
        order[active] = order[active[sorted_]]
        key, runs = key[sorted_], run[active]
        cut = np.ones(len(active), bool)
        cut[1:] = (key[1:] != key[:-1]) | (runs[1:] != runs[:-1])
        run[active] = active[np.flatnonzero(cut)][np.cumsum(cut) - 1]
        same = np.zeros(len(active), bool)
        same[1:] |= ~cut[1:]
        same[:-1] |= ~cut[1:]
        active = active[same]
    common = np.zeros(n, np.int64)
    if n > 1:
        differ = strings[order[1:]] != strings[order[:-1]]
        found = np.where(differ.any(axis=1), differ.argmax(axis=1), strings.shape[1])
        common[1:] = np.minimum(found, np.minimum(sizes[order[1:]], sizes[order[:-1]]))
    return order, common


def _matrix(parts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    width = -(-max(width, 1) // 8) * 8
    sizes = np.array([len(p) for p in parts], np.int64)
    return np.frombuffer(b"".join(p.ljust(width, b"\0") for p in parts), np.uint8).reshape(len(parts), width), sizes


def _backwards(part: bytes, width: int) -> bytes:
    return part[::-1] if width == 1 else np.frombuffer(part, f"V{width}")[::-1].tobytes()


def repeats(bodies: list[bytes], lefts: list[int], moved: list[int], window: int, span: int, width: int = 1) -> np.ndarray:
    """For each body (its place ``left`` tokens in) and s of 0..span: does the window s tokens before that place equal another's?

    Tokens have ``width`` bytes. Only bodies whose places were moved equally far from their anchors are
    compared: one window of one text may be reached from two anchors, and is not its own repeat.
    """
    n = len(bodies)
    right, right_size = _matrix([m.to_bytes(8, "big") + b[width * x :] for b, x, m in zip(bodies, lefts, moved)], width * window + 8)
    left, left_size = _matrix([_backwards(b[: width * x], width) for b, x in zip(bodies, lefts)], width * span)
    order_r, common_r = multikey(right, right_size)
    order_l, common_l = multikey(left, left_size)
    out = np.zeros((n, span + 1), bool)
    # nothing has more in common with a body than one of its neighbours in an order; on both sides it must come to a window
    best = np.zeros((2, n), np.int64)
    for side, (order, common) in enumerate(((order_r, common_r), (order_l, common_l))):
        best[side, order] = np.maximum(common, np.append(common[1:], 0))
    may = best[0] - 8 + best[1] >= width * window
    if not may.any():
        return out
    class_r, class_l = np.empty(n, np.int64), np.empty(n, np.int64)
    bits = int(n).bit_length()  # of a class or a body's number; a block of two million would not fit memory
    for s in range(span + 1):
        class_r[order_r] = np.cumsum(common_r < width * (window - s) + 8)
        class_l[order_l] = np.cumsum(common_l < width * s)
        valid = np.flatnonzero(may & (left_size >= width * s) & (right_size >= width * (window - s) + 8))
        # both classes and the body in one number: plain numbers sort faster than places by a key
        key = np.sort((class_r[valid] << 2 * bits) + (class_l[valid] << bits) + valid)
        classes, body = key >> bits, key & ((1 << bits) - 1)
        same = classes[1:] == classes[:-1]
        out[body[1:][same], s] = True
        out[body[:-1][same], s] = True
    return out


def _sorted_blocks(unit: Unit, span: int):
    window = unit.window

    def settle(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.concat_batches(parts)
        found = repeats(*[rows.column(c).to_pylist() for c in ("body", "left", "moved")], window, span, unit.bytes)
        # runs of s, of all bodies at once: an empty place stands between two bodies
        hits = np.zeros((rows.num_rows, span + 2), bool)
        hits[:, :-1] = found & rows.column("lone").to_numpy(zero_copy_only=False)[:, None]
        flat = hits.ravel()
        begin, end = np.flatnonzero(flat[1:] & ~flat[:-1]) + 1, np.flatnonzero(flat[:-1] & ~flat[1:])
        if flat[:1].any():
            begin = np.concatenate([[0], begin])
        row, a, b = begin // (span + 2), begin % (span + 2), end % (span + 2)
        k1, k2, at = (rows.column(c).to_numpy()[row] for c in ("k1", "k2", "at"))
        return pa.RecordBatch.from_arrays([_longs(k1), _longs(k2), _longs(at - b), _longs(at - a + window)], ["k1", "k2", "start", "stop"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, last = 0, None
        for batch in batches:
            done, firsts = 0, batch.column("first").to_pylist()
            for j, first in enumerate(firsts):
                if size + j - done >= BLOCK and first != (firsts[j - 1] if j else last):
                    yield settle([*held, batch.slice(done, j - done)])
                    held, size, done = [], 0, j
            held.append(batch.slice(done))
            size, last = size + batch.num_rows - done, firsts[-1] if firsts else last
        if size:
            yield settle(held)

    return run


_BODY = "k1 long, k2 long, at long, left long, body binary, lone boolean, first binary, moved long"


def _cut(unit: Unit):
    """The surroundings of each wanted anchor of a text."""
    w = unit.bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text.chunks(batch, limit=STEP):
                raw, ends = text.buffer(part.column("text"))
                values, offsets, _, _ = unit.tokens(raw, ends) if w > 1 else (raw, ends, None, None)
                data = _bodies(unit, raw, values)
                lists = part.column("wanted")
                wanted = lists.flatten()
                row = np.repeat(np.arange(part.num_rows), pc.list_value_length(lists).to_numpy())
                at, left, size = (wanted.field(c).to_numpy() for c in ("at", "left", "size"))
                place = w * (offsets[row] + at)
                first, begin = [data[a:b] for a, b in zip(place.tolist(), (place + w * unit.gram).tolist())], place - w * left
                body = [data[a:b] for a, b in zip(begin.tolist(), (begin + w * size).tolist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column("k1").take(pa.array(row)), part.column("k2").take(pa.array(row)), _longs(at), _longs(left), pa.array(body, pa.binary()),
                     wanted.field("lone"), pa.array(first, pa.binary()), _longs(np.zeros(len(row), np.int64)), wanted.field("hot")],
                    ["k1", "k2", "at", "left", "body", "lone", "first", "moved", "hot"])

    return run


def _finer(unit: Unit, span: int):
    """Each body cut to ``PARTS`` ranges of its windows; the tokens all windows of a range share lead it."""
    step, window, w = -(-(span + 1) // PARTS), unit.window, unit.bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for k1, k2, at, left, body, lone, moved in zip(*[batch.column(c).to_pylist() for c in ("k1", "k2", "at", "left", "body", "lone", "moved")]):
                for s0 in range(0, span + 1, step):
                    s1 = s0 + step - 1
                    if left < s0 or len(body) // w - left < window - s1:
                        continue
                    begin = max(0, left - s1)
                    part, inner = body[w * begin : w * (left - s0 + window)], left - s0 - begin
                    far = (moved + s0).to_bytes(8, "little")
                    first = part[w * inner : w * (inner + window - (step - 1))] + far
                    rows.append((k1, k2, at - s0, inner, part, lone, first, moved + s0, _hash(first), _hash(part + far, inner)))
            yield pa.RecordBatch.from_arrays(
                [*[pa.array([r[j] for r in rows], kind) for j, kind in enumerate(
                    (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.bool_(), pa.binary(), pa.int64()))], *[_hashes([r[j] for r in rows]) for j in (8, 9)]],
                ["k1", "k2", "at", "left", "body", "lone", "first", "moved", "lead", "whole"])

    return run, step - 1


def _classes(rows: DataFrame) -> DataFrame:
    """For each lead and surroundings: rows that have them (n), and the kinds of surroundings of the lead."""
    n = rows.groupBy("lead", "whole").agg(F.count("*").alias("n"))
    # a written table: a join of two plain exchanges lets Spark split a hot lead
    kinds = cut_lineage(n.groupBy("lead").agg(F.count("*").alias("kinds")).where("kinds > 1"))
    return n.join(kinds, "lead", "left").withColumn("kinds", F.coalesce("kinds", F.lit(1)))


def spans(texts: DataFrame, unit: Unit, path: str) -> DataFrame:
    """(k1, k2, start, stop) in tokens of stretches made of repeated windows; ``texts`` has k1, k2, text. They may overlap.

    Work tables go below ``path``, and are read by the result.
    """
    spark = texts.sparkSession
    texts.mapInArrow(_scan(unit), "k1 long, k2 long, at long, left long, size long, lead long, whole long") \
        .write.parquet(f"{path}/anchors")
    found = spark.read.parquet(f"{path}/anchors")
    often = cut_lineage(found.groupBy("lead").agg(F.count("*").alias("c")).where("c > 1").select("lead"))
    found.join(often, "lead").write.parquet(f"{path}/often")
    found = spark.read.parquet(f"{path}/often")
    discard(f"{path}/anchors")
    # equal surroundings have equal left and size; any place that has them stands for all (first takes all columns of one row)
    found.groupBy("lead", "whole").agg(F.count("*").alias("n"), *[F.first(c).alias(c) for c in ("k1", "k2", "at", "left", "size")]).write.parquet(f"{path}/groups")
    groups = spark.read.parquet(f"{path}/groups")
    place = F.col("at") - F.col("left")
    out = [found.join(groups.where("n > 1").select("lead", "whole"), ["lead", "whole"]).select("k1", "k2", place.alias("start"), (place + F.col("size")).alias("stop"))]

    kinds = cut_lineage(groups.groupBy("lead").agg(F.count("*").alias("kinds")).where("kinds > 1"))
    wanted = groups.join(kinds, "lead").groupBy("k1", "k2").agg(
        F.collect_list(F.struct("at", "left", "size", (F.col("n") == 1).alias("lone"), (F.col("kinds") > HOT).alias("hot"))).alias("wanted"))
    texts.join(wanted, ["k1", "k2"]).mapInArrow(_cut(unit), _BODY + ", hot boolean").write.parquet(f"{path}/bodies")
    rows, span, level = spark.read.parquet(f"{path}/bodies"), unit.window - unit.gram, 0
    while True:
        hot, rest = rows.where("hot"), rows.where("not hot").drop("hot")
        buckets = max(1, -(-rest.count() // BUCKET), spark.sparkContext.defaultParallelism)
        dealt = rest.repartitionByRange(buckets, "first").sortWithinPartitions("first")
        out.append(dealt.mapInArrow(_sorted_blocks(unit, span), "k1 long, k2 long, start long, stop long"))
        if hot.isEmpty():
            break
        level += 1
        run, span = _finer(unit, span)
        hot.mapInArrow(run, _BODY + ", lead long, whole long").write.parquet(f"{path}/fine{level}")
        fine = spark.read.parquet(f"{path}/fine{level}")
        known = _classes(fine)
        again = fine.join(known, ["lead", "whole"])
        out.append(again.where("n > 1 and lone").select(
            "k1", "k2", (F.col("at") - F.col("left")).alias("start"), (F.col("at") - F.col("left") + F.length("body") / unit.bytes).cast("long").alias("stop")))
        again.where("kinds > 1").groupBy("lead", "whole").agg(
            F.min(F.struct("k1", "k2", "at", "left", "body", "lone", "first", "moved")).alias("r"), (F.first("n") == 1).alias("single"),
            (F.first("kinds") > HOT).alias("hot")) \
            .select("r.k1", "r.k2", "r.at", "r.left", "r.body", (F.col("r.lone") & F.col("single")).alias("lone"), "r.first", "r.moved", "hot") \
            .write.parquet(f"{path}/bodies{level}")
        rows = spark.read.parquet(f"{path}/bodies{level}")
    total = out[0]
    for more in out[1:]:
        total = total.unionByName(more)
    return total


def covered(texts: DataFrame, unit: Unit = BYTES) -> DataFrame:
    """(_k1, _k2, spans): the stretches of each text that has any, written; its work tables are gone by then."""
    spark = texts.sparkSession
    work, path = fresh(spark, "suffixes"), fresh(spark, "spans")
    # a word has a byte at least, and white space stands between two
    long = texts.where(F.length("text") >= (unit.window if unit.bytes == 1 else 2 * unit.window - 1))
    found = spans(long, unit, work).groupBy(F.col("k1").alias("_k1"), F.col("k2").alias("_k2")).agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    found.write.parquet(path)
    discard(work)
    return spark.read.parquet(path)


def _merged(lists: pa.Array) -> list[list[list[int]]]:
    """Of each row the spans in order, those that meet joined; null is none."""
    runs: list[list[list[int]]] = [[] for _ in range(len(lists))]
    flat = lists.flatten()
    if not len(flat):
        return runs
    row = np.repeat(np.arange(len(lists)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy())
    start, stop = (flat.field(c).to_numpy() for c in ("start", "stop"))
    by = np.lexsort((start, row))
    row, start, stop = row[by], start[by], stop[by]
    far = int(stop.max()) + 1
    stop = np.maximum.accumulate(row * far + stop) - row * far  # the furthest so far in the row
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (start[1:] > stop[:-1])
    first = np.flatnonzero(new)
    for r, x, y in zip(row[first].tolist(), start[first].tolist(), stop[np.append(first[1:], len(row)) - 1].tolist()):
        runs[r].append([x, y])
    return runs


def _in_bytes(unit: Unit, raw: bytes, runs: list[list[int]]) -> list[list[int]]:
    """Spans of tokens as spans of bytes, from the first token's begin to the last one's end."""
    if unit.bytes == 1 or not runs:
        return runs
    data = np.frombuffer(raw, np.uint8)
    starts, ends = text.places(data, np.array([0, len(data)]))
    return [[int(starts[a]), int(ends[b - 1])] for a, b in runs]


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def _shown(runs: list[list[int]]) -> list[dict]:
    return [{"start": a, "stop": b} for a, b in runs]


def _removed(kinds: list[str], unit: Unit, other: Unit | None, keep_characters: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text.chunks(batch, "_text", STEP):
                merged, kept, also = [], [], []
                for t, runs, others in zip(part.column("_text"), _merged(part.column("_spans")), _merged(part.column("_others"))):
                    raw = t.as_buffer().to_pybytes() if t.is_valid else b""
                    runs = _in_bytes(unit, raw, runs)
                    if keep_characters:
                        for r in runs:
                            while r[0] < r[1] and raw[r[0]] & 0xC0 == 0x80:
                                r[0] += 1
                            while r[0] < r[1] < len(raw) and raw[r[1]] & 0xC0 == 0x80:
                                r[1] -= 1
                        runs = [r for r in runs if r[0] < r[1]]
                    edges = [0, *[x for r in runs for x in r], len(raw)]
                    kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])))
                    merged.append(_shown(runs))
                    also.append(_shown(_in_bytes(other, raw, others)) if other else None)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in kinds], pa.array(merged, _SPANS), pa.array(kept, pa.binary()), pa.array(also, _SPANS)], [*kinds, "_removed", "_kept", "_also"])

    return run


def remove(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: Unit = BYTES, other: Unit | None = None, whole_characters: bool = False) -> DataFrame:
    """Every row of ``docs`` with ``_removed`` (spans of bytes), ``_kept`` (the bytes left) and ``_also``.

    Removes each token covered by a string of ``unit.window`` tokens that also starts elsewhere in any
    text, all copies alike, judged on the input. Between the words of a removed run white space goes as well. With
    ``whole_characters`` a span keeps characters that it would cut. ``_also`` are the spans of bytes that the
    unit ``other`` would remove (null without one). Null and empty texts and those under
    a window stay as they are (null: no bytes). Rows with the same id and text are repeated rows: each
    counts, so both lose their windows. Null ids are values like others. The caller's columns may have any
    name, but for the three new ones, which replace them.
    """
    safe, named, back = text.renamed(docs)
    a, b = text.row_key(docs[id_col], docs[text_col].cast("string"))
    keyed = docs.select(*named, a.alias("_k1"), b.alias("_k2"), docs[text_col].cast("string").alias("_text"))
    texts = keyed.select(F.col("_k1").alias("k1"), F.col("_k2").alias("k2"), F.col("_text").cast("binary").alias("text"))
    found = keyed.join(covered(texts, unit).withColumnRenamed("spans", "_spans"), ["_k1", "_k2"], "left")
    if other:
        found = found.join(covered(texts, other).withColumnRenamed("spans", "_others"), ["_k1", "_k2"], "left")
    else:
        found = found.withColumn("_others", F.lit(None).cast("array<struct<start:long,stop:long>>"))
    kinds = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(safe, docs.schema))
    cut = found.select(*safe, F.col("_text").cast("binary").alias("_text"), "_spans", "_others").mapInArrow(
        _removed(safe, unit, other, whole_characters),
        f"{kinds}, _removed array<struct<start:long,stop:long>>, _kept binary, _also array<struct<start:long,stop:long>>")
    made = ("_removed", "_kept", "_also")
    return cut.select(*[c for c, n in zip(back, docs.columns) if n not in made], *made)
