"""Near-duplicate groups: SuperMinHash signatures, banding, exact verification, components."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import text
from tidemark.llm.graph import components
from tidemark.llm.work import discard, fresh, kept

WORDS, SLOTS, ROWS = 5, 128, 4
#: Share of two shingle sets in percent from which they are linked.
PERCENT = 75
_STEP = np.uint64(0x9FB21C651E98DF25)
#: Bytes of text handled at once, and sets that a task takes.
STEP, SETS = 1 << 18, 4096


def shingles(raw: np.ndarray, offsets: np.ndarray, n: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's ``n``-word shingles; a shorter text is one shingle."""
    words, at = text.words(raw, offsets)
    run = words.copy()
    for j in range(1, n):
        run[: len(run) - j] = run[: len(run) - j] * _STEP + words[j:] if len(words) > j else run[: len(run) - j]
    run = text.mix(run)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a >= n:
            hashes = np.sort(run[a : b - n + 1])
            keep = np.ones(len(hashes), bool)
            np.not_equal(hashes[1:], hashes[:-1], out=keep[1:])
            out.append(hashes[keep])
        elif b > a:
            whole = np.uint64(b - a)
            for w in words[a:b]:
                whole = text.mix(np.array([whole], np.uint64) * _STEP + w)[0]
            out.append(np.array([whole], np.uint64))
        else:
            out.append(words[:0])
    return out


def signatures(sets: list[np.ndarray], slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash of each set, one row of ``slots`` values a set (Ertl, 2017).

    Each element walks a random order of the slots, and its value at step j is j plus a
    fraction; a slot keeps the least. A set is done as soon as every slot holds a value
    below the next step, as later steps can't lower any. Steps run over all sets at once.
    """
    sizes = np.array([len(s) for s in sets])
    least = np.full((len(sets), slots), np.iinfo(np.uint64).max, np.uint64)
    elements = np.concatenate(sets) if len(sets) else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = None
    for j in range(slots):
        if not len(elements):
            break
        draw = text.mix(elements + (np.array([j + 1], np.uint64) * _STEP))
        k = j + ((draw & np.uint64(0xFFFF)) * np.uint64(slots - j) >> np.uint64(16)).astype(np.int64)
        value = (np.uint64(j) << np.uint64(48)) | (draw >> np.uint64(16))
        if j == 0:
            slot = k
        else:
            if order is None:  # as step 0 left it
                rows = np.arange(len(elements))
                order = np.broadcast_to(np.arange(slots, dtype=np.uint8), (len(elements), slots)).copy()
                order[rows, 0], order[rows, first] = first, 0
            rows = np.arange(len(elements))
            slot = order[rows, k].astype(np.int64)
            order[rows, k] = order[rows, j]
            order[rows, j] = slot
        np.minimum.at(least, (owner, slot), value)
        open_ = least.max(axis=1) >= np.uint64(j + 1) << np.uint64(48)
        stay = open_[owner]
        elements, owner = elements[stay], owner[stay]
        if j == 0:
            first = k[stay].astype(np.uint8)
        else:
            order = order[stay]
    return least


def bands(signature: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit hash for every ``rows`` slots, the band's number mixed in."""
    parts = signature.reshape(len(signature), -1, rows)
    out = np.arange(1, parts.shape[1] + 1, dtype=np.uint64)[None, :] * _STEP
    for j in range(rows):
        out = text.mix(out ^ parts[:, :, j]) * _STEP
    return out


def _digest(hashes: np.ndarray) -> tuple[int, int]:
    full = hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()
    return int.from_bytes(full[:8], "little", signed=True), int.from_bytes(full[8:], "little", signed=True)


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text.chunks(batch, limit=STEP):
            sets = shingles(*text.buffer(part.column("text")))
            rows = bands(signatures(sets)).view(np.int64)
            both = [_digest(s) if len(s) else (None, None) for s in sets]
            held = pa.array([r if len(s) else [] for r, s in zip(rows, sets)], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*[part.column(c) for c in ("k1", "k2", "id")], pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([b[0] for b in both], pa.int64()), pa.array([b[1] for b in both], pa.int64()), held],
                ["k1", "k2", "id", "n_shingles", "node", "more", "bands"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text.chunks(batch, limit=STEP):
            sets = shingles(*text.buffer(part.column("text")))
            yield pa.RecordBatch.from_arrays([part.column("node"), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["node", "hashes"])


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("left"), batch.column("right")):
            x, y = np.asarray(x.values), np.asarray(y.values)
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * both >= PERCENT * (len(x) + len(y) - both))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those pairs whose full sets reach the share. Sets of too unlike sizes are not fetched."""
    left = sets.select(F.col("node").alias("a"), F.col("hashes").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("hashes").alias("right"))
    near = pairs.join(left, "a").join(right, "b").where(
        (100 * F.size("left") >= PERCENT * F.size("right")) & (100 * F.size("right") >= PERCENT * F.size("left")))
    return near.select("a", "b", "left", "right").mapInArrow(_linked, "a long, b long")


def _pairs(left: F.Column, right: F.Column) -> list:
    return [F.least(left, right).alias("a"), F.greatest(left, right).alias("b")]


def _split(held: DataFrame, labels: DataFrame, order: F.Column) -> tuple[DataFrame, DataFrame]:
    """Members with their component, and the buckets that hold several components, with the member first in ``order``."""
    now = held.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    split = now.groupBy("band").agg(
        F.min("label").alias("low"), F.max("label").alias("high"),
        F.min_by(F.struct("node", "label"), F.struct(order, "node")).alias("first")).where("low <> high")
    return now, split.select("band", F.col("first.node").alias("leader"), F.col("first.label").alias("leader_label"))


def _to_leaders(now: DataFrame, split: DataFrame) -> DataFrame:
    """Each member of a split bucket with the bucket's leader, if that is in another component."""
    return now.join(split, "band").where("label <> leader_label").select(*_pairs(F.col("node"), F.col("leader"))).distinct()


def _to_central(now: DataFrame, split: DataFrame, sets: DataFrame) -> DataFrame:
    return _to_leaders(now, split)


def _across(now: DataFrame, split: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs of nodes of split buckets that may be linked though in two components, by an exact prefix filter.

    Shingles are ordered from the rarest among these nodes. Two linked sets of m and n have at
    least 75 / 175 (m + n) shingles in common; so the first of those in order has as many, itself
    counted, still to come in both sets, and stands among the first few of either. Pairs of one component are
    not written: one end is outside the largest component that the shingle is met in.
    """
    nodes = now.join(split, "band").groupBy("node").agg(F.min("label").alias("label"), F.min("m").alias("m"))
    known = kept(sets.join(nodes, "node").select("node", "label", "m", F.size("hashes").alias("n"), "hashes"), SETS)
    each = known.select("node", "label", "m", "n", F.explode("hashes").alias("h"))
    rare = each.groupBy("h").agg(F.count("*").alias("c")).where("c > 1")
    # of a set's n shingles those alone in it come first of all
    counted = each.join(rare, "h")
    shared = counted.groupBy("node").agg(F.count("*").alias("shared"))
    order = Window.partitionBy("node").orderBy("c", "h")
    placed = counted.join(shared, "node").withColumn("place", F.col("n") - F.col("shared") + F.row_number().over(order) - 1)
    partner = F.greatest(F.col("m"), F.ceil(F.col("n") * PERCENT / 100))
    head = placed.where((100 + PERCENT) * (F.col("n") - F.col("place")) >= PERCENT * (F.col("n") + partner)).select("h", "node", "label", "n", "place")
    sizes = nodes.groupBy("label").agg(F.count("*").alias("nodes"))
    head = kept(head.join(sizes, "label"))
    mixed = head.groupBy("h").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.max_by("label", F.struct("nodes", "label")).alias("main")) \
        .where("low <> high").select("h", "main")
    left = head.join(mixed, "h").where("label <> main")
    right = head.select(F.col("h").alias("other_h"), *[F.col(c).alias(f"other_{c}") for c in ("node", "label", "n", "place")])
    rest = F.least(F.col("n") - F.col("place"), F.col("other_n") - F.col("other_place"))
    near = (F.col("label") != F.col("other_label")) & ((100 + PERCENT) * rest >= PERCENT * (F.col("n") + F.col("other_n")))
    return left.join(right, (F.col("h") == F.col("other_h")) & near).select(*_pairs(F.col("node"), F.col("other_node"))).distinct()


def _able(members: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, m, apart): members that may still be linked to another one, the least size of a partner, and the share of shingles they have alone.

    Of a set of n shingles, u in no other member's: a set of m can't have more than n - u of
    them in common with it, and both together have m + u at least. A linked set has at least
    75 % of n, and no partner is smaller than the least member of the node's buckets.
    """
    nodes = members.select("node").distinct()
    known = kept(sets.join(nodes, "node").select("node", "hashes"), SETS)
    alone = known.select("node", F.explode("hashes").alias("h")).groupBy("h").agg(F.count("*").alias("c"), F.min("node").alias("node")) \
        .where("c = 1").groupBy("node").agg(F.count("*").alias("u"))
    sizes = known.select("node", F.size("hashes").alias("n"))
    sized = members.select("band", "node").join(sizes, "node")
    least = sized.groupBy("band").agg(F.min("n").alias("m"))
    near = sized.join(least, "band").groupBy("node").agg(F.min("m").alias("m"), F.min("n").alias("n")).join(alone, "node", "left")
    u = F.coalesce("u", F.lit(0))
    partner = F.greatest(F.col("m"), F.ceil(F.col("n") * PERCENT / 100))
    return near.where(100 * (F.col("n") - u) >= PERCENT * (partner + u)).select("node", "m", (u / F.col("n")).alias("apart"))


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Near-duplicate groups of whole texts: k1, k2, id, n_shingles, component_id, kept.

    Texts with the same shingle set are one node (64 bits of a 128-bit digest; a clash of two
    sets would join them). Nodes that share any of 32 bands are candidates; a pair at the
    threshold is missed with probability 5e-6, at 0.8 with 5e-8. In each bucket all nodes
    are held against one leader. Nodes of buckets that still hold several components leave if
    they have too many shingles alone to be linked to anything there; the others are held
    against the most central node. What is still in two components then goes through an exact
    prefix filter, so no link among candidates is lost and no pair within a component is written. ``component_id`` is the least id of the group;
    ``kept`` marks its row. k1 and k2 stand for the row's id and text.

    Null or wordless texts are groups of their own. Null ids come after all others: a group
    without any other id has a null component_id and keeps one text. Repeated rows are equal
    in everything, also in ``kept``. Other columns are not read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    texts = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))
    texts = texts.select(*text.row_key(F.col("id"), F.col("text")), "id", "text")
    path = fresh(spark, "minhash")
    texts.mapInArrow(_described, "k1 long, k2 long, id long, n_shingles long, node long, more long, bands array<long>").write.parquet(f"{path}/rows")
    rows = spark.read.parquet(f"{path}/rows")

    # equal sets are one node, so however many texts share one, it has its bands once
    nodes = rows.where("node is not null").groupBy("node").agg(F.first("bands").alias("bands"))
    nodes.write.parquet(f"{path}/nodes")
    held = spark.read.parquet(f"{path}/nodes").select("node", F.explode("bands").alias("band"))
    full = held.groupBy("band").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high").select("band")
    # members of buckets with at least two nodes
    held.join(full, "band").distinct().write.parquet(f"{path}/held")
    held = spark.read.parquet(f"{path}/held")
    discard(f"{path}/nodes")
    wanted = held.select("node").distinct()
    chosen = rows.join(wanted, "node").groupBy("node").agg(F.min(F.struct("k1", "k2")).alias("k")).select("node", "k.*")
    texts.join(chosen, ["k1", "k2"]).select("node", "text").mapInArrow(_sets, "node long, hashes array<long>") \
        .dropDuplicates(["node"]).write.parquet(f"{path}/sets")
    sets = spark.read.parquet(f"{path}/sets")

    label = F.coalesce("label", "node")
    now, split = _split(held, spark.createDataFrame([], "node long, label long"), F.xxhash64("node"))
    tried = kept(_to_leaders(now, split))
    labels = components(kept(_verified(tried, sets)))
    now, split = _split(held, labels, F.xxhash64("node"))
    held = kept(now.join(_able(now.join(split, "band"), sets), "node").drop("label"))
    for more in (_to_central, _across):
        now, split = _split(held, labels, F.col("apart"))
        pairs = kept(more(now, split, sets).join(tried, ["a", "b"], "left_anti"))
        tried = tried.unionByName(pairs)
        labels = components(kept(_verified(pairs, sets)), labels)

    discard(f"{path}/held", f"{path}/sets")  # the labels are checkpointed
    grouped = rows.join(labels, "node", "left").select("k1", "k2", "id", "n_shingles", label.alias("label"))
    order = F.struct(F.col("id").isNull(), "id", "k1", "k2")
    least = grouped.where("label is not null").groupBy("label").agg(F.min("id").alias("component_id"), F.min(order).alias("keeper"))
    joined = grouped.join(least, "label", "left")
    alone = F.col("label").isNull()
    return joined.select(
        "k1", "k2", "id", "n_shingles", F.when(alone, F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
        (alone | (F.col("keeper") == order)).alias("kept"))
