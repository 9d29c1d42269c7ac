"""Sources mixed to target weights: Pfair windows and earliest deadline first, in blocks."""

from __future__ import annotations

import heapq
import itertools
import math
from collections.abc import Iterator
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tidemark.llm import text

#: Blocks gathered at a time on the driver, and sources at most.
TURN, MOST = 1024, 100_000
#: Documents of a block, and documents that a numbering bin has on average.
BLOCK, BIN = 16, 2000


def parts(weights: dict[str, float]) -> dict[str, int]:
    """The weights as whole numbers in exactly the same proportion."""
    if any(not w > 0 or w == math.inf for w in weights.values()):
        raise ValueError("weights must be positive")
    exact = {s: Fraction(w) for s, w in weights.items()}
    unit = math.lcm(*[w.denominator for w in exact.values()])
    whole = {s: w.numerator * (unit // w.denominator) for s, w in exact.items()}
    common = math.gcd(*whole.values()) or 1
    return {s: w // common for s, w in whole.items()}


def blocks_in_order(share: dict[str, int], blocks: dict[str, int]) -> Iterator[tuple[int, str, int, int, int]]:
    """Slot, source, number, release and deadline of every block, by slot.

    Block j of a source with n of D parts is released at floor(j D / n) and due at
    ceil((j + 1) D / n). Each slot goes to the released block with the earliest deadline,
    which meets all deadlines, so that no source is a whole block off its weight anywhere
    before one runs out. From there on its slots stay free, and slots in which no block
    is released are stepped over, so the steps are as many as the blocks.
    """
    whole = sum(share.values())
    coming = [(0, s, 0) for s in sorted(share) if blocks.get(s)]
    heapq.heapify(coming)
    ready: list[tuple[int, str, int, int]] = []
    now = 0
    while coming or ready:
        if not ready:
            now = max(now, coming[0][0])
        while coming and coming[0][0] <= now:
            release, s, j = heapq.heappop(coming)
            heapq.heappush(ready, (-(-(j + 1) * whole // share[s]), s, j, release))
        due, s, j, release = heapq.heappop(ready)
        yield now, s, j, release, due
        if j + 1 < blocks[s]:
            heapq.heappush(coming, ((j + 1) * whole // share[s], s, j + 1))
        now += 1


def tempered(docs: DataFrame, source: Column, power: float = 0.5) -> dict[str, float]:
    """Target weights in proportion to a power of each source's number of documents."""
    counts = docs.groupBy(F.coalesce(source.cast("string"), F.lit("")).alias("s")).count().limit(MOST + 1).collect()
    if len(counts) > MOST:
        raise ValueError(f"more than {MOST} sources: give weights for groups of them")
    return {r.s: r["count"] ** power for r in counts}


def mix(docs: DataFrame, weights: dict[str, float], source: Column, order: Column, block: int = BLOCK, turn: int = TURN) -> DataFrame:
    """Every row with ``_rank`` in its source, ``_block``, ``_slot``, ``_release``, ``_deadline``, ``_on_target``.

    Rows of a source are ranked by the hash ``order``; ``block`` of them form a block, and the
    blocks of all sources follow each other by ``_slot``, rows in a block by ``_rank``. Slots
    follow the exact weights over all blocks: the driver goes through the blocks (not the rows)
    once, ``turn`` of them to a batch, and joins their slots to the bins of ranks. ``weights`` is
    configuration of at most ``MOST`` sources; a null source counts as "", a source without
    a weight is an error. Nothing is dropped or repeated: ``_on_target`` is false from the
    slot on at which the first source has run out (one without rows: from the first), and
    later slots of that source stay free.
    Null orders come first; ties and repeated rows take any order among themselves. The
    caller's columns may have any name and come back as they were, but for those that have the name of a new one.
    """
    spark = docs.sparkSession
    _, named, own = text.renamed(docs)
    share = parts(weights)
    whole = sum(share.values())
    rows = docs.select(*named, F.coalesce(source.cast("string"), F.lit("")).alias("_source"), order.alias("_order"))
    many = max(1, rows.count() // BIN)
    # ranks: rows are binned by hash range, bins counted, and counts summed in order of bins
    place = F.coalesce(F.shiftrightunsigned(F.col("_order"), 1).cast("double") / float(1 << 63) * many, F.lit(0.0))
    rows = rows.withColumn("_bin", F.least(F.floor(place), F.lit(many - 1)).cast("long"))
    counted = rows.groupBy("_source", "_bin").agg(F.count("*").alias("_n"))
    before = counted.select("_source", "_bin", "_n", (F.sum("_n").over(Window.partitionBy("_source").orderBy("_bin")) - F.col("_n")).alias("_before"))
    sizes = {r._source: r.n for r in counted.groupBy("_source").agg(F.sum("_n").alias("n")).collect()}
    if unknown := sorted(set(sizes) - set(weights)):
        raise ValueError(f"sources without a weight: {unknown[:5]}")
    blocks = {s: -(-n // block) for s, n in sizes.items()}
    # the first slot beyond a source's last block
    horizon = min((blocks.get(s, 0) * whole // n for s, n in share.items()), default=0)
    plan = spark.createDataFrame(_table(blocks_in_order(share, blocks), turn))
    # the slots of a bin's blocks, in order: only counts and blocks are joined, not rows
    spans = before.withColumn("_first", F.floor(F.col("_before") / block).cast("long"))
    last = F.floor((F.col("_before") + F.col("_n") - 1) / block).cast("long")
    spans = spans.withColumn("_block", F.explode(F.sequence("_first", last))).join(plan, ["_source", "_block"])
    spans = spans.groupBy("_source", "_bin").agg(
        F.first("_before").alias("_before"), F.first("_first").alias("_first"),
        F.array_sort(F.collect_list(F.struct("_block", "_slot", "_release", "_deadline"))).alias("_blocks"))
    hashed = Window.partitionBy("_source", "_bin").orderBy(F.shiftrightunsigned("_order", 1), "_order")
    rows = rows.withColumn("_nth", F.row_number().over(hashed) - 1).join(spans, ["_source", "_bin"])
    rows = rows.withColumn("_rank", F.col("_before") + F.col("_nth")).withColumn("_block", F.floor(F.col("_rank") / block).cast("long"))
    found = F.get("_blocks", (F.col("_block") - F.col("_first")).cast("int"))
    made = {"_source", "_rank", "_block", "_slot", "_release", "_deadline", "_on_target"}
    return rows.select(
        *[c for c, n in zip(own, docs.columns) if n not in made], "_source", "_rank", "_block", found["_slot"].alias("_slot"), found["_release"].alias("_release"),
        found["_deadline"].alias("_deadline"), (found["_slot"] < horizon).alias("_on_target"))


def _table(rows: Iterator[tuple[int, str, int, int, int]], size: int) -> pa.Table:
    """The scheduled blocks as columns, gathered ``size`` rows at a time."""
    kinds = pa.schema([("_slot", pa.int64()), ("_source", pa.string()), ("_block", pa.int64()), ("_release", pa.int64()), ("_deadline", pa.int64())])
    batches = []
    for some in itertools.batched(rows, max(1, size)):
        batches.append(pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), kinds)], schema=kinds))
    return pa.Table.from_batches(batches, kinds).combine_chunks()
