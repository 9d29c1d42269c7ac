"""Texts read in splits: line numbers, and records whose quoted fields hold line breaks.

A file of any size is read by many tasks. What a line needs to know of the lines before it, its number
or whether a quoted field is open, is summed for each block of the file, the blocks' sums are added up in file
order (one row for each block), and each line adds what its own block holds before it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec, functions as F

from tidemark.session import work_path
from tidemark.sources import archives as arc

# listed files are read in blocks of so many bytes
BLOCK_BYTES = 64 * 1024 * 1024


def block_lines(spark: SparkSession, path: str, separator: str | None = "\n") -> DataFrame:
    """Lines (file, block, place, line): the block's offset in the file, and a number that grows within the block."""
    reader = spark.read if separator is None else spark.read.option("lineSep", separator)
    return reader.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"), F.col("value").alias("line"))


def _lines_of(path: str, start: int, end: int):
    """Lines, without their ends, of the texts between line feeds that begin in a block of a file; ends as Spark's reader knows them."""
    with arc.open_shared(path) as handle:
        if start:
            handle.seek(start - 1)
            handle.readline()
        at = handle.tell()
        while at < end and (text := handle.readline()):
            if at == 0 and text.startswith(b"\xef\xbb\xbf"):
                at, text = 3, text[3:]
                if not text:
                    return
            at += len(text)
            yield from text.removesuffix(b"\n").removesuffix(b"\r").split(b"\r")


def listed_lines(files: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Lines (file, block, place, line) of listed files (path, size), as :func:`block_lines` gives those of a path.

    For very many files: Spark's own reader makes a task of a few, however small they are. Here tasks stay as many
    as the listing has, and a large file still is read in blocks by several.
    """
    blocks = files.select("path", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(block_bytes).cast("long"))).alias("block"))
    blocks = blocks.repartition(4 * files.sparkSession.sparkContext.defaultParallelism, "path", "block")

    def read(frames):
        for frame in frames:
            rows = ((path, block, place, line.decode("utf-8", "replace")) for path, block in zip(frame["path"], frame["block"])
                    for place, line in enumerate(_lines_of(path, block, block + block_bytes)))
            for batch in arc.sized_batches(rows):
                yield pd.DataFrame(batch, columns=["file", "block", "place", "line"])

    return blocks.mapInPandas(read, "file string, block long, place long, line string")


def _written(df: DataFrame, name: str) -> DataFrame:
    """A small table as a file: its size is known, so Spark can choose to broadcast it."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def _before() -> WindowSpec:
    return Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)


def numbered_lines(lines: DataFrame) -> DataFrame:
    """(file, line_no, line) of :func:`block_lines`, numbered from 0 in each file, whatever the splits."""
    blocks = lines.groupBy("file", "block").agg(F.count("*").alias("lines"), F.min("place").alias("first"))
    blocks = _written(blocks.select("file", "block", "first", F.coalesce(F.sum("lines").over(_before()), F.lit(0)).alias("ahead")), "blocks")
    return lines.join(blocks, ["file", "block"]).select("file", (F.col("ahead") + F.col("place") - F.col("first")).alias("line_no"), "line")


_STATES = "starts_closed long, starts_opened long, open_closed boolean, open_opened boolean, after_closed boolean, after_opened boolean"


def _scan(kept: list[str]):
    """Adds to each line what holds if its block begins outside quotes (closed), and if within (opened).

    The records begun in the block so far, this line's included, and whether a quoted field is open before and after
    the line. A line that ``resets`` leaves the same state whatever was before it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, starts, after = None, [0, 0], [0, 1]
        for batch in batches:
            n, part, quotes = batch.num_rows, batch.column("part").to_numpy(), batch.column("quotes").to_numpy()
            candidate, resets = (np.asarray(batch.column(c)) for c in ("candidate", "resets"))
            out = {(c, h): np.empty(n, np.int64) for c in ("starts", "open", "after") for h in (0, 1)}
            edges = np.unique([0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), n])
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                if part[a] != now:
                    now, starts, after = part[a], [0, 0], [0, 1]
                total = np.cumsum(quotes[a:b])
                place = np.arange(b - a)
                last = np.maximum.accumulate(np.where(resets[a:b], place, -1))
                since = total - np.where(last >= 0, (total - quotes[a:b])[np.maximum(last, 0)], 0)
                for h in (0, 1):
                    behind = (since + np.where(last >= 0, 0, after[h])) % 2
                    before = np.concatenate([[after[h]], behind[:-1]])
                    begun = starts[h] + np.cumsum(candidate[a:b] & (before == 0))
                    out["open", h][a:b], out["after", h][a:b], out["starts", h][a:b] = before, behind, begun
                    after[h], starts[h] = int(behind[-1]), int(begun[-1])
            made = [out["starts", 0], out["starts", 1], *[out[c, h] == 1 for c in ("open", "after") for h in (0, 1)]]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], *[pa.array(m) for m in made]],
                [*kept, *[k.split()[0] for k in _STATES.split(", ")]])

    return run


def record_lines(lines: DataFrame, quotes: Column, candidate: Column, resets: Column | None = None) -> DataFrame:
    """(file, record_no, block, place, line, closed, quotes): the record each line belongs to, from 1; 0 stands before the first.

    ``quotes`` counts a line's quote signs; a line is ``closed`` if an even number of them stands before it. A
    record starts at a closed line where ``candidate`` holds. A line that ``resets`` leaves the state its own
    quotes give, whatever was before it. Nothing but one row for each block is shuffled.
    """
    flag = lambda c: F.coalesce(c, F.lit(False))
    told = lines.select("*", F.xxhash64("file", "block").alias("part"), quotes.cast("long").alias("quotes"), flag(candidate).alias("candidate"),
                        (F.lit(False) if resets is None else flag(resets)).alias("resets"))
    narrow = told.select("file", "block", "place", "part", "quotes", "candidate", "resets")
    each = narrow.mapInArrow(_scan(["file", "block", "place"]), f"file string, block long, place long, {_STATES}")
    ends = each.groupBy("file", "block").agg(F.max_by(F.struct("starts_closed", "starts_opened", "after_closed", "after_opened"), "place").alias("e")).select("file", "block", "e.*")
    fixed = F.col("after_closed") == F.col("after_opened")
    toggles = ends.withColumn("turn", F.when(fixed, 0).otherwise(F.col("after_closed").cast("int")))
    turned = toggles.withColumn("turns", F.coalesce(F.sum("turn").over(_before()), F.lit(0))) \
        .withColumn("base", F.when(fixed, F.col("after_closed").cast("int") - F.col("turns")))
    opened = turned.withColumn("opened", F.pmod(F.col("turns") + F.coalesce(F.last("base", ignorenulls=True).over(_before()), F.lit(0)), F.lit(2)) == 1)
    ahead = F.coalesce(F.sum(F.when(F.col("opened"), F.col("starts_opened")).otherwise(F.col("starts_closed"))).over(_before()), F.lit(0))
    blocks = _written(opened.select("file", "block", "opened", ahead.alias("ahead")), "quotes")
    kept = [c for c in told.columns if c not in ("candidate", "resets", "part")]
    kinds = ", ".join(f"{c} {told.schema[c].dataType.simpleString()}" for c in kept)
    known = told.mapInArrow(_scan(kept), f"{kinds}, {_STATES}").join(blocks, ["file", "block"])
    chosen = lambda name: F.when(F.col("opened"), F.col(f"{name}_opened")).otherwise(F.col(f"{name}_closed"))
    return known.select("file", (F.col("ahead") + chosen("starts")).alias("record_no"), "block", "place", "line", (~chosen("open")).alias("closed"), "quotes")


def joined_records(lines: DataFrame, whole: Column | None = None) -> DataFrame:
    """(file, record_no, record) of :func:`record_lines`; lines of one record are joined by line breaks.

    Lines for which ``whole`` holds are records by themselves and aren't moved. A record is one
    value, so a quote that is never closed takes the rest of its file into one.
    """
    lines = lines.where("record_no > 0")
    alone = F.lit(False) if whole is None else whole
    parts = lines.where(~alone).groupBy("file", "record_no").agg(F.array_sort(F.collect_list(F.struct("block", "place", "line"))).alias("parts"))
    joined = parts.select("file", "record_no", F.array_join(F.transform("parts", lambda p: p["line"]), "\n").alias("record"))
    return joined if whole is None else joined.unionByName(lines.where(alone).select("file", "record_no", F.col("line").alias("record")))


def count_of(text: Column, sign: str) -> Column:
    return F.char_length(text) - F.char_length(F.replace(text, F.lit(sign), F.lit("")))


def delimited_records(spark: SparkSession, path: str, quote: str = '"') -> DataFrame:
    """(file, record_no, record) of delimited text: a record ends at a line break outside quotes; blank lines outside are none."""
    lines = block_lines(spark, path)
    quotes = count_of(F.col("line"), quote)
    found = record_lines(lines, quotes, F.btrim(F.col("line"), F.lit(" \t\r")) != "")
    whole = F.col("closed") & (F.col("quotes") % 2 == 0)
    # a blank line after the last record closes nothing and belongs to none
    return joined_records(found.where(~(whole & (F.btrim(F.col("line"), F.lit(" \t\r")) == ""))), whole)
