"""Row numbers and ordered scans that never put one key, or the whole table, in one task."""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from tidemark.session import work_path

# Positions per chunk of an ordered scan; bounds the rows one window group holds.
CHUNK_ROWS = 100_000
# Larger groups are numbered by a range sort in place of one window group.
MAX_WINDOW_ROWS = 2_000_000


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


# how a column shows the direction it carries
DIRECTION = re.compile(r" (ASC|DESC) NULLS (FIRST|LAST)$")


def plain(column) -> Column:
    """The column without its direction; Spark can neither select nor sort again by a column that carries one."""
    if isinstance(column, str):
        return F.col(column)
    shown = str(column).removeprefix("Column<'").removesuffix("'>")
    return F.expr(DIRECTION.sub("", shown)) if DIRECTION.search(shown) else column


def directed(column, name: str) -> Column:
    """The column ``name`` in the direction that ``column`` carries."""
    found = DIRECTION.search(str(column).removeprefix("Column<'").removesuffix("'>"))
    ways = {("ASC", "FIRST"): F.asc_nulls_first, ("ASC", "LAST"): F.asc_nulls_last, ("DESC", "FIRST"): F.desc_nulls_first, ("DESC", "LAST"): F.desc_nulls_last}
    return ways[found.groups()](name) if found else F.col(name)


def _first_ranks(keys: DataFrame, order: list, partitions: int | None) -> DataFrame:
    """The distinct keys with ``_before``, the rows before the first of each; ``order`` sorts the key columns.

    Only keys are sorted and written, once: what is read from then on is the same for a recomputed task.
    """
    spark, names = keys.sparkSession, keys.columns
    counted = keys.groupBy(*names).agg(F.count("*").alias("_n"))
    ranged = counted.repartitionByRange(partitions, *order) if partitions else counted.repartitionByRange(*order)
    path = work_path(spark, "ranks")
    ranged.sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id()).write.parquet(path)
    placed = spark.read.parquet(path).withColumns({
        "_part": F.shiftright("_place", 33).cast("int"), "_in": F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))})
    # one row per partition, so the driver holds a few thousand triples at most
    parts = placed.groupBy("_part").agg(F.sum("_n").alias("rows"), F.max("_n").alias("most")).orderBy("_part").collect()
    starts = list(itertools.accumulate((r.rows for r in parts), initial=0))
    offsets = spark.createDataFrame([(r._part, start) for r, start in zip(parts, starts)], "_part int, _start long")
    if all(r.most == 1 for r in parts):
        inside = placed.withColumn("_upto", F.col("_in") + 1)
    else:
        inside = running_sum(placed, ["_part"], "_in", F.col("_n"), "_upto")
    return inside.join(F.broadcast(offsets), "_part").select(*names, (F.col("_start") + F.col("_upto") - F.col("_n")).alias("_before"))


def global_rank(df: DataFrame, order: list, out: str = "rank", partitions: int | None = None) -> DataFrame:
    """Number all rows 1..n by ``order``: the keys are ranked by a range sort, and the rows take their number from their key.

    ``order`` should be unique: the trailing columns are what splits a hot leading value over tasks. Rows with
    one key take its numbers in any order.
    """
    names = [f"_o{i}" for i in range(len(order))]
    keyed = df.withColumns({n: plain(c) for n, c in zip(names, order)})
    first = _first_ranks(keyed.select(*names), [directed(c, n) for c, n in zip(order, names)], partitions)
    first = first.toDF(*[f"_k{i}" for i in range(len(order))], "_before")
    match = reduce(lambda a, b: a & b, [keyed[n].eqNullSafe(first[f"_k{i}"]) for i, n in enumerate(names)])
    place = F.row_number().over(Window.partitionBy(*names).orderBy(*names))
    numbered = keyed.join(first, match).withColumn("_number", F.col("_before") + place)
    return numbered.select(*[c for c in df.columns if c != out], F.col("_number").alias(out))


def row_number_by(
    df: DataFrame, keys: list[str], order: list, out: str = "row_num", max_rows: int = MAX_WINDOW_ROWS
) -> DataFrame:
    """``row_number`` per key; groups above ``max_rows`` are ranked by a range sort.

    The check counts keys with a map-side combine and reads the key columns only.
    """
    plain = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("bigint")
    hot = df.groupBy(*keys).count().filter(F.col("count") > max_rows).select(*keys)
    if hot.isEmpty():
        return df.withColumn(out, plain)
    cold = df.join(hot, _same(df, hot, keys), "left_anti").withColumn(out, plain)
    ranked = global_rank(df.join(hot, _same(df, hot, keys), "left_semi"), [*keys, *order], "_global")
    first = ranked.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(F.min("_global").alias("_first"))
    match = reduce(lambda a, b: a & b, [ranked[k].eqNullSafe(first[f"_k_{k}"]) for k in keys])
    big = ranked.join(first, match).withColumn(out, F.col("_global") - F.col("_first") + 1)
    return cold.unionByName(big.select(*cold.columns))


@dataclass(frozen=True)
class Scan:
    """One output of an ordered scan: inside a chunk, and what earlier chunks hand on."""

    value: Column
    local: Callable[[str, WindowSpec], Column]
    summary: Callable[[str, str], Column]
    carried: Callable[[str], Column]
    combine: Callable[[Column, Column], Column]


def sum_so_far(value: Column) -> Scan:
    """Sum of ``value`` over the rows of the key up to this one."""
    return Scan(
        value.cast("bigint"),
        lambda v, w: F.sum(v).over(w.rowsBetween(Window.unboundedPreceding, 0)),
        lambda v, pos: F.sum(v),
        lambda s: F.sum(s),
        lambda here, carry: F.coalesce(here + carry, here, carry),
    )


def last_so_far(value: Column) -> Scan:
    """Last non-null ``value`` of the key at or before this row."""
    return Scan(
        value,
        lambda v, w: F.last(v, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)),
        lambda v, pos: F.max_by(v, F.when(F.col(v).isNotNull(), F.col(pos))),
        lambda s: F.last(s, ignorenulls=True),
        lambda here, carry: F.coalesce(here, carry),
    )


def last_before(value: Column) -> Scan:
    """Last non-null ``value`` of the key before this row."""
    return Scan(
        value,
        lambda v, w: F.last(v, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)),
        lambda v, pos: F.max_by(v, F.when(F.col(v).isNotNull(), F.col(pos))),
        lambda s: F.last(s, ignorenulls=True),
        lambda here, carry: F.coalesce(here, carry),
    )


def previous(value: Column) -> Scan:
    """``value`` of the row just before this one; null on the first row."""
    return Scan(
        F.struct(value.alias("v")),
        lambda v, w: F.lag(v).over(w),
        lambda v, pos: F.max_by(v, pos),
        lambda s: F.last(s),
        lambda here, carry: F.coalesce(here, carry)["v"],
    )


def ordered_scan(
    df: DataFrame, keys: list[str], pos: str, scans: dict[str, Scan], chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Add one column per scan over the rows of a key in ``pos`` order.

    Rows are windowed in chunks of ``pos``, so a key of any size spreads over tasks; a
    small summary per chunk carries state from one chunk to the next. All scans share
    one shuffle, one summary and one join.
    """
    names = list(scans)
    rows = df.withColumn("_chunk", F.floor(F.col(pos) / F.lit(chunk_rows))).withColumns(
        {f"_v_{n}": scans[n].value for n in names})
    inside = Window.partitionBy(*keys, "_chunk").orderBy(pos)
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        rows.groupBy(*keys, "_chunk").agg(*[scans[n].summary(f"_v_{n}", pos).alias(f"_s_{n}") for n in names])
        .withColumns({f"_c_{n}": scans[n].carried(f"_s_{n}").over(before) for n in names})
        # the first chunk of a key has nothing to take over
        .filter(reduce(lambda a, b: a | b, [F.col(f"_c_{n}").isNotNull() for n in names]))
        .select(*keys, "_chunk", *[f"_c_{n}" for n in names])
    )
    local = rows.withColumns({f"_l_{n}": scans[n].local(f"_v_{n}", inside) for n in names})
    named = carry.select("_chunk", *[F.col(k).alias(f"_k_{k}") for k in keys], *[f"_c_{n}" for n in names]).withColumnRenamed("_chunk", "_k_chunk")
    # null is a key like any other
    match = reduce(lambda a, b: a & b, [local[k].eqNullSafe(named[f"_k_{k}"]) for k in keys], local["_chunk"] == named["_k_chunk"])
    joined = local.join(named, match, "left")
    return joined.select(
        *[local[c] for c in df.columns], *[scans[n].combine(F.col(f"_l_{n}"), F.col(f"_c_{n}")).alias(n) for n in names])


def running_sum(df, keys, pos, value, out, chunk_rows=CHUNK_ROWS) -> DataFrame:
    return ordered_scan(df, keys, pos, {out: sum_so_far(value)}, chunk_rows)


def carry_forward(df, keys, pos, value, out, chunk_rows=CHUNK_ROWS) -> DataFrame:
    return ordered_scan(df, keys, pos, {out: last_so_far(value)}, chunk_rows)


def previous_value(df, keys, pos, value, out, chunk_rows=CHUNK_ROWS) -> DataFrame:
    return ordered_scan(df, keys, pos, {out: previous(value)}, chunk_rows)


def next_value(df, keys, pos, value, out, chunk_rows=CHUNK_ROWS) -> DataFrame:
    turned = df.withColumn("_back", -F.col(pos))
    return previous_value(turned, keys, "_back", value, out, chunk_rows).drop("_back")
