"""Joins, duplicates, paging and scalar subqueries beyond one DataFrame method."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.operators.ranks import global_rank, plain, row_number_by

# join kinds named in mapping metadata -> Spark's name; NATURAL and RIGHT SEMI/ANTI are built below
JOIN_KINDS = {
    "INNER JOIN": "inner",
    "LEFT JOIN": "left",
    "LEFT OUTER JOIN": "left",
    "RIGHT JOIN": "right",
    "RIGHT OUTER JOIN": "right",
    "FULL OUTER JOIN": "full",
    "LEFT SEMI JOIN": "left_semi",
    "LEFT ANTI JOIN": "left_anti",
}
NATURAL_KINDS = {
    "NATURAL JOIN": "inner",
    "NATURAL LEFT JOIN": "left",
    "NATURAL RIGHT JOIN": "right",
    "NATURAL FULL JOIN": "full",
}
SWAPPED_KINDS = {"RIGHT SEMI JOIN": "left_semi", "RIGHT ANTI JOIN": "left_anti"}


def join_frames(left: DataFrame, right: DataFrame, kind: str, on=None) -> DataFrame:
    """Join by one of the thirteen kinds; AQE picks the strategy from measured sizes."""
    name = " ".join(kind.upper().split())
    if name in JOIN_KINDS:
        return left.join(right, on, JOIN_KINDS[name])
    if name in NATURAL_KINDS:
        return natural_join(left, right, NATURAL_KINDS[name])
    if name in SWAPPED_KINDS:
        return right.join(left, on, SWAPPED_KINDS[name])
    if name == "CROSS JOIN":
        return left.crossJoin(right)
    raise ValueError(f"unknown join kind: {kind}")


def natural_join(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    shared = [c for c in left.columns if c in right.columns]
    if not shared:
        raise ValueError("natural join needs a shared column name")
    return left.join(right, shared, how)


def conditional_left_join(left: DataFrame, right: DataFrame, flag: Column, on: Column) -> DataFrame:
    """All left rows; those with ``flag`` meet the right rows of ``on``, the others none."""
    return left.join(right, F.coalesce(flag, F.lit(False)) & on, "left")


def merge_one_to_one(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, each of which may stand in one row of either side; a repeated key ends the job.

    Each side is grouped by the keys, which the join then finds in place, so the check costs no
    further shuffle. Rows with a null key meet nothing and are not checked.
    """
    def once(df: DataFrame, name: str) -> DataFrame:
        rest = [c for c in df.columns if c not in keys]
        known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
        single = df.filter(known).groupBy(*keys).agg(F.count("*").alias("_n"), F.first(F.struct(F.lit(1).alias("_"), *rest)).alias("_r"))
        message = F.concat(F.lit(f"a key of the {name} side repeats: "), F.to_json(F.struct(*keys)))
        checked = single.filter(F.when(F.col("_n") == 1, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
        kept = checked.select(*keys, *[F.col("_r")[c].alias(c) for c in rest])
        return kept.unionByName(df.filter(~known).select(*keys, *rest)) if (name, how) in KEPT_SIDES else kept

    return once(left, "left").join(once(right, "right"), keys, how)


# sides whose rows without a key stay in the result
KEPT_SIDES = {("left", "left"), ("right", "right"), ("left", "full"), ("right", "full")}


def beside(left: DataFrame, right: DataFrame, keys: list[str], left_order: str, right_order: str, place: str = "place") -> DataFrame:
    """The n-th row of one side beside the n-th of the other, for each key; the longer side goes on alone."""
    a, b = (row_number_by(df, keys, [order], place) for df, order in ((left, left_order), (right, right_order)))
    return a.join(b, [*keys, place], "full")


def attach_one_row(df: DataFrame, one: DataFrame) -> DataFrame:
    """Add the columns of a one-row frame, such as run parameters or a grand total.

    A scalar subquery runs once and fails on a second row; no join is planned.
    """
    row = one.select(F.struct("*").alias("one")).scalar()
    return df.withColumn("_one", row).select(*df.columns, *[F.col("_one")[c].alias(c) for c in one.columns])


def in_subquery(df: DataFrame, column: str, other: DataFrame, other_column: str, negate: bool = False) -> DataFrame:
    """``IN`` / ``NOT IN`` over another table.

    As in SQL, a null in the listed values makes NOT IN keep no row, and a null
    value is kept only by NOT IN over an empty list.
    """
    listed = other.select(F.col(other_column).alias("_in"))
    if not negate:
        return df.join(listed, df[column] == listed["_in"], "left_semi")
    sizes = listed.agg(F.struct(F.count("*").alias("all"), F.count("_in").alias("known"))).scalar()
    kept = df.join(listed, df[column] == listed["_in"], "left_anti")
    no_null = (sizes["all"] == sizes["known"]) & F.col(column).isNotNull()
    return kept.filter((sizes["all"] == 0) | no_null)


def anti_by_basename(left: DataFrame, left_path: str, right: DataFrame, right_path: str, on: list[str]) -> DataFrame:
    """Rows of ``left`` whose file (by base name) and ``on`` columns are not in ``right``."""
    names = right.select(F.split_part(F.col(right_path), F.lit("/"), F.lit(-1)).alias("_base"), *on).distinct()
    keyed = left.withColumn("_base", F.split_part(F.col(left_path), F.lit("/"), F.lit(-1)))
    return keyed.join(names, ["_base", *on], "left_anti").select(*left.columns)


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the smallest ``order`` per key."""
    return _top_row(df, keys, [F.col(c).asc_nulls_last() for c in order], order)


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the largest ``order`` per key."""
    return _top_row(df, keys, [F.col(c).desc_nulls_last() for c in order], order)


def _top_row(df, keys, order, named):
    """``row_number() = 1``: Spark limits groups to one row before the shuffle, so a hot key stays small."""
    # the other sortable columns break ties, so the choice does not depend on row order
    ties = [F.col(f.name) for f in df.schema.fields
            if f.name not in (*keys, *named) and f.dataType.typeName() not in ("map", "variant")]
    window = Window.partitionBy(*keys).orderBy(*order, *ties)
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def sort_by(df: DataFrame, columns: list, ascending: list | None = None) -> DataFrame:
    """Sort; an ``ascending`` list wins over a direction a column already carries."""
    if ascending is None:
        return df.orderBy(*columns)
    return df.orderBy(*[
        plain(c).asc_nulls_last() if up else plain(c).desc_nulls_last()
        for c, up in zip(columns, ascending, strict=True)])


def page(df: DataFrame, order: list, limit: int, offset: int = 0) -> DataFrame:
    """Rows ``offset+1 .. offset+limit`` in order."""
    return df.orderBy(*order).offset(offset).limit(limit)


def deep_page(df: DataFrame, order: list, limit: int, offset: int) -> DataFrame:
    """The same rows by their rank, for offsets too deep for one task's heap."""
    ranked = global_rank(df, order, "_rank")
    return ranked.filter(F.col("_rank").between(offset + 1, offset + limit)).drop("_rank")


def anti_by_null(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """LEFT JOIN … WHERE right key IS NULL, planned as an anti join."""
    return left.join(right, left[left_key] == right[right_key], "left_anti")


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)
