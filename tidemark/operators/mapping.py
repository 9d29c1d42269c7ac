"""Source-to-target mappings kept as rows."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.relational import join_frames

MAPPING_SCHEMA = (
    "MAPPING_ID string, CONFIG_KEY string, CONFIG_VALUE string, TARGET_COLUMN string, "
    "TGT_ORDIANAL_POSITION int, SOURCE_COLUMN string, TRANSFORMATION string"
)


def alias_of(table: str) -> str:
    return table.split(".")[-1]


@dataclass(frozen=True)
class Join:
    """A joined table: by free text, or by pairs of (main column, joined column)."""

    table: str
    kind: str = "INNER JOIN"
    condition: str | None = None
    pairs: tuple[tuple[str, str], ...] = ()


@dataclass(frozen=True)
class Target:
    column: str
    source: str
    transformation: str = ""


@dataclass(frozen=True)
class Mapping:
    mapping_id: str
    target: str
    source: str
    joins: tuple[Join, ...] = ()
    columns: tuple[Target, ...] = field(default_factory=tuple)


def mapping_rows(spark: SparkSession, mapping: Mapping) -> DataFrame:
    """The mapping as rows to append to the metadata table; one id throughout."""
    rows = [("target_table_name", mapping.target, None, None, None, None), ("source_table_name", mapping.source, None, None, None, None)]
    rows += [("join_table_name", j.table, None, None, None, None) for j in mapping.joins]
    for j in mapping.joins:
        text = j.condition or " AND ".join(f"{alias_of(mapping.source)}.{a} = {alias_of(j.table)}.{b}" for a, b in j.pairs)
        on = f" ON {text}" if text else ""
        rows.append(("join_condition", f"{j.kind} {j.table} AS {alias_of(j.table)}{on}", None, None, None, None))
    rows += [("columns", None, c.column, i, c.source, c.transformation) for i, c in enumerate(mapping.columns, 1)]
    return spark.createDataFrame([(mapping.mapping_id, *r) for r in rows], MAPPING_SCHEMA)


WIDE_SCHEMA = (
    "TARGET_TABLE string, TARGET_COLUMN string, SOURCE_TABLE string, SOURCE_COLUMN string, TRANSFORMATION string, "
    "JOIN_CONDITION string, TARGET_ORDINAL_POSITION int"
)


def wide_rows(spark: SparkSession, mapping: Mapping) -> DataFrame:
    """The mapping in its wide form: a row for each target column, each with all joins, and none but its own source column."""
    long = mapping_rows(spark, mapping)
    joins = "; ".join(r["CONFIG_VALUE"] for r in long.filter("CONFIG_KEY = 'join_condition'").collect())
    rows = []
    for i, c in enumerate(mapping.columns, 1):
        short, _, column = c.source.rpartition(".")
        table = next((t for t in (mapping.source, *[j.table for j in mapping.joins]) if alias_of(t) == short), None)
        rows.append((mapping.target, c.column, table, "" if c.transformation else column, c.transformation, joins, i))
    rows.append((mapping.target, "", mapping.source, "", "", joins, None))
    return spark.createDataFrame(rows, WIDE_SCHEMA)


def long_rows(wide: DataFrame, mapping_id: str, target: str, source: str) -> DataFrame:
    """Wide rows of one target table as the rows that :func:`read_mapping` takes; ``source`` is the table the joins start from.

    A source column is named with its table where the row has one. Joins stand in every row; each counts once.
    """
    rows = wide.filter(F.col("TARGET_TABLE") == target)
    text = lambda c: F.nullif(F.btrim(c), F.lit(""))
    joins = rows.select(F.posexplode(F.split("JOIN_CONDITION", r"\s*;\s*")).alias("n", "join")).filter(text("join").isNotNull()) \
        .groupBy("join").agg(F.min("n").alias("n"))
    named = F.concat_ws(".", F.element_at(F.split(text("SOURCE_TABLE"), r"\."), -1), text("SOURCE_COLUMN"))
    keys = lambda key, value: [F.lit(key).alias("CONFIG_KEY"), value.alias("CONFIG_VALUE")]
    columns = rows.filter(text("TARGET_COLUMN").isNotNull()).select(
        *keys("columns", F.lit(None).cast("string")), "TARGET_COLUMN", F.col("TARGET_ORDINAL_POSITION").alias("TGT_ORDIANAL_POSITION"),
        F.when(text("SOURCE_COLUMN").isNotNull(), named).alias("SOURCE_COLUMN"), F.coalesce("TRANSFORMATION", F.lit("")).alias("TRANSFORMATION"))
    one = rows.select(F.lit(1)).limit(1)
    heads = [one.select(*keys("target_table_name", F.lit(target))), one.select(*keys("source_table_name", F.lit(source))),
             joins.select(*keys("join_condition", F.col("join")), F.col("n").cast("int").alias("TGT_ORDIANAL_POSITION"))]
    out = columns
    for head in heads:
        out = out.unionByName(head, allowMissingColumns=True)
    return out.select(F.lit(mapping_id).alias("MAPPING_ID"), *[c.split()[0] for c in MAPPING_SCHEMA.split(", ")[1:]])


# fixed: how a join is written in a mapping row
_JOIN = re.compile(r"^\s*(?P<kind>[A-Za-z ]*?JOIN)\s+(?P<table>\S+)(?:\s+AS\s+\S+)?(?:\s+ON\s+(?P<on>.+))?\s*$", re.I | re.S)


def read_mapping(mapping_df: DataFrame, mapping_id: str) -> Mapping:
    """One mapping from its rows, which are few and read once."""
    rows = mapping_df.filter(F.col("MAPPING_ID") == mapping_id).collect()
    if not rows:
        raise ValueError(f"no mapping {mapping_id}")
    value = {r["CONFIG_KEY"]: r["CONFIG_VALUE"] for r in rows}
    joins = []
    # rows of the wide form say the place of a join; others stand in order
    for r in sorted(rows, key=lambda r: r["TGT_ORDIANAL_POSITION"] or 0):
        if r["CONFIG_KEY"] == "join_condition":
            found = _JOIN.match(r["CONFIG_VALUE"])
            if not found:
                raise ValueError(f"unreadable join: {r['CONFIG_VALUE']}")
            joins.append(Join(found["table"], found["kind"], found["on"]))
    columns = sorted((r for r in rows if r["CONFIG_KEY"] == "columns"), key=lambda r: r["TGT_ORDIANAL_POSITION"])
    return Mapping(mapping_id, value["target_table_name"], value["source_table_name"], tuple(joins), tuple(
        Target(r["TARGET_COLUMN"], r["SOURCE_COLUMN"], (r["TRANSFORMATION"] or "").strip()) for r in columns))


def run_mapping(mapping_df: DataFrame, mapping_id: str, tables: dict[str, DataFrame]) -> DataFrame:
    """The mapped rows: transformed or plain columns in ordinal order.

    Every table is aliased by its short name, and Catalyst resolves the columns of a
    transformation, so an ambiguous name is an error in place of a wrong pick.
    """
    mapping = read_mapping(mapping_df, mapping_id)
    order = [mapping.source, *[j.table for j in mapping.joins]]
    frames = {alias_of(name): tables[name].alias(alias_of(name)) for name in order}
    joined = frames[alias_of(mapping.source)]
    for j in mapping.joins:
        joined = join_frames(joined, frames[alias_of(j.table)], j.kind, F.expr(j.condition) if j.condition else None)

    def plain(column: str):
        if "." in column:
            return F.col(column)
        for short, frame in frames.items():
            if column.lower() in (c.lower() for c in frame.columns):
                return F.col(f"{short}.{column}")
        raise ValueError(f"no source table has column {column}")

    return joined.select(*[
        (F.expr(c.transformation) if c.transformation else plain(c.source)).alias(c.column) for c in mapping.columns])


def preview(mapping_df: DataFrame, mapping_id: str, tables: dict[str, DataFrame], rows: int = 10) -> DataFrame:
    return run_mapping(mapping_df, mapping_id, tables).limit(rows)


def auto_map(spark: SparkSession, target: list[str], sources: dict[str, list[str]]) -> DataFrame:
    """Target columns matched to source columns by name without case; the first source wins."""
    rows = []
    for column in target:
        hits = [(table, c) for table, columns in sources.items() for c in columns if c.upper() == column.upper()]
        table, found = hits[0] if hits else (None, None)
        rows.append((column, table, found, len(hits) > 1))
    return spark.createDataFrame(rows, "target_column string, source_table string, source_column string, ambiguous boolean")


def join_display(left: DataFrame, right: DataFrame, right_name: str, condition: str, left_name: str = "left") -> DataFrame:
    """Join with repeated column names shown as COLUMN_TABLE."""
    a, b = left.alias(left_name), right.alias(right_name)
    return a.join(b, F.expr(condition)).select(
        *[F.col(f"{left_name}.{c}") for c in left.columns],
        *[F.col(f"{right_name}.{c}").alias(f"{c}_{right_name}" if c in left.columns else c) for c in right.columns])


def _fill(code: str, values: list[str]) -> str:
    """Put values into the empty argument places of a call, from left to right."""
    head, body = code.split("(", 1)
    waiting = list(values)
    arguments = [a.strip() or (waiting.pop(0) if waiting else "NULL") for a in body.rsplit(")", 1)[0].split(",")]
    return f"{head}({', '.join(arguments)})"


def transformation(column: str, stack: list[tuple]) -> str:
    """Expression text of functions applied inside out: the last of the stack is innermost.

    An entry is (code, type, further arguments…); a CASE template takes the condition
    built so far and, as further arguments, its two results.
    """
    text = column
    for code, kind, *others in reversed(stack):
        if kind == "wrapper":
            text = _fill(code, [text, *others])
        elif kind == "operator":
            text = f"{code}{text}"
        elif kind == "template":
            then, other = (*others, "NULL", "NULL")[:2]
            text = f"CASE WHEN {text} THEN {then} ELSE {other} END"
        elif kind == "function":
            text = code
        else:
            raise ValueError(f"unknown function type {kind}")
    return text
