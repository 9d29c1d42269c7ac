"""Columns and narrowest types of delimited files, per file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.session import spread_small
from tidemark.sources.tables import CsvFormat, read_file_lines

# narrowest first; a column takes the first type all its values fit
TYPES = ("bigint", "decimal(38,9)", "double", "date", "timestamp_ntz", "boolean")


def _fields(line: Column, fmt: CsvFormat) -> Column:
    """Fields of one record; quotes are taken off and doubled quotes undone."""
    q, d = fmt.quote, "\\Q" + fmt.delimiter + "\\E"
    pattern = f"({q}(?:[^{q}]|{q}{q})*{q}|(?:(?!{d}).)*){d}"
    raw = F.regexp_extract_all(F.concat(line, F.lit(fmt.delimiter)), F.lit(pattern), F.lit(1))
    return F.transform(raw, lambda f: F.when(
        f.startswith(q) & f.endswith(q) & (F.length(f) > 1),
        F.replace(F.substring(f, F.lit(2), F.length(f) - 2), F.lit(q + q), F.lit(q))).otherwise(f))


def _fits(value: Column, kind: str) -> Column:
    if kind.startswith("decimal"):
        return value.rlike(r"^\s*[+-]?[0-9]{1,29}(\.[0-9]{1,9})?\s*$")
    if kind == "date":
        return value.rlike(r"^\d{4}-\d{2}-\d{2}$") & value.try_cast("date").isNotNull()
    return value.try_cast(kind).isNotNull()


def infer_files(spark: SparkSession, path: str, fmt: CsvFormat = CsvFormat()) -> DataFrame:
    """FC(file, ordinal, column, type): one pass of map-side combined flags over all files."""
    rows = spread_small(read_file_lines(spark, path).filter(F.length("line") > 0)).select("file", "pos", _fields(F.col("line"), fmt).alias("fields"))
    first = rows.groupBy("file").agg(F.min(F.struct("pos", "fields")).alias("first"))
    first = first.select("file", F.col("first.pos").alias("first_pos"), F.col("first.fields").alias("names"))
    if not fmt.header:
        first = first.withColumn("names", F.transform("names", lambda _, i: F.concat(F.lit("c"), (i + 1).cast("string"))))
    named = first.select("file", F.posexplode("names").alias("place", "column"))
    cells = rows.select("file", "pos", F.posexplode("fields").alias("place", "value"))
    if fmt.header:
        # the first record of a file starts its first block
        cells = cells.join(first.select("file", "first_pos"), "file").filter(F.col("pos") != F.col("first_pos"))
    value = F.when(~F.col("value").isin("", *fmt.null_if), F.col("value"))
    flags = cells.groupBy("file", "place").agg(*[F.bool_and(_fits(value, kind)).alias(kind) for kind in TYPES])
    kind = F.coalesce(*[F.when(F.col(f"`{k}`"), F.lit(k.split("(")[0].removesuffix("_ntz"))) for k in TYPES], F.lit("string"))
    return named.join(flags, ["file", "place"], "left").select(
        "file", (F.col("place") + 1).alias("ordinal"), "column", kind.alias("type"))
