"""Tables, files and listings as DataFrames."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.sources import splits


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table, or a parquet path when the name holds a slash."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def sql(spark: SparkSession, text: str, **views: DataFrame) -> DataFrame:
    """SQL text over catalog tables and the frames passed by name."""
    return spark.sql(text, **views)


def from_rows(spark: SparkSession, rows: list[tuple], columns) -> DataFrame:
    return spark.createDataFrame(rows, columns)


def range_df(spark: SparkSession, start: int, end: int, step: int = 1, name: str = "id") -> DataFrame:
    return spark.range(start, end, step).toDF(name)


@dataclass(frozen=True)
class CsvFormat:
    """Delimited text: optional quotes, optional header, tokens read as null."""

    delimiter: str = ","
    quote: str = '"'
    header: bool = True
    null_if: tuple[str, ...] = ("NULL", "null")
    #: quoted fields may hold line breaks; records are then found by a scan of the quotes
    line_breaks: bool = False

    def options(self) -> dict[str, str]:
        return {"sep": self.delimiter, "quote": self.quote, "escape": self.quote, "header": str(self.header).lower()}


def read_text_columns(spark: SparkSession, path: str, names: list[str] | None, fmt: CsvFormat, **options: str) -> DataFrame:
    """All columns of delimited files as text; without ``names`` the header gives them.

    With ``line_breaks`` a file is still read in splits: lines are put together to records by the
    parity of the quotes before them. Quotes stand in quoted fields only, doubled inside them.
    """
    reader = spark.read.options(**fmt.options(), **options)
    if names is None:
        names = reader.csv(path).columns if fmt.header else None
    if names is None:
        raise ValueError("name the columns of files without a header")
    as_text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    if not fmt.line_breaks:
        return reader.schema(as_text).csv(path)
    records = splits.delimited_records(spark, path, fmt.quote)
    if fmt.header:
        records = records.where("record_no > 1")
    # a field may be as long as a text; the parser would stop at a million characters
    parsed = F.from_csv("record", ", ".join(f"`{n}` string" for n in names),
                        {**fmt.options(), **options, "header": "false", "lineSep": "\0", "maxCharsPerColumn": "-1", "emptyValue": "", "nullValue": "\u0001missing\u0001"})
    return records.select(parsed.alias("r")).select(*[F.col("r")[n].alias(n) for n in names])


def read_csv(spark: SparkSession, path: str, schema, fmt: CsvFormat = CsvFormat()) -> DataFrame:
    """CSV with a declared schema; null tokens are replaced before the cast to the declared type."""
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    rows = read_text_columns(spark, path, declared.names, fmt)
    return rows.select(*[
        F.when(~F.col(f.name).isin(*fmt.null_if), F.col(f.name)).cast(f.dataType).alias(f.name)
        for f in declared.fields
    ])


def list_files(spark: SparkSession, path: str, prefix: str = "", contains: str = "", md5: bool = False) -> DataFrame:
    """Files below ``path``: name after the prefix, size, time. Contents are read only for ``md5``."""
    root = path.rstrip("/") + "/"
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    relative = F.substring_index(F.col("path"), root, -1)
    columns = [F.col("path"), F.col("length").alias("size"), F.col("modificationTime").alias("last_modified")]
    if md5:
        columns.append(F.md5("content").alias("md5"))
    listed = found.select(*columns, relative.alias("relative_path"))
    kept = listed.filter(
        F.startswith(F.upper("relative_path"), F.lit(prefix.upper()))
        & F.contains(F.upper("relative_path"), F.lit(contains.upper()))
    )
    return kept.withColumn("file_name", F.substring(F.col("relative_path"), len(prefix) + 1, F.length("relative_path")))


def classify_files(df: DataFrame, name: str, patterns: dict[str, str]) -> DataFrame:
    """One column per pattern: the name where it matches without case, else null."""
    return df.select(*[F.when(F.col(name).ilike(p), F.col(name)).alias(c) for c, p in patterns.items()])


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Trimmed lines (doc_id, line_no, line) of report files, numbered from 0; large files are read in splits.

    A line ends at a line feed, a carriage return or both. A break at the end of a file begins no line.
    """
    lines = splits.numbered_lines(splits.block_lines(spark, path, separator=None))
    return lines.select(F.col("file").alias("doc_id"), "line_no", F.btrim("line").alias("line"))


def text_lines(df: DataFrame, doc: str, text: str) -> DataFrame:
    """Trimmed lines (doc, line_no, line) of a text column."""
    lines = F.split(F.regexp_replace(F.col(text), "\r\n?", "\n"), "\n")
    return df.select(F.col(doc), F.posexplode(lines).alias("line_no", "line")).withColumn("line", F.btrim("line"))


def read_file_lines(spark: SparkSession, path: str | DataFrame) -> DataFrame:
    """Lines (file, pos, line) of files of any size, below a path or, for very many, listed in a frame (path, size).

    Large files are read in splits; ``pos`` (block offset, place in the task) orders
    the lines of one file without numbering them.
    """
    lines = splits.listed_lines(path) if isinstance(path, DataFrame) else splits.block_lines(spark, path, separator=None)
    return lines.select("file", F.struct("block", "place").alias("pos"), "line")


def history(df: DataFrame, time: str, *, tag: Column | None = None, since=None, limit: int | None = None) -> DataFrame:
    """Log rows by tag or start time, newest first; a page of them where ``limit`` asks for one."""
    if tag is not None:
        df = df.filter(tag)
    if since is not None:
        df = df.filter(F.col(time) >= F.lit(since))
    others = [F.col(c) for c in df.columns if c != time]
    ordered = df.orderBy(F.col(time).desc(), *others)
    return ordered if limit is None else ordered.limit(limit)


def sample_rows(df: DataFrame, n: int) -> DataFrame:
    return df.limit(n)


def describe_columns(df: DataFrame) -> DataFrame:
    """(ordinal, column_name, data_type, nullable) of a frame."""
    rows = [(i + 1, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "ordinal int, column_name string, data_type string, nullable boolean")


def describe_table(spark: SparkSession, name: str) -> DataFrame:
    """(ordinal, column_name, data_type, nullable) of a catalog table as it was declared, lengths of texts included."""
    declared = {r.col_name: r.data_type for r in spark.sql("DESCRIBE TABLE IDENTIFIER(:name)", args={"name": name}).collect()}
    rows = [(i + 1, c.name, declared[c.name], c.nullable) for i, c in enumerate(spark.catalog.listColumns(name))]
    return spark.createDataFrame(rows, "ordinal int, column_name string, data_type string, nullable boolean")
