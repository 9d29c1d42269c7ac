"""Tables and files written by jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.operators.relational import first_per_key


REQUIRED = "required.columns"


def ctas(df: DataFrame, name: str) -> None:
    df.write.mode("overwrite").saveAsTable(name)


def clone_schema(df: DataFrame, name: str) -> None:
    df.limit(0).write.mode("overwrite").saveAsTable(name)


def append(df: DataFrame, name: str) -> None:
    """Append after the compatibility check, by column name."""
    target = df.sparkSession.table(name)
    ok, reason = check_compatible(df.schema, target.schema)
    if not ok:
        raise ValueError(reason)
    full = df.select(*[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
                       for f in target.schema.fields])
    full.write.mode("append").insertInto(name)


def insert_select(df: DataFrame, name: str) -> None:
    """INSERT INTO … SELECT * by position."""
    df.write.mode("append").insertInto(name)


def unload_csv(df: DataFrame, path: str, header: bool = True, single: bool = False) -> None:
    """CSV parts, or by the caller's choice one file, which one task then writes. White space around values stays."""
    (df.coalesce(1) if single else df).write.mode("overwrite").csv(
        path, header=header, emptyValue="", escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def unload_lines(df: DataFrame, column: str, path: str, single: bool = False) -> None:
    """One text line per row: no escapes, no compression."""
    lines = df.select(F.col(column).cast("string").alias("value"))
    (lines.coalesce(1) if single else lines).write.mode("overwrite").option("compression", "none").text(path)


def write_dated(df: DataFrame, path: str, load_date: str, name: str) -> None:
    """``path/load_date=YYYYMMDD/name=…``, so readers prune by date."""
    stamped = df.withColumns({"load_date": F.lit(load_date.replace("-", "")), "name": F.lit(name)})
    stamped.write.mode("append").partitionBy("load_date", "name").parquet(path)


def new_rows(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows, one per key, whose key the target lacks."""
    rest = [c for c in source.columns if c not in keys]
    once = first_per_key(source, keys, rest) if rest else source.distinct()
    return once.join(target.select(*keys), keys, "left_anti").select(*source.columns)


def merge_new(name: str, source: DataFrame, keys: list[str]) -> None:
    """Insert-only merge into a table."""
    append(new_rows(source.sparkSession.table(name), source, keys), name)


def fits(source: T.DataType, target: T.DataType) -> bool:
    """Whether values of one type can be stored in the other without another meaning."""
    text, whole, real = (T.StringType, T.CharType, T.VarcharType), T.IntegralType, T.FractionalType
    if isinstance(source, text):
        return isinstance(target, text)
    if isinstance(source, T.DecimalType):
        return isinstance(target, T.DecimalType) and target.precision - target.scale >= source.precision - source.scale
    if isinstance(source, whole):
        return isinstance(target, (whole, real))
    if isinstance(source, real):
        return isinstance(target, real) and not isinstance(target, T.DecimalType)
    if isinstance(source, (T.TimestampType, T.TimestampNTZType)):
        return isinstance(target, (T.TimestampType, T.TimestampNTZType))
    if isinstance(source, (T.MapType, T.StructType)):
        return isinstance(target, (T.MapType, T.StructType))
    return type(source) is type(target)


def check_compatible(source: T.StructType, target: T.StructType) -> tuple[bool, str]:
    """Every source column exists in the target and fits it; all misfits are named."""
    kinds = {f.name: f.dataType for f in target.fields}
    unknown = [f"{f.name} is not in the target" for f in source.fields if f.name not in kinds]
    unlike = [f"{f.name}: {f.dataType.simpleString()} does not fit {kinds[f.name].simpleString()}"
              for f in source.fields if f.name in kinds and not fits(f.dataType, kinds[f.name])]
    return not unknown + unlike, "; ".join(unknown + unlike)


def create_from_spec(spark: SparkSession, name: str, spec) -> DataFrame:
    """An empty table from generator column specs, with their lengths, precisions and scales; one of that name is replaced.

    Longer texts and larger numbers than the columns hold are an error of the write.
    """
    from tidemark.functions.generate import spec_columns

    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name)", args={"name": name})
    # files keep no bound against nulls, so the table remembers its own
    required = ",".join(c.name for c in spec if not c.nullable)
    spark.sql(f"CREATE TABLE IDENTIFIER(:name) ({spec_columns(spec)}) USING parquet TBLPROPERTIES ('{REQUIRED}' = '{required}')", args={"name": name})
    return spark.table(name)


def insert_checked(df: DataFrame, name: str) -> None:
    """Append by column name; a value that its column can't hold, or a null where none may be, ends the write before a row is kept."""
    spark = df.sparkSession
    properties = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES IDENTIFIER(:name)", args={"name": name}).collect()}
    required = [c for c in properties.get(REQUIRED, "").split(",") if c]
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"columns without a value: {missing}")
    checked = df.select(*[F.when(F.col(c).isNull(), F.raise_error(F.lit(f"{c} is null"))).otherwise(F.col(c)).alias(c) if c in required else F.col(c) for c in df.columns])
    spark.sql("INSERT INTO IDENTIFIER(:name) BY NAME SELECT * FROM {rows}", args={"name": name}, rows=checked)
