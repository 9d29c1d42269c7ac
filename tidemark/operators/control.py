"""Load control: trailers, routing, arrivals, not-yet-loaded files, job log, settings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.sources import splits

FIELD_SEPARATOR = '"|"'
SUCCESS, FAILED = 1, 3
# fixed: texts of the job log that its readers look for
TRAILERS_FAILED = "ERROR: Trailer validation failed on {} files:\n"
TRAILERS_FINE = "INFO: Trailer validation for the {} was successful"
NO_FILE = "Source file is missing."


def _split(column: Column, separator: str) -> Column:
    return F.split(column, "\\Q" + separator + "\\E", -1)


def validate_trailers(
    lines: DataFrame, account_date: str, separator: str = FIELD_SEPARATOR,
    file: str = "file", pos: str = "pos", line: str = "line",
) -> DataFrame:
    """Per file, the trailer's date and record count against the account date and the records found.

    The count includes header and trailer. One map-side combined aggregate over all
    files; ``pos`` may be any sortable column, so large files need no line numbers.
    """
    per_file = lines.groupBy(file).agg(F.count("*").alias("record_count"), F.max_by(line, pos).alias("trailer"))
    fields = _split(F.col("trailer"), separator)
    field = lambda i: F.btrim(F.get(fields, F.lit(i)), F.lit('" '))
    found = per_file.select(
        file, "record_count",
        F.replace(field(2), F.lit("-"), F.lit("")).alias("trailer_date"), field(3).try_cast("bigint").alias("trailer_count"))
    date = F.lit(account_date.replace("-", ""))
    unreadable = F.col("trailer_date").isNull() | F.col("trailer_count").isNull()
    parts = F.concat_ws(
        " | ",
        F.when(F.col("trailer_date") != date, F.concat(F.lit("date "), F.col("trailer_date"), F.lit("||"), date)),
        F.when(F.col("trailer_count") != F.col("record_count"),
               F.concat(F.lit("counts "), F.col("trailer_count").cast("string"), F.lit("||"), F.col("record_count").cast("string"))))
    error = F.when(unreadable, F.lit("runtime_error: no trailer")).when(parts != "", parts)
    return found.withColumn("error", error).withColumn(
        "status", F.when(F.col("error").isNull(), SUCCESS).otherwise(FAILED))


def _hits(name: Column, patterns: list[str]) -> Column:
    return sum((F.when(F.contains(name, F.lit(p)), 1).otherwise(0) for p in patterns), F.lit(0))


def route_files(
    files: DataFrame, name: str, out_of_scope: list[str], special: list[str],
    delimiter: str = FIELD_SEPARATOR, special_delimiter: str = "|",
) -> DataFrame:
    """Route of each file: checked, checked with the special delimiter, or skipped."""
    base = F.split_part(F.col(name), F.lit("/"), F.lit(-1))
    out = _hits(base, out_of_scope) if delimiter == FIELD_SEPARATOR else F.lit(0)
    spl = _hits(base, special) if special_delimiter == "|" else F.lit(0)
    routed = files.withColumns({"out_hits": out, "special_hits": spl})
    return routed.withColumn(
        "route", F.when(F.col("out_hits") == 0, "default").when(F.col("special_hits") > 0, "special").otherwise("skipped"))


def run_summary(checked: DataFrame, routed: DataFrame, snap_date: str, file: str = "file") -> DataFrame:
    """One log row for a validation run over all its files."""
    totals = checked.agg(
        F.count(F.when(F.col("status") == FAILED, 1)).alias("failed"),
        F.array_join(F.array_sort(F.collect_list(F.when(
            F.col("status") == FAILED, F.concat(F.col(file), F.lit(": "), F.col("error"))))), "\n").alias("lines"))
    counts = routed.agg(F.count("*").alias("source_cnt"), F.sum(F.col("out_hits") - F.col("special_hits")).alias("skipped_cnt"))
    row = totals.withColumn("c", counts.select(F.struct("*")).scalar())
    bad = F.col("failed") > 0
    return row.select(
        F.col("c.source_cnt").alias("source_cnt"), (F.col("c.source_cnt") - F.col("failed")).alias("target_cnt"),
        "failed", F.col("c.skipped_cnt").alias("skipped_cnt"), F.when(bad, FAILED).otherwise(SUCCESS).alias("status"),
        F.when(bad, F.concat(F.replace(F.lit(TRAILERS_FAILED), F.lit("{}"), F.col("failed").cast("string")), F.col("lines")))
        .otherwise(TRAILERS_FINE.format(snap_date)).alias("message"))


def arrival_sla(log: DataFrame, as_of, day: int) -> DataFrame:
    """Monthly files: arrived within 24 hours, or failed on their scheduled day; others give no row."""
    as_of = F.lit(as_of)
    arrived = F.col("FILE_ENDTIME_EST") >= as_of - F.expr("INTERVAL 24 HOURS")
    sched = F.col("DAY_OF_EMAIL").cast("int")
    rows = (
        log.filter(F.col("LOAD_DATE").isNotNull() & (F.upper("SOURCE_FREQ") == "MONTHLY"))
        .withColumn("_in", F.coalesce(arrived, F.lit(False)))
        # an end time that is null has neither arrived nor failed
        .filter(F.col("_in") | ((sched == day) & F.col("FILE_ENDTIME_EST").isNotNull() & ~F.col("_in")))
    )
    if_in = lambda c, other: F.when(F.col("_in"), F.col(c)).otherwise(other)
    return rows.select(
        F.to_date(as_of).alias("LOAD_DATE"), "SOURCE_FREQ", "LOAD_DATA_CATEGORY",
        if_in("ACCOUNTING_DATE", None).alias("ACCOUNTING_DATE"), if_in("SOURCE_FILE_NAME", "**").alias("SOURCE_FILE_NAME"),
        if_in("TARGET_NAME", "**").alias("TARGET_NAME"), if_in("SOURCE_RECORDS", 0).alias("SOURCE_RECORDS"),
        if_in("TARGET_RECORDS", 0).alias("TARGET_RECORDS"),
        F.when(F.col("_in"), "Success").otherwise("Failed").alias("LOAD_STATUS"),
        F.when(F.col("_in"), "").otherwise(NO_FILE).alias("ERROR_MESSAGE"),
        sched.alias("DAY_OF_EMAIL"), "ETL_INSERT_TIMESTAMP", if_in("FILE_ENDTIME_EST", None).alias("FILE_ENDTIME_EST"))


def not_loaded(listing: DataFrame, name: str, log: DataFrame, category: str) -> DataFrame:
    """Listed files without a successful log row of the category."""
    loaded = log.filter((F.col("task_flow_status") == SUCCESS) & (F.col("load_data_category") == category)).select("src_name").distinct()
    return listing.join(loaded, listing[name] == loaded["src_name"], "left_anti")


AUDIT_SCHEMA = (
    "JOB_ID string, LOAD_DATE date, LOAD_DATA_CATEGORY string, TASKFLOW_NAME string, ACCOUNT_DATE date, SRC_NAME string, "
    "TGT_NAME string, TOT_SRC_CNT long, TOT_TGT_CNT long, TOT_SRC_SKIP long, START_TIME timestamp, END_TIME timestamp, "
    "TASK_FLOW_STATUS int, ERROR_MSG string, ETL_USER string, SRC_FREQ string"
)


def audit_rows(spark: SparkSession, runs: list[dict]) -> DataFrame:
    """Job log rows: status 1 and SUCCESS, or status 3 and the error. One row per run of the caller."""
    schema = T.StructType.fromDDL(AUDIT_SCHEMA)
    rows = []
    for run in runs:
        error = run.get("error")
        row = {**run, "TASK_FLOW_STATUS": FAILED if error else SUCCESS, "ERROR_MSG": error or "SUCCESS"}
        rows.append(tuple(row.get(f.name) for f in schema.fields))
    return spark.createDataFrame(rows, schema)


# fixed: setting name → result column
CONFIG_COLUMNS = {
    "STAGE": "STAGE",
    "PATH": "PATH",
    "TABLE": "TARGET_TABLE",
    "FILE_FORMAT": "FILE_FORMAT",
    "PATTERN": "PATTERN",
    "ON_ERROR": "ON_ERROR",
    "PURGE": "PURGE",
    "FORCE": "FORCE",
}


def load_config(
    config: DataFrame, project: str, file: str, kind: str = "COPY", columns: dict[str, str] | None = None
) -> DataFrame:
    """Enabled key/value settings of one file as one row."""
    kept = config.filter(
        (F.col("PROJECT_NAME") == project) & (F.col("FILE_NAME") == file) & (F.col("CONFIG_TYPE") == kind) & F.col("ENABLED"))
    return kept.agg(*[F.max(F.when(F.col("CONFIG_NAME") == n, F.col("CONFIG_VALUE"))).alias(c)
                      for n, c in (columns or CONFIG_COLUMNS).items()])


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Records (file, kind, record) of H/D/T files whose fields may hold line breaks.

    The data marker after a line break is the record separator of the reader, so large
    files split over tasks. Text before the first marker is the header; a trailer ends
    the last piece.
    """
    piece = spark.read.text(path, lineSep='\nD"|').select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"), "value")
    # only the piece at the file's beginning still has its own marker; later ones begin inside a data record
    first = piece.filter("block = 0").groupBy("file").agg(F.min("place").alias("first_place"))
    piece = piece.join(first, "file", "left")
    at_start = F.coalesce((F.col("block") == 0) & (F.col("place") == F.col("first_place")), F.lit(False))
    start = F.when(at_start, F.regexp_extract("value", r'^([HT])"\|', 1)).otherwise("")
    parts = F.split("value", r'\r?\nT"\|', 2)
    body = F.when(start == "H", parts[0]).when(start == "T", F.lit(None)) \
        .otherwise(F.when(at_start & parts[0].startswith('D"|'), parts[0]).otherwise(F.concat(F.lit('D"|'), parts[0])))
    trailer = F.when(start == "T", F.col("value")).otherwise(F.concat(F.lit('T"|'), F.get(parts, F.lit(1))))
    rows = F.array(
        F.struct(F.when(start == "H", "H").otherwise("D").alias("kind"), _flat(body).alias("record")),
        F.struct(F.lit("T").alias("kind"), _flat(trailer).alias("record")))
    return (piece.select("file", F.struct("block", "place").alias("pos"), F.explode(rows).alias("r"))
            .select("file", "pos", "r.kind", "r.record").filter(F.col("record").isNotNull()))


def _flat(text: Column) -> Column:
    return F.btrim(F.regexp_replace(text, r"[\r\n]+", " "))


def quoted_records(spark: SparkSession, path: str) -> DataFrame:
    """Records (file, record_no, kind, record) of H/D/T files, where a marker counts only after a closed field.

    A record starts at a line that begins with a marker while no quoted field is open; quotes inside fields are doubled. The
    quote of a marker that starts a record opens nothing; where a field ends with such a letter on a line of its
    own, its quote closes the field. So behind either the other quotes of the line alone say what is open.
    Large files are read in splits. Text before the first marker is no record.
    """
    marker = F.col("line").rlike(r'^[HDT]"\|')
    rest = F.when(marker, F.substring("line", 3, F.char_length("line"))).otherwise(F.col("line"))
    lines = splits.record_lines(splits.block_lines(spark, path), splits.count_of(rest, '"'), marker, resets=marker)
    records = splits.joined_records(lines)
    return records.select("file", "record_no", F.left("record", F.lit(1)).alias("kind"), _flat(F.col("record")).alias("record"))
