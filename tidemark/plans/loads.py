"""Checked queries over schema drift, load control, sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import control, drift
from tidemark.operators.ranks import last_so_far, ordered_scan
from tidemark.plans.registry import query
from tidemark.session import work_path
from tidemark.sinks import writers
from tidemark.sources import inference, tables as src


# --- drift: part brand stands for the file, part size for the column ---------------

def fc(t):
    return t.part.select(F.concat(F.lit("in/"), "p_brand", F.lit(".csv")).alias("file"),
                         F.col("p_size").alias("ordinal"), F.concat(F.lit("c"), F.lpad(F.col("p_size").cast("string"), 2, "0")).alias("column"),
                         F.lit("string").alias("type"))


def even(t):
    """A consistent set: every market segment has customers of each fifth of the nations."""
    part = F.floor(F.col("c_nationkey") / 5)
    return t.customer.select(F.col("c_mktsegment").alias("file"), part.alias("ordinal"),
                             F.concat(F.lit("n"), part.cast("string")).alias("column"), F.lit("int").alias("type"))


_FC = "(SELECT DISTINCT 'in/' || p_brand || '.csv' AS file, 'c' || lpad(CAST(p_size AS VARCHAR), 2, '0') AS col FROM part)"
_EVEN = "(SELECT DISTINCT c_mktsegment AS file, 'n' || (c_nationkey // 5) AS col FROM customer)"
_INFO = f"(SELECT col, count(*) AS n FROM {_FC} GROUP BY col)"
_FILES = f"(SELECT count(DISTINCT file) FROM {_FC})"
_MISSING = f"""(SELECT f.file, c.col FROM (SELECT DISTINCT file FROM {_FC}) f CROSS JOIN (SELECT DISTINCT col FROM {_FC}) c
 WHERE NOT EXISTS (SELECT 1 FROM {_FC} x WHERE x.file = f.file AND x.col = c.col))"""


@query("sd2_columns_by_files", f"""
SELECT col AS "column", string_agg(file, ',' ORDER BY file) AS files, count(*) AS file_count FROM {_FC} GROUP BY col""")
def _(t):
    return drift.columns_by_files(fc(t))


@query("sd3_column_count", f"SELECT count(DISTINCT col) AS column_count FROM {_FC} WHERE file IN ('in/Brand#1.csv', 'in/Brand#2.csv')")
def _(t):
    return drift.column_count(fc(t), ["in/Brand#1.csv", "in/Brand#2.csv"])


_SUMMARY = """
WITH fc AS (SELECT * FROM {fc}), i AS (SELECT col, count(*) AS n FROM fc GROUP BY col),
v AS (SELECT count(*) AS total_columns, min(n) AS min_file_count, max(n) AS max_file_count,
             (SELECT count(DISTINCT file) FROM fc) AS expected_file_count FROM i)
SELECT *, CASE WHEN min_file_count < max_file_count THEN 'uneven' WHEN max_file_count = expected_file_count THEN 'even' ELSE 'short' END AS validation_status FROM v"""


@query("sd4_validation_summary", _SUMMARY.format(fc=_FC))
def _(t):
    return drift.validation_summary(fc(t))


@query("sd4_validation_summary_even", _SUMMARY.format(fc=_EVEN))
def _(t):
    return drift.validation_summary(even(t))


@query("sd5_partial_columns", f"""
SELECT col AS "column", count(*) AS appears_in_files, {_FILES} AS expected_files, {_FILES} - count(*) AS missing_from,
       string_agg(file, ',' ORDER BY file) AS files_containing_column FROM {_FC} GROUP BY col HAVING count(*) < {_FILES}""")
def _(t):
    return drift.partial_columns(fc(t))


@query("sd6_missing_by_file", f"""
SELECT file, count(*) AS num_missing_columns, string_agg(col, ', ' ORDER BY col) AS missing_columns FROM {_MISSING} GROUP BY file""")
def _(t):
    return drift.missing_by_file(fc(t))


@query("sd7_expected_vs_actual", f"""
SELECT 7 AS expected_columns, count(DISTINCT col) AS actual_columns,
       CASE WHEN count(DISTINCT col) = 7 THEN 'equal' ELSE 'different' END AS validation_status FROM {_FC}""")
def _(t):
    return drift.expected_vs_actual(fc(t), [*t.part.columns, "p_comment", "etl_user", "source_file_name"])


@query("sd8_count_or_partial", f"""
SELECT CASE WHEN min(n) = max(n) THEN CAST(count(*) AS VARCHAR) ELSE
  (SELECT string_agg(col, ', ' ORDER BY col) FROM {_INFO} WHERE n <> (SELECT max(n) FROM {_INFO})) END AS result FROM {_INFO}""")
def _(t):
    return drift.count_or_partial(fc(t))


@query("sd9_compare_to_table", f"""
SELECT string_agg(upper(col), ', ' ORDER BY upper(col)) AS result FROM (SELECT DISTINCT col FROM {_FC}) WHERE col NOT IN ('c01', 'c02', 'c03')""")
def _(t):
    return drift.compare_to_table(fc(t), ["c01", "C02", "c03", "ETL_USER"])


@query("sd10_summary_or_mismatches", f"""
SELECT CAST(NULL AS VARCHAR) AS validation_result, col AS missing_column, n || ' / ' || {_FILES} || ' files' AS file_count_mismatch
FROM {_INFO} WHERE n < {_FILES}
UNION ALL SELECT 'even: ' || {_FILES} || ' files, ' || count(*) || ' columns', NULL, NULL FROM {_INFO}
HAVING min(n) = max(n) AND min(n) = {_FILES}""")
def _(t):
    return drift.summary_or_mismatches(fc(t))


@query("sd10_summary_or_counts_even", f"""
SELECT 'even: ' || count(DISTINCT file) || ' files, ' || count(DISTINCT col) || ' columns' AS result, CAST(NULL AS VARCHAR) AS column_name, CAST(NULL AS BIGINT) AS file_count FROM {_EVEN}
WHERE (SELECT min(n) FROM (SELECT count(*) AS n FROM {_EVEN} GROUP BY col)) = (SELECT count(DISTINCT file) FROM {_EVEN})""")
def _(t):
    return drift.summary_or_counts(even(t))


@query("sd11_summary_or_missing", f"SELECT CAST(NULL AS VARCHAR) AS result, file AS file_name, col AS missing_column FROM {_MISSING} "
       f"UNION ALL SELECT 'even: ' || {_FILES} || ' files, ' || count(*) || ' columns', NULL, NULL FROM {_INFO} HAVING min(n) = max(n) AND min(n) = {_FILES}")
def _(t):
    return drift.summary_or_missing(fc(t))


@query("sd12_files_short_of_total", f"""
SELECT file FROM {_FC} GROUP BY file HAVING count(*) < (SELECT count(DISTINCT col) FROM {_FC})""")
def _(t):
    return drift.files_short_of(fc(t))


@query("sd12_files_short_of_best", f"""
SELECT file FROM {_FC} GROUP BY file HAVING count(*) < (SELECT max(n) FROM (SELECT count(*) AS n FROM {_FC} GROUP BY file))""")
def _(t):
    return drift.files_short_of(fc(t), best=True)


@query("sd14_files_with_partial_column", f"SELECT DISTINCT file FROM {_FC} WHERE col IN (SELECT col FROM {_INFO} WHERE n < {_FILES})")
def _(t):
    return drift.files_with_partial_column(fc(t))


def _drift_folder(t):
    """Two slices of customers, one with an extra column, and one of orders, as CSV."""
    root = work_path(t.spark, "drift")
    slices = {
        "customer-1": t.customer.filter("c_custkey % 2 = 0"),
        "customer-2": t.customer.filter("c_custkey % 2 = 1").select(F.lit("x, \"y\"").alias("extra"), "*"),
        "orders-1": t.orders,
    }
    for name, frame in slices.items():
        writers.unload_csv(frame, f"{root}/{name}")
    return root


_FOLDER = lambda c: F.regexp_extract(c, "(customer-1|customer-2|orders-1)/", 1)


@query("sd1_infer_files", """
SELECT * FROM (VALUES ('customer-1', 1, 'c_custkey', 'bigint'), ('customer-1', 2, 'c_name', 'string'), ('customer-1', 3, 'c_nationkey', 'bigint'),
 ('customer-1', 4, 'c_acctbal', 'decimal'), ('customer-1', 5, 'c_mktsegment', 'string'), ('customer-2', 1, 'extra', 'string'),
 ('customer-2', 2, 'c_custkey', 'bigint'), ('customer-2', 3, 'c_name', 'string'), ('customer-2', 4, 'c_nationkey', 'bigint'),
 ('customer-2', 5, 'c_acctbal', 'decimal'), ('customer-2', 6, 'c_mktsegment', 'string'), ('orders-1', 1, 'o_orderkey', 'bigint'),
 ('orders-1', 2, 'o_custkey', 'bigint'), ('orders-1', 3, 'o_orderstatus', 'string'), ('orders-1', 4, 'o_totalprice', 'decimal'),
 ('orders-1', 5, 'o_orderdate', 'timestamp'), ('orders-1', 6, 'o_orderpriority', 'string')) v(folder, ordinal, "column", type)""")
def _(t):
    found = inference.infer_files(t.spark, _drift_folder(t) + "/*")
    return found.select(_FOLDER("file").alias("folder"), "ordinal", "column", "type").distinct()


@query("sd13_columns_with_listing", """
SELECT 'customer-1' AS folder, 5 AS "columns", true AS listed UNION ALL SELECT 'customer-2', 6, true UNION ALL SELECT 'orders-1', 6, true""")
def _(t):
    root = _drift_folder(t)
    listing = src.list_files(t.spark, root, contains=".csv").select(F.col("path").alias("relative_path"), "size", "last_modified")
    joined = drift.with_listing(inference.infer_files(t.spark, root + "/*"), listing)
    return joined.groupBy(_FOLDER("file").alias("folder")).agg(
        F.count_distinct("column").cast("int").alias("columns"), F.bool_and(F.col("size") > 0).alias("listed"))


# --- load control -----------------------------------------------------------------

def control_lines(t):
    """One H/D/T file per order priority; the trailer of one counts short, another is dated wrong."""
    data = t.orders.select(
        F.col("o_orderpriority").alias("file"), (F.col("o_orderkey") + 1).alias("pos"),
        F.concat_ws('"|"', F.lit("D"), F.col("o_orderkey").cast("string"), F.col("o_orderstatus")).alias("line"))
    ends = t.orders.groupBy(F.col("o_orderpriority").alias("file")).agg(F.count("*").alias("n"), F.max("o_orderkey").alias("top"))
    header = ends.select("file", F.lit(0).cast("bigint").alias("pos"), F.lit('H"|"orders"|"2002-01-01"').alias("line"))
    count = F.col("n") + F.when(F.col("file").startswith("3"), 1).otherwise(2)
    date = F.when(F.col("file").startswith("5"), "2001-12-31").otherwise("2002-01-01")
    trailer = ends.select("file", (F.col("top") + 2).alias("pos"),
                          F.concat(F.lit('T"|"orders"|"'), date, F.lit('"|"'), count.cast("string"), F.lit('"')).alias("line"))
    return data.union(header).union(trailer)


_TRAILERS = """(SELECT file, record_count, CASE WHEN file LIKE '5%' THEN '20011231' ELSE '20020101' END AS trailer_date,
  record_count - CASE WHEN file LIKE '3%' THEN 1 ELSE 0 END AS trailer_count,
  CASE WHEN file LIKE '5%' THEN 'date 20011231||20020101' WHEN file LIKE '3%' THEN 'counts ' || (record_count - 1) || '||' || record_count END AS error,
  CASE WHEN file LIKE '5%' OR file LIKE '3%' THEN 3 ELSE 1 END AS status
  FROM (SELECT o_orderpriority AS file, count(*) + 2 AS record_count FROM orders GROUP BY 1))"""


@query("ops1_validate_trailers", f"SELECT * FROM {_TRAILERS}")
def _(t):
    return control.validate_trailers(control_lines(t), "2002-01-01")


def _routes(t):
    names = t.part.select(F.concat(F.lit("in/"), "p_name", F.lit(".csv")).alias("file"))
    return control.route_files(names, "file", ["red", "bolt"], ["large", "red w"])


_ROUTES = """(SELECT file, CAST(contains(file, 'red') AS INT) + CAST(contains(file, 'bolt') AS INT) AS out_hits,
  CAST(contains(file, 'large') AS INT) + CAST(contains(file, 'red w') AS INT) AS special_hits
  FROM (SELECT 'in/' || p_name || '.csv' AS file FROM part))"""


@query("ops2_route_files", f"""
SELECT *, CASE WHEN out_hits = 0 THEN 'default' WHEN special_hits > 0 THEN 'special' ELSE 'skipped' END AS route FROM {_ROUTES}""")
def _(t):
    return _routes(t)


@query("ops3_run_summary", f"""
SELECT r.n AS source_cnt, r.n - f.failed AS target_cnt, f.failed, r.skipped AS skipped_cnt, 3 AS status,
  'ERROR: Trailer validation failed on ' || f.failed || ' files:' || chr(10) || f.lines AS message
FROM (SELECT count(*) AS n, CAST(sum(out_hits - special_hits) AS BIGINT) AS skipped FROM {_ROUTES}) r,
     (SELECT count(*) AS failed, string_agg(file || ': ' || error, chr(10) ORDER BY file) AS lines FROM {_TRAILERS} WHERE status = 3) f""")
def _(t):
    return control.run_summary(control.validate_trailers(control_lines(t), "2002-01-01"), _routes(t), "2002-01-01")


def arrivals(t):
    return t.events.select(
        F.to_date("ts").alias("LOAD_DATE"), F.when(F.col("event_type") == "click", "Daily").otherwise("Monthly").alias("SOURCE_FREQ"),
        F.col("event_type").alias("LOAD_DATA_CATEGORY"), F.date_format("ts", "yyyy-MM-dd").alias("ACCOUNTING_DATE"),
        F.concat(F.lit("f"), F.col("event_id").cast("string")).alias("SOURCE_FILE_NAME"), F.lit("tgt").alias("TARGET_NAME"),
        F.col("user_id").alias("SOURCE_RECORDS"), F.col("user_id").alias("TARGET_RECORDS"), (F.col("event_id") % 28 + 1).alias("DAY_OF_EMAIL"),
        F.col("ts").alias("ETL_INSERT_TIMESTAMP"), F.col("ts").alias("FILE_ENDTIME_EST"))


_AS_OF = "2024-01-20 12:00:00"


@query("ops4_arrival_sla", f"""
WITH f AS (SELECT *, ts >= TIMESTAMP '{_AS_OF}' - INTERVAL 24 HOUR AS arrived, event_id % 28 + 1 AS sched FROM events WHERE event_type <> 'click')
SELECT '2024-01-20' AS load_day, event_type AS LOAD_DATA_CATEGORY, CASE WHEN arrived THEN strftime(ts, '%Y-%m-%d') END AS ACCOUNTING_DATE,
  CASE WHEN arrived THEN 'f' || event_id ELSE '**' END AS SOURCE_FILE_NAME, CASE WHEN arrived THEN user_id ELSE 0 END AS SOURCE_RECORDS,
  CASE WHEN arrived THEN 'Success' ELSE 'Failed' END AS LOAD_STATUS, CASE WHEN arrived THEN '' ELSE 'Source file is missing.' END AS ERROR_MESSAGE,
  CAST(sched AS INT) AS DAY_OF_EMAIL FROM f WHERE arrived OR sched = 20""")
def _(t):
    report = control.arrival_sla(arrivals(t), F.lit(_AS_OF).cast("timestamp_ntz"), 20)
    return report.select(F.date_format("LOAD_DATE", "yyyy-MM-dd").alias("load_day"), "LOAD_DATA_CATEGORY", "ACCOUNTING_DATE", "SOURCE_FILE_NAME",
                         "SOURCE_RECORDS", "LOAD_STATUS", "ERROR_MESSAGE", "DAY_OF_EMAIL")


@query("ops5_not_loaded", """
SELECT 'zip/' || o_orderkey AS name FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'O')""")
def _(t):
    zipped = lambda c: F.concat(F.lit("zip/"), F.col(c).cast("string"))
    log = t.lineitem.select(zipped("l_orderkey").alias("src_name"), F.when(F.col("l_returnflag") == "R", 1).otherwise(3).alias("task_flow_status"),
                            F.col("l_linestatus").alias("load_data_category"))
    return control.not_loaded(t.orders.select(zipped("o_orderkey").alias("name")), "name", log, "O")


@query("ops7_load_config", """
SELECT CAST(max(CASE WHEN o_orderpriority = '1-URGENT' THEN v END) AS VARCHAR) AS urgent, CAST(max(CASE WHEN o_orderpriority = '5-LOW' THEN v END) AS VARCHAR) AS low
FROM (SELECT o_orderpriority, o_custkey || '/' || o_orderkey AS v FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 1000)""")
def _(t):
    config = t.orders.select(
        F.lit("demo").alias("PROJECT_NAME"), F.col("o_orderstatus").alias("FILE_NAME"), F.lit("COPY").alias("CONFIG_TYPE"),
        F.col("o_orderpriority").alias("CONFIG_NAME"), F.expr("o_custkey || '/' || o_orderkey").alias("CONFIG_VALUE"),
        (F.col("o_totalprice") > 1000).alias("ENABLED"))
    return control.load_config(config, "demo", "F", columns={"1-URGENT": "urgent", "5-LOW": "low"})


@query("ag8_conditional_max_pivot", """
SELECT o_orderstatus, max(CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice END) AS urgent,
       max(CASE WHEN o_orderpriority = '5-LOW' THEN o_totalprice END) AS low FROM orders GROUP BY o_orderstatus""")
def _(t):
    return (t.orders.groupBy("o_orderstatus").pivot("o_orderpriority", ["1-URGENT", "5-LOW"]).agg(F.max("o_totalprice"))
            .withColumnsRenamed({"1-URGENT": "urgent", "5-LOW": "low"}))


def _record_text(t):
    """Each conversation turn as a data record whose text keeps its line breaks."""
    return F.concat(F.lit('D"|"'), F.col("conv_id").cast("string"), F.lit('"|"'), F.col("turn").cast("string"), F.lit('"|"'),
                    F.replace(F.col("text"), F.lit('"'), F.lit("'")), F.lit('"'))


_RECORD = """'D"|"' || conv_id || '"|"' || turn || '"|"' || trim(regexp_replace(replace(text, '"', ''''), '[\\r\\n]+', ' ', 'g')) || '"'"""


@query("ops8_reassemble_records", f"""
SELECT 'D' AS kind, {_RECORD} AS record FROM conversations""")
def _(t):
    path = work_path(t.spark, "records")
    writers.unload_lines(t.conversations.select(_record_text(t).alias("r")), "r", path)
    clean = F.regexp_replace("record", r'(\|"|^) +| +(?="$)', "$1")
    return control.read_records(t.spark, path).select("kind", clean.alias("record"))


@query("ops9_quoted_records", """
SELECT 'D' AS kind, regexp_replace('D"|"' || conv_id || '"|"' || turn || '"|"x' || chr(10) || 'D|' || replace(text, '"', '""') || ' ""said""' || chr(10) || 'T"|"end"', '[\\r\\n]+', ' ', 'g') AS record FROM conversations
UNION ALL SELECT 'H', 'H"|"' || role || '"' FROM conversations
UNION ALL SELECT 'T', 'T"|"' || turn || '"' FROM conversations""")
def _(t):
    # quotes are doubled, fields hold line breaks before markers, and one ends with a marker's letter on a line of its own
    said = F.concat(F.replace("text", F.lit('"'), F.lit('""')), F.lit(' ""said""'))
    body = F.concat(F.lit('D"|"'), F.col("conv_id").cast("string"), F.lit('"|"'), F.col("turn").cast("string"), F.lit('"|"x\nD|'), said, F.lit('\nT"|"end"'))
    text = F.concat(F.lit('H"|"'), "role", F.lit('"\n'), body, F.lit('\nT"|"'), F.col("turn").cast("string"), F.lit('"'))
    path = work_path(t.spark, "quoted")
    writers.unload_lines(t.conversations.select(text.alias("r")), "r", path)
    return control.quoted_records(t.spark, path).select("kind", "record")


@query("ops10_tagged_history", """
SELECT event_id, event_type FROM events WHERE event_type = 'error' ORDER BY ts DESC, event_id""")
def _(t):
    return src.history(t.events.select("ts", "event_id", "event_type"), "ts", tag=F.col("event_type") == "error").select("event_id", "event_type")


# --- sources and sinks ------------------------------------------------------------

@query("src1_table_scan", "SELECT * FROM nation")
def _(t):
    return src.read_table(t.spark, f"{t.folder}/nation.parquet")


@query("src2_sql_text", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")
def _(t):
    return src.sql(t.spark, "SELECT o_orderstatus, count(*) AS n FROM {o} GROUP BY o_orderstatus", o=t.orders)


@query("src3_csv_with_schema", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, nullif(c_mktsegment, 'MACHINERY') AS c_mktsegment FROM customer")
def _(t):
    path = work_path(t.spark, "csv")
    token = F.when(F.col("c_mktsegment") == "MACHINERY", "NULL").otherwise(F.col("c_mktsegment"))
    writers.unload_csv(t.customer.withColumn("c_mktsegment", token), path)
    return src.read_csv(t.spark, path, t.customer.schema)


@query("src3_csv_line_breaks", """
SELECT conv_id, turn, role, text || chr(10) || '"' || role || '", said' || chr(10) AS text FROM conversations""")
def _(t):
    path = work_path(t.spark, "csv")
    text = F.concat("text", F.lit('\n"'), "role", F.lit('", said\n'))
    writers.unload_csv(t.conversations.select("conv_id", "turn", "role", text.alias("text")), path)
    return src.read_csv(t.spark, path, t.conversations.select("conv_id", "turn", "role", "text").schema, src.CsvFormat(line_breaks=True))


@query("src5_rows_from_literals", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'one' WHEN 'O' THEN 'two' END AS word FROM orders")
def _(t):
    words = src.from_rows(t.spark, [("F", "one"), ("O", "two")], ["o_orderstatus", "word"])
    return t.orders.join(words, "o_orderstatus", "left").select("o_orderkey", "word")


@query("src6_integer_range", "SELECT o_orderkey FROM orders WHERE o_orderkey BETWEEN 1 AND 99 AND (o_orderkey - 1) % 3 = 0")
def _(t):
    return t.orders.join(src.range_df(t.spark, 1, 100, 3, "o_orderkey"), "o_orderkey").select("o_orderkey")


@query("src7_list_files", "SELECT 'orders-1' AS folder, true AS has_size UNION ALL SELECT 'customer-1', true UNION ALL SELECT 'customer-2', true")
def _(t):
    listed = src.list_files(t.spark, _drift_folder(t), contains=".CSV")
    return listed.groupBy(F.split_part("file_name", F.lit("/"), F.lit(1)).alias("folder")).agg(F.bool_and(F.col("size") > 0).alias("has_size"))


@query("src8_classify_files", """
SELECT CASE WHEN p_name ILIKE '%RING%' THEN p_name END AS col_ring, CASE WHEN p_name ILIKE '%bolt%' THEN p_name END AS col_bolt FROM part""")
def _(t):
    return src.classify_files(t.part, "p_name", {"col_ring": "%RING%", "col_bolt": "%bolt%"})


@query("src9_text_lines", """
SELECT doc_id, CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS INT) AS line_no, trim(unnest(string_split(text, chr(10)))) AS line FROM documents""")
def _(t):
    return src.text_lines(t.documents, "doc_id", "text")


@query("src9_file_lines", """
SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no, trim(unnest(string_split(text, chr(10)))) AS line FROM documents""")
def _(t):
    path = work_path(t.spark, "texts")
    writers.unload_lines(t.documents.select(F.concat(F.lit("document "), F.col("doc_id").cast("string"), F.lit("\n"), "text").alias("r")), "r", path)
    lines = src.read_lines(t.spark, path).withColumnRenamed("doc_id", "file")
    head = F.col("line").rlike("^document [0-9]+$")
    named = ordered_scan(lines, ["file"], "line_no", {
        "doc_id": last_so_far(F.when(head, F.split_part("line", F.lit(" "), F.lit(2)).cast("bigint"))), "first": last_so_far(F.when(head, F.col("line_no")))})
    return named.where(F.col("line_no") > F.col("first")).select("doc_id", (F.col("line_no") - F.col("first") - 1).alias("line_no"), "line")


@query("src13_history_since", "SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-25 00:00:00' ORDER BY ts DESC, event_id")
def _(t):
    since = F.lit("2024-01-25 00:00:00").cast("timestamp_ntz")
    return src.history(t.events.select("ts", "event_id"), "ts", since=since).select("event_id")


@query("src14_sample_rows", "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 10")
def _(t):
    return src.sample_rows(t.customer.select("c_custkey", "c_name").orderBy("c_custkey"), 10)


@query("snk4_unload_csv_page", "SELECT o_orderkey, o_orderpriority, 'extra' AS tag FROM orders ORDER BY o_orderkey LIMIT 500 OFFSET 100")
def _(t):
    from tidemark.operators.relational import page

    path = work_path(t.spark, "unload")
    rows = page(t.orders.select("o_orderkey", "o_orderpriority", F.lit("extra").alias("tag")), ["o_orderkey"], 500, 100)
    writers.unload_csv(rows, path, single=True)
    return src.read_csv(t.spark, path, "o_orderkey long, o_orderpriority string, tag string")


@query("snk5_unload_lines", "SELECT c_custkey || ',' || c_name AS line FROM customer")
def _(t):
    path = work_path(t.spark, "lines")
    writers.unload_lines(t.customer.select(F.expr("c_custkey || ',' || c_name").alias("line")), "line", path)
    return src.read_file_lines(t.spark, path).select("line")


@query("snk11_dated_path", "SELECT c_custkey, 20020101 AS load_date, 'customer' AS name FROM customer")
def _(t):
    path = work_path(t.spark, "dated")
    writers.write_dated(t.customer.select("c_custkey"), path, "2002-01-01", "customer")
    return t.spark.read.parquet(path).filter("load_date = 20020101")
