"""Checked queries over catalog tables, file formats, jobs and the operators that others are made of."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.functions import aes
from tidemark.functions.generate import ColumnSpec
from tidemark.functions.hashing import derive_key, secret_column
from tidemark.operators import control, encrypt, lineage, mapping as mp, obfuscate as obf, reports as rep
from tidemark.operators.obfuscate import Rule
from tidemark.operators.relational import beside
from tidemark.plans import aes_sql, jobs as job_plans, lineage as lineage_plans
from tidemark.plans.protection import IVS, PHRASE, SALT
from tidemark.plans.registry import query
from tidemark.session import work_path
from tidemark.sinks import writers
from tidemark.sources import tables as src


def _name(kind):
    """A table of its own for each call."""
    return f"tidemark_{kind}_{uuid.uuid4().hex}"


# --- tables -----------------------------------------------------------------------

@query("snk1_create_table_as_select", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def _(t):
    name = _name("ctas")
    writers.ctas(t.orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice"), name)
    return t.spark.table(name)


@query("snk2_empty_clone", """
SELECT column_name, count(*) OVER () AS columns, 0 AS rows FROM information_schema.columns WHERE table_name = 'orders'""")
def _(t):
    name = _name("clone")
    writers.clone_schema(t.orders, name)
    listed = src.describe_columns(t.spark.table(name))
    return listed.select("column_name", F.lit(len(t.orders.columns)).cast("bigint").alias("columns"), F.lit(t.spark.table(name).count()).cast("int").alias("rows"))


@query("snk3_append", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_custkey END AS o_custkey FROM orders WHERE o_orderstatus IN ('F', 'O')""")
def _(t):
    name = _name("append")
    writers.ctas(t.orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_custkey"), name)
    writers.append(t.orders.filter("o_orderstatus = 'O'").select("o_orderkey"), name)  # the column it lacks becomes null
    return t.spark.table(name)


@query("snk7_check_compatible", """
SELECT false AS ok, 'o_comment is not in the target; o_orderkey: string does not fit bigint' AS reason, count(*) AS orders FROM orders""")
def _(t):
    source = t.orders.select(F.lit("x").alias("o_comment"), F.col("o_orderkey").cast("string").alias("o_orderkey"), "o_custkey")
    ok, reason = writers.check_compatible(source.schema, t.orders.schema)
    return t.orders.agg(F.lit(ok).alias("ok"), F.lit(reason).alias("reason"), F.count("*").alias("orders"))


_CUSTOMER_SPEC = [ColumnSpec("c_custkey", "INTEGER", False, 10), ColumnSpec("c_name", "VARCHAR", False, 25), ColumnSpec("c_acctbal", "NUMBER", True, 8), ColumnSpec("seen", "DATE", True)]


@query("snk8_table_from_spec", """
SELECT 1 AS ordinal, 'c_custkey' AS column_name, 'decimal(10,0)' AS data_type, count(c_custkey) AS filled, CAST(sum(c_custkey) AS VARCHAR) AS total FROM customer UNION ALL
SELECT 2, 'c_name', 'varchar(25)', count(c_name), NULL FROM customer UNION ALL
SELECT 3, 'c_acctbal', 'decimal(12,4)', count(c_acctbal), CAST(sum(CAST(round(c_acctbal * 10000) AS BIGINT)) AS VARCHAR) FROM customer UNION ALL SELECT 4, 'seen', 'date', 0, NULL""")
def _(t):
    name = _name("spec")
    writers.create_from_spec(t.spark, name, _CUSTOMER_SPEC)
    writers.insert_checked(t.customer.select("c_custkey", "c_name", F.col("c_acctbal").cast("decimal(12,4)").alias("c_acctbal")), name)
    stored = t.spark.table(name)
    filled = stored.agg(*[F.count(c).alias(c) for c in stored.columns]).unpivot([], stored.columns, "column_name", "filled")
    totals = stored.agg(F.sum("c_custkey").cast("string").alias("c_custkey"), (F.sum("c_acctbal") * 10000).cast("decimal(38,0)").cast("string").alias("c_acctbal")) \
        .unpivot([], ["c_custkey", "c_acctbal"], "column_name", "total")
    columns = src.describe_table(t.spark, name).select("ordinal", "column_name", "data_type")
    return columns.join(filled, "column_name").join(totals, "column_name", "left").select("ordinal", "column_name", "data_type", "filled", "total")


@query("snk10_view_then_insert", "SELECT n_nationkey, n_name FROM nation UNION ALL SELECT r_regionkey, r_name FROM region")
def _(t):
    name = _name("insert")
    writers.ctas(t.nation.select("n_nationkey", "n_name"), name)
    writers.insert_select(t.region.select("r_regionkey", "r_name"), name)
    return t.spark.table(name)


# --- formats and listings ---------------------------------------------------------

@query("src4_csv_options", """
SELECT c_custkey, CASE WHEN c_custkey % 4 >= 2 THEN c_name || '|' || c_mktsegment END AS c_name, CASE WHEN c_custkey % 3 > 0 THEN c_acctbal END AS c_acctbal FROM customer""")
def _(t):
    path = work_path(t.spark, "csv")
    # fields in quotes and not, the separator inside one, and both spellings of null
    name = F.when(F.col("c_custkey") % 4 == 0, "NULL").when(F.col("c_custkey") % 4 == 1, "null").otherwise(F.concat(F.lit('"'), "c_name", F.lit("|"), "c_mktsegment", F.lit('"')))
    balance = F.when(F.col("c_custkey") % 3 == 0, "NULL").otherwise(F.col("c_acctbal").cast("string"))
    writers.unload_lines(t.customer.select(F.concat_ws("|", F.col("c_custkey").cast("string"), name, balance).alias("line")), "line", path)
    return src.read_csv(t.spark, path, t.customer.select("c_custkey", "c_name", "c_acctbal").schema, src.CsvFormat(delimiter="|", header=False))


@query("src10_dictionary_csv", "SELECT lower(n_name) AS field_name, CASE WHEN n_regionkey % 2 = 0 THEN 'numeric' ELSE 'alphanumeric' END AS type FROM nation")
def _(t):
    path = work_path(t.spark, "dictionary")
    kind = F.when(F.col("n_regionkey") % 2 == 0, " Numeric").otherwise("ALPHANUMERIC")
    writers.unload_csv(t.nation.select(F.col("n_name").alias("field_name"), kind.alias("type"), F.lit("any").alias("format"), F.lit(None).cast("string").alias("description")), path)
    return t.spark.createDataFrame(list(encrypt.read_dictionary(t.spark, path).items()), "field_name string, type string")


@query("src15_column_metadata", """
SELECT CAST(ordinal_position AS INT) AS ordinal, column_name, CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double'
  WHEN 'DATE' THEN 'date' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(data_type) END AS data_type, true AS nullable FROM information_schema.columns WHERE table_name = 'orders'""")
def _(t):
    return src.describe_columns(t.orders)


# --- operators that others are made of --------------------------------------------

@query("prj6_before_after_columns", """
SELECT c_name, repeat('X', length(c_name) - 4) || right(c_name, 4) AS "c_name_OBF", c_mktsegment, CAST(NULL AS VARCHAR) AS "c_mktsegment_OBF" FROM customer""")
def _(t):
    return obf.before_after(t.customer, [Rule("c_name", "MASK_LASTN", {"n": 4}), Rule("c_mktsegment", "NULLIFY")], SALT)


@query("jn17_positional_concat", """
WITH a AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders WHERE o_orderstatus = 'F'),
b AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders WHERE o_orderstatus = 'O')
SELECT coalesce(a.o_custkey, b.o_custkey) AS o_custkey, coalesce(a.n, b.n) AS place, a.o_orderkey AS closed, b.o_orderkey AS opened FROM a FULL JOIN b ON a.o_custkey = b.o_custkey AND a.n = b.n""")
def _(t):
    part = lambda status, name: t.orders.filter(F.col("o_orderstatus") == status).select("o_custkey", F.col("o_orderkey").alias(name))
    return beside(part("F", "closed"), part("O", "opened"), ["o_custkey"], "closed", "opened")


@query("jn18_lines_between_marks", """
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents),
s AS (SELECT doc_id, line_no, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS pair FROM l WHERE contains(line, 'the')),
e AS (SELECT doc_id, line_no, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS pair FROM l WHERE contains(line, '.'))
SELECT l.doc_id, s.pair, l.line_no FROM s JOIN e ON s.doc_id = e.doc_id AND s.pair = e.pair AND s.line_no < e.line_no
JOIN l ON l.doc_id = s.doc_id AND l.line_no BETWEEN s.line_no AND e.line_no""")
def _(t):
    lines = t.documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return rep.between_markers(lines, "the", ".").select("doc_id", "pair", "line_no")


_NAME_CIPHER = aes_sql.cbc_hex("c_name", derive_key(PHRASE), dict(IVS)["C_NAME"])


@query("fn18_aes_encrypt_decrypt", f"WITH {aes_sql.tables()} SELECT c_custkey, {_NAME_CIPHER} AS sealed, c_name AS opened FROM customer, aes")
def _(t):
    key, iv = secret_column(t.spark, derive_key(PHRASE)), F.lit(dict(IVS)["C_NAME"]).cast("binary")
    sealed = t.customer.select("c_custkey", aes.aes_cbc_det(F.col("c_name"), key, iv).alias("c"))
    return sealed.select("c_custkey", F.hex("c").alias("sealed"), aes.aes_cbc_det_decrypt(F.col("c"), key, iv).alias("opened"))


@query("ops6_audit_rows", """
SELECT 'J' || n_nationkey AS "JOB_ID", n_name AS "SRC_NAME", count(c_custkey) AS "TOT_SRC_CNT", CASE WHEN count(c_custkey) > 0 AND n_regionkey <> 2 THEN 1 ELSE 3 END AS "TASK_FLOW_STATUS",
  CASE WHEN n_regionkey = 2 THEN 'region 2 is closed' WHEN count(c_custkey) = 0 THEN 'no rows' ELSE 'SUCCESS' END AS "ERROR_MSG" FROM nation LEFT JOIN customer ON n_nationkey = c_nationkey GROUP BY n_nationkey, n_name, n_regionkey""")
def _(t):
    # one run for each nation, as a job would report them
    counts = t.nation.join(t.customer, F.expr("n_nationkey = c_nationkey"), "left").groupBy("n_nationkey", "n_name", "n_regionkey").agg(F.count("c_custkey").alias("n"))
    runs = []
    for r in counts.collect():
        error = "region 2 is closed" if r.n_regionkey == 2 else "no rows" if not r.n else None
        runs.append({"JOB_ID": f"J{r.n_nationkey}", "SRC_NAME": r.n_name, "TOT_SRC_CNT": r.n, **({"error": error} if error else {})})
    return control.audit_rows(t.spark, runs).select("JOB_ID", "SRC_NAME", "TOT_SRC_CNT", "TASK_FLOW_STATUS", "ERROR_MSG")


# --- mappings and jobs ------------------------------------------------------------

@query("mp8_wide_mapping", job_plans._MAPPED)
def _(t):
    wide = mp.wide_rows(t.spark, job_plans.ORDER_MAP)
    rows = mp.long_rows(wide, "W1", job_plans.ORDER_MAP.target, job_plans.ORDER_MAP.source)
    return mp.run_mapping(rows, "W1", job_plans._sources(t))


_WINDOW = f"(SELECT DISTINCT query_id, source_object, target_object FROM {lineage_plans._EDGES} WHERE query_start_time >= TIMESTAMP '1998-06-01' - INTERVAL {{}} DAY)"


@query("ud5_refresh_procedure", f"""
SELECT 30 AS days_back, count(*) AS edges, count(*) AS inserted, true AS in_window, 1 AS status FROM {_WINDOW.format(30)} UNION ALL
SELECT 90, count(*), count(*) - (SELECT count(*) FROM {_WINDOW.format(30)}), true, 1 FROM {_WINDOW.format(90)} UNION ALL
SELECT 90, count(*), 0, true, 1 FROM {_WINDOW.format(90)}""")
def _(t):
    name, log = _name("edges"), lineage_plans.access_log(t)
    rows = [lineage.refresh_job(t.spark, log, name, days, "1998-06-01 00:00:00").first() for days in (30, 90, 90)]
    return t.spark.createDataFrame(rows, "days_back int, edges long, inserted long, in_window boolean, status int")
