"""Checked queries over report text and table cells."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import reports as rep
from tidemark.plans.registry import query
from tidemark.session import cut_lineage
from tidemark.sources.tables import text_lines


def doc_lines(t):
    return t.documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


_L = """(SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents)"""


@query("txt1_between_markers", f"""
WITH l AS {_L},
s AS (SELECT doc_id, line_no, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS pair FROM l WHERE contains(line, 'The')),
e AS (SELECT doc_id, line_no, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS pair FROM l WHERE contains(line, 'and'))
SELECT l.doc_id, s.pair, l.line_no, l.line FROM s JOIN e ON s.doc_id = e.doc_id AND s.pair = e.pair AND s.line_no < e.line_no
JOIN l ON l.doc_id = s.doc_id AND l.line_no BETWEEN s.line_no AND e.line_no""")
def _(t):
    return rep.between_markers(doc_lines(t), "The", "and")


@query("txt2_drop_noise", f"SELECT doc_id, line_no FROM {_L} WHERE line NOT IN ('', 'Accrued') AND NOT contains(line, 'http')")
def _(t):
    return rep.drop_noise(doc_lines(t), equal=("", "Accrued"), contains=("http",)).select("doc_id", "line_no")


@query("txt3_section_ids", f"""
WITH l AS (SELECT *, contains(line, 'The') AS st, contains(line, 'and') AS en FROM {_L}),
w AS (SELECT *, sum(CAST(st AS INT)) OVER o AS n, max(CASE WHEN st THEN line_no END) OVER o AS opened,
  max(CASE WHEN en THEN line_no END) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS closed
  FROM l WINDOW o AS (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT doc_id, line_no, CAST(CASE WHEN opened IS NOT NULL AND (closed IS NULL OR opened > closed) THEN n ELSE 0 END AS BIGINT) AS section FROM w""")
def _(t):
    return rep.section_ids(doc_lines(t), "The", "and").select("doc_id", "line_no", "section")


def report_lines(t):
    """One collateral report of two sections per customer, as line rows."""
    text = F.concat_ws("\n", F.lit("PAGE HEAD"), F.lit("AS OF 01/02/2002"), F.lit("Accrued"), F.lit("Mutual Fund"),
                       F.expr("'C' || c_custkey || 'X Fund ' || c_mktsegment || ' 5.00% 1 2 3 4 5 6 7'"), F.lit("LENDING COLLATERAL"),
                       F.lit("STIF POOL N/R N/R N/R"), F.expr("'Mutual Fund $1.00 $' || c_acctbal || ' $3.00 $4.00'"),
                       F.lit("Cash-USD Cash Dollar extra"), F.lit("Cash-USD Second ignored"), F.lit("USD $10.00 $11.00 $12.00 $13.00"),
                       F.lit("Debentures"), F.expr("'D' || c_custkey || ' Bond of ' || c_mktsegment || ' 99 more'"),
                       F.expr("'Debentures $5.00 $6.' || c_nationkey || ' $7.00 $8.00'"), F.expr("'Total For : ' || c_name || ' $1 $2 $3 $4'"),
                       F.lit("USD $9 outside"), F.lit("AS OF 01/03/2002"), F.lit("USD $20.00 $21.00 $22.00 $23.00"),
                       F.expr("'Total For : Second ' || c_name || ' $1'"))
    return text_lines(t.customer.select(F.col("c_custkey").alias("doc_id"), text.alias("text")), "doc_id", "text")


def sections(t):
    return cut_lineage(rep.section_ids(rep.drop_noise(report_lines(t))).filter("section > 0"))


@query("txt4_account_names", """
SELECT c_custkey AS doc_id, 1 AS section, c_name AS account_name FROM customer UNION ALL SELECT c_custkey, 2, 'Second ' || c_name FROM customer""")
def _(t):
    return rep.account_names(sections(t))


@query("txt5_as_of_dates", """
SELECT c_custkey AS doc_id, 1 AS section, ' 01/02/2002' AS as_of_date FROM customer UNION ALL SELECT c_custkey, 2, ' 01/03/2002' FROM customer""")
def _(t):
    return rep.as_of_dates(sections(t))


_VALUES = """
SELECT c_custkey AS doc_id, 1 AS section, 'Mutual Fund ' AS collateral_type, '$' || c_acctbal || ' ' AS market_value FROM customer
UNION ALL SELECT c_custkey, 1, 'USD ', '$11.00 ' FROM customer UNION ALL SELECT c_custkey, 1, 'Debentures ', '$6.' || c_nationkey || ' ' FROM customer
UNION ALL SELECT c_custkey, 2, 'USD ', '$21.00 ' FROM customer"""


@query("txt6_market_values", _VALUES)
def _(t):
    return rep.market_values(sections(t)).select("doc_id", "section", "collateral_type", "market_value")


@query("txt7_cash_identifiers", "SELECT c_custkey AS doc_id, 1 AS section, 'Cash-USD' AS cusip, 'Cash' AS security_description FROM customer")
def _(t):
    return rep.cash_identifiers(sections(t)).drop("line_no")


_FUND = "'C' || c_custkey || 'X' AS cusip, 'Fund ' || c_mktsegment || '  LENDING COLLATERAL STIF POOL ' AS security_description"


@query("txt8_fund_identifiers", f"SELECT c_custkey AS doc_id, 1 AS section, {_FUND} FROM customer")
def _(t):
    return rep.fund_identifiers(sections(t)).drop("line_no")


_BOND = "'D' || c_custkey AS cusip, 'Bond of ' || c_mktsegment || ' ' AS security_description"


@query("txt9_debenture_identifiers", f"SELECT c_custkey AS doc_id, 1 AS section, {_BOND} FROM customer")
def _(t):
    return rep.debenture_identifiers(sections(t)).drop("line_no")


@query("txt10_assemble", f"""
SELECT c_custkey AS doc_id, 1 AS section, 1 AS "rank", ' 01/02/2002' AS as_of_date, c_name AS account_name, {_FUND},
  'Mutual Fund ' AS collateral_type, '$' || c_acctbal || ' ' AS market_value FROM customer
UNION ALL SELECT c_custkey, 1, 2, ' 01/02/2002', c_name, 'Cash-USD', 'Cash', 'USD ', '$11.00 ' FROM customer
UNION ALL SELECT c_custkey, 1, 3, ' 01/02/2002', c_name, {_BOND}, 'Debentures ', '$6.' || c_nationkey || ' ' FROM customer
UNION ALL SELECT c_custkey, 2, 1, ' 01/03/2002', 'Second ' || c_name, NULL, NULL, 'USD ', '$21.00 ' FROM customer""")
def _(t):
    return rep.extract_report(report_lines(t))


@query("txt11_document_status", """
SELECT c_custkey AS doc_id, 4 AS "rows", 0 AS incomplete, 'OK' AS status FROM customer
UNION ALL SELECT -doc_id - 1, 0, 0, 'ERROR: no rows' FROM documents""")
def _(t):
    reports = report_lines(t)
    others = doc_lines(t).withColumn("doc_id", -F.col("doc_id") - 1)
    both = reports.unionByName(others)
    return rep.document_status(rep.extract_report(both), both)


@query("txt12_first_page_with", """
SELECT split_part(url, '/', 3) AS host, CAST(min(CASE WHEN contains(html, 'class="ad"') AND page_id >= 1 THEN page_id END) AS BIGINT) AS first_page FROM pages GROUP BY 1""")
def _(t):
    pages = t.pages.withColumn("host", F.split_part("url", F.lit("/"), F.lit(3)))
    return rep.first_page_with(pages, "host", "page_id", "html", 'class="ad"')


@query("txt13_find_label", r"""
WITH x AS (SELECT page_id, 'see ' || replace(split_part(url, '/', 3), '.', ' . ') || ' for more' AS line FROM pages)
SELECT page_id, regexp_extract(line, '([A-Za-z_][A-Za-z0-9_$]*)\s*\.\s*([A-Za-z_][A-Za-z0-9_$]*)\s*\.\s*([A-Za-z_][A-Za-z0-9_$]*)', 1) AS db,
  regexp_extract(line, '([A-Za-z_][A-Za-z0-9_$]*)\s*\.\s*([A-Za-z_][A-Za-z0-9_$]*)\s*\.\s*([A-Za-z_][A-Za-z0-9_$]*)', 2) AS schema,
  regexp_extract(line, '([A-Za-z_][A-Za-z0-9_$]*)\s*\.\s*([A-Za-z_][A-Za-z0-9_$]*)\s*\.\s*([A-Za-z_][A-Za-z0-9_$]*)', 3) AS "table" FROM x""")
def _(t):
    host = F.replace(F.split_part("url", F.lit("/"), F.lit(3)), F.lit("."), F.lit(" . "))
    found = t.pages.select("page_id", rep.find_label(F.concat(F.lit("see "), host, F.lit(" for more"))).alias("l"))
    return found.select("page_id", "l.db", "l.schema", "l.table")


def cells(t):
    """Whole conversation turns as table cells; every fifth row repeats the heading."""
    head = F.col("turn") % 5 == 4
    return t.conversations.select(
        "conv_id", "turn", F.when(head, "Column Name").when(F.col("role") == "user", F.concat(F.lit(" k"), F.col("turn").cast("string"))).alias("column_name"),
        F.when(head, "Description").when(F.col("turn") % 7 == 6, " ").otherwise(F.col("text")).alias("description"),
        F.when(head, "COMMENTS / Notes").when(F.col("turn") % 7 == 6, None).otherwise(F.col("role")).alias("comments"))


_CELLS = """(SELECT conv_id, turn, CASE WHEN turn % 5 = 4 THEN 'Column Name' WHEN role = 'user' THEN ' k' || turn END AS column_name,
  CASE WHEN turn % 5 = 4 THEN 'Description' WHEN turn % 7 = 6 THEN ' ' ELSE text END AS description,
  CASE WHEN turn % 5 = 4 THEN 'COMMENTS / Notes' WHEN turn % 7 = 6 THEN NULL ELSE role END AS comments FROM conversations)"""

_DROPPED = "SELECT * FROM {} WHERE turn % 5 <> 4"


@query("txt14_drop_header_rows", _DROPPED.format(_CELLS))
def _(t):
    return rep.drop_header_rows(cells(t))


_MERGED = """
WITH r AS (SELECT conv_id, turn, trim(coalesce(column_name, '')) AS k, trim(coalesce(description, ''), ' ') AS d, trim(coalesce(comments, '')) AS c FROM {}),
g AS (SELECT *, sum(CASE WHEN k <> '' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS grp FROM r)
SELECT conv_id, min(turn) AS turn, max(k) AS column_name, coalesce(string_agg(CASE WHEN d <> '' THEN d END, ' ' ORDER BY turn), '') AS description,
  coalesce(string_agg(CASE WHEN c <> '' THEN c END, ' ' ORDER BY turn), '') AS comments FROM g GROUP BY conv_id, grp"""


@query("txt15_merge_continuations", _MERGED.format(_CELLS))
def _(t):
    return rep.merge_continuations(cells(t), ["conv_id"], "turn", "column_name", ["description", "comments"])


@query("txt16_words_to_lines", """
WITH w AS (SELECT o_custkey AS page, o_orderkey AS x0, floor(o_totalprice / 1000) AS top, 'w' || o_orderkey AS text FROM orders),
g AS (SELECT *, row_number() OVER o AS pos, CASE WHEN top - lag(top) OVER o <= 3 THEN 0 ELSE 1 END AS new FROM w WINDOW o AS (PARTITION BY page ORDER BY top, x0, text)),
n AS (SELECT *, sum(new) OVER (PARTITION BY page ORDER BY pos) AS line_no FROM g)
SELECT page, CAST(line_no AS BIGINT) AS line_no, min(top) AS top, string_agg(text, ' ' ORDER BY x0, pos) AS line FROM n GROUP BY page, line_no""")
def _(t):
    words = t.orders.select(F.col("o_custkey").alias("page"), F.col("o_orderkey").alias("x0"),
                            F.floor(F.col("o_totalprice") / 1000).cast("double").alias("top"), F.expr("'w' || o_orderkey").alias("text"))
    return rep.words_to_lines(words, ["page"])


@query("txt17_label_tables", """
WITH lab AS (SELECT o_custkey % 50 AS doc_id, o_custkey AS page, floor(o_totalprice / 100) AS y, 'l' || o_orderkey AS label FROM orders WHERE o_orderpriority = '1-URGENT'),
tab AS (SELECT o_custkey % 50 AS doc_id, o_custkey AS page, floor(o_totalprice / 100) AS top, floor(o_totalprice / 100) + 20 AS bottom, o_orderkey AS table_no FROM orders WHERE o_orderpriority = '5-LOW'),
ev AS (SELECT doc_id, page, y, 0 AS kind, label, NULL AS table_no, NULL AS bottom FROM lab UNION ALL SELECT doc_id, page, top, 1, NULL, table_no, bottom FROM tab),
p AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page ORDER BY y, kind DESC, label) AS n,
  last_value(CASE WHEN kind = 0 THEN {'y': y, 'label': label} END IGNORE NULLS) OVER (PARTITION BY doc_id, page ORDER BY y, kind DESC, label ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS near,
  max(bottom) OVER (PARTITION BY doc_id, page) AS last FROM ev),
s AS (SELECT *, CASE WHEN kind = 1 THEN CASE WHEN y - near.y <= 700 THEN near.label END WHEN last IS NULL OR y > last THEN label END AS st FROM p),
a AS (SELECT *, last_value(st IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY page, kind DESC, n ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS active_label FROM s)
SELECT doc_id, page, y AS top, bottom, table_no, active_label FROM a WHERE kind = 1""")
def _(t):
    def at(name):
        return F.floor(F.col("o_totalprice") / 100).cast("double").alias(name)

    place = [(F.col("o_custkey") % 50).alias("doc_id"), F.col("o_custkey").alias("page")]
    labels = t.orders.filter("o_orderpriority = '1-URGENT'").select(*place, at("y"), F.expr("'l' || o_orderkey").alias("label"))
    tables = t.orders.filter("o_orderpriority = '5-LOW'").select(*place, at("top"), F.col("o_orderkey").alias("table_no"))
    tables = tables.withColumn("bottom", F.col("top") + 20).select("doc_id", "page", "top", "bottom", "table_no")
    return rep.label_tables(labels, tables)


_THREE = """
SELECT conv_id, turn, nullif(trim(column_name), '') AS column_name, nullif(trim(description), '') AS description, nullif(trim(comments), '') AS comments
FROM {} WHERE coalesce(nullif(trim(column_name), ''), nullif(trim(description), ''), nullif(trim(comments), '')) IS NOT NULL"""


@query("txt18_keep_three_columns", _THREE.format(_CELLS))
def _(t):
    return rep.keep_three_columns(cells(t))
