"""Checked queries over scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans.registry import query


@query("fn1_upper_lower_trim_length", """
SELECT p_partkey, upper(p_name) AS u, lower(p_brand) AS l, trim('  ' || p_type || ' ') AS t, length(p_name) AS n FROM part""")
def _(t):
    return t.part.select("p_partkey", F.upper("p_name").alias("u"), F.lower("p_brand").alias("l"),
                         F.trim(F.concat(F.lit("  "), "p_type", F.lit(" "))).alias("t"), F.length("p_name").alias("n"))


@query("fn2_substr", "SELECT c_custkey, substr(c_name, 1, 3) AS head, substr(c_name, 10) AS rest FROM customer")
def _(t):
    return t.customer.select("c_custkey", F.substring("c_name", 1, 3).alias("head"), F.substr(F.col("c_name"), F.lit(10)).alias("rest"))


@query("fn3_split_size", r"SELECT page_id, len(string_split(url, '.')) AS parts, string_split(url, '.')[1] AS first FROM pages")
def _(t):
    parts = F.split("url", r"\.")
    return t.pages.select("page_id", F.size(parts).alias("parts"), parts[0].alias("first"))


@query("fn4_split_part", "SELECT page_id, split_part(url, '/', 3) AS host, split_part(url, '/', -1) AS last FROM pages")
def _(t):
    return t.pages.select("page_id", F.split_part("url", F.lit("/"), F.lit(3)).alias("host"),
                          F.split_part("url", F.lit("/"), F.lit(-1)).alias("last"))


@query("fn5_startswith_contains", """
SELECT page_id, starts_with(url, 'https') AS tls, contains(upper(url), 'EXAMPLE.NET') AS net FROM pages""")
def _(t):
    return t.pages.select("page_id", F.startswith("url", F.lit("https")).alias("tls"),
                          F.contains(F.upper("url"), F.lit("EXAMPLE.NET")).alias("net"))


@query("fn6_concat", "SELECT p_partkey, concat(p_brand, '/', p_type) AS a, p_name || ' ' || p_size AS b FROM part")
def _(t):
    return t.part.select("p_partkey", F.concat("p_brand", F.lit("/"), "p_type").alias("a"), F.expr("p_name || ' ' || p_size").alias("b"))


@query("fn7_regex", r"""
SELECT doc_id, regexp_matches(text, '[0-9]{3}') AS has, regexp_replace(text, '[0-9]+', '#', 'g') AS masked,
       len(regexp_extract_all(text, '[0-9]+')) AS n FROM documents""")
def _(t):
    return t.documents.select("doc_id", F.col("text").rlike("[0-9]{3}").alias("has"), F.regexp_replace("text", "[0-9]+", "#").alias("masked"),
                              F.size(F.regexp_extract_all("text", F.lit("[0-9]+"), F.lit(0))).alias("n"))


@query("fn8_split_limit", """
SELECT c_custkey, split_part(c_name, '0', 1) AS head, substr(c_name, strpos(c_name, '0') + 1) AS tail FROM customer""")
def _(t):
    parts = F.split("c_name", "0", 2)
    return t.customer.select("c_custkey", parts[0].alias("head"), parts[1].alias("tail"))


@query("fn9_lpad_repeat", "SELECT p_partkey, lpad(CAST(p_size AS VARCHAR), 6, '0') AS z, repeat('X', p_size) AS r FROM part")
def _(t):
    return t.part.select("p_partkey", F.lpad(F.col("p_size").cast("string"), 6, "0").alias("z"), F.repeat(F.lit("X"), F.col("p_size")).alias("r"))


@query("fn10_coalesce_nullif", """
SELECT d.doc_id, coalesce(l.quality, -1) AS q, nullif(d.lang, 'en') AS foreign_lang FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def _(t):
    return t.documents.join(t.labels, "doc_id", "left").select(
        "doc_id", F.coalesce("quality", F.lit(-1)).alias("q"), F.nullif("lang", F.lit("en")).alias("foreign_lang"))


@query("fn11_round_abs_mod", """
SELECT c_custkey, CAST(round(CAST(c_acctbal AS DECIMAL(12,2)), 1) AS DOUBLE) AS r, abs(c_acctbal) AS a, c_custkey % 7 AS m FROM customer""")
def _(t):
    return t.customer.select("c_custkey", F.round(F.col("c_acctbal").cast("decimal(12,2)"), 1).cast("double").alias("r"),
                             F.abs("c_acctbal").alias("a"), (F.col("c_custkey") % 7).alias("m"))


@query("fn12_dates", """
SELECT o_orderkey, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month, CAST(day(o_orderdate) AS INT) AS d,
       strftime(o_orderdate - INTERVAL 24 HOUR, '%Y-%m-%d') AS day_before, date_diff('day', o_orderdate, DATE '2002-01-01') AS age FROM orders""")
def _(t):
    day = "yyyy-MM-dd"
    return t.orders.select(
        "o_orderkey", F.date_format(F.date_trunc("month", "o_orderdate"), day).alias("month"), F.day("o_orderdate").alias("d"),
        F.date_format(F.expr("dateadd(HOUR, -24, o_orderdate)"), day).alias("day_before"),
        F.datediff(F.lit("2002-01-01").cast("date"), F.to_date("o_orderdate")).alias("age"))


@query("fn13_date_formats", """
SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS compact, strftime(o_orderdate, '%m/%d/%Y') AS us FROM orders""")
def _(t):
    compact = F.date_format("o_orderdate", "yyyyMMdd")
    return t.orders.select("o_orderkey", compact.alias("compact"),
                           F.date_format(F.to_date(compact, "yyyyMMdd"), "MM/dd/yyyy").alias("us"))


@query("fn14_casts", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(trunc(l_quantity) AS INT) AS q, try_cast(l_returnflag || l_linenumber AS INT) AS bad FROM lineitem""")
def _(t):
    return t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.expr("l_quantity::int").alias("q"),
                             F.expr("try_cast(l_returnflag || l_linenumber AS int)").alias("bad"))


@query("fn15_json_path", "SELECT event_id, CAST(props->>'$.k' AS INT) AS k FROM events")
def _(t):
    return t.events.select("event_id", F.try_variant_get(F.parse_json("props"), "$.k", "int").alias("k"))


@query("fn16_flatten_json", "SELECT event_id, unnest(json_keys(props)) AS key FROM events")
def _(t):
    return t.events.select("event_id", F.explode(F.json_object_keys("props")).alias("key"))


@query("fn17_sha2_hex", "SELECT doc_id, sha256(text) AS digest, upper(hex(lang)) AS lang_hex FROM documents")
def _(t):
    return t.documents.select("doc_id", F.lower(F.hex(F.unhex(F.sha2("text", 256)))).alias("digest"),
                              F.hex(F.to_binary("lang", F.lit("utf-8"))).alias("lang_hex"))


@query("fn19_json_build", """
SELECT p_partkey, '{"name":"' || p_name || '","size":' || p_size || ',"tags":["' || p_brand || '","' || p_type || '"]}' AS doc FROM part""")
def _(t):
    return t.part.select("p_partkey", F.to_json(F.struct(
        F.col("p_name").alias("name"), F.col("p_size").alias("size"), F.array("p_brand", "p_type").alias("tags"))).alias("doc"))
