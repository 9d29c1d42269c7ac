"""Checked queries over mappings, requests, generation, archives and streams."""

from __future__ import annotations

import io
import zipfile

from pyspark.sql import Window, functions as F

from tidemark.functions import generate as gen
from tidemark.functions.generate import ColumnSpec
from tidemark.functions.sql import register_functions
from tidemark.operators import mapping as mp, obfuscate as obf, requests as req
from tidemark.operators.mapping import Join, Mapping, Target
from tidemark.operators.obfuscate import Rule
from tidemark.operators.relational import join_frames
from tidemark.plans import lineage as lineage_plans
from tidemark.plans.protection import KEY, SALT
from tidemark.plans.registry import query
from tidemark.session import work_path
from tidemark.sinks import unpack, writers
from tidemark.sources import archives as arc, tables as src
from tidemark.streaming import jobs

# --- mapping ----------------------------------------------------------------------

ORDER_MAP = Mapping(
    "M1", "dw.core.order_fact", "src.sales.orders",
    (Join("src.sales.customer", "LEFT OUTER JOIN", pairs=(("o_custkey", "c_custkey"),)),
     Join("src.ref.nation", "INNER JOIN", "customer.c_nationkey = nation.n_nationkey")),
    (Target("ORDER_ID", "o_orderkey"), Target("CUSTOMER", "c_name", mp.transformation("c_name", [("UPPER()", "wrapper"), ("TRIM()", "wrapper")])),
     Target("NATION", "nation.n_name"),
     Target("AMOUNT", "o_totalprice", mp.transformation("o_totalprice", [("-", "operator"), ("CEIL()", "wrapper")])),
     Target("STATE", "o_orderstatus", mp.transformation("o_orderstatus = 'F'", [("CASE WHEN  THEN  ELSE  END", "template", "'closed'", "'open'")]))),
)


def _sources(t):
    return {"src.sales.orders": t.orders, "src.sales.customer": t.customer, "src.ref.nation": t.nation}


_MAPPED = """SELECT o_orderkey AS "ORDER_ID", upper(trim(c_name)) AS "CUSTOMER", n_name AS "NATION", CAST(-ceil(o_totalprice) AS BIGINT) AS "AMOUNT",
  CASE WHEN o_orderstatus = 'F' THEN 'closed' ELSE 'open' END AS "STATE"
FROM orders LEFT JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""


@query("mp1_run_mapping", _MAPPED)
def _(t):
    return mp.run_mapping(mp.mapping_rows(t.spark, ORDER_MAP), "M1", _sources(t))


@query("mp2_preview", f"SELECT * FROM ({_MAPPED.replace('FROM orders', 'FROM (SELECT * FROM orders ORDER BY o_orderkey LIMIT 10) orders')}) LIMIT 10")
def _(t):
    # the first ten orders, so that the preview has one answer; every order has a customer with a nation
    first = t.orders.orderBy("o_orderkey").limit(10)
    return mp.preview(mp.mapping_rows(t.spark, ORDER_MAP), "M1", _sources(t) | {"src.sales.orders": first})


@query("mp3_auto_map", """
SELECT doc_id, quality, lang FROM documents JOIN labels USING (doc_id)""")
def _(t):
    found = mp.auto_map(t.spark, ["DOC_ID", "Quality", "lang", "unknown"], {"documents": t.documents.columns, "labels": t.labels.columns})
    picks = found.filter("source_column IS NOT NULL").collect()
    joined = t.documents.alias("documents").join(t.labels.alias("labels"), F.expr("documents.doc_id = labels.doc_id"))
    return joined.select(*[F.col(f"{r['source_table']}.{r['source_column']}") for r in picks])


@query("mp4_duplicate_names", """
SELECT d.doc_id, d.lang, l.doc_id AS doc_id_labels, l.quality, l.toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id""")
def _(t):
    return mp.join_display(t.documents.select("doc_id", "lang"), t.labels, "labels", "left.doc_id = labels.doc_id")


_KINDS = {
    "INNER JOIN": "JOIN", "LEFT OUTER JOIN": "LEFT JOIN", "RIGHT OUTER JOIN": "RIGHT JOIN", "FULL OUTER JOIN": "FULL JOIN",
    "NATURAL JOIN": "NATURAL JOIN", "NATURAL LEFT JOIN": "NATURAL LEFT JOIN", "NATURAL RIGHT JOIN": "NATURAL RIGHT JOIN",
    "NATURAL FULL JOIN": "NATURAL FULL JOIN", "LEFT SEMI JOIN": "SEMI JOIN", "LEFT ANTI JOIN": "ANTI JOIN",
    "RIGHT SEMI JOIN": "SEMI JOIN", "RIGHT ANTI JOIN": "ANTI JOIN", "CROSS JOIN": "CROSS JOIN",
}


def _kind_sql(kind, sql):
    left, right = "(SELECT n_nationkey AS k FROM nation)", "(SELECT c_nationkey + 10 AS k, c_custkey FROM customer)"
    if kind.startswith("RIGHT S") or kind.startswith("RIGHT A"):
        left, right = right, left
    if kind == "CROSS JOIN":
        return f"SELECT count(*) AS n FROM (SELECT max(n_nationkey) AS k FROM nation) a CROSS JOIN {right} b"
    on = "" if kind.startswith("NATURAL") else " ON a.k = b.k"
    return f"SELECT count(*) AS n FROM {left} a {sql} {right} b{on}"


@query("mp5_join_kinds", " UNION ALL ".join(f"SELECT '{k}' AS kind, n FROM ({_kind_sql(k, s)})" for k, s in _KINDS.items()))
def _(t):
    left = t.nation.select(F.col("n_nationkey").alias("k"))
    right = t.customer.select((F.col("c_nationkey") + 10).alias("k"), "c_custkey")
    parts = None
    top = t.nation.agg(F.max("n_nationkey").alias("k"))
    for kind in _KINDS:
        side = top if kind == "CROSS JOIN" else left
        n = join_frames(side, right, kind, side["k"] == right["k"]).agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "n")
        parts = n if parts is None else parts.unionByName(n)
    return parts


@query("mp6_join_by_pairs_or_text", """
SELECT o_orderkey AS a, l_partkey AS b, c_name AS c FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN customer c ON o_custkey = c.c_custkey AND c.c_acctbal > 5000""")
def _(t):
    m = Mapping("M2", "x.y.z", "s.s.orders", (Join("s.s.lineitem", pairs=(("o_orderkey", "l_orderkey"),)),
                Join("s.s.customer", condition="orders.o_custkey = customer.c_custkey AND customer.c_acctbal > 5000")),
                (Target("a", "o_orderkey"), Target("b", "l_partkey"), Target("c", "customer.c_name")))
    return mp.run_mapping(mp.mapping_rows(t.spark, m), "M2", {"s.s.orders": t.orders, "s.s.lineitem": t.lineitem, "s.s.customer": t.customer})


@query("mp7_qualified_transformation", """
SELECT d.doc_id, d.source || '/' || l.quality AS tag, upper(d.lang) AS lang FROM documents d JOIN labels l ON d.doc_id = l.doc_id""")
def _(t):
    m = Mapping("M3", "x.y.z", "s.s.documents", (Join("s.s.labels", pairs=(("doc_id", "doc_id"),)),),
                (Target("doc_id", "documents.doc_id"), Target("tag", "source", "source || '/' || labels.quality"), Target("lang", "lang", "upper(lang)")))
    return mp.run_mapping(mp.mapping_rows(t.spark, m), "M3", {"s.s.documents": t.documents, "s.s.labels": t.labels})


@query("mp9_function_stack", """
SELECT p_partkey, round(abs(p_retailprice), 2) AS price, coalesce(nullif(p_type, 'SMALL'), 'none') AS kind FROM part""")
def _(t):
    price = mp.transformation("p_retailprice", [("ROUND(, 2)", "wrapper"), ("ABS()", "wrapper")])
    kind = mp.transformation("p_type", [("COALESCE(, )", "wrapper", "'none'"), ("NULLIF(, )", "wrapper", "'SMALL'")])
    return t.part.select("p_partkey", F.expr(price).alias("price"), F.expr(kind).alias("kind"))


@query("mr2_idempotent_requests", """
SELECT 'R' || c_custkey AS "Request_ID", CAST(c_nationkey AS INT) AS "S_No", c_name AS "Field_name" FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""")
def _(t):
    fresh = t.customer.select(F.expr("'R' || c_custkey").alias("Request_ID"), F.col("c_nationkey").alias("S_No"), F.col("c_name").alias("Field_name"))
    stored = t.orders.filter("o_orderstatus = 'F'").select(F.expr("'R' || o_custkey").alias("Request_ID"))
    return req.new_requests(stored, fresh)


# --- functions for SQL users --------------------------------------------------------

@query("ud1_scalar_udf_in_sql", "SELECT c_custkey, c_name AS back FROM customer")
def _(t):
    register_functions(t.spark, KEY)
    return t.spark.sql("SELECT c_custkey, tm_alnum_decrypt(tm_alnum_encrypt(c_name)) AS back FROM {c}", c=t.customer)


@query("ud2_sql_function", """
SELECT c_custkey, repeat('*', length(c_name) - 4) || right(c_name, 4) AS masked, repeat('#', length(c_mktsegment)) AS fixed FROM customer""")
def _(t):
    register_functions(t.spark, KEY)
    return t.spark.sql("SELECT c_custkey, tm_mask_lastn(c_name, 4, '*') AS masked, tm_mask_fixed(c_mktsegment, '#') AS fixed FROM {c}", c=t.customer)


@query("ud3_table_function", """
SELECT page_id, unnest(['id,url', page_id || ',' || url]) AS line FROM pages WHERE page_id % 10 <> 9 UNION ALL
SELECT page_id, trim(x, ' ' || chr(9) || chr(13)) FROM (SELECT page_id, unnest(string_split(html, chr(10))) AS x FROM pages WHERE page_id % 10 <> 9)
WHERE trim(x, ' ' || chr(9) || chr(13)) <> ''""")
def _(t):
    register_functions(t.spark, KEY)
    members = arc.select_members(arc.list_members(arc.list_archives(t.spark, page_archives(t))))
    lines = t.spark.sql("SELECT m.archive, l.line FROM {m} m, LATERAL tm_unzip_member(m.archive, m.member) l WHERE l.error IS NULL", m=members)
    return lines.select(_page(), "line")


# --- generation: rows come from a table, values from its key --------------------------

ALL_TYPES = [ColumnSpec(k.lower(), k, False, 4) for k in gen.SPARK_TYPES] + [ColumnSpec("maybe", "INTEGER", True, 6)]


def _draw(row, seed, name, *salt, digits=15):
    """The generator's draw in SQL."""
    keys = ", ".join([f"'{seed}'", f"CAST({row} AS VARCHAR)", f"'{name}'", *[f"CAST({x} AS VARCHAR)" for x in salt]])
    return f"CAST('0x' || substr(md5(concat_ws(':', {keys})), 1, {digits}) AS BIGINT)"


def _pick(alphabet, draw):
    return f"substr('{alphabet}', CAST(1 + {draw} % {len(alphabet)} AS INT), 1)"


def _letters(alphabet, length, row, seed, name, *salt):
    return f"array_to_string(list_transform(range(1, {length + 1}), lambda z: {_pick(alphabet, _draw(row, seed, name, *salt, 'z'))}), '')"


def _pattern(pattern, row, seed, name):
    return " || ".join(_pick(gen.TEMPLATE[c], _draw(row, seed, name, i)) if c in gen.TEMPLATE else f"'{c}'" for i, c in enumerate(pattern))


def _of(words, draw):
    return f"{list(words)}[CAST(1 + {draw} % {len(words)} AS INT)]"


def _made(t, spec, seed=7):
    return gen.generate_for(t.orders.select("o_orderkey"), "o_orderkey", spec, seed)


def _type(*names):
    return [c for c in ALL_TYPES if c.name in names]


_O = lambda name, *salt, **more: _draw("o_orderkey", 7, name, *salt, **more)
_INT4 = f"{_O('integer', 0)} % 10000"
_FLOAT = f"CAST({_O('float', digits=13)} AS DOUBLE) / 4503599627370496 * 400"
_DAY = f"strftime(DATE '2000-01-01' + CAST({_O('date')} % 8766 AS INT), '%Y-%m-%d')"


@query("gn1_generate_columns", f"SELECT o_orderkey, {_letters(gen.ALNUM, 4, 'o_orderkey', 7, 'varchar')} AS varchar, {_INT4} AS integer, {_FLOAT} AS float, {_DAY} AS date FROM orders")
def _(t):
    made = _made(t, _type("varchar", "integer", "float", "date"))
    return made.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@query("gn2_null_share", f"""
SELECT o_orderkey, CASE WHEN CAST({_O('maybe', "'null'", digits=13)} AS DOUBLE) / 4503599627370496 >= 0.1 THEN {_O('maybe', 0)} % 1000000 END AS maybe FROM orders""")
def _(t):
    return _made(t, _type("maybe"))


@query("gn3_varchar_lengths", f"""
SELECT o_orderkey, {_letters(gen.ALNUM, 1, 'o_orderkey', 7, 'one')} AS one, {_letters(gen.ALNUM, 30, 'o_orderkey', 7, 'thirty')} AS thirty,
  {_letters(gen.ALNUM, 5, 'o_orderkey', 7, 'unsaid')} AS unsaid FROM orders""")
def _(t):
    return _made(t, [ColumnSpec("one", length=1), ColumnSpec("thirty", length=30), ColumnSpec("unsaid", length=0)])


def _number(name, length):
    step = f"[1000, 100, 10, 1][CAST(1 + {_O(name, chr(39) + 'scale' + chr(39))} % {min(4, length)} AS INT)]"
    return f"(SELECT v - v % step FROM (SELECT {step} AS step, {_O(name)} % {(10**length - 1) * 10**4 + 1} + {step} // 2 AS v))"


@query("gn4_numbers", f"""
SELECT o_orderkey, {_number('number', 4)} AS ten_thousandths, {_number('small', 2)} AS small, {_INT4} AS integer, {_FLOAT} AS float,
  CAST({_O('long', 0)} % 1000000000000000 AS HUGEINT) * 100000 + {_O('long', 1)} % 100000 AS long FROM orders""")
def _(t):
    made = _made(t, [*_type("number", "integer", "float"), ColumnSpec("small", "NUMBER", length=2), ColumnSpec("long", "INTEGER", length=20)])
    whole = lambda c: (F.col(c) * 10000).cast("bigint")
    return made.select("o_orderkey", whole("number").alias("ten_thousandths"), whole("small").alias("small"), "integer", "float", "long")


def _moment(name):
    return f"TIMESTAMP '2000-01-01 00:00:00' + to_seconds({_O(name, chr(39) + 'second' + chr(39))} % 757382400)"


def _zone(name):
    return _of(gen.OFFSETS, _O(name, "'zone'"))


@query("gn5_dates_and_times", f"""
SELECT o_orderkey, {_DAY} AS date, strftime({_moment('timestamp')}, '%Y-%m-%d %H:%M:%S') AS timestamp, strftime({_moment('timestamp_ntz')}, '%Y-%m-%d %H:%M:%S') AS timestamp_ntz,
  strftime({_moment('timestamp_ltz')} - to_hours({_zone('timestamp_ltz')}), '%Y-%m-%d %H:%M:%S') AS timestamp_ltz,
  strftime({_moment('timestamp_tz')}, '%Y-%m-%d %H:%M:%S') || (CASE WHEN {_zone('timestamp_tz')} < 0 THEN '-' ELSE '+' END) || lpad(CAST(abs({_zone('timestamp_tz')}) AS VARCHAR), 2, '0') || ':00' AS timestamp_tz FROM orders""")
def _(t):
    made = _made(t, _type("date", "timestamp", "timestamp_ntz", "timestamp_ltz", "timestamp_tz"))
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return made.select("o_orderkey", F.date_format("date", "yyyy-MM-dd").alias("date"), *[text(c).alias(c) for c in ("timestamp", "timestamp_ntz", "timestamp_ltz")],
                       F.concat(text("timestamp_tz.ts"), "timestamp_tz.offset").alias("timestamp_tz"))


def _object_key(name, size, *salt):
    return f"""{_letters(gen.ALNUM, size - 1, 'o_orderkey', 7, name, "'key'", *salt)} || substr('{gen.ALNUM}', CAST({salt[-1]} % 62 + 1 AS INT), 1)"""


_VARIANT = f"""list_transform(range(1, 5), lambda i: '"' || {_object_key('variant', 5, 'i')} || '":' || CASE {_O('variant', "'kind'", 'i')} % 3
  WHEN 0 THEN '"' || {_letters(gen.ALNUM, 5, 'o_orderkey', 7, 'variant', "'value'", 'i')} || '"' WHEN 1 THEN CAST({_O('variant', "'value'", 'i')} % 100 + 1 AS VARCHAR)
  ELSE CASE WHEN {_O('variant', "'value'", 'i')} % 2 = 0 THEN 'true' ELSE 'false' END END)"""
_OBJECT = f"""list_transform(range(1, 5), lambda i: '"' || {_object_key('object', 5, 'i')} || '":{{' || array_to_string(list_transform(range(1, 2 + {_O('object', "'size'", 'i')} % 2), lambda j:
  '"' || {_object_key('object', 3, 'i', 'j')} || '":' || ({_O('object', 'i', 'j')} % 100 + 1)), ',') || '}}')"""


@query("gn6_nested_values", f"""
SELECT o_orderkey, {_O('boolean')} % 2 = 0 AS boolean, array_to_string(list_transform(range(1, 5), lambda i: {_O('array', 'i')} % 100 + 1), ',') AS array,
  '{{' || array_to_string(list_sort({_VARIANT}), ',') || '}}' AS variant, '{{' || array_to_string({_OBJECT}, ',') || '}}' AS object FROM orders""")
def _(t):
    made = _made(t, _type("boolean", "array", "variant", "object"))
    return made.select("o_orderkey", "boolean", F.array_join("array", ",").alias("array"), F.to_json("variant").alias("variant"), F.to_json("object").alias("object"))


_PERSON = lambda name, *salt: _draw("c_custkey", 42, name, *salt)


def _people(t, *columns):
    return gen.fake_people(t.customer, "c_custkey", 42, "2024-01-01").select("c_custkey", *columns)


_TEMPLATES = {"ssn": "999-99-9999", "credit_card": "9999-9999-9999-9999", "phone": "(999) 999-9999", "account_number": "9" * 10, "routing_number": "9" * 9}


@query("gn7_fake_people", "SELECT c_custkey, " + ", ".join(
    f"{_pattern(p, 'c_custkey', 42, {'credit_card': 'card', 'account_number': 'account', 'routing_number': 'routing'}.get(n, n))} AS {n}" for n, p in _TEMPLATES.items()) + f""",
  {_letters(gen.UPPER + gen.DIGITS, 9, 'c_custkey', 42, 'passport')} AS passport, {_letters(gen.UPPER + gen.DIGITS, 8, 'c_custkey', 42, 'license')} AS drivers_license FROM customer""")
def _(t):
    return _people(t, *_TEMPLATES, "passport", "drivers_license")


@query("gn8_copied_column", f"SELECT c_custkey, {_pattern('999-99-9999', 'c_custkey', 3, 'ssn')} AS ssn, {_pattern('999-99-9999', 'c_custkey', 3, 'ssn')} AS ssn2 FROM customer")
def _(t):
    spec = [ColumnSpec("ssn", pattern="999-99-9999"), ColumnSpec("ssn2", copy_of="ssn")]
    return gen.generate_for(t.customer.select("c_custkey"), "c_custkey", spec, 3)


@query("gn9_birth_date", f"""
SELECT c_custkey, strftime(DATE '2024-01-01' - CAST({_PERSON('dob')} % 22631 + 6570 AS INT), '%m/%d/%Y') AS dob FROM customer""")
def _(t):
    return _people(t, "dob")


@query("gn10_sequence_id", "SELECT c_custkey, 'CUST' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS customer_id FROM customer")
def _(t):
    return _people(t, "customer_id")


_NAMES = f"{_of(gen.FIRST_NAMES, _PERSON('first'))} AS first, {_of(gen.LAST_NAMES, _PERSON('last'))} AS last"


@query("gn11_names_and_addresses", f"""
SELECT c_custkey, first || ' ' || last AS name, lower(first || '.' || last || c_custkey || '@example.com') AS email,
  ({_PERSON('house')} % 9999 + 1) || ' ' || {_of(gen.STREETS, _PERSON('street'))} || ', ' || {_of(gen.TOWNS, _PERSON('town'))} || ' ' || {_pattern('AA 99999', 'c_custkey', 42, 'zip')} AS address
FROM (SELECT c_custkey, {_NAMES} FROM customer)""")
def _(t):
    return _people(t, "name", "email", "address")


# --- archives: each page is packed as one zip -------------------------------------------

def _dealt_pages(t):
    """Pages for all cores; a few scan tasks would pack them all. Rows of one page stay in one task, as they write one file."""
    return t.pages.select("page_id", "url", "html").repartition(4 * t.spark.sparkContext.defaultParallelism, "page_id")


def page_archives(t):
    """Write one archive per page: two CSV members, a note and a resource fork; every tenth is cut short."""
    root = work_path(t.spark, "zips")
    system, folder = arc.shared_system(root)
    system.create_dir(folder, recursive=True)

    def pack(frames):
        out, _ = arc.shared_system(root)
        for frame in frames:
            for page, url, html in zip(frame["page_id"], frame["url"], frame["html"]):
                held = io.BytesIO()
                with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
                    z.writestr("page.csv", html)
                    z.writestr(f"sub/p{page}.csv", f"id,url\n{page},{url}\n\n".encode("latin-1"))
                    z.writestr("note.txt", "note")
                    z.writestr("__MACOSX/._page.csv", "Mac OS X")
                data = held.getvalue()
                with out.open_output_stream(f"{folder}/a{page}.zip") as stream:
                    stream.write(data[:len(data) // 2] if page % 10 == 9 else data)
            yield frame[["page_id"]]

    _dealt_pages(t).mapInPandas(pack, "page_id long").count()
    return root


def _page(column="archive"):
    return F.regexp_extract(column, r"a(\d+)\.zip$", 1).cast("bigint").alias("page_id")


@query("zip1_zip_lines", r"""
SELECT page_id, trim(x, ' ' || chr(9) || chr(13)) AS line, member FROM (
  SELECT page_id, 'page.csv' AS member, unnest(string_split(html, chr(10))) AS x FROM pages UNION ALL
  SELECT page_id, 'sub/p' || page_id || '.csv', unnest(['id,url', page_id || ',' || url]) FROM pages UNION ALL SELECT page_id, 'note.txt', 'note' FROM pages)
WHERE page_id % 10 <> 9 AND trim(x, ' ' || chr(9) || chr(13)) <> '' UNION ALL
SELECT page_id, NULL, NULL FROM pages WHERE page_id % 10 = 9""")
def _(t):
    return arc.zip_lines(t.spark, page_archives(t)).select(_page(), "line", "member")


@query("zip2_list_members", """
SELECT page_id, m AS member, CASE m WHEN 'page.csv' THEN octet_length(encode(html)) END AS page_bytes
FROM pages, (SELECT unnest(['page.csv', 'sub', 'note.txt', '__MACOSX/._page.csv']) AS m) WHERE page_id % 10 <> 9""")
def _(t):
    members = arc.list_members(arc.list_archives(t.spark, page_archives(t))).filter("error IS NULL")
    return members.select(_page(), F.when(F.col("member").startswith("sub"), "sub").otherwise(F.col("member")).alias("member"),
                          F.when(F.col("member") == "page.csv", F.col("size")).alias("page_bytes"))


@query("zip3_csv_members", "SELECT page_id, unnest(['page.csv', 'sub/p' || page_id || '.csv']) AS member FROM pages WHERE page_id % 10 <> 9")
def _(t):
    return arc.select_members(arc.list_members(arc.list_archives(t.spark, page_archives(t)))).select(_page(), "member")


@query("zip4_members_by_name", "SELECT page_id, 'page.csv' AS member FROM pages WHERE page_id % 10 <> 9 UNION ALL SELECT 3, 'sub/p3.csv'")
def _(t):
    return arc.select_members(arc.list_members(arc.list_archives(t.spark, page_archives(t))), ["page.csv", "p3.csv"]).select(_page(), "member")


@query("zip5_archives_by_name", "SELECT page_id FROM pages WHERE page_id IN (3, 4)")
def _(t):
    return arc.list_archives(t.spark, page_archives(t), ["a3.zip", "a4.zip"]).select(_page())


@query("zip6_split_members", """
SELECT page_id, 'out/20020101/a' || page_id || CASE WHEN octet_length(encode(html)) >= 3000 THEN '/page/page_part001.csv' ELSE '/page.csv' END AS target,
  true AS has_header, octet_length(encode(html)) >= 3000 AS is_split FROM pages WHERE page_id % 10 <> 9""")
def _(t):
    members = arc.select_members(arc.list_members(arc.list_archives(t.spark, page_archives(t))), ["page.csv"])
    lines = arc.split_members(members, "out", "20020101", split_bytes=3000)
    files = lines.groupBy("archive", "target", "is_split").agg((F.min("line_no") == 0).alias("has_header"))
    return files.filter(~F.col("is_split") | F.col("target").endswith("part001.csv")).select(_page(), "target", "has_header", "is_split")


@query("zip6_written_targets", r"""
SELECT page_id, CASE WHEN octet_length(encode(html)) >= 3000 THEN 'page' ELSE 'page.csv' END AS stem, unnest(string_split(rtrim(html, chr(10)), chr(10))[2:]) AS line
FROM pages WHERE page_id % 10 <> 9 UNION ALL
SELECT page_id, CASE WHEN octet_length(encode(html)) >= 3000 THEN 'page' ELSE 'page.csv' END, 'header: ' || string_split(html, chr(10))[1]
FROM pages WHERE page_id % 10 <> 9""")
def _(t):
    root = work_path(t.spark, "targets")
    unpack.unpack(t.spark, page_archives(t), root, "20020101", members=["page.csv"], split_bytes=3000)
    files = arc.list_tree(t.spark, f"{root}/20020101").filter(F.col("path").rlike(r"/20020101/[^/]+/(page/)?[^/]+\.csv$"))
    lines = src.read_file_lines(t.spark, files)
    first = F.row_number().over(Window.partitionBy("file").orderBy("pos")) == 1
    page = F.regexp_extract("file", r"/a(\d+)/", 1).cast("bigint").alias("page_id")
    stem = F.regexp_extract("file", r"/a\d+/([^/]+)", 1).alias("stem")
    rows = lines.withColumn("first", first).select(page, stem, F.when(F.col("first"), F.concat(F.lit("header: "), "line")).otherwise(F.col("line")).alias("line"), "first")
    # every part repeats the header; it counts once
    return rows.filter("NOT first").drop("first").unionByName(rows.filter("first").drop("first").distinct())


def twin_archives(t):
    """For each page two archives of one name in two folders, each with two members of one base name; some bytes are no UTF-8."""
    root = work_path(t.spark, "twins")
    system, folder = arc.shared_system(root)

    def pack(frames):
        out, _ = arc.shared_system(root)
        for frame in frames:
            for page, url, html in zip(frame["page_id"], frame["url"], frame["html"]):
                for side in ("p", "q"):
                    held = io.BytesIO()
                    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
                        z.writestr("s1/page.csv", f"{side} {html}")
                        z.writestr("s2/page.csv", f"{side}\r\n{url} caf\xe9".encode("latin-1"))
                    out.create_dir(f"{folder}/{side}{page}", recursive=True)
                    with out.open_output_stream(f"{folder}/{side}{page}/x.zip") as stream:
                        stream.write(held.getvalue())
            yield frame[["page_id"]]

    _dealt_pages(t).mapInPandas(pack, "page_id long").count()
    return root


_TWINS = """(SELECT page_id, side, unnest(['s1/page.csv', 's2/page.csv']) AS source,
  unnest([octet_length(encode(side || ' ' || html)), octet_length(encode(side || url)) + 7]) AS bytes FROM pages, (SELECT unnest(['p', 'q']) AS side))"""


def _side(column):
    return (F.regexp_extract(column, r"/([pq])\d+/x", 1).alias("side"), F.regexp_extract(column, r"/[pq](\d+)/x", 1).cast("bigint").alias("page_id"))


@query("zip6_equal_names", """
SELECT page_id, side, 's1/page.csv' AS source, sha256(side || ' ' || html) AS sha256 FROM pages, (SELECT unnest(['p', 'q']) AS side) UNION ALL
SELECT page_id, side, 's2/page.csv', sha256(encode(side || chr(13) || chr(10) || url || ' caf') || '\\xE9'::BLOB) FROM pages, (SELECT unnest(['p', 'q']) AS side)""")
def _(t):
    root = work_path(t.spark, "targets")
    unpack.unpack(t.spark, twin_archives(t), root, "20020101")
    files = arc.read_contents(arc.list_tree(t.spark, f"{root}/20020101").filter(F.col("path").endswith(".csv")))
    return files.select(*_side("path"), F.regexp_extract("path", r"/x/(.*)$", 1).alias("source"), F.sha2("content", 256).alias("sha256"))


@query("zip8_equal_names", f"SELECT page_id, side, source, '/20020101/' || side || page_id || '/x/' || source AS target, false AS is_split, bytes, 1 AS status FROM {_TWINS}")
def _(t):
    root = work_path(t.spark, "targets")
    listed = unpack.unpack(t.spark, twin_archives(t), root, "20020101")
    return listed.select(*_side("archive"), F.col("source_full_csv_file_name").alias("source"), F.regexp_extract("target_full_csv_file_name", r"(/20020101/.*)$", 1).alias("target"),
                         "is_split", "bytes", "status")


@query("ud4_unpack_job", """
SELECT page_id, 'page.csv' AS source, octet_length(encode(html)) AS bytes, octet_length(encode(html)) >= 3000 AS is_split, 1 AS status FROM pages WHERE page_id % 10 <> 9 UNION ALL
SELECT page_id, 'sub/p' || page_id || '.csv', octet_length(encode('id,url' || page_id || url)) + 4, false, 1 FROM pages WHERE page_id % 10 <> 9 UNION ALL
SELECT page_id, NULL, NULL, NULL, 3 FROM pages WHERE page_id % 10 = 9""")
def _(t):
    listed = unpack.unpack(t.spark, page_archives(t), work_path(t.spark, "targets"), "20020101", split_bytes=3000, header=False)
    files = listed.groupBy(_page(), F.col("source_full_csv_file_name").alias("source"), "is_split", "status").agg(F.sum("bytes").alias("bytes"))
    return files.select("page_id", "source", "bytes", "is_split", "status")


@query("zip7_route_by_size", "SELECT page_id, octet_length(encode(html)) >= 3000 AS is_split FROM pages WHERE page_id % 10 <> 9")
def _(t):
    members = arc.select_members(arc.list_members(arc.list_archives(t.spark, page_archives(t))), ["page.csv"])
    return arc.route_members(members, 3000).select(_page(), "is_split")


@query("zip8_manifest", """
SELECT page_id, m AS source_full_csv_file_name, 'out/20020101/a' || page_id || '/' || m AS target_full_csv_file_name,
  false AS is_split FROM (SELECT page_id, unnest(['sub/p' || page_id || '.csv', 'page.csv']) AS m FROM pages WHERE page_id % 10 <> 9)""")
def _(t):
    members = arc.select_members(arc.list_members(arc.list_archives(t.spark, page_archives(t))))
    return arc.manifest(arc.split_members(members, "out", "20020101")).select(
        _page(), "source_full_csv_file_name", "target_full_csv_file_name", "is_split")


@query("zip9_archive_outcomes", """
SELECT page_id, CASE WHEN page_id % 10 = 9 THEN 'rejected' ELSE 'archived' END AS outcome, CASE WHEN page_id % 10 = 9 THEN 0 ELSE 4 END AS members FROM pages""")
def _(t):
    members = arc.list_members(arc.list_archives(t.spark, page_archives(t)))
    return arc.archive_outcomes(members, arc.read_members(arc.select_members(members))).select(_page(), "outcome", "members")


@query("zip10_clean_csv", """SELECT page_id || ',' || url AS value FROM pages WHERE page_id % 10 <> 9 UNION ALL SELECT 'id,url' FROM pages WHERE page_id % 10 <> 9 UNION ALL
SELECT trim(x, ' ' || chr(9) || chr(13)) FROM (SELECT unnest(string_split(html, chr(10))) AS x FROM pages WHERE page_id % 10 <> 9)
WHERE trim(x, ' ' || chr(9) || chr(13)) <> ''""")
def _(t):
    members = arc.select_members(arc.list_members(arc.list_archives(t.spark, page_archives(t))))
    path = work_path(t.spark, "clean")
    writers.unload_lines(arc.good_lines(arc.read_members(members)), "line", path)
    return t.spark.read.text(path)


# --- streams ----------------------------------------------------------------------

def _event_stream(t):
    return t.spark.readStream.schema(t.events.schema).option("pathGlobFilter", "events.parquet").parquet(t.folder)


@query("ss1_ingest_new_files", "SELECT event_id, event_type, value FROM events")
def _(t):
    source, target, mark = (work_path(t.spark, n) for n in ("incoming", "loaded", "mark"))
    rows = t.events.select("event_id", "event_type", "value")
    for half in (0, 1):  # the second run sees only the files added after the first
        rows.filter(F.col("event_id") % 2 == half).write.mode("append").csv(source)
        jobs.ingest_new_files(t.spark, source, rows.schema, target, mark).awaitTermination()
    return t.spark.read.parquet(target).drop("source_file")


@query("ss2_incremental_lineage", f"""
SELECT DISTINCT query_id, source_object, target_object FROM {lineage_plans._EDGES}""")
def _(t):
    log, target, mark = (work_path(t.spark, n) for n in ("log", "edges", "mark"))
    rows = lineage_plans.access_log(t)
    for half in ("user_name = 'A'", "user_name != 'A'"):
        rows.filter(half).write.mode("append").parquet(log)
        stream = t.spark.readStream.schema(rows.schema).parquet(log)
        jobs.stream_lineage(stream, target, mark).awaitTermination()
    return t.spark.read.parquet(target).select("query_id", "source_object", "target_object")


@query("ss3_daily_arrivals", """
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*) AS arrived, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_arrival FROM events GROUP BY ALL""")
def _(t):
    source, target, mark = (work_path(t.spark, n) for n in ("events", "daily", "mark"))
    rows = t.events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    # the days of the second half of a month come first, then those before: late by weeks
    for part in ("dayofmonth(ts) >= 15", "dayofmonth(ts) < 15 AND event_id % 2 = 0", "dayofmonth(ts) < 15 AND event_id % 2 = 1"):
        rows.filter(part).write.mode("append").parquet(source)
        daily = jobs.daily_arrivals(t.spark.readStream.schema(rows.schema).parquet(source), "ts", "event_type")
        jobs.store_versions(daily, target, mark).awaitTermination()
    held = jobs.latest_versions(t.spark, target, ["day", "event_type"])
    return held.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "event_type", "arrived", F.date_format("last_arrival", "yyyy-MM-dd HH:mm:ss").alias("last_arrival"))


@query("ss4_masked_stream", f"""
SELECT event_id, repeat('X', length(event_type) - 2) || right(event_type, 2) AS event_type, left(sha256('{SALT}' || props), 16) AS props FROM events""")
def _(t):
    target, mark = work_path(t.spark, "masked"), work_path(t.spark, "mark")
    rules = [Rule("event_type", "MASK_LASTN", {"n": 2}), Rule("props", "HASH_DETERMINISTIC", max_length=16)]
    masked = obf.obfuscate(_event_stream(t).select("event_id", "event_type", "props"), rules, SALT)
    jobs.write_once(masked, target, mark).awaitTermination()
    return t.spark.read.parquet(target)
