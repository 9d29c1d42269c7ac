"""Checked queries over the relational surface: projection to set operations."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from tidemark.operators import ranks, relational as rel
from tidemark.plans.registry import query

DAY = "yyyy-MM-dd"


def money(column):
    """Exact sums whatever the row order; back to double for the result."""
    return F.sum(F.col(column).cast("decimal(18,2)")).cast("double")


# --- projection -------------------------------------------------------------------

@query("prj1_select_alias", "SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice AS order_amount FROM orders")
def _(t):
    return t.orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
                           F.col("o_totalprice").alias("order_amount"))


@query("prj2_arithmetic", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST(CAST(l_quantity AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(12,2)) AS DOUBLE) AS total_discount
FROM lineitem""")
def _(t):
    qty, disc = F.col("l_quantity").cast("decimal(12,2)"), F.col("l_discount").cast("decimal(12,2)")
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                             (qty * disc).cast("double").alias("total_discount"))


@query("prj3_literal", "SELECT p_partkey, 'piece' AS unit, CAST(0.19 AS DOUBLE) AS rate, CAST(NULL AS VARCHAR) AS note FROM part")
def _(t):
    return t.part.select("p_partkey", F.lit("piece").alias("unit"), F.lit(0.19).alias("rate"), F.lit(None).cast("string").alias("note"))


@query("prj4_with_column", "SELECT s_suppkey, upper(s_name) AS s_name, s_nationkey, s_acctbal, s_acctbal < 0 AS overdrawn FROM supplier")
def _(t):
    return t.supplier.withColumn("s_name", F.upper("s_name")).withColumn("overdrawn", F.col("s_acctbal") < 0)


@query("prj5_case_chain", """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_quantity IS NULL THEN 'unknown' WHEN l_quantity < 10 THEN 'single' WHEN l_quantity < 35 THEN 'pack' ELSE 'pallet' END AS shipped_as,
       CASE WHEN l_returnflag = 'R' THEN 0.0 ELSE l_quantity END AS quantity_kept
FROM lineitem""")
def _(t):
    quantity = F.col("l_quantity")
    shipped = F.when(quantity.isNull(), "unknown").when(quantity < 10, "single").when(quantity < 35, "pack").otherwise("pallet")
    return t.lineitem.select("l_orderkey", "l_linenumber", shipped.alias("shipped_as"), F.expr("if(l_returnflag = 'R', 0.0D, double(l_quantity))").alias("quantity_kept"))


@query("prj7_rename_set", """
SELECT c_custkey AS "ACCOUNT_ID", c_name AS "ACCOUNT_NAME", c_mktsegment AS "COLLATERAL_TYPE", c_acctbal AS "MARKET_VALUE" FROM customer""")
def _(t):
    names = {"c_custkey": "ACCOUNT_ID", "c_name": "ACCOUNT_NAME",
             "c_mktsegment": "COLLATERAL_TYPE", "c_acctbal": "MARKET_VALUE"}
    return t.customer.select(*names).withColumnsRenamed(names)


# --- filters ----------------------------------------------------------------------

@query("flt1_comparisons", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE l_quantity > 5 AND l_returnflag = 'R' AND l_discount <> 0 AND l_quantity <= 40 AND l_tax < 0.05""")
def _(t):
    kept = t.lineitem.filter(rel.all_of([
        F.col("l_quantity") > 5, F.col("l_returnflag") == "R", F.col("l_discount") != 0,
        F.col("l_quantity") <= 40, F.col("l_tax") < 0.05]))
    return kept.select("l_orderkey", "l_linenumber", "l_partkey")


@query("flt2_and_or_not", """
SELECT o_orderkey FROM orders
WHERE (o_totalprice > 100000 AND o_orderstatus = 'O') OR (o_totalprice < 5000 AND NOT o_orderpriority = '5-LOW')""")
def _(t):
    big = (F.col("o_totalprice") > 100000) & (F.col("o_orderstatus") == "O")
    small = (F.col("o_totalprice") < 5000) & ~(F.col("o_orderpriority") == "5-LOW")
    return t.orders.filter(big | small).select("o_orderkey")


@query("flt3_like_ilike", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%ring%' OR p_brand ILIKE 'bRAND#1%'")
def _(t):
    return t.part.filter(F.col("p_name").like("%ring%") | F.col("p_brand").ilike("bRAND#1%")).select("p_partkey", "p_name")


@query("flt4_starts_ends_contains", """
SELECT p_partkey, p_name FROM part
WHERE starts_with(p_name, 'small') OR ends_with(p_name, 'bolt') OR contains(p_name, 'ed w')""")
def _(t):
    name = F.col("p_name")
    return t.part.filter(name.startswith("small") | name.endswith("bolt") | name.contains("ed w")).select("p_partkey", "p_name")


@query("flt5_null_checks", """
SELECT d.doc_id, l.quality IS NULL AS unlabelled FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE l.quality IS NULL OR l.toxic IS NOT NULL""")
def _(t):
    joined = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return (joined.filter(F.col("quality").isNull() | F.col("toxic").isNotNull())
            .select("doc_id", F.col("quality").isNull().alias("unlabelled")))


@query("flt6_in_list", """
SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('F', 'P') AND o_orderpriority NOT IN ('1-URGENT', '5-LOW')""")
def _(t):
    return t.orders.filter(F.col("o_orderstatus").isin("F", "P")
                           & ~F.col("o_orderpriority").isin("1-URGENT", "5-LOW")).select("o_orderkey")


@query("flt7_between", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice BETWEEN 1000 AND 50000")
def _(t):
    return t.orders.filter(F.col("o_totalprice").between(1000, 50000)).select("o_orderkey", "o_totalprice")


@query("flt8_full_regex", r"SELECT page_id, url FROM pages WHERE regexp_full_match(url, 'https://[a-z.]+\.net/en/[0-9]+.*')")
def _(t):
    return t.pages.filter(F.col("url").rlike(r"^https://[a-z.]+\.net/en/[0-9]+.*$")).select("page_id", "url")


@query("flt9_function_predicate", "SELECT p_partkey FROM part WHERE length(p_name) > 8 AND upper(p_type) = 'ECONOMY'")
def _(t):
    return t.part.filter((F.length("p_name") > 8) & (F.upper("p_type") == "ECONOMY")).select("p_partkey")


@query("flt10_having", """
SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS tot FROM orders GROUP BY o_custkey
HAVING sum(CAST(o_totalprice AS DECIMAL(18,2))) > 1000000""")
def _(t):
    return t.orders.groupBy("o_custkey").agg(money("o_totalprice").alias("tot")).filter(F.col("tot") > 1000000)


@query("flt11_in_subquery", "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def _(t):
    return rel.in_subquery(t.customer, "c_custkey", t.orders.filter("o_orderstatus = 'F'"), "o_custkey").select("c_custkey")


@query("flt11_not_in_subquery", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def _(t):
    return rel.in_subquery(t.orders, "o_orderkey", t.lineitem, "l_orderkey", negate=True).select("o_orderkey")


@query("flt12_alias_filter", """
SELECT * FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS closed_priority FROM orders)
WHERE closed_priority IS NOT NULL""")
def _(t):
    closed = F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority"))
    return t.orders.select("o_orderkey", closed.alias("closed_priority")).filter(F.col("closed_priority").isNotNull())


@query("flt13_fill_nulls", """
SELECT d.doc_id, coalesce(quality, -1) AS quality, coalesce(toxic, 0) AS toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def _(t):
    return t.documents.select("doc_id").join(t.labels, "doc_id", "left").na.fill({"quality": -1, "toxic": 0})


@query("flt14_keep_first_duplicate", """
SELECT o_custkey, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1""")
def _(t):
    orders = t.orders.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return rel.first_per_key(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


# --- joins ------------------------------------------------------------------------

@query("jn1_inner_expression", """
SELECT c.c_custkey, c.c_name, o.o_orderkey, strftime(o.o_orderdate, '%Y-%m-%d') AS order_date
FROM customer c JOIN orders o ON c.c_custkey = o.o_custkey""")
def _(t):
    c, o = t.customer, t.orders
    return c.join(o, c["c_custkey"] == o["o_custkey"]).select(
        "c_custkey", "c_name", "o_orderkey", F.date_format("o_orderdate", DAY).alias("order_date"))


@query("jn2_shared_name", "SELECT doc_id, lang, quality FROM documents JOIN labels USING (doc_id)")
def _(t):
    return rel.join_frames(t.documents, t.labels, "inner join", "doc_id").select("doc_id", "lang", "quality")


def _customer_orders(t, kind):
    """Customers and their urgent orders; keys without a partner occur on both sides."""
    customers = t.customer.filter("c_acctbal > 0").select("c_custkey", "c_name")
    orders = t.orders.filter("o_orderpriority = '1-URGENT'").select("o_orderkey", "o_custkey")
    return rel.join_frames(customers, orders, kind, customers["c_custkey"] == orders["o_custkey"])


def _customer_orders_sql(kind, columns="c_custkey, c_name, o_orderkey, o_custkey"):
    return f"""
SELECT {columns} FROM (SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 0) c
{kind} (SELECT o_orderkey, o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') o ON c.c_custkey = o.o_custkey"""


@query("jn3_left_outer", _customer_orders_sql("LEFT JOIN"))
def _(t):
    return _customer_orders(t, "left outer join")


@query("jn4_right_outer", _customer_orders_sql("RIGHT JOIN"))
def _(t):
    return _customer_orders(t, "right outer join")


@query("jn5_full_outer", _customer_orders_sql("FULL JOIN"))
def _(t):
    return _customer_orders(t, "full outer join")


@query("jn6_cross_one_row", """
SELECT o_orderkey, o_totalprice, p.top_price, o_totalprice = p.top_price AS is_top
FROM orders CROSS JOIN (SELECT max(o_totalprice) AS top_price FROM orders) p""")
def _(t):
    top = t.orders.agg(F.max("o_totalprice").alias("top_price"))
    return (rel.attach_one_row(t.orders.select("o_orderkey", "o_totalprice"), top)
            .select("o_orderkey", "o_totalprice", "top_price", (F.col("o_totalprice") == F.col("top_price")).alias("is_top")))


def _pairs(t):
    """Two tables that share the column names doc_id and lang in part."""
    left = t.documents.select("doc_id", "lang", "source")
    right = (t.documents.join(t.labels, "doc_id")
             .select((F.col("doc_id") + F.col("toxic")).alias("doc_id"), "lang", "quality"))
    return left, right


_PAIRS_SQL = """
WITH l AS (SELECT doc_id, lang, source FROM documents),
     r AS (SELECT d.doc_id + b.toxic AS doc_id, d.lang, b.quality FROM documents d JOIN labels b ON d.doc_id = b.doc_id)
SELECT * FROM l {} JOIN r"""


@query("jn7_natural_inner", _PAIRS_SQL.format("NATURAL"))
def _(t):
    return rel.join_frames(*_pairs(t), "natural join")


@query("jn7_natural_left", _PAIRS_SQL.format("NATURAL LEFT"))
def _(t):
    return rel.join_frames(*_pairs(t), "natural left join")


@query("jn7_natural_right", _PAIRS_SQL.format("NATURAL RIGHT"))
def _(t):
    return rel.join_frames(*_pairs(t), "natural right join")


@query("jn7_natural_full", _PAIRS_SQL.format("NATURAL FULL"))
def _(t):
    return rel.join_frames(*_pairs(t), "natural full join")


@query("jn8_left_semi", _customer_orders_sql("SEMI JOIN", "c_custkey, c_name"))
def _(t):
    return _customer_orders(t, "left semi join")


@query("jn8_left_anti", _customer_orders_sql("ANTI JOIN", "c_custkey, c_name"))
def _(t):
    return _customer_orders(t, "left anti join")


@query("jn9_right_semi", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'
AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""")
def _(t):
    return _customer_orders(t, "right semi join")


@query("jn9_right_anti", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'
AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""")
def _(t):
    return _customer_orders(t, "right anti join")


@query("jn10_anti_by_null", """
SELECT o_orderkey FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey WHERE l_orderkey IS NULL""")
def _(t):
    return rel.anti_by_null(t.orders, t.lineitem, "o_orderkey", "l_orderkey").select("o_orderkey")


@query("jn11_multi_key", """
SELECT a.l_orderkey, a.l_linenumber, a.l_partkey, b.n FROM lineitem a
JOIN (SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY ALL) b
ON a.l_partkey = b.l_partkey AND a.l_suppkey = b.l_suppkey""")
def _(t):
    n = t.lineitem.groupBy("l_partkey", "l_suppkey").agg(F.count("*").alias("n"))
    return t.lineitem.join(n, ["l_partkey", "l_suppkey"]).select("l_orderkey", "l_linenumber", "l_partkey", "n")


@query("jn12_basename_anti", """
SELECT u.path, u.priority FROM (SELECT 'in/' || o_orderstatus || '/f' || o_orderkey || '.csv' AS path, o_orderpriority AS priority FROM orders) u
ANTI JOIN (SELECT DISTINCT 'f' || l_orderkey || '.csv' AS base, o_orderpriority FROM lineitem JOIN orders ON o_orderkey = l_orderkey) d
ON split_part(u.path, '/', -1) = d.base AND u.priority = d.o_orderpriority""")
def _(t):
    listed = t.orders.select(
        F.concat(F.lit("in/"), "o_orderstatus", F.lit("/f"), F.col("o_orderkey").cast("string"), F.lit(".csv")).alias("path"),
        F.col("o_orderpriority").alias("priority"))
    loaded = (t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
              .select(F.concat(F.lit("done/f"), F.col("l_orderkey").cast("string"), F.lit(".csv")).alias("done"),
                      F.col("o_orderpriority").alias("priority")))
    return rel.anti_by_basename(listed, "path", loaded, "done", ["priority"])


@query("jn14_lateral_flatten", r"""
SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents""")
def _(t):
    return t.documents.select("doc_id", F.explode(F.split("text", "\n")).alias("line"))


@query("jn15_free_text_on", """
SELECT o.o_orderkey, c.c_custkey FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey AND c.c_acctbal > 9000""")
def _(t):
    return (t.orders.alias("o").join(t.customer.alias("c"), F.expr("o.o_custkey = c.c_custkey AND c.c_acctbal > 9000"))
            .select("o.o_orderkey", "c.c_custkey"))


# --- aggregates -------------------------------------------------------------------

@query("ag1_global", """
SELECT CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS qty_sum, round(stddev(l_quantity), 6) AS qty_std,
       count(l_quantity) AS qty_count, min(l_quantity) AS qty_min, max(l_extendedprice) AS price_max FROM lineitem""")
def _(t):
    return t.lineitem.agg(
        money("l_quantity").alias("qty_sum"), F.round(F.stddev("l_quantity"), 6).alias("qty_std"),
        F.count("l_quantity").alias("qty_count"), F.min("l_quantity").alias("qty_min"),
        F.max("l_extendedprice").alias("price_max"))


@query("ag2_dict_form", "SELECT min(l_quantity) AS qty_min, max(l_extendedprice) AS price_max FROM lineitem")
def _(t):
    return (t.lineitem.agg({"l_quantity": "min", "l_extendedprice": "max"})
            .withColumnsRenamed({"min(l_quantity)": "qty_min", "max(l_extendedprice)": "price_max"}))


@query("ag3_group_by", """
SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS qty_sum,
       round(stddev(l_extendedprice), 3) AS price_std, count(*) AS n FROM lineitem GROUP BY ALL""")
def _(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        money("l_quantity").alias("qty_sum"), F.round(F.stddev("l_extendedprice"), 3).alias("price_std"),
        F.count("*").alias("n"))


@query("ag4_chain_top_k", """
SELECT DISTINCT lines, CAST(quantity AS DOUBLE) AS quantity FROM (
  SELECT l_partkey, count(*) AS lines, sum(CAST(l_quantity AS DECIMAL(18,2))) AS quantity FROM lineitem WHERE l_returnflag <> 'R' GROUP BY l_partkey HAVING count(*) > 1)
ORDER BY lines DESC, quantity DESC LIMIT 7""")
def _(t):
    # the largest pairs of lines and quantity that any part reaches
    kept = t.lineitem.filter("l_returnflag <> 'R'")
    parts = kept.groupBy("l_partkey").agg(F.count("*").alias("lines"), money("l_quantity").alias("quantity")).filter("lines > 1")
    return parts.select("lines", "quantity").distinct().orderBy(F.desc("lines"), F.desc("quantity")).limit(7)


@query("ag5_avg", "SELECT o_orderpriority, round(avg(o_totalprice), 3) AS avg_amount FROM orders GROUP BY o_orderpriority")
def _(t):
    return t.orders.groupBy("o_orderpriority").agg(F.round(F.avg("o_totalprice"), 3).alias("avg_amount"))


@query("ag6_count_distinct", """
SELECT p_brand, count(*) AS n, count(DISTINCT p_size) AS sizes, count(DISTINCT p_type) AS types FROM part GROUP BY p_brand""")
def _(t):
    return t.part.groupBy("p_brand").agg(F.count("*").alias("n"), F.count_distinct("p_size").alias("sizes"),
                                         F.count_distinct("p_type").alias("types"))


@query("ag7_listagg", """
SELECT p_brand, string_agg(p_type, ', ' ORDER BY p_type) AS types FROM (SELECT DISTINCT p_brand, p_type FROM part) GROUP BY p_brand""")
def _(t):
    return (t.part.select("p_brand", "p_type").distinct().groupBy("p_brand")
            .agg(F.expr("listagg(p_type, ', ') WITHIN GROUP (ORDER BY p_type)").alias("types")))


@query("ag9_distinct", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def _(t):
    return t.lineitem.select("l_returnflag", "l_linestatus", "l_linenumber").distinct()


@query("ag10_scalar_subquery", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > (SELECT avg(o_totalprice) * 1.9 FROM orders)""")
def _(t):
    bar = t.orders.agg(F.avg("o_totalprice") * 1.9).scalar()
    return t.orders.filter(F.col("o_totalprice") > bar).select("o_orderkey", "o_totalprice")


@query("ag11_min_equals_max", """
SELECT o_custkey, min(o_orderpriority) = max(o_orderpriority) AS consistent FROM orders GROUP BY o_custkey""")
def _(t):
    return t.orders.groupBy("o_custkey").agg((F.min("o_orderpriority") == F.max("o_orderpriority")).alias("consistent"))


@query("ag12_rows_to_lists", """
SELECT n_regionkey, string_agg(n_nationkey || ':' || n_name, '|' ORDER BY n_nationkey) AS nations FROM nation GROUP BY n_regionkey""")
def _(t):
    grouped = t.nation.groupBy("n_regionkey").agg(
        F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("rows"))
    return grouped.select("n_regionkey", F.array_join(F.transform(
        "rows", lambda r: F.concat(r["n_nationkey"].cast("string"), F.lit(":"), r["n_name"])), "|").alias("nations"))


# --- windows ----------------------------------------------------------------------

@query("wn1_row_number", """
SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS row_num FROM orders""")
def _(t):
    orders = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    return ranks.row_number_by(orders, ["o_custkey"], [F.col("o_totalprice").desc(), F.col("o_orderkey")]).select("o_orderkey", "row_num")


@query("wn2_global_row_number", """
SELECT row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey) AS "rank", o_orderkey, o_totalprice FROM orders""")
def _(t):
    orders = t.orders.select("o_orderdate", "o_orderkey", "o_totalprice")
    return ranks.global_rank(orders, [F.col("o_orderdate").desc(), F.col("o_orderkey")]).select("rank", "o_orderkey", "o_totalprice")


@query("wn3_latest_per_key", """
SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def _(t):
    return (rel.latest_per_key(t.events.select("user_id", "event_id", "event_type", "ts"), ["user_id"], ["ts", "event_id"])
            .select("user_id", "event_id", "event_type"))


@query("wn4_count_over_all", "SELECT p_partkey, count(*) OVER () AS total FROM part")
def _(t):
    return t.part.select("p_partkey", t.part.agg(F.count("*")).scalar().alias("total"))


_LINES_SQL = "SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents"


def _lines(t):
    return t.documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


@query("wn5_row_after_marker", f"""
SELECT doc_id, line_no, line FROM (
  SELECT *, lag(contains(line, ' the ')) OVER (PARTITION BY doc_id ORDER BY line_no) AS after FROM ({_LINES_SQL})) WHERE after""")
def _(t):
    return (ranks.previous_value(_lines(t), ["doc_id"], "line_no", F.col("line").contains(" the "), "after")
            .filter("after").drop("after"))


@query("wn6_running_group_id", f"""
SELECT doc_id, line_no, CAST(sum(CASE WHEN contains(line, ' the ') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS BIGINT) AS group_id
FROM ({_LINES_SQL})""")
def _(t):
    return (ranks.running_sum(_lines(t), ["doc_id"], "line_no", F.col("line").contains(" the ").cast("int"), "group_id")
            .select("doc_id", "line_no", "group_id"))


@query("wn7_carry_label", """
SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN text END IGNORE NULLS) OVER
  (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS asked FROM conversations""")
def _(t):
    asked = F.when(F.col("role") == "user", F.col("text"))
    return ranks.carry_forward(t.conversations, ["conv_id"], "turn", asked, "asked").select("conv_id", "turn", "asked")


# --- sort and limit ---------------------------------------------------------------

@query("so1_multi_key_sort", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_custkey ASC NULLS LAST, o_totalprice DESC NULLS LAST")
def _(t):
    return t.orders.select("o_orderkey", "o_custkey", "o_totalprice").orderBy(
        F.col("o_custkey").asc_nulls_last(), F.col("o_totalprice").desc_nulls_last())


@query("so2_ascending_list", "SELECT l_orderkey, l_quantity FROM lineitem ORDER BY l_quantity, l_orderkey")
def _(t):
    lines = t.lineitem.select("l_orderkey", "l_quantity")
    return rel.sort_by(lines, [F.col("l_quantity"), F.col("l_orderkey").desc()], ascending=[1, 1])


@query("so3_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def _(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(100)


@query("so4_page", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 50 OFFSET 200")
def _(t):
    return rel.page(t.orders.select("o_orderkey", "o_totalprice"), [F.col("o_totalprice"), F.col("o_orderkey")], 50, 200)


@query("so5_order_by_ordinal", "SELECT DISTINCT o_orderpriority, o_orderstatus FROM orders ORDER BY 1, 2")
def _(t):
    return t.orders.select("o_orderpriority", "o_orderstatus").distinct().orderBy(1, 2)


# --- sets -------------------------------------------------------------------------

@query("st1_union_all", """
SELECT 'order' AS kind, o_orderkey AS id, o_totalprice AS amount FROM orders
UNION ALL SELECT 'customer', c_custkey, NULL FROM customer""")
def _(t):
    orders = t.orders.select(F.lit("order").alias("kind"), F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("amount"))
    customers = t.customer.select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"))
    return orders.unionByName(customers, allowMissingColumns=True)


@query("st2_difference", """
SELECT p_brand, p_type FROM part WHERE p_size <= 25 EXCEPT SELECT p_brand, p_type FROM part WHERE p_size > 45""")
def _(t):
    return (t.part.filter("p_size <= 25").select("p_brand", "p_type").distinct()
            .join(t.part.filter("p_size > 45").select("p_brand", "p_type"), ["p_brand", "p_type"], "left_anti"))


@query("st3_distinct_of_two_columns", """
SELECT DISTINCT node FROM (SELECT 'n' || s_nationkey AS node FROM supplier UNION ALL SELECT 'c' || c_custkey FROM customer UNION ALL SELECT 'n' || c_nationkey FROM customer)""")
def _(t):
    nation = lambda c: F.concat(F.lit("n"), F.col(c).cast("string"))
    both = t.customer.select(F.explode(F.array(F.concat(F.lit("c"), F.col("c_custkey").cast("string")), nation("c_nationkey"))).alias("node"))
    return t.supplier.select(nation("s_nationkey").alias("node")).union(both).distinct()


@query("jn13_conditional_left_join", """
SELECT o_orderkey, c_name FROM orders LEFT JOIN customer ON o_orderstatus = 'O' AND o_custkey = c_custkey AND c_acctbal < o_totalprice""")
def _(t):
    o, c = t.orders, t.customer
    on = (o.o_custkey == c.c_custkey) & (c.c_acctbal < o.o_totalprice)
    return rel.conditional_left_join(o, c, o.o_orderstatus == "O", on).select("o_orderkey", "c_name")


@query("jn16_merge_one_to_one", """
SELECT c_custkey, c_name, n FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey""")
def _(t):
    counts = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    return rel.merge_one_to_one(t.customer.select("c_custkey", "c_name"), counts, ["c_custkey"], "left")
