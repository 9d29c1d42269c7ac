"""Checked queries over lineage: each lineitem row is one logged query."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import lineage as lin
from tidemark.plans.registry import query
from tidemark.sinks.writers import new_rows

SINCE = "1998-01-01 00:00:00"


def _ts(text):
    return F.lit(text).cast("timestamp_ntz")


def access_log(t):
    """A query reads a part table and an order view and writes a supplier table and a temporary stage."""
    name = lambda kind, c: F.concat(F.lit(kind), F.col(c).cast("string"))
    obj = lambda n, d: F.struct(n.alias("objectName"), F.lit(d).alias("objectDomain"))
    return t.lineitem.select(
        name("q", "l_orderkey").alias("query_id"), F.col("l_shipdate").alias("query_start_time"), F.col("l_returnflag").alias("user_name"),
        F.array(obj(name("part_", "l_partkey"), "Table"), obj(name("order_", "l_orderkey"), "View"),
                obj(F.lit("tmp"), "Stage")).alias("direct_objects_accessed"),
        F.array(obj(name("supplier_", "l_suppkey"), "Table"), obj(F.lit(None).cast("string"), "Table")).alias("objects_modified"))


_EDGES = """(SELECT 'q' || l_orderkey AS query_id, l_shipdate AS query_start_time, l_returnflag AS user_name, s.src AS source_object,
  'supplier_' || l_suppkey AS target_object, 'READ_TO_WRITE' AS edge_type
FROM lineitem, LATERAL (SELECT unnest(['part_' || l_partkey, 'order_' || l_orderkey]) AS src) s)"""


@query("ln1_lineage_edges", f"""
SELECT query_id, strftime(query_start_time, '%Y-%m-%d') AS day, user_name, source_object, target_object, edge_type
FROM {_EDGES} WHERE query_start_time >= TIMESTAMP '{SINCE}'""")
def _(t):
    edges = lin.lineage_edges(access_log(t), _ts(SINCE))
    return edges.withColumn("day", F.date_format("query_start_time", "yyyy-MM-dd")).drop("query_start_time")


@query("ln2_refresh_edges", f"""
SELECT query_id, source_object, target_object, min(user_name) AS user_name, '2002-01-01' AS loaded FROM (
  SELECT * FROM {_EDGES} f WHERE NOT EXISTS (SELECT 1 FROM {_EDGES} e WHERE e.query_start_time < TIMESTAMP '{SINCE}'
    AND e.query_id = f.query_id AND e.source_object = f.source_object AND e.target_object = f.target_object)
  QUALIFY row_number() OVER (PARTITION BY query_id, source_object, target_object ORDER BY query_start_time, user_name) = 1) GROUP BY ALL""")
def _(t):
    edges = lin.lineage_edges(access_log(t))
    stored = edges.filter(F.col("query_start_time") < _ts(SINCE))
    fresh = lin.refresh_edges(stored, edges, _ts("2002-01-01 00:00:00"))
    return fresh.select(*lin.EDGE_KEYS, "user_name", F.date_format("load_ts", "yyyy-MM-dd").alias("loaded"))


@query("ln3_latest_edges", f"""
SELECT query_id, source_object, target_object, strftime(max(query_start_time), '%Y-%m-%d') AS day FROM {_EDGES} GROUP BY ALL""")
def _(t):
    # the log is dealt by query before its arrays unfold, so that the window finds its keys in place
    return lin.latest_edges(lin.lineage_edges(access_log(t).repartition("query_id"))).select(
        *lin.EDGE_KEYS, F.date_format("query_start_time", "yyyy-MM-dd").alias("day"))


@query("ln4_upstream", f"SELECT DISTINCT source_object FROM {_EDGES} WHERE target_object = 'supplier_7'")
def _(t):
    return lin.upstream(lin.lineage_edges(access_log(t)), "supplier_7")


@query("ln4_downstream", f"SELECT DISTINCT target_object FROM {_EDGES} WHERE source_object = 'part_11'")
def _(t):
    return lin.downstream(lin.lineage_edges(access_log(t)), "part_11")


_GRAPH = f"""(SELECT source_object, target_object FROM {_EDGES} WHERE query_start_time >= TIMESTAMP '{SINCE}'
  ORDER BY source_object, target_object, query_id)"""


@query("ln5_graph_edges", f"SELECT * FROM {_GRAPH}")
def _(t):
    return lin.graph_edges(lin.lineage_edges(access_log(t)), _ts(SINCE))


@query("ln5_graph_nodes", f"""
SELECT row_number() OVER (ORDER BY node) - 1 AS node_id, node FROM
  (SELECT source_object AS node FROM {_GRAPH} UNION SELECT target_object FROM {_GRAPH})""")
def _(t):
    return lin.graph_nodes(lin.graph_edges(lin.lineage_edges(access_log(t)), _ts(SINCE)))


@query("snk6_insert_only_merge", """
SELECT DISTINCT l_orderkey, l_partkey FROM lineitem l WHERE l_returnflag = 'R' AND NOT EXISTS
  (SELECT 1 FROM lineitem o WHERE o.l_returnflag = 'A' AND o.l_orderkey = l.l_orderkey AND o.l_partkey = l.l_partkey)""")
def _(t):
    pairs = lambda flag: t.lineitem.filter(F.col("l_returnflag") == flag).select("l_orderkey", "l_partkey")
    return new_rows(pairs("A"), pairs("R"), ["l_orderkey", "l_partkey"])
