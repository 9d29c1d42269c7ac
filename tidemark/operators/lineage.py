"""Read→write edges from an access log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.ranks import global_rank
from tidemark.operators.relational import latest_per_key
from tidemark.sinks.writers import new_rows

EDGE_TYPE = "READ_TO_WRITE"
DOMAINS = ("Table", "View")
EDGE_KEYS = ["query_id", "source_object", "target_object"]


def _named(rows: DataFrame, objects: str, out: str) -> DataFrame:
    """One row for each named table or view of an object array; the filter stays in generated code."""
    each = rows.withColumn("_o", F.explode(objects)).drop(objects)
    kept = each.filter(F.col("_o")["objectDomain"].isin(*DOMAINS) & F.col("_o")["objectName"].isNotNull())
    return kept.withColumn(out, F.col("_o")["objectName"]).drop("_o")


def lineage_edges(access: DataFrame, since=None) -> DataFrame:
    """One edge per object read and object written by the same logged query.

    Both arrays sit on the log row, so two explodes take the place of a join on the
    query and nothing is shuffled.
    """
    rows = access if since is None else access.filter(F.col("query_start_time") >= F.lit(since))
    rows = rows.select("query_id", "query_start_time", "user_name", "direct_objects_accessed", "objects_modified")
    both = _named(_named(rows, "direct_objects_accessed", "source_object"), "objects_modified", "target_object")
    return both.select("query_id", "query_start_time", "user_name", "source_object", "target_object", F.lit(EDGE_TYPE).alias("edge_type"))


def refresh_edges(edges: DataFrame, fresh: DataFrame, load_ts) -> DataFrame:
    """The fresh edges not yet stored, stamped with their load time."""
    return new_rows(edges, fresh, EDGE_KEYS).withColumn("load_ts", F.lit(load_ts))


EDGE_TABLE = "query_id string, query_start_time timestamp, user_name string, source_object string, target_object string, edge_type string, load_ts timestamp"

_REFRESH = """
INSERT INTO IDENTIFIER(:edges)
SELECT query_id, first.query_start_time, first.user_name, source_object, target_object, first.edge_type, CAST(:as_of AS TIMESTAMP)
FROM (SELECT query_id, source_object, target_object, min(struct(CAST(query_start_time AS TIMESTAMP) AS query_start_time, user_name, edge_type)) AS first
      FROM {fresh} GROUP BY ALL) AS f
LEFT ANTI JOIN IDENTIFIER(:edges) AS e USING (query_id, source_object, target_object)"""


def refresh_job(spark: SparkSession, access: DataFrame, table: str, days_back: int, as_of: str) -> DataFrame:
    """Merge the edges of the last ``days_back`` days before ``as_of`` into ``table``, which is made if it isn't there; one status row.

    Every value is a parameter of the statements, and a null key is no edge. A second call adds nothing.
    """
    columns = ", ".join(EDGE_TABLE.split(", "))
    spark.sql(f"CREATE TABLE IF NOT EXISTS IDENTIFIER(:edges) ({columns}) USING parquet", args={"edges": table})
    before = spark.table(table).count()
    since = spark.sql("SELECT CAST(:as_of AS TIMESTAMP) - make_interval(0, 0, 0, :days) AS since", args={"as_of": as_of, "days": days_back}).first().since
    fresh = lineage_edges(access, since)
    spark.sql(_REFRESH, args={"edges": table, "as_of": as_of}, fresh=fresh)
    return spark.sql(
        "SELECT :days AS days_back, count(*) AS edges, count(*) - :before AS inserted, min(query_start_time) >= CAST(:since AS TIMESTAMP) AS in_window, 1 AS status FROM IDENTIFIER(:edges)",
        args={"edges": table, "days": days_back, "before": before, "since": since})


def latest_edges(edges: DataFrame) -> DataFrame:
    """The newest edge of each key; dealing the log by ``query_id`` beforehand saves the shuffle of edges."""
    # the edge type is the same everywhere and breaks no tie
    kind = "edge_type" in edges.columns
    latest = latest_per_key(edges.drop("edge_type"), EDGE_KEYS, ["query_start_time"])
    return latest.withColumn("edge_type", F.lit(EDGE_TYPE)).select(*edges.columns) if kind else latest


def upstream(edges: DataFrame, target: str | None = None) -> DataFrame:
    kept = edges if target is None else edges.filter(F.col("target_object") == target)
    return kept.select("source_object").distinct().orderBy("source_object")


def downstream(edges: DataFrame, source: str | None = None) -> DataFrame:
    kept = edges if source is None else edges.filter(F.col("source_object") == source)
    return kept.select("target_object").distinct().orderBy("target_object")


def graph_edges(edges: DataFrame, since, max_edges: int | None = None) -> DataFrame:
    """Edges of a window in order; a drawing may ask for the first ``max_edges``."""
    kept = edges.filter((F.col("query_start_time") >= F.lit(since)) & F.col("source_object").isNotNull()
                        & F.col("target_object").isNotNull())
    ordered = kept.orderBy("source_object", "target_object", "query_id")
    return (ordered if max_edges is None else ordered.limit(max_edges)).select("source_object", "target_object")


def graph_nodes(edges: DataFrame) -> DataFrame:
    """Distinct nodes of either end, numbered from 0 by name."""
    nodes = edges.select(F.explode(F.array("source_object", "target_object")).alias("node")).distinct()
    return global_rank(nodes, ["node"], "_n").select((F.col("_n") - 1).alias("node_id"), "node")
