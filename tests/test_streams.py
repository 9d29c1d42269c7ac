"""Streams run several times over a growing log."""

import datetime

from pyspark.sql import functions as F

from tidemark.operators import lineage
from tidemark.streaming import jobs

OBJECTS = "array<struct<objectName:string,objectDomain:string>>"
KINDS = f"query_id string, query_start_time timestamp, user_name string, direct_objects_accessed {OBJECTS}, objects_modified {OBJECTS}"


def log_row(query, day, source="s", target="t"):
    return query, datetime.datetime(2024, 1, 1) + datetime.timedelta(days=day), "u", [(source, "Table")], [(target, "View")]


def test_edges_are_stored_once_however_late(spark, tmp_path):
    source, target, mark = (str(tmp_path / n) for n in ("log", "edges", "mark"))
    runs = [[log_row("q1", 40), log_row("q2", 41)], [log_row("q1", 40), log_row("q3", -400)], [log_row("q3", -400, "other"), log_row("q2", 41)], []]
    seen, totals = [], []
    for rows in runs:
        spark.createDataFrame(rows, KINDS).write.mode("append").parquet(source)
        query = jobs.stream_lineage(spark.readStream.schema(KINDS).parquet(source), target, mark)
        query.awaitTermination()
        totals.append([p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators])
        seen.append(spark.read.parquet(target).count())
    assert seen == [2, 3, 4, 4] and totals[2][-1] == 4
    edges = spark.read.parquet(target).select("query_id", "source_object").collect()
    assert sorted(map(tuple, edges)) == [("q1", "s"), ("q2", "s"), ("q3", "other"), ("q3", "s")]


def test_no_row_is_too_late_by_default(spark, tmp_path):
    source, target, mark = (str(tmp_path / n) for n in ("events", "daily", "mark"))
    kinds = "id long, ts timestamp, kind string"
    at = lambda day, hour: datetime.datetime(2024, 3, 1, hour) + datetime.timedelta(days=day)
    runs = [[(1, at(40, 1), "a"), (2, at(40, 9), "a"), (3, at(41, 2), "b")], [(4, at(0, 3), "a"), (5, at(40, 5), "a")], [(6, at(-300, 3), "b"), (7, at(0, 4), "a")]]
    for rows in runs:
        spark.createDataFrame(rows, kinds).write.mode("append").parquet(source)
        jobs.store_versions(jobs.daily_arrivals(spark.readStream.schema(kinds).parquet(source), "ts", "kind"), target, mark).awaitTermination()
    batch = jobs.daily_arrivals(spark.read.parquet(source), "ts", "kind")
    held = jobs.latest_versions(spark, target, ["day", "kind"]).select(*batch.columns)
    assert sorted(map(tuple, held.collect())) == sorted(map(tuple, batch.collect())) and batch.count() == 4
    # what a batch stored before is not read, and a replay overwrites its own folder
    assert {int(r.version) for r in spark.read.parquet(target).select("version").distinct().collect()} == {0, 1, 2}


def test_the_refresh_procedure_adds_nothing_twice(spark):
    rows = [log_row("q1", 0), log_row("q1", 0), log_row("q2", -3), log_row("q3", -30), log_row("q4", 0, None)]
    log = spark.createDataFrame(rows, KINDS)
    name = f"edges_{abs(hash(str(rows))) % 10**9}"
    got = [tuple(lineage.refresh_job(spark, log, name, days, "2024-01-02 00:00:00").first()) for days in (7, 7, 60)]
    assert got == [(7, 2, 2, True, 1), (7, 2, 0, True, 1), (60, 3, 1, True, 1)]
    assert spark.table(name).filter(F.col("load_ts") == F.lit("2024-01-02").cast("timestamp")).count() == 3
    spark.sql(f"DROP TABLE {name}")
