"""Incremental forms of the load and lineage jobs, and masking of streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.lineage import EDGE_KEYS, lineage_edges


def ingest_new_files(
    spark: SparkSession, source: str, schema, target: str, checkpoint: str, fmt: str = "csv", **options: str
) -> StreamingQuery:
    """Load each file once, whatever the number of runs; ends when no new file is left."""
    rows = spark.readStream.schema(schema).options(**options).format(fmt).load(source)
    stamped = rows.withColumn("source_file", F.col("_metadata.file_path"))
    return (stamped.writeStream.format("parquet").option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start(target))


def stream_lineage(access: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Add the edges of new log rows to the parquet edges at ``target``, each (query, source, target) once.

    What has been seen is keyed state without a watermark, so log rows may be late by any time, and a batch costs
    what its own rows cost: neither the stored edges nor the whole state is read. The file sink and the
    state move on together, so a replayed batch adds nothing.
    """
    keyed_state_on_disk(access.sparkSession)
    edges = lineage_edges(access.withColumn("query_start_time", F.col("query_start_time").cast("timestamp")))
    return write_once(edges.dropDuplicates(EDGE_KEYS), target, checkpoint)


def keyed_state_on_disk(spark: SparkSession) -> None:
    """Keep the state of streams started from now on in RocksDB: it may outgrow memory, and only its changes are uploaded."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def daily_arrivals(events: DataFrame, time: str, category: str, lateness: str | None = None) -> DataFrame:
    """Arrivals per category and day of event time.

    Without ``lateness`` every row counts, however late: store the result with :func:`store_versions`. With
    it a day is given out once, when it is over by so much; rows that come later are not counted.
    """
    known = events if lateness is None else events.withWatermark(time, lateness)
    return (
        known.groupBy(F.window(time, "1 day").alias("w"), category)
        .agg(F.count("*").alias("arrived"), F.max(time).alias("last_arrival"))
        .select(F.col("w.start").alias("day"), category, "arrived", "last_arrival")
    )


def store_versions(df: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Store the rows of an aggregate that each batch changed, under the batch's number.

    A replayed batch overwrites its own folder. :func:`latest_versions` reads what holds.
    """
    keyed_state_on_disk(df.sparkSession)

    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/version={number}")

    return (df.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
            .outputMode("update").trigger(availableNow=True).start())


def latest_versions(spark: SparkSession, target: str, keys: list[str]) -> DataFrame:
    """For each key the row of the last batch that changed it."""
    rows = spark.read.parquet(target)
    others = [c for c in rows.columns if c not in (*keys, "version")]
    latest = rows.groupBy(*keys).agg(F.max_by(F.struct(*others), "version").alias("r"))
    return latest.select(*keys, *[F.col("r")[c].alias(c) for c in others])


def write_once(df: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append a stream's rows to parquet until its input is used up."""
    return (df.writeStream.format("parquet").option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(availableNow=True).start(target))
