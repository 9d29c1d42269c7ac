"""Written work tables of the operators, and their removal once nothing reads them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import cut_lineage, work_path
from tidemark.sources.archives import shared_system

#: Folders made by this driver and not yet removed.
MADE: list[str] = []
#: Rows of a few numbers that a task takes at least.
TASK_ROWS = 200_000


def fresh(spark: SparkSession, name: str) -> str:
    """A new folder of the shared one, for the tables of one call of an operator."""
    path = work_path(spark, name)
    MADE.append(path)
    return path


def discard(*paths: str) -> None:
    """Remove folders that no later job reads; one that is not there is no error."""
    for path in paths:
        system, inner = shared_system(path)
        system.delete_dir_contents(inner, missing_dir_ok=True)
        if path in MADE:
            MADE.remove(path)


def tasks_for(rows: DataFrame, per_task: int = TASK_ROWS) -> int:
    """Tasks that so many rows are worth, as many as there are cores at least: a task leaves files behind for each shuffle it feeds."""
    return max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // per_task))


def kept(rows: DataFrame, per_task: int = TASK_ROWS) -> DataFrame:
    """The rows checkpointed, in as many partitions as they are worth."""
    done = cut_lineage(rows)
    return done.coalesce(tasks_for(done, per_task))
