"""Members of archives written as files: staged by tasks, published once all are there, listed last.

A task streams a member into files under a name of its own attempt, so attempts that run twice or
at the same time never meet. Only what the finished attempts report is moved to its place, and a manifest is written
when everything has been moved: files that no manifest names are not part of any run.
"""

from __future__ import annotations

import hashlib
import itertools
import uuid
import zipfile

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.session import cut_lineage
from tidemark.sources import archives as arc

STAGED = "archive string, member string, target string, is_split boolean, staged string, bytes long, lines long, sha256 string, error string"
SUCCESS, FAILED = 1, 3


def clashes(routed: DataFrame) -> DataFrame:
    """(target, sources): files that more than one source would write; ``routed`` has archive, member, stem, is_split.

    The parts of a split member are not yet known, so a whole file with the name of any part counts as one.
    """
    source = F.concat_ws("!", "archive", "member")
    own = routed.select(F.when(F.col("is_split"), F.concat("stem", F.lit("#.csv"))).otherwise(F.col("stem")).alias("target"), source.alias("source"), F.lit(True).alias("sure"))
    as_part = routed.filter(~F.col("is_split") & F.col("stem").rlike(r"_part\d{3,}\.csv$")) \
        .select(F.regexp_replace("stem", r"_part\d{3,}\.csv$", "_part#.csv").alias("target"), source.alias("source"), F.lit(False).alias("sure"))
    met = own.unionByName(as_part).groupBy("target").agg(F.count("*").alias("sources"), F.bool_or("sure").alias("sure"), F.min("source").alias("first"), F.max("source").alias("last"))
    return met.filter("sure AND sources > 1").drop("sure")


def _files(path: str, member: str, is_split: bool, stem: str, folder: str, split_bytes: int, header: bool):
    """Rows of the files staged for one member, byte for byte; parts end where a record ends and begin with the header."""
    rows, out, held, quotes, head, digest = [], None, 0, 0, b"", hashlib.sha256()

    def opened():
        nonlocal out, held, digest
        staged = f"{folder}/{uuid.uuid4().hex}"
        system, inner = arc.shared_system(staged)
        system.create_dir(inner.rpartition("/")[0], recursive=True)
        out, held, digest = system.open_output_stream(inner), 0, hashlib.sha256()
        rows.append([path, member, f"{stem}{len(rows) + 1:03d}.csv" if is_split else stem, is_split, staged, 0, 0, None, None])

    def put(data: bytes, lines: int):
        out.write(data)
        digest.update(data)
        rows[-1][5] += len(data)
        rows[-1][6] += lines

    def closed():
        out.close()
        rows[-1][7] = digest.hexdigest()

    try:
        with arc.open_shared(path) as handle, zipfile.ZipFile(handle) as archive, archive.open(member) as stream:
            opened()
            if is_split:
                for number, line in enumerate(stream):
                    if header and number == 0:
                        head = line
                    elif held >= split_bytes and quotes % 2 == 0:
                        closed()
                        opened()
                        if head:
                            put(head, 1)
                    put(line, 1)
                    if not (header and number == 0):
                        held += len(line)
                        quotes += line.count(b'"')
            else:
                last = b"\n"
                while block := stream.read(arc.READ_BLOCK):
                    put(block, block.count(b"\n"))
                    last = block[-1:]
                rows[-1][6] += last != b"\n"
            closed()
    except arc.MEMBER_ERRORS as error:
        if out is not None and not out.closed:
            out.close()
        return [[path, member, None, is_split, None, None, None, None, f"{type(error).__name__}: {error}"]]
    return rows


def stage(routed: DataFrame, folder: str, split_bytes: int, header: bool = True, tasks: int | None = None) -> DataFrame:
    """One row for each file staged below ``folder``, or with ``error`` for a member that can't be read to its end."""
    tasks = tasks or 4 * routed.sparkSession.sparkContext.defaultParallelism
    columns = [c.split()[0] for c in STAGED.split(", ")]

    def run(frames):
        attempt = f"{folder}/{TaskContext.get().taskAttemptId()}"
        for frame in frames:
            found = itertools.chain.from_iterable(
                _files(*row, attempt, split_bytes, header) for row in zip(frame["archive"], frame["member"], frame["is_split"], frame["stem"]))
            yield pd.DataFrame(found, columns=columns).astype({"bytes": "Int64", "lines": "Int64"})

    return routed.select("archive", "member", "is_split", "stem").repartition(tasks, "archive", "member").mapInPandas(run, STAGED)


def publish(staged: DataFrame) -> int:
    """Move each staged file to its target; a move that was done before counts as done. Returns the files moved."""

    def run(frames):
        for frame in frames:
            for source, target, size in zip(frame["staged"], frame["target"], frame["bytes"]):
                system, inner = arc.shared_system(source)
                _, goal = arc.shared_system(target)
                if system.get_file_info(inner).is_file:
                    system.create_dir(goal.rpartition("/")[0], recursive=True)
                    system.move(inner, goal)
                elif system.get_file_info(goal).size != size:
                    raise OSError(f"{source} was not staged and {target} is not its file")
            yield frame[["target"]]

    return staged.filter("error IS NULL").select("staged", "target", "bytes").mapInPandas(run, "target string").count()


def unpack(spark: SparkSession, source: str, target: str, day: str, archives: list[str] | None = None, members: list[str] | None = None,
           split_bytes: int = arc.SPLIT_BYTES, header: bool = True) -> DataFrame:
    """Write the CSV members of the archives below ``source`` as files below ``target/day``; returns the status rows.

    Members under ``split_bytes`` are copied byte for byte, larger ones are cut at record ends, each part with the
    header. ``archives`` and ``members`` choose by name. Two sources with one target are an error before anything is
    written. One row for each file (source_full_csv_file_name, target_full_csv_file_name, is_split, bytes, lines, sha256), for each member or archive
    that can't be read (error) and for each archive without a CSV member; ``status`` is 1 or 3. The rows are also the manifest ``target/day/_manifest/run``.
    """
    # every archive is opened once for its directory; all steps below go by these rows
    found = cut_lineage(arc.list_members(arc.list_archives(spark, source, archives)))
    chosen = arc.select_members(found, members)
    target = target.rstrip("/")
    root = arc.common_folder(found)
    routed = arc.route_members(chosen, split_bytes)
    routed = routed.withColumn("stem", arc.target_stem(target, day, root, F.col("archive"), F.col("member"), F.col("is_split")))
    double = clashes(routed).orderBy("target").limit(5).collect()
    if double:
        raise ValueError("sources with one target: " + "; ".join(f"{r.target} of {r.first} and {r.last}" for r in double))
    job = uuid.uuid4().hex
    folder, listed = f"{target}/{day}/_staged/{job}", f"{target}/{day}/_manifest/{job}"
    # the written list names the files of finished attempts only
    stage(routed, folder, split_bytes, header).write.parquet(f"{folder}-list")
    staged = spark.read.parquet(f"{folder}-list")
    publish(staged)
    broken = found.filter("error IS NOT NULL").select("archive", "error")
    empty = found.filter("error IS NULL").join(chosen.select("archive").distinct(), "archive", "left_anti").select("archive").distinct()
    rows = staged.select(
        "archive", arc.clean_name(F.col("member")).alias("source_full_csv_file_name"), F.col("target").alias("target_full_csv_file_name"), "is_split", "bytes", "lines", "sha256", "error")
    rows = rows.unionByName(broken, allowMissingColumns=True).unionByName(empty, allowMissingColumns=True)
    status = F.when(F.col("error").isNull(), SUCCESS).otherwise(FAILED)
    rows.withColumns({"status": status, "run": F.lit(job)}).write.parquet(listed)
    for path in (folder, f"{folder}-list"):
        system, inner = arc.shared_system(path)
        if system.get_file_info(inner).is_file or system.get_file_info(inner).type.name == "Directory":
            system.delete_dir(inner)
    return spark.read.parquet(listed)
