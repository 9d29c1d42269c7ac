"""CSV members of zip archives, listed and read on executors.

Archives stay on shared storage: a task opens one by path, seeks to its directory or to
one member and streams that, so neither archive nor member has to fit a row or memory.
A member is one deflate stream and so one task; different members run side by side.
"""

from __future__ import annotations

import codecs
import contextlib
import io
import itertools
import os
import re
import zipfile
import zlib

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.session import cut_lineage

READ_BLOCK = 16 * 1024 * 1024
SPLIT_BYTES = 250 * 1024 * 1024
BATCH_LINES = 10_000
# folders a task lists below one folder; those left then go to other tasks
LIST_FOLDERS = 1_000
FILE_SCHEMA = "path string, size long, is_folder boolean"
MEMBER_SCHEMA = "archive string, member string, size long, compressed long, error string"
LINE_SCHEMA = "archive string, member string, part int, line_no long, line string, error string"
# what a damaged, encrypted or unknown member raises while it is read
MEMBER_ERRORS = (zipfile.BadZipFile, zlib.error, EOFError, OSError, RuntimeError)


class SharedFile(io.RawIOBase):
    """A pyarrow file with the errors the zip reader expects of a Python file."""

    def __init__(self, handle):
        self._handle = handle

    def readable(self):
        return True

    def seekable(self):
        return True

    def tell(self):
        return self._handle.tell()

    def seek(self, offset, whence=io.SEEK_SET):
        start = {io.SEEK_SET: 0, io.SEEK_CUR: self._handle.tell(), io.SEEK_END: self._handle.size()}[whence]
        if start + offset < 0:
            raise OSError("seek before the start of the file")
        return self._handle.seek(start + offset)

    def readinto(self, buffer):
        data = self._handle.read(len(buffer))
        buffer[:len(data)] = data
        return len(data)

    def close(self):
        self._handle.close()
        super().close()


def shared_system(path: str):
    """File system and inner path of a local or object-storage path."""
    from pyarrow import fs

    local = re.sub(r"^file:/+", "/", path)
    if local.startswith("/"):
        return fs.LocalFileSystem(), local
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", path))


def open_shared(path: str):
    """A seekable reader."""
    system, inner = shared_system(path)
    return io.BufferedReader(SharedFile(system.open_input_file(inner)), 1 << 20)


def sized_batches(rows, most: int = READ_BLOCK):
    """Lists of rows, each closed once the last values of its rows hold ``most`` bytes."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[-1]) + 100
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def _is_hidden(name: str) -> bool:
    """Names that Spark's readers leave out as well."""
    if name.startswith(("_metadata", "_common_metadata")):
        return False
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def _entries(system, folder: str, most: int):
    """(path, size, is_folder): the files below a folder, and the folders left once ``most`` are listed."""
    from pyarrow import fs

    left = [folder]
    for _ in range(most):
        if not left:
            return
        for entry in system.get_file_info(fs.FileSelector(left.pop())):
            if _is_hidden(entry.base_name):
                continue
            if entry.type == fs.FileType.Directory:
                left.append(entry.path)
            elif entry.is_file:
                yield entry.path, entry.size, False
    yield from ((path, None, True) for path in left)


def list_tree(spark: SparkSession, path: str) -> DataFrame:
    """Files (path, size) below ``path``, listed by tasks: no name passes the driver, and the number of tasks does not grow with the files.

    Spark's own reader lists on the driver and reads a few files in a task, however small they are.
    """
    from pyarrow import fs

    path = path if re.match(r"\w+:|/", path) else os.path.abspath(path)
    system, inner = shared_system(path)
    inner = inner.rstrip("/") or "/"
    scheme = "file:" if isinstance(system, fs.LocalFileSystem) else path.rstrip("/").removesuffix(inner)
    start = system.get_file_info(inner)
    if start.is_file:
        return spark.createDataFrame([(scheme + inner, start.size)], "path string, size long")
    if start.type == fs.FileType.NotFound:
        raise FileNotFoundError(f"{path} not found")
    tasks, most = 4 * spark.sparkContext.defaultParallelism, LIST_FOLDERS

    def walk(frames):
        system, _ = shared_system(path)
        for frame in frames:
            rows = itertools.chain.from_iterable(_entries(system, folder, most) for folder in frame["path"])
            while batch := list(itertools.islice(rows, BATCH_LINES)):
                yield pd.DataFrame(batch, columns=["path", "size", "is_folder"]).astype({"size": "Int64"})

    files, left = None, spark.createDataFrame([(inner,)], "path string")
    while files is None or not left.isEmpty():
        # a folder with very many others is the rule: so each round deals out those that are left
        found = cut_lineage(left.repartition(tasks, "path").mapInPandas(walk, FILE_SCHEMA))
        left = found.filter("is_folder").select("path")
        found = found.filter("NOT is_folder").select(F.concat(F.lit(scheme), "path").alias("path"), "size")
        files = found if files is None else files.unionByName(found)
    return files.repartition(tasks, "path")


def read_contents(files: DataFrame) -> DataFrame:
    """(path, content) of listed files; a file is one value."""

    def read(frames):
        def content(path):
            system, inner = shared_system(path)
            with system.open_input_stream(inner) as stream:
                return path, stream.read()

        for frame in frames:
            for batch in sized_batches(map(content, frame["path"])):
                yield pd.DataFrame(batch, columns=["path", "content"])

    return files.select("path").mapInPandas(read, "path string, content binary")


def list_archives(spark: SparkSession, path: str, names: list[str] | None = None) -> DataFrame:
    """Zip files below ``path``, all or by base name; a name that is not there is an error."""
    found = list_tree(spark, path).filter(F.lower("path").endswith(".zip")).select(F.col("path").alias("archive"), F.col("size").alias("archive_size"))
    if names is None:
        return found
    base = F.split_part("archive", F.lit("/"), F.lit(-1))
    kept = found.filter(base.isin(names))
    # at most one row for each name asked for
    absent = sorted(set(names) - {r.name for r in kept.select(base.alias("name")).distinct().collect()})
    if absent:
        raise FileNotFoundError(f"{absent} not found below {path}")
    return kept


def list_members(archives: DataFrame) -> DataFrame:
    """Members with their sizes, from each archive's directory; a broken archive gives an error row."""

    def read(frames):
        for frame in frames:
            rows = []
            for path in frame["archive"]:
                try:
                    with open_shared(path) as handle, zipfile.ZipFile(handle) as archive:
                        found = [(path, m.filename, m.file_size, m.compress_size, None) for m in archive.infolist()]
                except (zipfile.BadZipFile, OSError) as error:
                    found = [(path, None, None, None, f"{type(error).__name__}: {error}")]
                rows.extend(found or [(path, None, None, None, None)])
            yield pd.DataFrame(rows, columns=["archive", "member", "size", "compressed", "error"])

    return archives.select("archive").mapInPandas(read, MEMBER_SCHEMA)


def clean_name(member: Column) -> Column:
    return F.btrim(F.replace(member, F.lit("\\"), F.lit("/")), F.lit("/"))


def is_csv_member(member: Column) -> Column:
    """CSV files, without directories and resource forks."""
    name = F.replace(member, F.lit("\\"), F.lit("/"))
    return F.lower(name).endswith(".csv") & ~is_fork(member)


def select_members(members: DataFrame, names: list[str] | None = None) -> DataFrame:
    """CSV members, all or those whose full or base name is listed; a name that is nowhere is an error."""
    kept = members.filter(F.col("member").isNotNull() & is_csv_member(F.col("member")))
    if names is None:
        return kept
    wanted = [n.replace("\\", "/").strip("/") for n in names if n.strip()]
    name = clean_name(F.col("member"))
    base = F.split_part(name, F.lit("/"), F.lit(-1))
    kept = kept.filter(name.isin(wanted) | base.isin(wanted))
    met = kept.select(F.explode(F.array_intersect(F.array(name, base), F.array(*map(F.lit, wanted)))).alias("n")).distinct() if wanted else None
    absent = sorted(set(wanted) - {r.n for r in met.collect()}) if wanted else ["(no name)"]
    if absent:
        raise FileNotFoundError(f"no CSV member is named {absent}")
    return kept


def _encoding(archive: zipfile.ZipFile, member: str) -> str:
    """UTF-8 when the whole member decodes, else Latin-1; read in blocks.

    The member is read to its end in either case: a wrong checksum is met here, before any
    of its lines is given out.
    """
    decoder, encoding = codecs.getincrementaldecoder("utf-8")(), "utf-8"
    with archive.open(member) as stream:
        while True:
            block = stream.read(READ_BLOCK)
            if encoding == "utf-8":
                try:
                    decoder.decode(block, final=not block)
                except UnicodeDecodeError:
                    encoding = "latin-1"
            if not block:
                return encoding


@contextlib.contextmanager
def _checked_text(archive: zipfile.ZipFile, member: str):
    """(lines, encoding) of a member whose checksum is known to hold: one within a block is inflated once, a larger one twice."""
    if archive.getinfo(member).file_size <= READ_BLOCK:
        data = archive.read(member)
        try:
            text, encoding = data.decode(), "utf-8"
        except UnicodeDecodeError:
            text, encoding = data.decode("latin-1"), "latin-1"
        yield io.StringIO(text, newline="\n"), encoding
    else:
        encoding = _encoding(archive, member)
        with archive.open(member) as stream:
            yield io.TextIOWrapper(stream, encoding, newline="\n"), encoding


def member_lines(path: str, member: str, clean: bool = True, split_bytes: int | None = None, header: bool = True, drop: tuple[str, ...] = ()):
    """(part, line_no, line) of one member; a part closes once it holds ``split_bytes`` and no quoted field is open, the next repeats the header.

    ``clean`` strips lines and leaves out blank ones, ``drop`` those that begin with one of its texts.
    """
    with open_shared(path) as handle, zipfile.ZipFile(handle) as archive, _checked_text(archive, member) as (stream, encoding):
        part, held, head, quotes = 1, 0, None, 0
        for number, line in enumerate(stream):
            line = line.removesuffix("\n")
            if clean:
                line = line.strip()
                if not line:
                    continue
            if drop and line.startswith(drop):
                continue
            if header and number == 0:
                head = line
            elif split_bytes:
                if held >= split_bytes and quotes % 2 == 0:
                    part, held = part + 1, 0
                    if head is not None:
                        yield part, 0, head
                held += len(line.encode(encoding)) + 1
                quotes += line.count('"')
            yield part, number, line


def read_members(
    members: DataFrame, clean: bool = True, split_bytes: int | None = None, header: bool = True, tasks: int | None = None,
    drop: tuple[str, ...] = (),
) -> DataFrame:
    """Lines (archive, member, part, line_no, line) of the members.

    ``clean`` strips lines and drops blank ones. A member that cannot be read to its end
    gives one row with ``error`` and no line. The member list
    is small, so the number of tasks is set here: adaptive execution would join it into one.
    """
    tasks = tasks or 4 * members.sparkSession.sparkContext.defaultParallelism
    columns = ["archive", "member", "part", "line_no", "line", "error"]

    def rows_of(path, member):
        try:
            for part, number, line in member_lines(path, member, clean, split_bytes, header, drop):
                yield path, member, part, number, line, None
        except MEMBER_ERRORS as error:
            yield path, member, None, None, None, f"{type(error).__name__}: {error}"

    def read(frames):
        for frame in frames:
            # batches run over members, as many of them are short
            rows = itertools.chain.from_iterable(map(rows_of, frame["archive"], frame["member"]))
            while batch := list(itertools.islice(rows, BATCH_LINES)):
                yield pd.DataFrame(batch, columns=columns).astype({"part": "Int32", "line_no": "Int64"})

    return members.select("archive", "member").repartition(tasks, "archive", "member").mapInPandas(read, LINE_SCHEMA)


def good_lines(lines: DataFrame) -> DataFrame:
    return lines.filter("error IS NULL").drop("error")


def member_errors(lines: DataFrame) -> DataFrame:
    """One row for each member that could not be read."""
    return lines.filter("error IS NOT NULL").select("archive", "member", "error")


def is_fork(member: Column) -> Column:
    """Resource forks that some packers add beside the files."""
    name = F.replace(member, F.lit("\\"), F.lit("/"))
    return name.startswith("__MACOSX/") | F.split_part(name, F.lit("/"), F.lit(-1)).startswith("._")


def zip_lines(spark: SparkSession, path: str) -> DataFrame:
    """Cleaned lines of every file member of the archives below ``path``, but of resource forks.

    Members and archives that can't be read have no lines; a row with ``error`` stands for each.
    """
    members = list_members(list_archives(spark, path))
    files = members.filter(F.col("member").isNotNull() & ~F.col("member").endswith("/") & ~is_fork(F.col("member")))
    broken = members.filter("error IS NOT NULL").select(
        "archive", "member", F.lit(None).cast("long").alias("line_no"), F.lit(None).cast("string").alias("line"), "error")
    return read_members(files).drop("part").unionByName(broken)


def route_members(members: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Members below the limit are copied whole, the others split."""
    return members.withColumn("is_split", F.col("size") >= split_bytes)


def common_folder(archives: DataFrame) -> str:
    """The folder that holds all archives, however deep: the first and the last path share what all share."""
    ends = archives.agg(F.min("archive").alias("a"), F.max("archive").alias("b")).first()
    return os.path.commonprefix([ends.a or "", ends.b or ""]).rpartition("/")[0]


def target_stem(target: str, day: str, root: str, archive: Column, member: Column, is_split: Column) -> Column:
    """Where a member goes: ``target/day/archive/member``, or ``…/member/base_part`` before the number of a part.

    Archive and member keep their folders, the archive those below ``root``; so different sources have different targets.
    """
    below = F.when(archive.startswith(root + "/"), F.substring(archive, len(root) + 2, F.length(archive))).otherwise(F.split_part(archive, F.lit("/"), F.lit(-1)))
    folder = F.concat_ws("/", F.lit(target.rstrip("/")), F.lit(day), F.regexp_replace(below, r"\.[^./]*$", ""))
    name = F.regexp_replace(clean_name(member), r"\.[^./]*$", "")
    split = F.concat_ws("/", folder, name, F.concat(F.split_part(name, F.lit("/"), F.lit(-1)), F.lit("_part")))
    return F.when(is_split, split).otherwise(F.concat_ws("/", folder, clean_name(member)))


def part_name(stem: Column, part: Column, is_split: Column) -> Column:
    number = F.when(F.length(part.cast("string")) < 3, F.lpad(part.cast("string"), 3, "0")).otherwise(part.cast("string"))
    return F.when(is_split, F.concat(stem, number, F.lit(".csv"))).otherwise(stem)


def split_members(members: DataFrame, target: str, day: str, split_bytes: int = SPLIT_BYTES, header: bool = True, root: str | None = None) -> DataFrame:
    """Lines by target file; large members are cut at record ends and repeat their header in each part."""
    root = common_folder(members) if root is None else root
    routed = route_members(members, split_bytes)
    whole = good_lines(read_members(routed.filter("NOT is_split"), clean=False)).withColumn("is_split", F.lit(False))
    parts = good_lines(read_members(routed.filter("is_split"), clean=False, split_bytes=split_bytes, header=header))
    lines = whole.unionByName(parts.withColumn("is_split", F.lit(True)))
    stem = target_stem(target, day, root, F.col("archive"), F.col("member"), F.col("is_split"))
    return lines.withColumn("target", part_name(stem, F.col("part"), F.col("is_split")))


def manifest(lines: DataFrame) -> DataFrame:
    """Source member, target file and whether it is a part."""
    return lines.select("archive", clean_name(F.col("member")).alias("source_full_csv_file_name"),
                        F.col("target").alias("target_full_csv_file_name"), "is_split").distinct()


def archive_outcomes(members: DataFrame, read: DataFrame, archive: bool = True) -> DataFrame:
    """Where each source archive goes: archived, rejected, or left in place.

    ``read``: what :func:`read_members` or a job of ``sinks.unpack`` gave, as damage inside a member shows only there.
    """
    found = members.select("archive", "member", "error")
    found = found.unionByName(member_errors(read).select("archive", F.lit(None).cast("string").alias("member"), "error"))
    return found.groupBy("archive").agg(F.max("error").alias("error"), F.count("member").alias("members")).withColumn(
        "outcome", F.when(F.col("error").isNotNull(), "rejected").otherwise("archived" if archive else "left in place"))
