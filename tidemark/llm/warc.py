"""WARC records in ZIP packages: written by tasks, then found by directory and index and read by range."""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.work import fresh
from tidemark.sources.archives import shared_system

#: Bytes of records from which a package is closed; the member names of records and index.
PACKAGE = 32 << 20
RECORDS, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
#: Fixed values of the formats.
END, END64, LOCATOR, ENTRY, LOCAL = b"PK\5\6", b"PK\6\6", b"PK\6\7", b"PK\1\2", b"PK\3\4"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2020-01-01T00:00:00Z"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- packages ---------------------------------------------------------------------------


def pack(members: list[tuple[str, bytes]]) -> bytes:
    """A ZIP file of stored members with ZIP64 sizes, offsets and directory."""
    parts, entries, at = [], [], 0
    for name, data in members:
        raw, crc = name.encode(), zlib.crc32(data)
        extra = struct.pack("<HHQQ", 1, 16, len(data), len(data))
        parts += [struct.pack("<4sHHHHHIIIHH", LOCAL, 45, 0x800, 0, 0, 33, crc, 0xFFFFFFFF, 0xFFFFFFFF, len(raw), len(extra)), raw, extra, data]
        extra64 = struct.pack("<HHQQQ", 1, 24, len(data), len(data), at)
        entries.append(struct.pack("<4sHHHHHHIIIHHHHHII", ENTRY, 45, 45, 0x800, 0, 0, 33, crc, 0xFFFFFFFF, 0xFFFFFFFF, len(raw), len(extra64), 0, 0, 0, 0, 0xFFFFFFFF) + raw + extra64)
        at += 30 + len(raw) + len(extra) + len(data)
    directory = b"".join(entries)
    end64 = struct.pack("<4sQHHIIQQQQ", END64, 44, 45, 45, 0, 0, len(members), len(members), len(directory), at)
    locator = struct.pack("<4sIQI", LOCATOR, 0, at + len(directory), 1)
    end = struct.pack("<4sHHHHIIH", END, 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    return b"".join([*parts, directory, end64, locator, end])


def directory(file) -> dict[str, tuple[int, int]]:
    """Where the bytes of each stored member lie: name -> (offset, size).

    Reads the end of the file, the central directory and one local header a member; both the
    plain and the ZIP64 form. A compressed or encrypted member can't be read by range and
    is an error, as is a file that is no ZIP package.
    """
    size = file.size()
    tail_at = max(0, size - 65_557)
    tail = file.read_at(size - tail_at, tail_at)
    found = tail.rfind(END)
    if found < 0:
        raise ValueError("no end of a central directory")
    _, _, _, _, count, length, start, _ = struct.unpack_from("<4sHHHHIIH", tail, found)
    if 0xFFFF == count or 0xFFFFFFFF in (length, start):
        mark, _, end64, _ = struct.unpack_from("<4sIQI", file.read_at(20, tail_at + found - 20))
        if mark != LOCATOR:
            raise ValueError("no ZIP64 locator")
        mark, _, _, _, _, _, _, count, length, start = struct.unpack("<4sQHHIIQQQQ", file.read_at(56, end64))
        if mark != END64:
            raise ValueError("no ZIP64 end of directory")
    entries, at, out = file.read_at(length, start), 0, {}
    for _ in range(count):
        mark, _, _, flags, method, _, _, _, packed, full, n, m, k, _, _, _, local = struct.unpack_from("<4sHHHHHHIIIHHHHHII", entries, at)
        if mark != ENTRY:
            raise ValueError("broken central directory")
        name, extra = entries[at + 46 : at + 46 + n].decode(), entries[at + 46 + n : at + 46 + n + m]
        at += 46 + n + m + k
        while len(extra) >= 4:
            kind, width = struct.unpack_from("<HH", extra)
            if kind == 1:  # holds, in this order, those of the three that are full of ones above
                wide = list(struct.unpack_from(f"<{width // 8}Q", extra, 4))
                full = wide.pop(0) if full == 0xFFFFFFFF else full
                packed = wide.pop(0) if packed == 0xFFFFFFFF else packed
                local = wide.pop(0) if local == 0xFFFFFFFF else local
            extra = extra[4 + width :]
        if method or flags & 1:
            raise ValueError(f"member {name} is not stored")
        mark, n, m = struct.unpack("<4s22xHH", file.read_at(30, local))
        if mark != LOCAL:
            raise ValueError(f"no local header of {name}")
        out[name] = local + 30 + n + m, full
    return out


# --- records ----------------------------------------------------------------------------


def _name(page_id: int | None, check: str) -> str:
    return f"<urn:x-page:{page_id}>" if page_id is not None else f"<urn:x-page:none:{check}>"


def _page(name: str) -> int | None:
    value = name.removeprefix("<urn:x-page:").removesuffix(">")
    return None if value.startswith("none:") else int(value)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC/1.1 record; a revisit holds the HTTP head, which names the full length, without payload."""
    check = digest(payload)
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_name(page_id, check)}", f"WARC-Date: {DATE}",
             f"WARC-Target-URI: {quote(url or '', safe=':/?#[]@!$&()*+,;=%~')}", f"WARC-Payload-Digest: sha1:{check}"]
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_name(refers_to, check)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """Fields of a record; ``intact`` says whether lengths and digest agree with the block."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("no WARC record")
    fields = {k.lower(): v for k, v in (line.split(": ", 1) for line in lines if ": " in line)}
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(line.split(":", 1)[1]) for line in http.decode("latin-1").split("\r\n") if line.lower().startswith("content-length:"))
    check = fields["warc-payload-digest"].removeprefix("sha1:")
    whole = fields["warc-type"] == "response"
    return {
        "page_id": _page(fields["warc-record-id"]), "url": fields.get("warc-target-uri", ""), "record_type": fields["warc-type"],
        "payload_bytes": length, "payload_digest": check, "refers_to": _page(fields["warc-refers-to"]) if "warc-refers-to" in fields else None,
        "payload": payload if whole else None, "intact": rest[len(block) :] == b"\r\n\r\n" and (not whole or (len(payload) == length and digest(payload) == check))}


# --- jobs -------------------------------------------------------------------------------


def _writer(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, lines, at = [], [], 0

        def close() -> pa.RecordBatch:
            # a task that runs again takes other names; only the names it returns count
            path = f"{folder}/{uuid.uuid4().hex}.wacz"
            place, name = shared_system(path)
            place.create_dir(name.rpartition("/")[0], recursive=True)
            with place.open_output_stream(name) as out:
                out.write(pack([(RECORDS, b"".join(parts)), (INDEX, "".join(sorted(lines)).encode())]))
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([len(lines)], pa.int64())], ["path", "records"])

        for batch in batches:
            for page_id, url, html, refers_to, revisit in zip(*[batch.column(c) for c in ("page_id", "url", "html", "refers_to", "revisit")]):
                payload = html.as_buffer().to_pybytes() if html.is_valid else b""
                raw = gzip.compress(record(page_id.as_py(), url.as_py(), payload, refers_to.as_py(), revisit.as_py()), 1, mtime=0)
                spot = {"filename": RECORDS, "offset": at, "length": len(raw), "page_id": page_id.as_py()}
                lines.append(f"{json.dumps(url.as_py() or '')} {DATE} {json.dumps(spot)}\n")
                parts.append(raw)
                at += len(raw)
                if at >= PACKAGE:
                    yield close()
                    parts, lines, at = [], [], 0
        if parts:
            yield close()

    return run


def write(pages: DataFrame, least: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", folder: str | None = None) -> DataFrame:
    """Packages of all pages: (path, records), itself a table of the shared folder.

    Of pages with equal payloads of at least ``least`` bytes those with the largest id are
    responses and the others revisit it (compared by SHA-256); repeated rows with that id are
    all responses. Null html is an empty payload, a null url empty, and a null id less than any:
    if all ids of a group are null, all are responses. An empty table gives no packages.
    """
    spark = pages.sparkSession
    folder = folder or fresh(spark, "warc")
    rows = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].cast("string").alias("url"),
                        F.coalesce(pages[html_col].cast("string"), F.lit("")).cast("binary").alias("html"))
    rows = rows.withColumn("same", F.sha2("html", 256))
    several = rows.where(F.length("html") >= least).groupBy("same").agg(F.max("page_id").alias("last"), F.count("*").alias("n")).where("n > 1 and last is not null")
    # a written table: a join of two plain exchanges lets Spark split a payload that very many pages have
    several.drop("n").write.parquet(f"{folder}/several")
    marked = rows.join(spark.read.parquet(f"{folder}/several"), "same", "left")
    revisit = F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last"))
    marked.select("page_id", "url", "html", F.when(revisit, F.col("last")).alias("refers_to"), revisit.alias("revisit")) \
        .mapInArrow(_writer(f"{folder}/packages"), "path string, records long").write.parquet(f"{folder}/list")
    return spark.read.parquet(f"{folder}/list")


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column("path").to_pylist():
            place, name = shared_system(path)
            with place.open_input_file(name) as file:
                members = directory(file)
                for index in (m for m in members if m.startswith("indexes/")):
                    at, size = members[index]
                    spots = [json.loads(line[line.index(f" {DATE} ") + len(DATE) + 2 :]) for line in file.read_at(size, at).decode().splitlines()]
                    spots.sort(key=lambda s: s["offset"])
                    for i in range(0, len(spots), 1000):
                        some = spots[i : i + 1000]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([path] * len(some)), pa.array([s["page_id"] for s in some], pa.int64()),
                             pa.array([members[s["filename"]][0] + s["offset"] for s in some], pa.int64()), pa.array([s["length"] for s in some], pa.int64())],
                            ["path", "page_id", "offset", "length"])


def index(packages: DataFrame) -> DataFrame:
    """(path, page_id, offset, length) of every record, from directories and indexes alone."""
    return packages.select("path").mapInArrow(_indexed, "path string, page_id long, offset long, length long")


_FIELDS = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary, intact boolean"


def _fetched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    opened: tuple[str, object] | None = None
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.bool_()]
    names = [f.split()[0] for f in _FIELDS.split(", ")]
    for batch in batches:
        rows, held = [], 0
        for path, offset, length in zip(*[batch.column(c).to_pylist() for c in ("path", "offset", "length")]):
            if opened is None or opened[0] != path:
                if opened is not None:
                    opened[1].close()
                place, name = shared_system(path)
                opened = path, place.open_input_file(name)
            rows.append(parse(gzip.decompress(opened[1].read_at(length, offset))))
            held += len(rows[-1]["payload"] or b"")
            if held > 8 << 20:
                yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds)], names)
                rows, held = [], 0
        yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds)], names)
    if opened is not None:
        opened[1].close()


def read(spots: DataFrame) -> DataFrame:
    """Records at the given places, each read by its own byte range: a filtered index reads only its records."""
    return spots.select("path", "offset", "length").mapInArrow(_fetched, _FIELDS)
