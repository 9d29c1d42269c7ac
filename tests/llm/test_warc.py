import base64
import hashlib
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from tidemark.llm import warc


def brute(rows, least=0):
    last = {}
    for i, h in rows:
        if len((h or "").encode()) >= least and i is not None:
            last[h or ""] = max(last.get(h or "", i), i)
    out = []
    for i, h in rows:
        raw = (h or "").encode()
        to = last.get(h or "") if len(raw) >= least else None
        revisit = to is not None and i != to
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response", to if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 3])
def test_round_trip(spark, monkeypatch, least):
    monkeypatch.setattr(warc, "PACKAGE", 900)
    rows = [(i, ["<p>é</p>", "b" * i, "", None, "\r\n\r\nHTTP/1.1", "ab"][i % 6]) for i in range(60)] + [(None, "ab"), (7, "x"), (7, "x"), (None, "only"), (None, "only")]
    pages = spark.createDataFrame([(i, f"http://h/{i} ä\r\nX: y", h) for i, h in rows], "page_id long, url string, html string")
    pages = pages.withColumns({"path": F.lit("p"), "same": F.lit(1), "payload": F.lit("z")})
    packages = warc.write(pages, least)
    assert packages.count() > 2 and packages.agg(F.sum("records")).first()[0] == len(rows)
    spots = warc.index(packages)
    got = warc.read(spots).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == brute(rows, least)
    assert all(r.intact for r in got)
    given = {(i, h or "") for i, h in rows}
    assert all((r.page_id, bytes(r.payload).decode()) in given for r in got if r.record_type == "response")
    assert all((r.payload is None) == (r.record_type == "revisit") for r in got)
    assert [r.page_id for r in warc.read(spots.where("page_id = 7")).collect()] == [7, 7, 7]


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read(warc.index(warc.write(pages))).collect() == []


class Memory:
    def __init__(self, raw):
        self.raw, self.reads = raw, []

    def size(self):
        return len(self.raw)

    def read_at(self, n, at):
        self.reads.append(n)
        return self.raw[at : at + n]


def test_directories_of_both_forms():
    members = [("archive/a", b"x" * 200_000), ("ü", b""), ("indexes/i", b"line\n")]
    mine = Memory(warc.pack(members))
    with zipfile.ZipFile(io.BytesIO(mine.raw)) as z:  # another reader agrees
        assert z.testzip() is None and [(n, z.read(n)) for n in z.namelist()] == members
    plain = io.BytesIO()
    with zipfile.ZipFile(plain, "w") as z:
        for n, d in members:
            z.writestr(n, d)
        z.comment = b"PK" * 20
    for file in (mine, Memory(plain.getvalue())):
        found = warc.directory(file)
        assert sum(file.reads) < 70_000
        assert [(n, file.raw[a : a + s]) for n, (a, s) in found.items()] == members
    with pytest.raises(ValueError):
        warc.directory(Memory(b"no package"))
    with zipfile.ZipFile(deflated := io.BytesIO(), "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a", b"a" * 99)
    with pytest.raises(ValueError):
        warc.directory(Memory(deflated.getvalue()))


def test_damage_is_seen():
    raw = warc.record(5, "u", b"payload", None, False)
    assert warc.parse(raw)["intact"] and not warc.parse(raw.replace(b"payload\r", b"paYload\r"))["intact"]
