import hashlib
import uuid
import zipfile

import pytest
from pyspark.sql import functions as F

from tidemark.functions import generate as gen
from tidemark.functions.generate import ColumnSpec
from tidemark.operators import mapping as mp, reports as rep, requests as req
from tidemark.operators.mapping import Join, Mapping, Target
from tidemark.plans import jobs as plans
from tidemark.plans.registry import Tables
from tidemark.sinks import unpack
from tidemark.sources import archives as arc


@pytest.fixture
def zips(tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("one.csv", "h\n" + "".join(f"row {i}\n" for i in range(100)))
        z.writestr("dir/two.CSV", "naïve\n\n  x  \nhas ATTR\nMac OS junk\n".encode("latin-1"))
        z.writestr("dir/", "")
        z.writestr("__MACOSX/one.csv", "junk")
        z.writestr("._one.csv", "junk")
        z.writestr("empty.csv", "")
    (tmp_path / "bad.zip").write_bytes(b"no archive")
    with zipfile.ZipFile(tmp_path / "none.ZIP", "w"):
        pass
    return str(tmp_path)


def test_members_and_outcomes(spark, zips):
    members = arc.list_members(arc.list_archives(spark, zips))
    assert sorted(r.member for r in arc.select_members(members).collect()) == ["dir/two.CSV", "empty.csv", "one.csv"]
    assert [r.member for r in arc.select_members(members, ["two.CSV"]).collect()] == ["dir/two.CSV"]
    with pytest.raises(FileNotFoundError):
        arc.select_members(members, ["three.csv"])
    with pytest.raises(FileNotFoundError):
        arc.list_archives(spark, zips, ["c.zip"])
    with pytest.raises(FileNotFoundError):
        arc.list_archives(spark, zips, ["a.zip", "c.zip"])
    with pytest.raises(FileNotFoundError):
        arc.select_members(members, ["one.csv", "three.csv"])
    read = arc.read_members(arc.select_members(members))
    outcome = {r.archive.rsplit("/", 1)[-1]: r.outcome for r in arc.archive_outcomes(members, read).collect()}
    assert outcome == {"a.zip": "archived", "bad.zip": "rejected", "none.ZIP": "archived"}
    assert {r.outcome for r in arc.archive_outcomes(members, read, archive=False).collect()} == {"rejected", "left in place"}


def test_a_damaged_member_rejects_its_archive_only(spark, zips):
    import pathlib

    path = pathlib.Path(zips) / "a.zip"
    data = bytearray(path.read_bytes())
    data[60:90] = b"\xff" * 30  # inside the first member's data
    (pathlib.Path(zips) / "c.zip").write_bytes(bytes(data))
    members = arc.list_members(arc.list_archives(spark, zips))
    lines = arc.read_members(arc.select_members(members))
    outcome = {r.archive.rsplit("/", 1)[-1]: r.outcome for r in arc.archive_outcomes(members, lines).collect()}
    assert outcome["c.zip"] == "rejected" and outcome["a.zip"] == "archived"
    assert arc.good_lines(lines).filter("archive LIKE '%a.zip' AND member = 'one.csv'").count() == 101


def test_lines_are_decoded_and_cleaned(spark, zips):
    rows = arc.zip_lines(spark, zips).filter("member = 'dir/two.CSV'").orderBy("line_no").collect()
    assert [r.line for r in rows] == ["naïve", "x", "has ATTR", "Mac OS junk"]
    members = arc.select_members(arc.list_members(arc.list_archives(spark, zips)), ["two.CSV"])
    assert sorted(r.line for r in arc.read_members(members, drop=("Mac OS",)).collect()) == ["has ATTR", "naïve", "x"]


def test_a_wrong_checksum_in_a_large_latin_member_gives_no_line(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(arc, "READ_BLOCK", 1 << 12)
    with zipfile.ZipFile(tmp_path / "d.zip", "w", zipfile.ZIP_STORED) as z:
        z.writestr("x.csv", ("é" + "0123456789\n" * 20_000).encode("latin-1"))
    data = bytearray((tmp_path / "d.zip").read_bytes())
    data[150_000] ^= 1
    (tmp_path / "d.zip").write_bytes(bytes(data))
    with pytest.raises(arc.MEMBER_ERRORS):
        next(arc.member_lines(str(tmp_path / "d.zip"), "x.csv"))
    members = arc.list_members(arc.list_archives(spark, str(tmp_path)))
    read = arc.read_members(arc.select_members(members))
    assert [(r.line, r.error is None) for r in read.collect()] == [(None, False)]
    assert arc.archive_outcomes(members, read).first().outcome == "rejected"
    written = unpack.unpack(spark, str(tmp_path), str(tmp_path / "out"), "20240101").collect()
    assert [(r.target_full_csv_file_name, r.error is None, r.status) for r in written] == [(None, False, 3)]
    assert not [p for p in (tmp_path / "out").rglob("*") if p.is_file() and "_manifest" not in str(p)]


def test_parts_repeat_the_header_and_lose_nothing(spark, zips):
    members = arc.select_members(arc.list_members(arc.list_archives(spark, zips)))
    lines = arc.split_members(members, "out/", "20240102", split_bytes=200)
    one = lines.filter("member = 'one.csv'").collect()
    parts = sorted({r.target for r in one})
    assert parts[0] == "out/20240102/a/one/one_part001.csv" and len(parts) > 2
    assert all(sum(r.line == "h" for r in one if r.target == p) == 1 for p in parts)
    assert sorted(r.line for r in one if r.line != "h") == sorted(f"row {i}" for i in range(100))
    for p in parts:
        assert sum(len(r.line) + 1 for r in one if r.target == p and r.line != "h") < 200 + 8
    rows = {(r.source_full_csv_file_name, r.is_split) for r in arc.manifest(lines).collect()}
    assert rows == {("one.csv", True), ("dir/two.CSV", False)}


def test_unpacked_files_hold_the_bytes_of_their_members(spark, zips, tmp_path):
    rows = unpack.unpack(spark, zips, f"{tmp_path}/out/", "20240102", split_bytes=200).collect()
    out = tmp_path / "out" / "20240102"
    assert (out / "a/dir/two.CSV").read_bytes() == "naïve\n\n  x  \nhas ATTR\nMac OS junk\n".encode("latin-1")
    assert (out / "a/empty.csv").read_bytes() == b""
    parts = sorted((out / "a/one").iterdir())
    assert [p.name for p in parts[:2]] == ["one_part001.csv", "one_part002.csv"] and len(parts) > 2
    texts = [p.read_text() for p in parts]
    assert all(x.startswith("h\n") for x in texts) and "".join(x[2:] for x in texts) == "".join(f"row {i}\n" for i in range(100))
    for r in rows:
        if r.target_full_csv_file_name:
            data = open(r.target_full_csv_file_name, "rb").read()
            assert (r.status, r.bytes, r.sha256, r.lines) == (1, len(data), hashlib.sha256(data).hexdigest(), data.count(b"\n"))
    assert sorted((r.archive.rsplit("/")[-1], r.status) for r in rows if r.source_full_csv_file_name is None) == [("bad.zip", 3), ("none.ZIP", 1)]
    assert not [p for p in out.rglob("*") if "_staged" in str(p) and p.is_file()]


def test_parts_end_outside_quotes(spark, tmp_path):
    body = "".join(f'{i},"two\nlines, ""{i}"""\n' for i in range(50))
    (tmp_path / "in").mkdir()
    with zipfile.ZipFile(tmp_path / "in" / "a.zip", "w") as z:
        z.writestr("q.csv", "id,x\n" + body)
    unpack.unpack(spark, f"{tmp_path}/in", f"{tmp_path}/out", "20240102", split_bytes=100)
    parts = [p.read_text() for p in sorted((tmp_path / "out/20240102/a/q").iterdir())]
    assert len(parts) > 5 and all(p.startswith("id,x\n") and p.count('"') % 6 == 0 and p.endswith('"\n') for p in parts)
    assert "".join(p[5:] for p in parts) == body


def test_equal_names_do_not_meet_and_a_clash_is_an_error_before_any_write(spark, tmp_path):
    for folder, text in (("p", "1"), ("q", "2")):
        (tmp_path / "in" / folder).mkdir(parents=True)
        with zipfile.ZipFile(tmp_path / "in" / folder / "x.zip", "w") as z:
            z.writestr("s1/lat.csv", text)
            z.writestr("s2/lat.csv", text * 9)
    unpack.unpack(spark, f"{tmp_path}/in", f"{tmp_path}/out", "d")
    got = {str(p.relative_to(tmp_path / "out/d")): p.read_text() for p in (tmp_path / "out/d").rglob("*.csv")}
    assert got == {"p/x/s1/lat.csv": "1", "p/x/s2/lat.csv": "1" * 9, "q/x/s1/lat.csv": "2", "q/x/s2/lat.csv": "2" * 9}
    with zipfile.ZipFile(tmp_path / "in" / "p" / "x.ZIP", "w") as z:
        z.writestr("s1/lat.csv", "3")
    with pytest.raises(ValueError, match="one target"):
        unpack.unpack(spark, f"{tmp_path}/in", f"{tmp_path}/new", "d")
    assert not (tmp_path / "new").exists()


def test_a_whole_file_named_as_a_part_of_another_is_a_clash(spark):
    rows = [("z.zip", "a.csv", "t/a/a_part", True), ("z.zip", "a/a_part002.csv", "t/a/a_part002.csv", False), ("z.zip", "b/b_part001.csv", "t/b/b_part001.csv", False)]
    assert [r.sources for r in unpack.clashes(spark.createDataFrame(rows, "archive string, member string, stem string, is_split boolean")).collect()] == [2]


def _most_tasks(spark, run):
    """The tasks of the largest stage of what ``run`` starts, with its result; files weigh as on a cluster of small splits."""
    group, tracker = uuid.uuid4().hex, spark.sparkContext.statusTracker()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")
    spark.sparkContext.setJobGroup(group, group)
    try:
        found = run()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    return max(s.numTasks for s in stages if s), found


def test_tasks_of_an_unpack_job_do_not_grow_with_its_archives(spark, tmp_path):
    for i in range(200):
        (tmp_path / "in" / f"{i:03d}").mkdir(parents=True)
        with zipfile.ZipFile(tmp_path / "in" / f"{i:03d}" / "x.zip", "w") as z:
            z.writestr("a.csv", f"{i}\n")
    tasks, rows = _most_tasks(spark, lambda: unpack.unpack(spark, f"{tmp_path}/in", f"{tmp_path}/out", "d").collect())
    assert len(rows) == 200 and tasks < 100
    tasks, rows = _most_tasks(spark, lambda: arc.read_contents(arc.list_tree(spark, f"{tmp_path}/out/d").filter("path LIKE '%.csv'")).collect())
    assert sorted(int(bytes(r.content)) for r in rows) == list(range(200)) and tasks < 100


def test_archives_are_listed_in_rounds_as_sparks_reader_lists_them(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(arc, "LIST_FOLDERS", 2)
    for name in ("a.zip", "b.ZIP", "c.txt", "p/q/r/s/d.zip", "p/q/e.zip", "p/t/f g%20.zip", "k=1/h.zip", "_k=2/i.zip", "_hidden/j.zip", ".k/l.zip", "p/_m.zip", "p/.n.zip"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(name.encode())
    (tmp_path / "empty").mkdir()
    spark_rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.[zZ][iI][pP]").load(str(tmp_path)).select("path", "length")
    expected = sorted(map(tuple, spark_rows.collect()))
    assert len(expected) == 7 and sorted(map(tuple, arc.list_archives(spark, str(tmp_path)).collect())) == expected
    assert [tuple(r) for r in arc.list_archives(spark, f"file://{tmp_path}/a.zip").collect()] == [(f"file:{tmp_path}/a.zip", 5)]
    with pytest.raises(FileNotFoundError):
        arc.list_archives(spark, f"{tmp_path}/nowhere")


def test_archives_may_go_once_their_members_are_staged(spark, zips, tmp_path, monkeypatch):
    publish = unpack.publish

    def late(staged):
        (tmp_path / "a.zip").unlink()
        return publish(staged)

    monkeypatch.setattr(unpack, "publish", late)
    rows = unpack.unpack(spark, zips, f"{tmp_path}/out", "d").collect()
    assert sorted((r.archive.rsplit("/")[-1], r.source_full_csv_file_name or "", r.status) for r in rows) == [
        ("a.zip", "dir/two.CSV", 1), ("a.zip", "empty.csv", 1), ("a.zip", "one.csv", 1), ("bad.zip", "", 3), ("none.ZIP", "", 1)]


def test_pages_are_packed_by_many_tasks(spark, tmp_path):
    rows = [(i % 50, f"http://x/{i % 50}", "<p>\nb") for i in range(100)]
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    packed = plans.page_archives(Tables(spark, str(tmp_path)))
    assert arc.list_archives(spark, packed).count() == 50
    dealt = plans._dealt_pages(Tables(spark, str(tmp_path))).groupBy("page_id", F.spark_partition_id().alias("task")).count().collect()
    assert len(dealt) == 50 and len({r.task for r in dealt}) > 4


def test_publishing_twice_is_harmless(spark, tmp_path):
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "1").write_text("abc")
    staged = spark.createDataFrame([(f"{tmp_path}/s/1", f"{tmp_path}/t/x.csv", 3, None)], "staged string, target string, bytes long, error string")
    assert unpack.publish(staged) == unpack.publish(staged) == 1 and (tmp_path / "t" / "x.csv").read_text() == "abc"
    with pytest.raises(Exception, match="not staged"):
        unpack.publish(staged.withColumn("target", F.lit(f"{tmp_path}/t/y.csv")).withColumn("bytes", F.lit(4)))


SPEC = [ColumnSpec(k.lower(), k, True, 3) for k in gen.SPARK_TYPES]


def test_generation_does_not_depend_on_partitions(spark):
    made = gen.generate(spark, SPEC, 200, seed=5)
    rows = spark.range(1, 201, 1, 7).toDF("_row")
    again = gen.generate_for(rows.repartition(3), "_row", SPEC, 5).drop("_row")
    texts = [sorted(str(r) for r in df.withColumn("variant", F.to_json("variant")).collect()) for df in (made, again)]
    assert texts[0] == texts[1]
    other = gen.generate(spark, SPEC, 200, seed=6)
    assert made.select("varchar").exceptAll(other.select("varchar")).count() > 150


def test_generated_types_match_the_spec(spark):
    made = gen.generate(spark, SPEC, 5, seed=1)
    assert [f.dataType.simpleString() for f in made.schema.fields] == [f.dataType.simpleString() for f in gen.spec_schema(SPEC).fields]


def test_people_have_unique_mail_and_stated_ages(spark):
    people = gen.fake_people(spark.range(1, 1001), "id", 1, "2024-01-01")
    assert people.select("email").distinct().count() == 1000
    assert people.filter("id = 7").first().customer_id == "CUST000007"
    assert gen.fake_people(spark.range(1234567, 1234568), "id", 1, "2024-01-01").first().customer_id == "CUST1234567"


def test_mapping_rows_and_back(spark):
    m = Mapping("M", "a.b.t", "a.b.s", (Join("a.b.j", "NATURAL LEFT JOIN"), Join("a.b.k", condition="s.x = k.x")),
                (Target("A", "x"), Target("B", "y", "upper(y)")))
    rows = mp.mapping_rows(spark, m)
    assert rows.count() == 8 and {r.MAPPING_ID for r in rows.collect()} == {"M"}
    back = mp.read_mapping(rows, "M")
    assert [(j.kind.upper(), j.table, j.condition) for j in back.joins] == [("NATURAL LEFT JOIN", "a.b.j", None), ("INNER JOIN", "a.b.k", "s.x = k.x")]
    assert back.columns == m.columns
    s, j, k = (spark.createDataFrame(r, c) for r, c in (([(1, "p")], "x int, y string"), ([(1, 5)], "x int, z int"), ([(1,), (1,)], "x int")))
    out = mp.run_mapping(rows, "M", {"a.b.s": s, "a.b.j": j, "a.b.k": k})
    assert [tuple(r) for r in out.collect()] == [(1, "P")] * 2
    with pytest.raises(ValueError):
        mp.read_mapping(rows, "other")


def test_longer_names_are_not_touched(spark):
    m = Mapping("M", "a.b.t", "a.b.s", (), (Target("A", "x", "x + xx"),))
    s = spark.createDataFrame([(1, 10)], "x int, xx int")
    assert mp.run_mapping(mp.mapping_rows(spark, m), "M", {"a.b.s": s}).first().A == 11


def test_auto_map_reports_ambiguity(spark):
    rows = {r.target_column: tuple(r)[1:] for r in mp.auto_map(spark, ["ID", "V", "N"], {"a": ["id"], "b": ["Id", "v"]}).collect()}
    assert rows == {"ID": ("a", "id", True), "V": ("b", "v", False), "N": (None, None, False)}


def test_function_stack_text():
    assert mp.transformation("c", []) == "c"
    assert mp.transformation("c", [("DATE_TRUNC('MONTH', )", "wrapper")]) == "DATE_TRUNC('MONTH', c)"
    assert mp.transformation("c", [("-", "operator"), ("ROUND(, 2)", "wrapper")]) == "-ROUND(c, 2)"
    assert mp.transformation("c = 1", [("CASE", "template", "'a'", "'b'")]) == "CASE WHEN c = 1 THEN 'a' ELSE 'b' END"


def test_requests_are_taken_once(spark):
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    first = req.request_rows(df, "R1", "d.s.t", ["v", "id"], "u")
    second = req.request_rows(df, "R2", "d.s.t", ["id"], "u")
    assert req.new_requests(first, first.unionByName(second)).select("Request_ID").distinct().collect()[0][0] == "R2"
    assert [r.column for r in req.request_rules(first, "R1")] == ["v", "id"]


def lines_of(spark, text):
    return spark.createDataFrame([("d", i, x) for i, x in enumerate(text.split("|"))], "doc_id string, line_no int, line string")


def test_marker_modes(spark):
    lines = lines_of(spark, "s|a|e|S|S x e|b|S|c")
    got = rep.between_markers(lines, "S", "e").orderBy("pair", "line_no").collect()
    # first S at 3 pairs with first e at 2 and is dropped, S at 4 pairs with the e of its own line and is dropped
    assert [(r.pair, r.line_no) for r in got] == []
    got = rep.between_markers(lines, "s", "e").orderBy("line_no").collect()
    assert [r.line_no for r in got] == [0, 1, 2]
    got = rep.between_markers(lines_of(spark, "M|M"), "M", "M", "equals_prefix").collect()
    assert sorted((r.pair, r.line_no) for r in got) == [(1, 0), (2, 1)]


def test_one_line_section_keeps_its_end(spark):
    lines = lines_of(spark, "x|AS OF 1 Total For : a $1|y|AS OF 2|z|Total For : b|w")
    assert [r.section for r in rep.section_ids(lines).orderBy("line_no").collect()] == [0, 1, 0, 2, 2, 2, 0]


def test_label_below_the_last_table_holds_for_the_next_page(spark):
    labels = spark.createDataFrame([("d", 1, 10.0, "a.b.c"), ("d", 1, 500.0, "a.b.d"), ("d", 3, 5.0, "a.b.e")], "doc_id string, page int, y double, label string")
    tables = spark.createDataFrame([("d", 1, 20.0, 100.0, 1), ("d", 2, 30.0, 60.0, 2), ("d", 3, 900.0, 950.0, 3)],
                                   "doc_id string, page int, top double, bottom double, table_no int")
    got = {r.table_no: r.active_label for r in rep.label_tables(labels, tables).collect()}
    # the label of page 3 is farther than the scan distance above its table
    assert got == {1: "a.b.c", 2: "a.b.d", 3: "a.b.d"}
