import contextlib
import datetime
import random

import pytest
from pyspark.sql import functions as F, types as T

from tidemark.functions.generate import ColumnSpec
from tidemark.operators import control, drift
from tidemark.sinks import writers
from tidemark.sources import archives, inference, splits, tables


def fc_of(spark, pairs):
    return spark.createDataFrame([(f, i, c, "string") for i, (f, c) in enumerate(pairs)], "file string, ordinal int, column string, type string")


def test_summary_has_three_cases(spark):
    even = fc_of(spark, [("a", "x"), ("a", "y"), ("b", "x"), ("b", "y")])
    odd = fc_of(spark, [("a", "x"), ("a", "y"), ("b", "x")])
    three = spark.createDataFrame([("a",), ("b",), ("c",)], "file string")
    status = lambda *a: drift.validation_summary(*a).first().validation_status
    assert (status(even), status(odd), status(even, three)) == ("even", "uneven", "short")
    # a listed file that nobody read lacks every column
    report = {(r.file_name, r.missing_column) for r in drift.summary_or_missing(even, three).collect()}
    assert report == {("c", "x"), ("c", "y")}


def test_missing_columns_with_a_listing(spark):
    fc = fc_of(spark, [("in/a.csv", "x"), ("in/a.csv", "y"), ("in/b.csv", "x")])
    files = spark.createDataFrame([("in/a.csv",), ("b.csv",), ("c.csv",)], "file string")
    rows = {(r.file, r.missing_column) for r in drift.missing_columns(fc, files).collect()}
    assert rows == {("b.csv", "y"), ("c.csv", "x"), ("c.csv", "y")}


def test_equal_names_in_two_folders_stay_apart(spark):
    fc = fc_of(spark, [("d1/a.csv", "x"), ("d1/a.csv", "y"), ("d2/a.csv", "x")])
    assert [tuple(r) for r in drift.missing_columns(fc).collect()] == [("d2/a.csv", "y")]


def test_compare_to_table(spark):
    fc = fc_of(spark, [("a", "x"), ("a", "y")])
    result = lambda cols: drift.compare_to_table(fc, cols).first().result
    assert result(["X", "Y", "etl_user"]) == "TRUE"
    assert result(["X", "Y", "Z", "W"]) == "W, Z"
    assert result(["X"]) == "Y"


def test_infer_types_quotes_and_no_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,amount,day,flag,text,empty\n1,1.50,2024-01-02,true,"a,""b""",\n2,NULL,2024-02-30,false,c,\n')
    got = {r.column: r.type for r in inference.infer_files(spark, str(tmp_path / "a.csv")).collect()}
    assert got == {"id": "bigint", "amount": "decimal", "day": "string", "flag": "boolean", "text": "string", "empty": "string"}
    fmt = tables.CsvFormat(header=False)
    (tmp_path / "b.csv").write_text("1,1e3,2024-01-02 03:04:05\n")
    got = {r.column: r.type for r in inference.infer_files(spark, str(tmp_path / "b.csv"), fmt).collect()}
    assert got == {"c1": "bigint", "c2": "double", "c3": "timestamp"}


def test_csv_null_tokens_and_types(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id|name\n1|"x|y"\nNULL|null\n')
    rows = tables.read_csv(spark, str(tmp_path / "a.csv"), "id int, name string", tables.CsvFormat("|")).collect()
    assert [tuple(r) for r in rows] == [(1, "x|y"), (None, None)]


def test_listing_reads_no_content(spark, tmp_path):
    from tests.plans import plan_of

    (tmp_path / "In").mkdir()
    (tmp_path / "In" / "cash_1.CSV").write_text("x")
    listed = tables.list_files(spark, str(tmp_path), prefix="In/", contains="cash")
    assert [(r.file_name, r.size) for r in listed.collect()] == [("cash_1.CSV", 1)]
    assert "content" not in plan_of(listed).split("ReadSchema")[-1]
    assert tables.list_files(spark, str(tmp_path), md5=True).first().md5 == "9dd4e461268c8034f5c8564e155c67a6"


def test_read_lines_and_columns(spark, tmp_path):
    (tmp_path / "r.txt").write_text(" a \r\nb\n")
    rows = tables.read_lines(spark, str(tmp_path)).orderBy("line_no").collect()
    assert [(r.line_no, r.line) for r in rows] == [(0, "a"), (1, "b")]
    described = tables.describe_columns(spark.range(1)).first()
    assert (described.ordinal, described.column_name, described.data_type) == (1, "id", "bigint")


def test_unreadable_trailer(spark):
    lines = spark.createDataFrame([("f", 1, 'H"|"x'), ("f", 2, "rubbish")], "file string, pos int, line string")
    row = control.validate_trailers(lines, "2024-01-02").first()
    assert row.status == 3 and row.error.startswith("runtime_error")


def test_trailers_of_split_files(spark, tmp_path):
    body = ['H"|"f"|"2024-01-02"'] + [f'D"|"{i}"' for i in range(500)] + ['T"|"f"|"2024-01-02"|"502"']
    (tmp_path / "a.txt").write_text("\n".join(body) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        lines = tables.read_file_lines(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 1
        row = control.validate_trailers(lines, "2024-01-02").first()
        records = control.read_records(spark, str(tmp_path)).groupBy("kind").count().collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert (row.record_count, row.status) == (502, 1)
    assert {r.kind: r["count"] for r in records} == {"H": 1, "D": 500, "T": 1}


def test_lines_of_listed_files_are_those_of_sparks_reader(spark, tmp_path):
    rng = random.Random(5)
    texts = ["", "\n", "\r", "\r\n", "a", "a\r\r\n\nb\r", "\ufeff", "\ufeff\nx", "\ufeffä\r\nö", "x\n\ufeffy\n"]
    texts += ["".join(rng.choices(["a", "é", "\n", "\r", "\r\n", "\U0001f600"], k=60)) for _ in range(20)]
    for i, text in enumerate(texts):
        (tmp_path / f"{i:03d}.txt").write_bytes(text.encode())

    def lines(frame):
        rows = sorted((r.file.rsplit("/")[-1], tuple(r.pos), r.line) for r in frame.collect())
        return [(f, line) for f, _, line in rows]

    expected = lines(tables.read_file_lines(spark, str(tmp_path)))
    files = archives.list_tree(spark, str(tmp_path))
    assert lines(tables.read_file_lines(spark, files)) == expected
    for size in (1, 2, 3, 7, 64):
        got = splits.listed_lines(files, size).select("file", F.struct("block", "place").alias("pos"), "line")
        assert lines(got) == expected, size


def test_markers_as_unquoted_fields_are_data(spark, tmp_path):
    (tmp_path / "a.txt").write_text('H"|"f"\nD"|H"|"x"\nD"|T"|"y"\nT"|"f"|"4"\n')
    (tmp_path / "b.txt").write_text('D"|T"|"z"\n')
    rows = control.read_records(spark, str(tmp_path)).collect()
    assert sorted((r.kind, r.record) for r in rows) == [
        ("D", 'D"|H"|"x"'), ("D", 'D"|T"|"y"'), ("D", 'D"|T"|"z"'), ("H", 'H"|"f"'), ("T", 'T"|"f"|"4"')]


@contextlib.contextmanager
def splits_of(spark, size):
    """Files are read in pieces of ``size`` bytes."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        yield
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_marker_inside_a_field_is_data(spark, tmp_path):
    (tmp_path / "f").write_text('rubbish\nH"|"h"\nD"|"a"|"one\nD"|" two"\nD"|"b"|"x"\nD"|"c"|"say ""hi""\n\nH""|"\nT"|"t"\n')
    for size in (1 << 20, 7):
        with splits_of(spark, size):
            rows = control.quoted_records(spark, str(tmp_path)).orderBy("record_no").collect()
        assert [(r.kind, r.record) for r in rows] == [
            ("H", 'H"|"h"'), ("D", 'D"|"a"|"one D"|" two"'), ("D", 'D"|"b"|"x"'), ("D", 'D"|"c"|"say ""hi"" H""|"'), ("T", 'T"|"t"')]


@pytest.mark.parametrize("size", [5, 64, 999, 1 << 20])
def test_line_numbers_do_not_depend_on_splits(spark, tmp_path, size):
    pick = random.Random(3)
    files = {n: ["".join(pick.choice("ab é") for _ in range(pick.randint(0, 9))) for _ in range(300)] + ["end"] for n in ("a.txt", "b.txt")}
    for name, lines in files.items():
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    (tmp_path / "empty.txt").write_text("")
    with splits_of(spark, size):
        frame = tables.read_lines(spark, str(tmp_path))
        rows = frame.collect()
        assert size > 999 or splits.block_lines(spark, str(tmp_path)).rdd.getNumPartitions() > 3
    got = {n: [r.line for r in sorted((r for r in rows if r.doc_id.endswith(n)), key=lambda r: r.line_no)] for n in files}
    assert got == {n: [x.strip(" ") for x in lines] for n, lines in files.items()}
    assert sorted(r.line_no for r in rows) == sorted([*range(301)] * 2)


@pytest.mark.parametrize("size", [5, 40, 700, 1 << 20])
def test_quoted_fields_with_line_breaks_in_splits(spark, tmp_path, size):
    pick = random.Random(5)
    value = lambda: "".join(pick.choice('ab,"\n\r é;') for _ in range(pick.randint(0, 30)))
    rows = [(i, value(), pick.choice([None, value()])) for i in range(200)]
    for name, part in (("a.csv", rows[:150]), ("b.csv", rows[150:])):
        with open(tmp_path / name, "w", newline="") as file:
            file.write("id,x,y\n" + "".join(
                f"{i}," + '"' + x.replace('"', '""') + '",' + ("" if y is None else '"' + y.replace('"', '""') + '"') + "\n" for i, x, y in part) + "\n")
    with splits_of(spark, size):
        got = tables.read_text_columns(spark, str(tmp_path), None, tables.CsvFormat(line_breaks=True), emptyValue="").collect()
    assert sorted((int(r.id), r.x, r.y) for r in got) == rows


def test_only_torn_records_are_shuffled(spark, tmp_path):
    from tests.plans import plan_of

    (tmp_path / "a.csv").write_text('x\n1\n"2\n3"\n')
    frame = splits.delimited_records(spark, str(tmp_path))
    assert sorted((r.record_no, r.record) for r in frame.collect()) == [(1, "x"), (2, "1"), (3, '"2\n3"')]
    assert "multiLine" not in plan_of(frame) and "wholetext" not in plan_of(frame)


def test_audit_rows(spark):
    now = datetime.datetime(2024, 1, 2)
    rows = control.audit_rows(spark, [{"JOB_ID": "1", "START_TIME": now, "TOT_SRC_CNT": 3}, {"JOB_ID": "2", "error": "boom"}]).collect()
    assert [(r.TASK_FLOW_STATUS, r.ERROR_MSG) for r in rows] == [(1, "SUCCESS"), (3, "boom")]
    assert len(rows[0]) == 16


def test_run_without_failures(spark):
    lines = spark.createDataFrame([("f", 1, 'H"|"x'), ("f", 2, 'T"|"f"|"2024-01-02"|"2"')], "file string, pos int, line string")
    files = spark.createDataFrame([("in/f",)], "file string")
    row = control.run_summary(control.validate_trailers(lines, "2024-01-02"), control.route_files(files, "file", [], []), "2024-01-02").first()
    assert (row.status, row.failed, row.target_cnt) == (1, 0, 1) and row.message.startswith("INFO")


def test_tables(spark):
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    writers.ctas(df, "t_one")
    writers.clone_schema(df, "t_two")
    assert spark.table("t_two").count() == 0 and spark.table("t_two").columns == ["id", "v"]
    writers.append(df.select("id"), "t_two")
    writers.insert_select(df, "t_two")
    assert {tuple(r) for r in spark.table("t_two").collect()} == {(1, None), (1, "a")}
    with pytest.raises(ValueError, match="not in the target"):
        writers.append(df.withColumn("more", F.lit(1)), "t_two")
    with pytest.raises(ValueError, match="does not fit"):
        writers.append(spark.createDataFrame([("x",)], "id string"), "t_two")
    writers.merge_new("t_one", spark.createDataFrame([(1, "b"), (2, "c"), (2, "d")], "id int, v string"), ["id"])
    assert sorted(r.id for r in spark.table("t_one").collect()) == [1, 2]
    made = writers.create_from_spec(spark, "t_three", [ColumnSpec("a", "VARCHAR", True), ColumnSpec("n", "NUMBER", True), ColumnSpec("v", "VARIANT", True)])
    assert [f.dataType.simpleString() for f in made.schema.fields] == ["string", "decimal(9,4)", "variant"]


def test_types_that_fit():
    kind = lambda ddl: T.StructType.fromDDL(f"a {ddl}")
    fit = lambda a, b: writers.check_compatible(kind(a), kind(b))[0]
    assert fit("int", "bigint") and fit("int", "double") and fit("string", "varchar(9)") and fit("timestamp", "timestamp_ntz")
    assert fit("array<int>", "array<string>") and fit("map<string,int>", "struct<x:int>") and fit("decimal(9,2)", "decimal(12,3)")
    assert not fit("string", "int") and not fit("date", "timestamp") and not fit("double", "decimal(9,2)") and not fit("decimal(9,2)", "decimal(5,2)")
    assert writers.check_compatible(T.StructType.fromDDL("a int, b int"), kind("string")) == (False, "b is not in the target; a: int does not fit string")


def test_single_file(spark, tmp_path):
    writers.unload_csv(spark.range(10), str(tmp_path / "one"), single=True)
    assert len(list((tmp_path / "one").glob("*.csv"))) == 1


def test_a_table_from_a_spec_holds_no_more_than_it_says(spark):
    spec = [ColumnSpec("code", "VARCHAR", False, 3), ColumnSpec("amount", "NUMBER", True, 2), ColumnSpec("n", "INTEGER", True, 2)]
    writers.create_from_spec(spark, "typed", spec)
    assert [(r.column_name, r.data_type) for r in tables.describe_table(spark, "typed").collect()] == [("code", "varchar(3)"), ("amount", "decimal(6,4)"), ("n", "decimal(2,0)")]
    writers.insert_checked(spark.createDataFrame([("abc", "12.3456", 99)], "code string, amount string, n int").withColumn("amount", F.col("amount").cast("decimal(6,4)")), "typed")
    for bad, kinds in (([("abcd", 1)], "code string, n int"), ([("a", 100)], "code string, n int"), ([(None, 1)], "code string, n int")):
        with pytest.raises(Exception):
            writers.insert_checked(spark.createDataFrame(bad, kinds), "typed")
    with pytest.raises(ValueError):
        writers.insert_checked(spark.createDataFrame([(1,)], "n int"), "typed")
    assert [tuple(map(str, r)) for r in spark.table("typed").collect()] == [("abc", "12.3456", "99")]
    spark.sql("DROP TABLE typed")


def test_white_space_around_values_is_written(spark, tmp_path):
    rows = [(" a ", "b\n"), ("\tc", " ")]
    writers.unload_csv(spark.createDataFrame(rows, "x string, y string"), str(tmp_path / "w"))
    got = tables.read_csv(spark, str(tmp_path / "w"), "x string, y string", tables.CsvFormat(line_breaks=True))
    assert sorted(map(tuple, got.collect())) == sorted(rows)
