from pyspark.sql import Window, functions as F

from tests.plans import plan_of
from tidemark.operators import ranks, relational as rel


def test_global_rank_is_a_plain_row_number_without_one_partition(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    order = [F.col("o_orderpriority").desc(), F.col("o_orderkey")]
    ranked = ranks.global_rank(orders, order, partitions=5)
    assert "SinglePartition" not in plan_of(ranked)
    plain = orders.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    assert ranked.select("o_orderkey", "rank").exceptAll(plain.select("o_orderkey", "rank")).count() == 0
    assert ranked.count() == 1500


def test_ties_and_nulls_are_numbered_once_each(spark):
    df = spark.range(300).select(F.col("id"), F.when(F.col("id") % 5 > 0, F.col("id") % 7).alias("v"), F.lit("x").alias("rank"))
    for order in (["v"], [F.col("v").desc()], [F.col("v").asc_nulls_last()]):
        rows = ranks.global_rank(df, order, partitions=4).collect()
        assert sorted(r["rank"] for r in rows) == list(range(1, 301))
        plain = [r.v for r in df.orderBy(*order).collect()]
        assert [r.v for r in sorted(rows, key=lambda r: r["rank"])] == plain
    assert ranks.global_rank(df.limit(0), ["v"]).collect() == []
    wide = df.withColumn("text", F.repeat(F.lit("long"), 9))
    assert "heckpoint" not in plan_of(ranks.global_rank(wide, ["id"]))


def test_hot_groups_get_the_same_numbers(spark):
    # one key holds most rows, null is a key too
    df = spark.range(400).select(F.when(F.col("id") % 4 == 0, F.col("id") % 3).alias("k"), (F.col("id") * 7919 % 401).alias("v"))
    plain = ranks.row_number_by(df, ["k"], ["v"], max_rows=10**6)
    split = ranks.row_number_by(df, ["k"], ["v"], max_rows=50)
    assert plain.exceptAll(split).count() == 0 and split.count() == 400


def test_scans_cross_chunks(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("pos"), F.when(F.col("id") % 7 == 0, F.col("id")).alias("v"))
    w = Window.partitionBy("k").orderBy("pos")
    scans = {"s": ranks.sum_so_far(F.col("v")), "l": ranks.last_so_far(F.col("v")), "b": ranks.last_before(F.col("v")), "p": ranks.previous(F.col("v"))}
    want = df.select("k", "pos", F.sum("v").over(w).alias("s"), F.last("v", True).over(w).alias("l"),
                     F.last("v", True).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("b"), F.lag("v").over(w).alias("p"))
    want = want.withColumn("s", F.coalesce("s", F.lit(0)))
    for size in (10, 97, 100_000):
        got = ranks.ordered_scan(df, ["k"], "pos", scans, size).withColumn("s", F.coalesce("s", F.lit(0)))
        assert got.select(*want.columns).exceptAll(want).count() == 0
        assert got.count() == 1000
    turned = ranks.next_value(df, ["k"], "pos", F.col("v"), "n", 50)
    assert turned.select("k", "pos", "n").exceptAll(df.select("k", "pos", F.lead("v").over(w))).count() == 0


def test_top_row_limits_groups_before_the_shuffle(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    assert plan_of(rel.latest_per_key(orders, ["o_custkey"], ["o_orderdate"])).count("WindowGroupLimit") >= 2


def test_ascending_list_wins(spark):
    df = spark.createDataFrame([(1, 2), (1, 3), (None, 1)], "a int, b int")
    rows = rel.sort_by(df, [F.col("a"), F.col("b").desc()], [1, 1]).collect()
    assert [tuple(r) for r in rows] == [(1, 2), (1, 3), (None, 1)]
    rows = rel.sort_by(df, [F.col("a"), F.col("b").desc()]).collect()
    assert [r.b for r in rows] == [1, 3, 2]


def test_not_in_with_nulls(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "a int")
    listed = spark.createDataFrame([(1,), (None,)], "x int")
    assert rel.in_subquery(df, "a", listed, "x", negate=True).count() == 0
    assert [r.a for r in rel.in_subquery(df, "a", listed.filter("x = 1"), "x", negate=True).collect()] == [2]
    assert rel.in_subquery(df, "a", listed.filter("x = 9"), "x", negate=True).count() == 3


def test_deep_page_uses_ranks(spark):
    rows = rel.deep_page(spark.range(100), ["id"], 5, 50).collect()
    assert sorted(r.id for r in rows) == [50, 51, 52, 53, 54]
    assert [r.id for r in rel.page(spark.range(100), ["id"], 5, 50).collect()] == [50, 51, 52, 53, 54]


def test_null_keys_are_carried_over_chunks(spark):
    from tidemark.operators import ranks

    df = spark.createDataFrame([(k, i, 1) for k in (None, "a") for i in range(6)], "k string, pos long, v int")
    got = ranks.running_sum(df, ["k"], "pos", F.col("v"), "s", chunk_rows=2).orderBy("k", "pos").collect()
    assert [r.s for r in got] == [1, 2, 3, 4, 5, 6] * 2


def test_one_row_is_checked(spark):
    import pytest

    with pytest.raises(Exception, match="(?i)more than one row"):
        rel.attach_one_row(spark.range(3), spark.range(2).toDF("x")).collect()


def test_merge_finds_a_repeated_key(spark):
    import pytest

    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    right = spark.createDataFrame([(1, "x"), (3, "y"), (None, "z")], "k int, w string")
    assert sorted(tuple(r)[1:] for r in rel.merge_one_to_one(left, right, ["k"], "left").collect()) == [("a", "x"), ("b", None), ("c", None)]
    with pytest.raises(Exception, match="right side repeats"):
        rel.merge_one_to_one(left, right.union(right), ["k"]).collect()
