import re

import pytest
from pyspark.sql import functions as F

from tests.plans import plan_of
from tidemark.functions import masking, scramble
from tidemark.operators import obfuscate as obf
from tidemark.operators.obfuscate import Rule

WORDS = ["pavan", "HOUSEHOLD", "1234567890", "Alice", "sam", "cutter"]


@pytest.fixture(scope="module")
def words(spark):
    return spark.createDataFrame([(i, w) for i, w in enumerate([*WORDS, None, ""])], "i int, v string")


def values(df, col):
    return [r[0] for r in df.orderBy("i").select(col).collect()]


def test_masks(words):
    v = F.col("v")
    assert values(words, masking.mask_fixed(v, "*"))[:2] == ["*****", "*********"]
    assert values(words, masking.mask_lastn(v, 4, "X"))[:6] == ["Xavan", "XXXXXHOLD", "XXXXXX7890", "Xlice", "XXX", "XXtter"]
    assert values(words, masking.mask_firstn(v, 3, "#"))[:6] == ["pav##", "HOU######", "123#######", "Ali##", "###", "cut###"]
    for made in (masking.mask_fixed(v), masking.mask_lastn(v), masking.mask_firstn(v), masking.nullify(v)):
        assert values(words, made)[6] is None


def test_word_variants(words):
    v = F.col("v")
    keyed = {"scope": "S", "salt": "z"}
    reverse = values(words, scramble.scramble_words(v, **keyed, variant="REVERSE"))
    assert reverse[:6] == ["navap", "DLOHESUOH", "0987654321", "Ecila", "mas", "rettuc"]
    inner = values(words, scramble.scramble_words(v, **keyed))
    for old, new in zip(WORDS, inner):
        assert sorted(old.lower()) == sorted(new.lower())
        if not old.isdigit():
            assert (old[0], old[-1]) == (new[0], new[-1])
    left = values(words, scramble.scramble_words(v, **keyed, variant="ROTATE_LEFT"))
    right = values(words, scramble.scramble_words(v, **keyed, variant="ROTATE_RIGHT"))
    for old, a, b in zip(WORDS, left, right):
        assert a != old or len(set(old)) == 1
        assert a.lower() in (old * 2).lower() and b.lower() in (old * 2).lower()


def test_separators_case_and_hyphens_stay(spark):
    df = spark.createDataFrame([(0, "O'Neil, JEAN-LUC (A1b) été\n\n x")], "i int, v string")
    out = values(df, scramble.scramble_words(F.col("v"), scope="S", salt="z", variant="FULL_SHUFFLE"))[0]
    shape = lambda s: re.sub("[A-Za-z0-9'-]", "", s)
    assert shape(out) == shape("O'Neil, JEAN-LUC (A1b) été\n\n x")
    assert re.search("[A-Z-]{8}", out)


def test_digits_and_alphanum_keep_classes(words):
    for change in (scramble.scramble_digits, scramble.scramble_alphanum):
        df = words.sparkSession.createDataFrame([(0, "Ab-12 cd/3456.X")], "i int, v string")
        out = values(df, change(F.col("v"), scope="S", salt="z"))[0]
        kinds = lambda s: re.sub("[0-9]", "9", re.sub("[A-Za-z]", "a", s))
        assert kinds(out) == kinds("Ab-12 cd/3456.X")
        assert sorted(out) == sorted("Ab-12 cd/3456.X")


def test_same_result_on_any_partitioning(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    rules = [Rule("text", "SCRAMBLE_WORDS_FULL")]
    one, seven = (obf.obfuscate(docs.repartition(n), rules, "s") for n in (1, 7))
    assert one.exceptAll(seven).count() == 0


def test_unknown_rule_and_variant_raise(words):
    with pytest.raises(ValueError):
        obf.obfuscate(words, [Rule("v", "MAGIC")], "s")
    with pytest.raises(ValueError):
        scramble.scramble_words(F.col("v"), scope="S", salt="z", variant="MAGIC")


def test_masks_need_no_python_and_salt_is_not_in_the_plan(words):
    rules = [Rule("v", "MASK_LASTN")]
    assert "Python" not in plan_of(obf.obfuscate(words, rules, "saltvalue77"))
    for rule in ("HASH_DETERMINISTIC", "SCRAMBLE_WORDS", "SCRAMBLE_DIGITS"):
        assert "saltvalue77" not in plan_of(obf.obfuscate(words, [Rule("v", rule)], "saltvalue77"))


def test_column_shuffle_keeps_the_multiset(spark, sf):
    customers = spark.read.parquet(f"{sf}/customer.parquet")
    shuffled = obf.shuffle_column(customers, ["c_custkey"], "c_acctbal", "s")
    assert sorted(r[0] for r in shuffled.select("c_acctbal").collect()) == sorted(r[0] for r in customers.select("c_acctbal").collect())
    assert customers.select("c_custkey", "c_acctbal").exceptAll(shuffled.select("c_custkey", "c_acctbal")).count() > 100
