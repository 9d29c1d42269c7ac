"""Spelling variants: words one edit apart, found by asymmetric chunks.

Of two words that differ by one inserted, deleted or replaced code point, take the shorter (of equally long
ones, either): cut into two disjoint chunks, at least one of them stands unchanged in the other word, in
its place or one further. So one word gives two chunks and the other the grams of that size at every
position a chunk could be met in; words meet at equal chunks within shift one, and each pair is verified.
A chunk that too many words share is not joined: what is left of these words is cut into two chunks again, as
the edit leaves one of those unchanged as well. This ends with one code point left, where a key has no
more words than there are letters; so no key ever pairs more than a bounded number of words, and no pair is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import flat
from tidemark.llm.work import fresh
from tidemark.session import cut_lineage

#: Runs of these are words; of them, A-Z become a-z.
LETTERS = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Shortest word in code points, least occurrences, and how much more frequent a form is than its variant.
LENGTH, OFTEN, TIMES = 6, 5, 5
#: One occurrence in so many, by hash, has a code point deleted.
MISSPELT = 199
#: Pairs of one key that are verified at once; keys with more are cut finer.
PAIRS = 4096


def words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", misspelt: int = MISSPELT, length: int = LENGTH, often: int = OFTEN) -> DataFrame:
    """(word, n): words of at least ``length`` code points with their occurrences, ``often`` at least.

    Null texts have no words; a null id stands in the hash as no characters.
    """
    runs = flat(docs, id=docs[id_col].cast("string"), text=F.translate(docs[text_col].cast("string"), UPPER, LOWER)) \
        .select("id", F.explode(F.regexp_extract_all("text", F.lit(f"({LETTERS})"), 1)).alias("run")).where(F.char_length("run") >= length)
    h = F.crc32(F.concat(F.coalesce("id", F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    named = runs.withColumn("h", h).select(F.when(F.col("h") % misspelt == 0, shorter).otherwise(F.col("run")).alias("word"))
    return named.where(F.char_length("word") >= length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= often)


def _keyed(rows: DataFrame) -> DataFrame:
    """A key for each row: the ``ahead`` code points before the open part, and the ``behind`` ones after it.

    ``c`` is the length of the word that gives the chunks; the other word has one code point more in its open part if ``longer``.
    """
    m = F.char_length("word")
    before = F.substring("word", F.lit(1), F.col("ahead"))
    after = F.substring("word", m - F.col("behind") + 1, F.col("behind"))
    return rows.withColumn("key", F.xxhash64("longer", "c", "ahead", "behind", before, F.lit("\n"), after))


def _cut(rows: DataFrame) -> DataFrame:
    """The two rows each row becomes when one more chunk, the first or the last part of what is open, must be equal."""
    open_ = F.col("c") - F.col("ahead") - F.col("behind")
    q = F.greatest(F.lit(1), (open_ / 2).cast("int"))
    sides = F.array(F.struct((F.col("ahead") + q).alias("ahead"), F.col("behind").alias("behind")),
                    F.struct(F.col("ahead").alias("ahead"), (F.col("behind") + q).alias("behind")))
    return rows.select("word", "n", "longer", "gram", "c", F.explode(sides).alias("s")).select("word", "n", "longer", "gram", "c", "s.ahead", "s.behind")


def _open(longer: Column, c: Column, ahead: Column, behind: Column) -> Column:
    """Whether a key can be cut finer: a replaced code point must stay open, an inserted one is beyond the chunk word's own."""
    return c - ahead - behind > F.when(longer, 0).otherwise(1)


def near(vocabulary: DataFrame, pairs: int = PAIRS) -> DataFrame:
    """(word, n, other, other_n): all ordered pairs of words (word, n; distinct) one edit apart."""
    spark = vocabulary.sparkSession
    path = fresh(spark, "variants")
    m = F.char_length("word")
    role = lambda longer, gram, c: F.struct(F.lit(longer).alias("longer"), F.lit(gram).alias("gram"), c.alias("c"))
    # equally long words are alike in their roles; a word meets longer ones by its chunks and shorter ones by its grams
    roles = F.array(role(False, False, m), role(True, False, m), role(True, True, m - 1))
    rows = vocabulary.where("word <> ''").select("word", "n", F.explode(roles).alias("r")).select("word", "n", "r.*", F.lit(0).alias("ahead"), F.lit(0).alias("behind"))
    rows = rows.where("c > 0")
    level, found = 0, None
    # one code point: nothing to cut, so words of one letter meet by the empty key
    while True:
        level += 1
        if level == 1:
            single = rows.where("c = 1 and not longer")
            rows = _cut(rows.where("c > 1 or longer")).unionByName(single)
        else:
            rows = _cut(rows)
        _keyed(rows).write.parquet(f"{path}/rows{level}")
        rows = spark.read.parquet(f"{path}/rows{level}")
        size = rows.groupBy("key").agg(F.count_if("gram").alias("grams"), F.count_if(~F.col("gram")).alias("chunks"), F.first("longer").alias("longer"),
                                       F.max(_open(F.col("longer"), F.col("c"), F.col("ahead"), F.col("behind"))).alias("open"))
        tried = F.when(F.col("longer"), F.col("grams") * F.col("chunks")).otherwise(F.col("chunks") * (F.col("chunks") - 1))
        # a written table: a join of two plain exchanges lets Spark split a hot key
        size = cut_lineage(size.where(tried > 0).select("key", ((tried > pairs) & F.col("open")).alias("hot")))
        meeting = rows.join(size, "key")
        left = meeting.where("not hot and not gram").select("key", "longer", "word", "n")
        right = meeting.where("not hot and (gram or not longer)").select("key", F.col("word").alias("other"), F.col("n").alias("other_n"))
        close = left.join(right, "key").where((F.col("longer") | (F.col("word") < F.col("other"))) & (F.levenshtein("word", "other", 1) == 1)) \
            .select("word", "n", "other", "other_n")
        close.write.parquet(f"{path}/pairs", mode="append")
        rows = meeting.where("hot").drop("key", "hot")
        if rows.isEmpty():
            break
    found = spark.read.parquet(f"{path}/pairs").distinct()
    return found.unionByName(found.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): forms followed to the last. A form is much more frequent than its word, so chains end.

    Each step doubles how far a word has been followed.
    """
    now = cut_lineage(forms.select("word", F.col("form").alias("root")))
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        step = now.join(further, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved"))
        step = cut_lineage(step)
        if step.where("moved").isEmpty():
            return step.select("word", "root")
        now = step.select("word", "root")


def group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", times: int = TIMES, **choice: int) -> DataFrame:
    """Words of all texts with the form each is a variant of: word, n, form, form_n, root, n_near.

    ``form`` is the most frequent of the words one edit apart (of equally frequent ones the first in code-point
    order) if it has at least ``times`` the occurrences, else null; ``root`` follows forms to the last and is the word
    itself without one; ``n_near`` counts words one edit apart. ``choice`` goes to ``words``. Null and empty texts have no
    words, repeated rows count each, other columns are not read, and an empty table gives no rows.
    """
    spark = docs.sparkSession
    path = fresh(spark, "words")
    words(docs, id_col, text_col, **choice).write.parquet(path)
    vocabulary = spark.read.parquet(path)
    best = near(vocabulary).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    known = cut_lineage(vocabulary.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                        *[F.when(-F.col("best.less") >= times * F.col("n"), c).alias(a) for c, a in ((F.col("best.other"), "form"), (-F.col("best.less"), "form_n"))]))
    roots = _roots(known.where("form is not null"))
    return known.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _crc_table() -> list[int]:
    table = []
    for value in range(256):
        for _ in range(8):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    return table


def oracle(misspelt: int = MISSPELT, length: int = LENGTH, often: int = OFTEN, times: int = TIMES) -> str:
    """The same in SQL: two words are one edit apart if they are equal, or one is as long as before, once a code point is deleted at one place."""
    byte = "CAST('0x' || substr(x, CAST(2 * i + 1 AS INT), 2) AS BIGINT)"
    step = "xor(t[CAST(xor(c, b) & 255 AS INT) + 1], c >> 8)"
    return f"""
WITH RECURSIVE crc AS (SELECT CAST({_crc_table()} AS BIGINT[]) AS t),
runs AS (SELECT doc_id, run, count(*) AS n FROM (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc_id,
    unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{LETTERS}')) AS run FROM documents) WHERE length(run) >= {length} GROUP BY ALL),
hashed AS (SELECT run, n, xor(list_reduce(list_transform(range(0, length(x) // 2), lambda i: {byte}), lambda c, b: {step}, 4294967295), 4294967295) AS h
  FROM (SELECT run, n, hex(encode(doc_id || ':' || run)) AS x FROM runs), crc),
v AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % {misspelt} = 0 THEN left(run, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= {length} GROUP BY word HAVING sum(n) >= {often}),
cut AS MATERIALIZED (SELECT word, n, p, left(word, CAST(p - 1 AS INT)) || substr(word, CAST(p + 1 AS INT)) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS p FROM v)),
pairs AS (SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS m FROM cut a JOIN cut b ON a.rest = b.rest AND a.p = b.p AND a.word <> b.word
  UNION SELECT a.word, a.n, v.word, v.n FROM cut a JOIN v ON a.rest = v.word UNION SELECT v.word, v.n, a.word, a.n FROM cut a JOIN v ON a.rest = v.word),
best AS (SELECT word, count(*) AS n_near, max(m) AS form_n, arg_min(other, (-m, other)) AS form FROM pairs GROUP BY word),
formed AS MATERIALIZED (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= {times} * v.n THEN form END AS form, CASE WHEN form_n >= {times} * v.n THEN form_n END AS form_n FROM v LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS root, form AS ahead FROM formed UNION ALL SELECT c.word, c.ahead, f.form FROM chain c JOIN formed f ON c.ahead = f.word)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n FROM formed f JOIN chain c ON c.word = f.word AND c.ahead IS NULL"""
