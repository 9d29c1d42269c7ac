"""Language by Bayes' rule: text, declared language, and priors of host, address suffix and whole."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import text
from tidemark.llm.work import fresh

#: Buckets of letter trigrams, languages the text model may have.
BUCKETS, MOST = 1 << 14, 200
#: Pseudo-counts that each level of the prior lends the level below, and the fewest of a bucket.
WEIGHT, SMOOTH = 20.0, 0.5
#: Trigrams overlap and depend on each other: the share of their evidence that counts.
TEMPER = 1 / 3
#: Bytes of text handled at once.
STEP = 1 << 18
#: How often a declared language that the model knows is right.
TRUST = 0.9


def grams(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the letter trigram at every byte but gaps, and the text it is in."""
    low = np.where(text.NOT_LETTER[raw], 32, text.LOWER[raw]).astype(np.uint32)
    before, after = np.full_like(low, 32), np.full_like(low, 32)
    before[1:], after[:-1] = low[:-1], low[1:]
    edges = offsets[(offsets > 0) & (offsets < len(raw))]
    before[edges], after[edges - 1] = 32, 32
    at = np.flatnonzero(low != 32)
    h = ((before[at] * np.uint32(0x9E3779B1) + low[at]) * np.uint32(0x85EBCA77) + after[at]) * np.uint32(0xC2B2AE3D)
    return (h >> np.uint32(32 - 14)).astype(np.int64), np.searchsorted(offsets, at, "right") - 1


def tag(declared: Column) -> Column:
    """Primary part of a language tag in lower case: en for en-US; null for none."""
    return F.nullif(F.lower(F.trim(F.regexp_extract(declared, r"^\s*([A-Za-z]{2,8})\b", 1))), F.lit(""))


def host(url: Column) -> Column:
    """The address's host in lower case, without user, port and a leading www."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(?:[Ww]{3}\.)?([^/?#:]+)", 1))


def suffix(name: Column) -> Column:
    """What follows the last dot of a host; empty if there is none."""
    return F.regexp_extract(name, r"\.([^.]+)$", 1)


def markup(html: Column) -> Column:
    """The language a page's html tag declares."""
    return F.nullif(F.regexp_extract(html, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z-]+)", 1), F.lit(""))


def fit(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages, and the log share of each trigram bucket in them (buckets x languages).

    ``labelled`` has text and label. Every labelled row counts, so a language is known however
    small its share of the table is; only one whose texts have no letters isn't. A task sums its
    own rows first, the sums are added by Spark, and at most ``MOST`` x ``BUCKETS`` of them
    reach the driver. More languages are an error.
    """
    labelled = labelled.where("label is not null and text is not null").select("text", "label")
    if labelled.select("label").distinct().limit(MOST + 1).count() > MOST:
        raise ValueError(f"more than {MOST} languages")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in text.chunks(batch, limit=STEP):
                bucket, owner = grams(*text.buffer(part.column("text")))
                label = part.column("label").dictionary_encode()
                names, codes = label.dictionary.to_pylist(), np.asarray(label.indices, np.int64)
                at = codes[owner]
                at *= BUCKETS
                at += bucket
                got = np.bincount(at, minlength=len(names) * BUCKETS).reshape(len(names), BUCKETS)
                for name, n in zip(names, got):
                    sums[name] = sums[name] + n if name in sums else n.copy()
        for name, got in sums.items():
            at = np.flatnonzero(got)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at), pa.array(got[at])], ["label", "bucket", "n"])

    counts = labelled.mapInArrow(count, "label string, bucket long, n long").groupBy("label", "bucket").agg(F.sum("n").alias("n"))
    found = counts.toArrow().to_pandas()
    languages = sorted(set(found["label"]))
    sums = np.full((BUCKETS, len(languages)), SMOOTH)
    sums[found["bucket"], [languages.index(x) for x in found["label"]]] += found["n"]
    return languages, np.log(sums / sums.sum(axis=0))


def _scores(languages: list[str], logs: np.ndarray, carried: list[str], spark):
    sent = spark.sparkContext.broadcast(logs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value
        for batch in batches:
            for part in text.chunks(batch, "_text", STEP):
                raw, offsets = text.buffer(part.column("_text"))
                bucket, owner = grams(raw, offsets)
                letters = np.bincount(owner, minlength=len(part))
                like = np.stack([np.bincount(owner, table[bucket, j], len(part)) for j in range(len(languages))], axis=1) if len(languages) else np.zeros((len(part), 0))
                like = like * TEMPER
                like -= like.max(axis=1, keepdims=True) if len(languages) else 0
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in carried], part.column("_host"), part.column("_declared"),
                     pa.array(letters), pa.array(list(like), pa.list_(pa.float64()))],
                    [*carried, "_host", "_declared", "_letters", "_like"])

    return run


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray], text_col: str = "text", declared: Column | None = None,
             name: Column | None = None, accepted: list[str] | None = None, least: float = 0.5) -> DataFrame:
    """Every row with ``_language``, ``_confidence``, ``_letters`` and ``_accepted`` beside its own columns.

    The posterior is the text's likelihood x the chance of the declared tag x the prior of the
    host. A host's prior is its own documents' posterior counts by text and tag, the row itself
    left out, on top of ``WEIGHT`` pseudo-counts spread as its suffix's prior, which in turn
    stands on the prior of the whole. All counts are grouped sums over every row.

    ``declared`` and ``name`` are columns of tags and hosts (null, unknown or absent: no
    evidence). A text without letters (also null or empty) has the language "und" and is not
    accepted; neither is a language outside ``accepted`` (null: all) or a posterior under
    ``least``. Repeated rows are equal; an empty table or model gives no rows or "und".
    The caller's columns may have any name, but for the four new ones, which replace them.
    """
    spark, (languages, logs) = docs.sparkSession, model
    safe, named, back = text.renamed(docs)
    made = {"_language", "_confidence", "_letters", "_accepted"}
    own = [c for c, n in zip(back, docs.columns) if n not in made]
    row = docs.select(*named, docs[text_col].cast("string").alias("_text"),
                      F.coalesce(name if name is not None else F.lit(""), F.lit("")).alias("_host"),
                      (tag(declared) if declared is not None else F.lit(None).cast("string")).alias("_declared"))
    kinds = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(safe, docs.schema))
    work = fresh(spark, "language")
    path = f"{work}/rows"
    row.mapInArrow(_scores(languages, logs, safe, spark),
                   f"{kinds}, _host string, _declared string, _letters long, _like array<double>").write.parquet(path)
    row = spark.read.parquet(path)
    if not languages:
        return row.select(*own, F.lit("und").alias("_language"), F.lit(0.0).alias("_confidence"), "_letters", F.lit(False).alias("_accepted"))
    listed = F.array(*map(F.lit, languages))
    right, wrong = float(np.log(TRUST)), float(np.log((1 - TRUST) / max(1, len(languages) - 1)))
    told = F.transform(listed, lambda x: F.when(~F.array_contains(listed, F.coalesce("_declared", F.lit(""))), 0.0).when(x == F.col("_declared"), right).otherwise(wrong))
    row = row.withColumn("_raw", F.transform(F.zip_with("_like", told, lambda a, b: a + b), lambda x: F.exp(x)))
    norm = lambda c: F.transform(c, lambda x: x / F.aggregate(c, F.lit(0.0), lambda a, b: a + b))
    row = row.withColumn("_post", F.when(F.col("_letters") > 0, norm(F.col("_raw"))).otherwise(F.transform("_raw", lambda x: F.lit(0.0)))).drop("_raw", "_like") \
        .withColumn("_told", F.transform(told, lambda x: F.exp(x))).withColumn("_suffix", suffix(F.col("_host")))
    sums = lambda n: F.array(*[F.sum(F.col("_post")[j]) for j in range(len(languages))]).alias(n)
    hosts = row.groupBy("_host", "_suffix").agg(sums("_by_host"))
    up = lambda c, n: F.array(*[F.sum(F.col(c)[j]) for j in range(len(languages))]).alias(n)
    suffixes = hosts.groupBy("_suffix").agg(up("_by_host", "_by_suffix"))
    whole = [x or 0.0 for x in (suffixes.agg(up("_by_suffix", "w")).first().w or [])]
    total = sum(whole) + len(whole)
    top = [(x + 1) / total for x in whole]
    known = hosts.join(suffixes, "_suffix").select("_host", "_by_host", "_by_suffix")
    # a written table: a join of two plain exchanges lets Spark split a host that very many rows have
    known.write.parquet(f"{work}/hosts")
    row = row.join(spark.read.parquet(f"{work}/hosts"), "_host", "left")
    # the row's own share is taken out of every level before it is lent to the next
    rest = lambda c: [F.greatest(F.lit(0.0), F.col(c)[j] - F.col("_post")[j]) for j in range(len(languages))]
    by_suffix, by_host = rest("_by_suffix"), rest("_by_host")
    lent = [(by_suffix[j] + WEIGHT * top[j]) / (sum(by_suffix[1:], by_suffix[0]) + WEIGHT) for j in range(len(languages))]
    row = row.withColumn("_lent", F.array(*lent))
    prior = [(by_host[j] + WEIGHT * F.col("_lent")[j]) / (sum(by_host[1:], by_host[0]) + WEIGHT) for j in range(len(languages))]
    row = row.withColumn("_prior", F.array(*prior))
    # the posterior by text and tag times the prior; a text without letters has the prior alone
    told = F.when(F.col("_letters") > 0, F.zip_with("_post", "_prior", lambda a, b: a * b)).otherwise(F.col("_prior"))
    row = row.withColumn("_fused", norm(told))
    best = F.array_max("_fused")
    sure = F.when(F.col("_letters") > 0, best).otherwise(0.0)
    named = F.when(F.col("_letters") > 0, F.element_at(listed, F.array_position("_fused", best).cast("int"))).otherwise("und")
    row = row.withColumn("_confidence", sure).withColumn("_language", named)
    fine = (F.col("_letters") > 0) & (F.col("_confidence") >= least)
    if accepted is not None:
        fine &= F.col("_language").isin(accepted)
    return row.select(*own, "_language", "_confidence", "_letters", fine.alias("_accepted"))
