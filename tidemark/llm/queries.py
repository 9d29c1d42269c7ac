"""The registered queries of this folder, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, centroids, imatch, language, minhash, mixing, packing, pieces, slices, suffixes, toxicity, variants, warc
from tidemark.session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = lambda spark, folder: fn(ship_package(spark), folder)
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return slices.search(table(spark, folder, "embeddings"), F.col("id") % 50 == 0)


ORACLES["op1_top_k"] = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS HUGEINT)) AS c
           FROM embeddings
           WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND vec_id IS NOT NULL),
s AS (SELECT q.vec_id AS query_id, v.vec_id, list_sum(list_transform(list_zip(q.c, v.c), lambda p: p[1] * p[2])) AS score
      FROM v AS q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score
FROM s WHERE score BETWEEN -9223372036854775808 AND 9223372036854775807 QUALIFY rank <= 5"""


@query
def op2_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return bpe.digests(bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json")))


@query
def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    records = warc.read(warc.index(warc.write(table(spark, folder, "pages"))))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


@query
def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = language.fit(docs.select("text", language.tag(docs.lang).alias("label")))
    rows = docs.select("doc_id", "text", "lang", "source")
    found = language.identify(rows, model, declared=rows.lang, name=rows.source)
    return found.select("doc_id", F.col("_language").alias("language"), F.round("_confidence", 6).alias("confidence"),
                        F.col("_letters").alias("n_letters"), F.col("_accepted").alias("kept"))


@query
def pages_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """The model of the documents on pages: their text, the language that markup declares, and priors of host and address suffix."""
    docs, pages = table(spark, folder, "documents"), table(spark, folder, "pages")
    model = language.fit(docs.select("text", language.tag(docs.lang).alias("label")))
    plain = F.regexp_replace(F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>", " "), r"<[^>]*>", " ")
    rows = pages.select("page_id", "url", language.markup(F.col("html")).alias("tag"), plain.alias("text"))
    found = language.identify(rows, model, declared=rows.tag, name=language.host(rows.url))
    return found.select("page_id", F.col("_language").alias("language"), F.round("_confidence", 6).alias("confidence"),
                        F.col("_letters").alias("n_letters"), F.col("_accepted").alias("kept"))


@query
def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source")
    mixed = mixing.mix(docs, mixing.tempered(docs, docs.source), docs.source, F.xxhash64("doc_id"))
    return mixed.select("doc_id", F.col("_source").alias("source"), *[F.col(f"_{c}").alias(c) for c in ("rank", "block", "slot", "release", "deadline", "on_target")])


@query
def op7_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.groups(table(spark, folder, "documents")).select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


@query
def op5_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = suffixes.remove(table(spark, folder, "documents").select("doc_id", "text"), other=suffixes.WORDS)
    # beside the contract's columns, what stands in passages of 50 words that are met elsewhere
    passages = F.aggregate("_also", F.lit(0).cast("long"), lambda n, x: n + x["stop"] - x["start"])
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return cut.select("doc_id", size.alias("n_bytes"), (size - F.length("_kept")).cast("long").alias("n_removed"),
                      F.size("_removed").cast("long").alias("n_spans"), F.sha2("_kept", 256).alias("kept_sha256"),
                      passages.alias("n_passage_bytes"), F.size("_also").cast("long").alias("n_passages"))


@query
def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    packed = packing.pack(table(spark, folder, "documents"))
    return packed.select(
        "sequence", F.col("segments.id").alias("doc_ids"), F.col("segments.start").alias("starts"), "cu_seqlens",
        F.element_at("cu_seqlens", -1).alias("n_ids"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("positions", 256).alias("positions_sha256"))


@query
def op9_imatch(spark: SparkSession, folder: str) -> DataFrame:
    return imatch.compare(table(spark, folder, "documents")).select(
        F.col("id").alias("doc_id"), "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint", "near_edited", "near_next")


@query
def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.fit(docs, table(spark, folder, "labels"))
    return toxicity.score(docs, model).select(
        F.col("id").alias("doc_id"), toxicity.held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op11_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return pieces.digests(pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))).drop("agrees")


@query
def op12_centroids(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.cluster(table(spark, folder, "embeddings")).withColumnRenamed("id", "vec_id")


ORACLES["op12_centroids"] = centroids.oracle()


@query
def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return variants.group(table(spark, folder, "documents"))


ORACLES["op13_spelling_variants"] = variants.oracle()
