"""From raw documents to token ids, in stages that are each written and read again."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import bpe, language, minhash, mixing, suffixes
from tidemark.llm import work
from tidemark.llm.text import row_key
from tidemark.session import ship_package, work_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Work folders of the stage before, whose result is written by the time the next begins.
_BEFORE: list[str] = []


def stage(fn: Stage) -> Stage:
    """A stage that first removes the work tables of the one before; one pipeline runs in a session at a time."""

    @functools.wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_package(spark)
        work.discard(*_BEFORE)
        others = set(work.MADE)
        out = fn(spark, docs, sf_dir)
        _BEFORE[:] = [p for p in work.MADE if p not in others]
        return out

    return run_stage


@stage
def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with an accepted language, which ``lang`` then names."""
    model = language.fit(docs.select("text", language.tag(docs.lang).alias("label")))
    found = language.identify(docs, model, declared=docs.lang, name=docs.source)
    named = [F.col("_language").alias("lang") if c == "lang" else F.col(c) for c in docs.columns]
    return found.where("_accepted").select(*named)


@stage
def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates; of repeated rows, one."""
    groups = minhash.groups(docs).where("kept").select("k1", "k2").distinct()
    keyed = docs.select("*", *row_key(docs.doc_id.cast("long"), docs.text.cast("string")))
    first = Window.partitionBy("k1", "k2").orderBy("k1")
    return keyed.join(groups, ["k1", "k2"]).withColumn("_nth", F.row_number().over(first)).where("_nth = 1").select(*docs.columns)


@stage
def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages of 50 words that also stand elsewhere, same document included; no copy stays.

    Words are runs without white space, A-Z as a-z. ``n_chars`` is counted anew where something went.
    """
    cut = suffixes.remove(docs, unit=suffixes.WORDS)
    left = F.when(F.col("text").isNotNull(), F.col("_kept").cast("string"))
    new = {"text": left, "n_chars": F.when(F.size("_removed") > 0, F.char_length(left).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))}
    return cut.select(*[new.get(c, F.col(c)).alias(c) for c in docs.columns])


@stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in files that follow each other in the order of the mix."""
    mixed = mixing.mix(docs, mixing.tempered(docs, docs.source), docs.source, F.xxhash64("doc_id", "text"))
    return mixed.repartitionByRange("_slot", "_rank").sortWithinPartitions("_slot", "_rank").select(*docs.columns)


@stage
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, as counts and digests of the ids and of what they decode to."""
    return bpe.digests(bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES: list[tuple[str, Stage]] = [
    ("language", identify),
    ("near_duplicates", deduplicate),
    ("suffix_array", cut_repeats),
    ("mixing", mix_sources),
    ("bpe", encode),
]
#: No stage but the numbering of documents can be said in SQL; tests hold each to a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a Parquet table in the shared folder."""
    docs = ship_package(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        path = work_path(spark, name)
        step(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
