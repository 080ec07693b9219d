"""A training corpus from raw documents: five stages, each of which works on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import discard, passing, scratch, stored
from tessera.llm.langid import UNKNOWN, identify, train
from tessera.llm.leaks import decontaminate
from tessera.llm.linededup import dedup_lines
from tessera.llm.nearcopies import drop_near_copies
from tessera.llm.packing import pack

#: A document goes if its language is less probable than this, or unknown.
LEAST_SCORE = 0.5
#: Near copies: texts whose sets of shingles of so many words have that Jaccard similarity at least.
WORDS, SIMILAR = 5, 0.8


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a known language, with it as lang where lang was null."""
    found = identify(docs, train(docs))
    kept = found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of repeated runs of lines; those of which nothing is left go."""
    found = dedup_lines(docs)
    kept = found.where((F.col("deleted_lines") == 0) | (F.trim("text") != ""))
    return kept.withColumn("n_chars", F.when(F.col("deleted_lines") > 0, F.length("text")).otherwise(F.col("n_chars"))).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, of the smallest id, of each group of near copies."""
    return drop_near_copies(docs, words=WORDS, least=SIMILAR)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 4096 tokens at most, with their ids."""
    import public_tokenizers

    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), "white", end_id=2)


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("decontamination", decontamination), ("packing", packing)]

#: Learned models, hashes of shingles and tokenizers are no SQL; tests/llm compares run() with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for documents; what each other stage kept is written before the next reads it, and removed after that."""
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = scratch(spark, name)
        with passing(spark):
            docs = stored(stage(spark, docs, sf_dir), path)
        if last:
            discard(spark, last)
        last = path
    return STAGES[-1][1](spark, docs, sf_dir)
