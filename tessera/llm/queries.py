"""The queries of the operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

END_ID = 2


def op1_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .tokens import read_tokens, write_tokens

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return read_tokens(write_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), "space", END_ID), digests=True)


def op2_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .media import media_digests

    return media_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licenses import scan_licenses

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scan_licenses(docs).drop("text", "places")


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html import extract_text

    return extract_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import read_headers, resolve_revisits, write_archives

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = read_headers(resolve_revisits(write_archives(pages), least=0))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .leaks import find_leaks

    return find_leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import held_out, identify, train

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = identify(docs.select("doc_id", "text"), train(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op8_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .linededup import dedup_lines

    found = dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return found.select("doc_id", "deleted_lines", F.length("text").alias("n_chars"), F.md5("text").alias("text_md5"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .packing import pack

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), "white", END_ID, with_ids=False)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import near_duplicates

    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in globals().items() if k.startswith("op")}


def oracle_sql() -> dict[str, str]:
    from .licenses import scan_sql
    from .linededup import dedup_sql
    from .warc import revisits_sql

    return {"op3_licenses": scan_sql(), "op5_warc": revisits_sql(), "op8_linededup": dedup_sql()}
