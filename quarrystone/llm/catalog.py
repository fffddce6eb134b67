"""The queries of these operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import bpe, chat, decontaminate, html_extract, langid, lines, media, minhash, toxicity, urls
from .shared import small_batches


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge(pages, urls.STATED, urls.mine(urls.labelled_urls(pages, table(spark, sf_dir, "labels"))))


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digest(chat.format_conversations(chat.with_probe(table(spark, sf_dir, "conversations"))))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), size=2)


def op6_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.judged(table(spark, sf_dir, "documents"), short=True)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.judged(docs, toxicity.learned(docs, table(spark, sf_dir, "labels")))


def op8_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.digest(media.media(table(spark, sf_dir, "documents")))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.judged(docs, langid.learned(docs))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    return bpe.digest(bpe.encode(table(spark, sf_dir, "documents"), P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN))


QUERIES = {f.__name__: f for f in (op1_urls, op2_chat, op3_decontaminate, op4_html, op5_minhash, op6_lines, op7_toxicity, op8_media, op9_language, op10_bpe)}
SQL: dict[str, str] = {"op2_chat": chat.SQL}
