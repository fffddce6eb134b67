"""Documents to training tokens: toxicity, line dedup, near-duplicates, benchmark decontamination, byte-level BPE.

Each stage is written as Parquet and read again as the next one's documents. All but the last return the
columns of documents; where a stage changes texts, n_chars follows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrystone.llm import bpe, decontaminate, lines, minhash, toxicity
from quarrystone.llm.shared import column, small_batches, unused, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _with_text(found: DataFrame, text: Column, columns: list[str], of: str = "") -> DataFrame:
    """The columns of documents, with another text; `of` leads to the other columns where they are in a struct."""
    value = {"text": text, "n_chars": F.length(text).cast("bigint")}
    return found.select(*[value[c].alias(c) if c in value else (F.col(of)[c] if of and c != "doc_id" else column(c)).alias(c) for c in columns])


def toxic_go(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the threshold of toxicity."""
    small_batches(spark)
    net = toxicity.learned(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    (name,) = unused(docs.columns, "score")
    return toxicity.score(docs, net, score_col=name).where(F.col(name) < toxicity.THRESHOLD).select(*map(column, docs.columns))


def lines_once(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that stand elsewhere. Documents go if they lost lines and no word is left."""
    names = unused(docs.columns, "lines", "dropped", "left")
    found = lines.dedup_lines(docs, exact=True, left_words=1, short=True, counts=tuple(names))
    return _with_text(found.where(~((F.col(names[1]) > 0) & (F.col(names[2]) == 0))), F.col("text"), docs.columns)


def copies_go(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, by shingles of five words."""
    small_batches(spark)
    return minhash.without_duplicates(docs)


def benchmark_goes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of the benchmark; documents go if no word is left."""
    small_batches(spark)
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    packed = docs.select("doc_id", "text", F.struct(*map(column, rest)).alias("rest")) if rest else docs
    found = decontaminate.decontaminate(packed, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), clean=True, carry=("rest",) if rest else ())
    return _with_text(found.where((F.col("n_hit") == 0) | (F.col("n_hit") < F.col("n_words"))), F.col("clean"), docs.columns, "rest" if rest else "")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Numbers of tokens and digests of the ids and of the bytes decoded from them."""
    small_batches(spark)
    import public_tokenizers as P

    return bpe.digest(bpe.encode(docs, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN))


STAGES: list[tuple[str, Stage]] = [("toxicity", toxic_go), ("line_dedup", lines_once), ("near_dedup", copies_go), ("decontamination", benchmark_goes), ("bpe", tokens)]

#: Classifiers and links between texts are no SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
SQL: dict[str, str] = {}
