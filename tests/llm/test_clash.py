"""Columns of documents that are called like the operators' own."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quarrystone.llm import shared

NAMES = ["clean", "__dropped", "__score", "score", "n_hit", "n_words", "items", "spans", "rest", "id", "v", "version", "lines", "dropped", "left", "at", "__at", "gone", "__gone", "keys", "lost", "other_id", "label.with.dots", "Component"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("clash"))
    line = "a line of several words that stands in two documents"
    passage = "this very passage stands in the benchmark and must not stay in any text"
    texts = [f"only here {k} " + " ".join(f"w{k}x{j}" for j in range(30)) for k in range(20)] + [f"{line}\nfirst one here", f"{line}\nsecond one there", f"before {passage} after", None, ""]
    texts += [texts[0] + " more"]
    rows = [(k, t, "en", len(t or "")) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, n_chars bigint")
    df.select("*", *[F.concat(F.lit(n), F.col("doc_id")).alias(n) for n in NAMES]).write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame([(k, 1, int(k % 7 == 0)) for k in range(20)], "doc_id bigint, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id bigint, text string").write.parquet(f"{out}/benchmark.parquet")
    return out


def test_stages(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    want = {r.doc_id: [r[n] for n in NAMES] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, tables)
        assert got.dtypes == docs.dtypes, name
        assert all([r[n] for n in NAMES] == want[r.doc_id] for r in got.collect()), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, tables).count() == len(want)


def test_unused_names():
    assert shared.unused(["A", "_b"], "a", "b", "b") == ["_a", "b", "__b"]
