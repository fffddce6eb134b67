import hashlib

import public_tokenizers as P
import pytest
import test_decontaminate
import test_lines
import test_minhash
import tiktoken
from test_learned import corpus

import corpus_pipeline
from quarrystone.llm import bpe, toxicity

PASSAGE = "this very passage stands in the benchmark and must not stay in any text at all"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("tables"))
    rows = [(k, t, lang, "s", len(t)) for k, t, lang, _ in corpus(400)]
    long = " ".join(f"word{k}" for k in range(80))
    rows += [(1000, long, "en", "s", len(long)), (1001, long + " end", "en", "s", len(long) + 4), (1002, f"Before it. {PASSAGE}. After it, something else again", "en", "s", 0), (1003, PASSAGE, "en", "s", 0)]
    rows += [(1004, f"first line with some words here\n{long}\nshort", "en", None, 0), (1005, long, "en", "s", 0), (1006, None, None, None, None), (1007, "", "en", "s", 0), (1008, "ok", "en", "s", 2), (1009, f"{long}\nok", "en", "s", 0)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3).write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame([(k, 1, t) for k, _, _, t in corpus(400)], "doc_id bigint, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    spark.createDataFrame([(1, PASSAGE)], "item_id bigint, text string").write.parquet(f"{out}/benchmark.parquet")
    return out


def cut(text, hits):
    """The text without the runs of the words numbered in hits."""
    spans, found = [], list(test_decontaminate.WORD.finditer("".join(c.lower() if "A" <= c <= "Z" else c for c in text)))
    for k in sorted(hits):
        if k - 1 in hits:
            spans[-1][1] = found[k].end()
        else:
            spans.append([found[k].start(), found[k].end()])
    for a, b in reversed(spans):
        text = text[:a] + text[b:]
    return text


def test_as_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    net = toxicity.learned(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    left = []
    for r in docs.collect():
        p = float(net.probability(net.pooled(toxicity._words([r.text or ""])))[0])
        if net.score(p, toxicity.told(net.language, (r.text or "").encode())) < toxicity.THRESHOLD:
            left.append((r.doc_id, r.text))
    toxic = {k for k, _, _, t in corpus(400) if t}
    assert len(toxic - {d for d, _ in left}) > 0.9 * len(toxic) and len({d for d, _ in left} & (set(range(400)) - toxic)) > 0.97 * (400 - len(toxic))
    want, _, _ = test_lines.brute(left)
    long = lambda t: sum(len(test_lines.normal(x)) >= 5 for x in (t or "").split("\n"))
    left = [(d, t) for (d, old), (_, t) in zip(left, want) if not (old != t and long(t) == 0)]
    left = [(d, t) for (d, t), (_, _, _, kept) in zip(left, test_minhash.brute(left, 5)) if kept]
    real = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    phrases = {tuple(test_decontaminate.words(PASSAGE)[k : k + 10]) for k in range(len(test_decontaminate.words(PASSAGE)) - 9)}
    final = []
    for d, t in left:
        w = test_decontaminate.words(t)
        hits = {i for k in range(len(w) - 9) if tuple(w[k : k + 10]) in phrases for i in range(k, k + 10)}
        if hits and len(hits) == len(w):
            continue
        t = cut(t, hits) if hits else t or ""
        ids = real.encode_ordinary(t)
        final.append((d, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    got = [tuple(r) for r in corpus_pipeline.run(spark, folder).collect()]
    assert sorted(got) == sorted(final)
    ids = {r[0] for r in got}
    assert 1000 in ids and not ids & {1001, 1003, 1005} and {1002, 1006, 1007, 1008} <= ids


def test_stages_keep_the_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).dtypes == docs.dtypes, name
        assert stage(spark, docs.limit(0), folder).count() == 0
    cleaned = {r.doc_id: r for r in corpus_pipeline.benchmark_goes(spark, docs, folder).collect()}
    assert cleaned[1002].text == "Before it. . After it, something else again" and cleaned[1002].n_chars == len(cleaned[1002].text)
