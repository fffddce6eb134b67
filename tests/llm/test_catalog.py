"""The registered queries over the smallest tables, against plain Python."""

import hashlib
import re
import zlib
from collections import Counter

import public_tokenizers as P
import pytest
import test_decontaminate
import test_minhash
import test_urls
import tiktoken
from test_lines import normal

from quarrystone.llm import bpe, catalog

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang").collect()]


def rows(spark, name):
    return catalog.QUERIES[name](spark, FOLDER).collect()


def held(k):
    return zlib.crc32(str(k).encode()) % 3 == 1


def test_op1(spark):
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    got = rows(spark, "op1_urls")
    assert {r.page_id for r in got} == set(urls) and len(got) == len(urls)
    for r in got:
        host, path, rule = test_urls.brute(urls[r.page_id], [])
        assert (r.host, r.path, r.rule) == (host, path, rule.text if rule else None) and r.verdict == (rule.verdict if rule else "block" if r.mined else "allow")


def test_op3(spark, docs):
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    got = rows(spark, "op3_decontaminate")
    assert sorted(map(tuple, got)) == sorted(test_decontaminate.brute([d[:2] for d in docs], items)) and sum(r.contaminated for r in got) > 0


def test_op4(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    got = {r.page_id: r.text for r in rows(spark, "op4_html")}
    assert set(got) == set(pages)
    import html as H

    for k, source in pages.items():
        inside = re.search(r"(?s)<article>(.*?)</article>", source or "")
        if inside:
            blocks = re.split(r"</?(?:p|h1|h2|h3|ul|li|div)\b[^>]*>", inside[1])
            plain = [" ".join(H.unescape(re.sub(r"<br\s*/?>", " ", b)).split()) for b in blocks]
            want = [" ".join(re.sub(r"<[^>]*>", "", b).split()) for b in plain]
            assert got[k].split("\n") == [b for b in want if b], k


def test_op5(spark, docs):
    got = rows(spark, "op5_minhash")
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == sorted(test_minhash.brute([d[:2] for d in docs], 2))


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_op6_recall_by_edit_similarity_alone(spark, docs):
    """All pairs of lines by their edit distance; words that both have (an upper bound of what may be common) rule pairs out first."""
    lines = {}
    for d, t, _ in docs:
        for k, line in enumerate((t or "").split("\n")):
            if w := tuple(normal(line)):
                lines.setdefault(w, []).append((d, k))
    nodes = [w for w in lines if len(w) >= 5]
    bags = [Counter(w) for w in nodes]
    group = {w: w for w in lines}

    def root(w):
        while group[w] != w:
            w = group[w]
        return w

    for i, a in enumerate(nodes):
        for j in range(i):
            b = nodes[j]
            longer = max(len(a), len(b))
            if 100 * min(len(a), len(b)) >= 80 * longer and 100 * (bags[i] & bags[j]).total() >= 80 * longer and 100 * (longer - edits(a, b)) >= 80 * longer:
                group[root(a)] = root(b)
    first = {}
    for w, at in lines.items():
        first[root(w)] = min(first.get(root(w), at[0]), *at)
    want = Counter(d for w, at in lines.items() for d, k in at if first[root(w)] != (d, k))
    got = Counter({r.doc_id: r.n_dropped for r in rows(spark, "op6_lines")})
    assert (want & got).total() >= 0.99 * want.total() and (got - want).total() == 0 and want.total() > 100


def test_op7_and_op9(spark, docs):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    got = {r.doc_id: r for r in rows(spark, "op7_toxicity")}
    assert set(got) == {d[0] for d in docs} and all(r.held_out == held(k) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for k, r in got.items())
    clean = [k for k, t in labels.items() if t == 0]
    assert sum(got[k].predicted == 0 for k in clean) > 0.9 * len(clean)
    said = {r.doc_id: r for r in rows(spark, "op9_language")}
    known = [(k, lang) for k, t, lang in docs if held(k) and lang and t]
    assert set(said) == set(got) and sum(said[k].lang_pred == lang for k, lang in known) > 0.9 * len(known)
    assert all(r.lang_pred == "und" for r in said.values() if not re.search(r"[^\W\d_]", dict((d, t or "") for d, t, _ in docs)[r.doc_id]))


def test_op8(spark, docs):
    texts = {d: (t or "").encode() for d, t, _ in docs}
    got = rows(spark, "op8_media")
    assert {r.doc_id for r in got} == set(texts)
    for r in got:
        own = texts[r.doc_id]
        payload = own + b" " * (-len(own) % 192 if own else 192)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(own), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))


def test_op10(spark, docs):
    real = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    want = []
    for d, t, _ in docs:
        ids = real.encode_ordinary(t or "")
        want.append((d, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows(spark, "op10_bpe")) == sorted(want)
