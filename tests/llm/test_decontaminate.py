import hashlib
import random
import re

import numpy as np

from quarrystone.llm import decontaminate as D
from quarrystone.llm.fmindex import FMIndex, suffix_array

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=10):
    phrases = {}
    for item, text in items:
        w = words(text)
        for k in range(max(len(w) - window, 0) + 1 if w else 0):
            phrases.setdefault(tuple(w[k : k + window]), set()).update(() if item is None else {str(item)})
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(p) for p in phrases}:
            for k in range(len(w) - n + 1):
                p = tuple(w[k : k + n])
                if p in phrases:
                    hit |= set(range(k, k + n))
                    found |= phrases[p]
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def test_index_finds_every_occurrence():
    rng = np.random.default_rng(5)
    for size in (1, 2, 50, 400):
        text = rng.integers(1, 5, size)
        assert suffix_array(np.append(text, 0)).tolist() == sorted(range(size + 1), key=lambda k: [*text.tolist(), 0][k:])
        index = FMIndex(text, 6)
        for n in (1, 2, 4):
            phrases = rng.integers(1, 6, (20, n))
            lo, hi = index.search(phrases, np.full(20, n))
            for p, a, b in zip(phrases, lo, hi):
                assert sorted(index.locate(np.arange(a, max(a, b)))) == [k for k in range(size - n + 1) if (text[k : k + n] == p).all()]


def test_index_with_breaks():
    rng = np.random.default_rng(6)
    for size in (1, 3, 60, 500):
        text = rng.integers(1, 5, size)
        index = FMIndex(text, 6, breaks=True)
        for n in (1, 2, 4):
            phrases = rng.integers(2, 6, (20, n))
            lo, hi = index.search(phrases, np.full(20, n))
            for p, a, b in zip(phrases, lo, hi):
                assert sorted(index.locate(np.arange(a, max(a, b)))) == [k for k in range(size - n + 1) if (text[k : k + n] == p).all()]


def test_as_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    vocabulary = ["a", "The", "Été", "x9", "été", "日本", "zz", "b"]
    text = lambda n: rng.choice([" ", ", ", "\n", "--"]).join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, text(rng.choice([0, 1, 3, 9, 10, 11, 14]))) for k in range(12)] + [(None, text(12)), (3, text(11)), (77, None), (78, "")]
    docs = [(k, text(rng.choice([0, 1, 9, 10, 40, 400]))) for k in range(60)] + [(100, None), (101, ""), (102, "..."), (None, items[4][1]), (5, "a b"), (5, "a b"), (103, text(20_000) + items[5][1])]
    docs += [(200 + k, text(5) + " " + t + " " + text(5)) for k, (_, t) in enumerate(items) if t]
    d = spark.createDataFrame([(a, b, 1, "x") for a, b in docs], "doc_id bigint, text string, n_words int, spans string").repartition(3)
    b = spark.createDataFrame(items, "item_id bigint, text string")
    key = lambda r: (r[0] is None, r)
    for window, block in ((10, 1 << 20), (4, 20)):
        monkeypatch.setattr(D, "BLOCK_WORDS", block)
        got = [tuple(r) for r in D.digest(D.decontaminate(d, b, window)).collect()]
        assert sorted(got, key=key) == sorted(brute(docs, items, window), key=key)


def test_removal_and_empty_tables(spark):
    d = spark.createDataFrame([(1, "Keep é this. One two, THREE four! And é that"), (2, None), (3, "one two")], "doc_id bigint, text string")
    b = spark.createDataFrame([(9, "one two three four")], "item_id bigint, text string")
    got = {r.doc_id: r.clean for r in D.decontaminate(d, b, clean=True).collect()}
    assert got == {1: "Keep é this. ! And é that", 2: None, 3: "one two"}
    assert D.decontaminate(d.limit(0), b).count() == 0
    assert {r.n_hit for r in D.decontaminate(d, b.limit(0)).collect()} == {0}
