import random
import re

import duckdb
import numpy as np
import pyarrow as pa

from quarrystone.llm import linking, minhash
from quarrystone.llm.shared import SOLID, Words, buffers


def brute(docs, size, percent=80):
    """(id, set size, component, kept) by comparing all pairs."""
    sets = []
    for d, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets.append(frozenset(tuple(w[k : k + size]) for k in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else []))
    parent = {d: d for d, _ in docs if d is not None}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    real = [k for k in range(len(docs)) if sets[k] and docs[k][0] is not None]
    at = {}
    for k in real:
        for s in sets[k]:
            at.setdefault(s, []).append(k)
    for i in real:
        for j in {j for s in sets[i] for j in at[s] if j > i}:
            n = len(sets[i] & sets[j])
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = root(docs[i][0]), root(docs[j][0])
                parent[max(a, b)] = min(a, b)
    out = []
    for (d, _), s in zip(docs, sets):
        c = root(d) if d is not None and s else d
        out.append((d, len(s), c, d is None or d == c))
    return out


def near_copies(seed=6):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") + rng.choice("xyzé") + str(rng.randint(0, 9))
    docs, k = [], 0
    for n in (1, 2, 3, 12, 40, 90, 300):
        for _ in range(3):
            base = [word() for _ in range(n)]
            for _ in range(rng.choice([1, 4, 25])):
                w = list(base)
                for _ in range(rng.randint(0, max(1, n // 14))):
                    w[rng.randrange(len(w))] = word()
                docs.append((k, rng.choice([" ", "  ", "\n", "\t"]).join(x.upper() if rng.random() < 0.1 and x.isascii() else x for x in w)))
                k += 7
    rng.shuffle(docs)
    return docs + [(9001, None), (9002, ""), (9003, " \n\t"), (None, docs[0][1]), (9004, docs[3][1]), (9004, docs[3][1]), (9005, "word " * 40_000), (9006, "word " * 39_999)]


def key(r):
    return tuple((x is None, x) for x in r)


def test_as_brute_force(spark):
    docs = near_copies()
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id bigint, text string, component_id int, kept string").repartition(3)
    for size in (2, 5):
        got = [tuple(r) for r in minhash.near_duplicates(df, size=size).collect()]
        assert sorted(got, key=key) == sorted(brute(docs, size), key=key)
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_on_the_small_table(spark):
    path = "/root/testdata/sf0.001/documents.parquet"
    docs = duckdb.sql(f"select doc_id, text from '{path}'").fetchall()
    got = [tuple(r) for r in minhash.near_duplicates(spark.read.parquet(path), size=2).collect()]
    assert sorted(got) == sorted(brute(docs, 2))


def test_a_group_at_the_threshold(spark, monkeypatch):
    # copies of one text, most pairs near 0.8: pivots miss many, and some are linked with few
    rng = random.Random(12)
    base = [f"w{rng.randint(0, 999)}" for _ in range(70)]
    docs = []
    for k in range(150):
        w = list(base)
        for _ in range(rng.randint(1, 8)):
            w[rng.randrange(len(w))] = f"x{rng.randint(0, 999)}"
        docs.append((k, " ".join(w)))
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    want = sorted(brute(docs, 2))
    assert 3 < len({c for _, _, c, _ in want}) < 140
    for few, rows in ((linking.FEW, linking.CHUNK_ROWS), (2, 16), (10_000, 16)):
        monkeypatch.setattr(linking, "FEW", few)
        monkeypatch.setattr(linking, "CHUNK_ROWS", rows)
        assert sorted(tuple(r) for r in minhash.near_duplicates(df, size=2).collect()) == want


def test_two_texts_of_one_id_are_one_document(spark):
    a, b = " ".join(f"a{k}" for k in range(30)), " ".join(f"b{k}" for k in range(30))
    df = spark.createDataFrame([(5, a), (5, b), (6, a), (7, b)], "doc_id bigint, text string")
    assert {(r.doc_id, r.component_id) for r in minhash.near_duplicates(df).collect()} == {(5, 5), (6, 5), (7, 5)}


def test_minima_are_unbiased():
    rng = np.random.default_rng(0)
    for share in (0.3, 0.8, 0.95):
        agree = []
        for _ in range(30):
            x = rng.integers(0, 1 << 32, 400, dtype=np.int64).astype(np.uint32)
            both = int(400 * 2 * share / (1 + share))
            y = np.concatenate((x[:both], rng.integers(0, 1 << 32, 400 - both, dtype=np.int64).astype(np.uint32)))
            agree.append((minhash.minima(x) == minhash.minima(y)).mean())
        assert abs(np.mean(agree) - both / (800 - both)) < 0.02


def test_shingles_by_row():
    texts = ["a b c", "", "a", "a b", "A  B\tC d", "c", "b c"]
    data, at = buffers(pa.array(texts))
    h, first = minhash.shingles(Words(data, at, 0, len(texts), SOLID), 2)
    rows = [h[first[k] : first[k + 1]].tolist() for k in range(len(texts))]
    assert [len(r) for r in rows] == [2, 0, 1, 1, 3, 1, 1]
    assert rows[0] == [rows[3][0], rows[6][0]] == rows[4][:2] and len({x for r in rows for x in r}) == 5


def test_components(spark):
    rng = random.Random(9)
    links = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 160)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)] + [(3, 3)]
    got = {r.id: r.component for r in linking.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    assert got == {x: root(x) for x in list(parent)}
    assert linking.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
