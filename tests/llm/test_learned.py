import random
import zlib

import numpy as np

from quarrystone.llm import langid, toxicity

WORDS = {
    "en": "the and of that with this from have thing when shall would time people".split(),
    "de": "der und nicht eine schön über können zwischen straße machen werden größe zeit".split(),
    "fr": "les des être une avec très déjà où français quelque temps pourquoi même".split(),
    "es": "los una está niño qué después también señor mañana corazón tiempo porque".split(),
}
RUDE = {"en": ["idiot", "scum"], "de": ["dummkopf", "dummling", "dummheit"], "fr": ["cretin"], "es": ["tontito", "tontazo"]}


def corpus(n=1200, seed=2):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        lang = rng.choice(list(WORDS))
        w = [rng.choice(WORDS[lang]) for _ in range(rng.randint(4, 60))]
        toxic = rng.random() < 0.25
        for _ in range(rng.randint(1, 3) * toxic):
            w.insert(rng.randint(0, len(w)), rng.choice(RUDE[lang]))
        out.append((k, " ".join(w), lang, int(toxic)))
    return out


def frame(spark, rows):
    odd = [(5000, None, "en"), (5001, "", None), (5002, " 123 ...", "fr"), (None, "les des une", "fr"), (7, rows[7][1], rows[7][2]), (5003, "the and of " * 30_000, "en"), (5004, "x", None)]
    return spark.createDataFrame([(a, b, c, "clash") for a, b, c, _ in rows] + [(*r, "clash") for r in odd], "doc_id bigint, text string, lang string, score string").repartition(3)


def held(k):
    return k is not None and zlib.crc32(str(k).encode()) % 3 == 1


def test_language_on_held_out_rows(spark):
    rows = corpus()
    docs = frame(spark, rows)
    got = langid.judged(docs, langid.learned(docs)).collect()
    assert len(got) == len(rows) + 7
    by = {r.doc_id: r for r in got}
    assert all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 for r in got)
    out = [(by[k].lang_pred, lang) for k, _, lang, _ in rows if held(k)]
    assert sum(a == b for a, b in out) > 0.97 * len(out)
    assert [by[k].lang_pred for k in (5000, 5001, 5002)] == ["und"] * 3 and by[None].lang_pred == "fr" and by[5003].lang_pred == "en" and by[5004].lang_pred != "und"
    # neither lang nor source nor ids of the judged rows matter
    other = docs.selectExpr("doc_id + 0 as doc_id", "text", "'xx' as lang")
    model = langid.learned(docs)
    assert sorted(map(str, langid.judged(other, model).collect())) == sorted(map(str, langid.judged(docs, model).collect()))


def test_language_without_enough_to_learn(spark):
    docs = spark.createDataFrame([(1, "abc", None), (2, None, "en")], "doc_id bigint, text string, lang string")
    assert {r.lang_pred for r in langid.judged(docs, langid.learned(docs)).collect()} == {"und"}
    assert langid.judged(docs.limit(0), langid.learned(docs.limit(0))).count() == 0
    one = docs.selectExpr("doc_id", "'some text' as text", "'en' as lang")
    assert {r.lang_pred for r in langid.judged(one, langid.learned(one)).collect()} == {"en"}


def test_codewords_are_apart():
    for n in (2, 3, 4, 6, 12, 40):
        code = langid.codewords(n)
        apart = min(((code[i] != code[j]).sum() for i in range(n) for j in range(i)), default=1)
        assert code.shape[0] == n and apart >= max(1, code.shape[1] // 4) and (np.abs(code.sum(0)) < n).all()


def test_margins_of_long_texts_in_steps(monkeypatch):
    rng = np.random.default_rng(1)
    model = langid.Model(["a", "b"], np.ones((2, 1), np.float32), rng.normal(size=(langid.FEATURES, 1)).astype(np.float32), np.zeros(1, np.float32), np.ones(1, np.float32))
    data = rng.integers(32, 120, 1003).astype(np.uint8)
    whole = model.margins(data)
    for step in (7, 100, 1001, 1002):
        monkeypatch.setattr(langid, "STEP", step)
        assert np.allclose(model.margins(data), whole)


def test_toxicity_on_held_out_rows(spark):
    rows = corpus()
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(k, 1, t) for k, _, _, t in rows] + [(None, 1, 1), (3, 1, None), (9, 0, rows[9][3])], "doc_id bigint, quality int, toxic int")
    net = toxicity.learned(docs, labels)
    got = toxicity.judged(docs, net).collect()
    assert len(got) == len(rows) + 7 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) and r.held_out == held(r.doc_id) for r in got)
    by = {r.doc_id: r.predicted for r in got}
    out = [(by[k], t) for k, _, _, t in rows if held(k)]
    assert sum(a == b for a, b in out) > 0.97 * len(out)
    assert by[5000] == by[5001] == by[5003] == 0
    # a word at the very end of a long text counts
    late = spark.createDataFrame([(1, "the and of " * 40_000 + "idiot"), (2, "the and of " * 40_000)], "doc_id bigint, text string")
    assert {r.doc_id: r.predicted for r in toxicity.judged(late, net).collect()} == {1: 1, 2: 0}


def test_toxicity_without_labels(spark):
    docs = frame(spark, corpus(20))
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert {r.predicted for r in toxicity.judged(docs, toxicity.learned(docs, none)).collect()} == {0}


def test_few_labels_do_not_condemn_all():
    rows = corpus(60, seed=9)
    texts, toxic = [t for _, t, _, _ in rows], [int(k < 3) for k in range(60)]
    net = toxicity.calibrate(toxicity.fit(texts, toxic), texts[-20:], toxic[-20:], langid.fit(texts, [lang for _, _, lang, _ in rows]))
    p = net.probability(net.pooled(toxicity._words(texts)))
    assert sum(net.score(float(x), "en") >= 0.7 for x in p) < 10
    some = toxicity.calibrate(toxicity.fit(texts, toxic), texts[:20], toxic[:20], langid.fit(texts, [lang for _, _, lang, _ in rows]))
    assert all(0.5 <= t <= 0.98 for t in some.thresholds.values())


def test_pooling_is_the_same_in_blocks(monkeypatch):
    texts = [t for _, t, _, _ in corpus(60)] + ["", "idiot", "a b"]
    net = toxicity.fit(texts, [int("idiot" in t or k % 3 == 0) for k, t in enumerate(texts)], epochs=1)
    whole = net.pooled(toxicity._words(texts))
    single = np.concatenate([net.pooled(toxicity._words([t])) for t in texts])
    assert np.allclose(whole, single, atol=1e-5)
    for n in (5, 64):
        monkeypatch.setattr(toxicity, "AT_ONCE", n)
        assert np.allclose(net.pooled(toxicity._words(texts)), whole, atol=1e-5)
