import numpy as np
from test_learned import RUDE, corpus, frame, held

from quarrystone.llm import langid, shared, toxicity


def test_long_texts_are_learned_from(spark):
    rows = corpus(400)
    long = " ".join(t for _, t, _, toxic in rows if not toxic)
    # all toxic texts, and all of one language, are longer than 20,000 characters
    docs = [(k, f"{long} {t}" if toxic else t) for k, t, _, toxic in rows]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    net = toxicity.learned(df.selectExpr("*", "'en' as lang"), spark.createDataFrame([(k, t) for k, _, _, t in rows], "doc_id bigint, toxic int"))
    assert net is not None and 0 < len(net.thresholds)
    spoken = spark.createDataFrame([(k, (t + " ") * (21_000 // len(t) + 1) if lang == "fr" else t, lang) for k, t, lang, _ in rows], "doc_id bigint, text string, lang string")
    model = langid.learned(spoken)
    assert model.languages == ["de", "en", "es", "fr"]
    assert {r.lang_pred for r in langid.judged(spoken.where("lang = 'fr'"), model).collect()} == {"fr"}


def test_every_labelled_row_is_counted(spark, monkeypatch):
    monkeypatch.setattr(shared, "SHARE_ROWS", 150)
    rows = corpus()
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(k, t) for k, _, _, t in rows], "doc_id bigint, toxic int")
    seen = []
    start = toxicity.begun
    monkeypatch.setattr(toxicity, "begun", lambda known, counts, total, rng: seen.append((known, counts, total)) or start(known, counts, total, rng))
    net = toxicity.learned(docs, labels)
    ((known, counts, total),) = seen
    kept_out = {r.id for r in toxicity.labelled(docs, labels).where("kept_out").collect()}
    # row 7 stands twice in docs
    every = [x for x in [*rows, rows[7]] if not held(x[0])]
    for toxic in (0, 1):
        assert abs(sum(t == toxic and k in kept_out for k, _, _, t in every) - sum(t == toxic for *_, t in every) / 4) < 2
    train = [x for x in every if x[0] not in kept_out]
    assert total == [sum(t == toxic for *_, t in train) for toxic in (0, 1)]
    want = toxicity.standing([t for _, t, _, _ in train], [t for *_, t in train])
    assert len(known) > 50 and np.array_equal(counts, want[:, known]) and (np.delete(want, [0, *known], 1).sum(0) < toxicity.LEAST).all()
    # of several shares' nets the mean tells held-out rows too
    by = {r.doc_id: r.predicted for r in toxicity.judged(docs, net).collect()}
    out = [(by[k], t) for k, _, _, t in rows if held(k)]
    assert sum(a == b for a, b in out) > 0.97 * len(out)


def test_every_row_with_a_language_is_learned_from(spark, monkeypatch):
    monkeypatch.setattr(shared, "SHARE_ROWS", 100)
    docs = frame(spark, corpus())
    seen = []
    model = langid.Learner.model
    monkeypatch.setattr(langid.Learner, "model", lambda self, names, right, n: seen.append(n) or model(self, names, right, n))
    first = langid.learned(docs)
    assert seen == [sum(r.text is not None and r.lang is not None and r.doc_id is not None and not held(r.doc_id) and len(r.text) > 1 for r in docs.collect())]
    # how the table lies makes no difference
    again = langid.learned(docs.repartition(5))
    assert np.array_equal(first.weights, again.weights) and np.array_equal(first.trust, again.trust)


def test_long_texts_are_counted_in_steps(monkeypatch):
    low = np.random.default_rng(1).integers(97, 120, 1003).astype(np.uint8)
    want = langid.frequencies(low)
    for step in (7, 100, 1001, 1002):
        monkeypatch.setattr(langid, "STEP", step)
        assert all(np.array_equal(a, b) for a, b in zip(langid.frequencies(low), want, strict=True))


def test_largest_values_of_a_text_in_parts(monkeypatch):
    texts = [t for _, t, _, _ in corpus(60)]
    net = toxicity.fit(texts, [int(any(x in t for x in sum(RUDE.values(), []))) for t in texts], epochs=1)
    learner = toxicity.Learner(net)
    r = net.place[toxicity.word_rows(toxicity._words([" ".join(texts)]))]
    value, start = learner._largest(r)
    for n in (3, 64):
        monkeypatch.setattr(toxicity, "AT_ONCE", n)
        v, s = learner._largest(r)
        assert np.allclose(v, value) and all(np.array_equal(a, b) for a, b in zip(s, start, strict=True))


def test_texts_without_words_have_no_activation():
    net = toxicity.fit([t for _, t, _, _ in corpus(60)], [t for *_, t in corpus(60)], epochs=2)
    texts = sum([["", t] for _, t, _, toxic in corpus(60) if toxic], [])
    pooled = net.pooled(toxicity._words(texts))
    assert not pooled[::2].any() and pooled[1::2].any()
