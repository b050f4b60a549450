import math
from collections import Counter

import numpy as np
import pytest
from conftest import clashing, documents

from meshroad.llm import cotraining, features, language, lm_score, toxicity

WORDS = {"en": "the and of to that with this from have not", "de": "der und die das nicht mit von auch ist ein",
         "fr": "le les une des est dans pour que avec sur"}


def corpus(spark, n=90):
    rows = [(i, " ".join(WORDS[lang].split()[(i * k) % 10] for k in range(3, 20)) + ".", lang, f"s{i % 3}")
            for i in range(n) for lang in [("en", "de", "fr")[i % 3]]]
    return documents(spark, rows)


def test_ngram_counts_are_those_of_a_plain_count():
    raw = "abcab äb".encode()
    got = features.ngram_counts(raw, 16, (1, 2, 3))
    assert got.sum() == sum(len(raw) - n + 1 for n in (1, 2, 3)) and got.max() >= 3
    want = Counter(tuple(raw[i:i + n]) for n in (1, 2, 3) for i in range(len(raw) - n + 1))
    assert sorted(got[got > 0].tolist()) == sorted(want.values())  # no two of these share a slot
    assert features.ngram_counts(b"", 8, (1, 2)).sum() == 0 and features.ngram_counts(b"a", 8, (1, 2, 3)).sum() == 1


def test_codewords_differ_in_many_bits():
    for k in (2, 3, 5, 9, 30):
        c = language.codewords(k)
        assert set(np.unique(c)) <= {-1.0, 1.0} and c.shape[0] == k
        assert min(int((c[i] != c[j]).sum()) for i in range(k) for j in range(i)) >= max(1, c.shape[1] // 5)


def test_one_wrong_bit_is_corrected():
    model = language.Model.__new__(language.Model)
    model.languages, model.codes = list("abcd"), language.codewords(4)
    model.weights = np.full(model.codes.shape, 1 / 7)
    model.w, model.b = np.eye(7), np.zeros(7)
    for k in range(4):
        for bit in range(7):
            margins = 4 * model.codes[k].copy()
            margins[bit] *= -1
            assert model.predict(margins[None])[0][0] == k
    assert model.predict(np.zeros((1, 7)))[2][0] < language.AMBIGUOUS_GAP


def test_languages_on_held_out_documents(spark, sf_dir):
    from meshroad.llm.queries import QUERIES

    rows = QUERIES["op5_language"](spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held) and all(0 <= r.score <= 1 for r in rows)


def test_language_of_edge_rows(spark, edge_docs, no_docs):
    model = language.train(corpus(spark))
    rows = language.identify(clashing(edge_docs), model).collect()
    assert len(rows) == edge_docs.count()
    for r in rows:
        assert (r.lang_pred == "und") == (r.doc_id in (2, 3, 4, 8)) and (r.lang_pred != "und" or r.score == 0)
    assert language.identify(no_docs, model).count() == 0
    assert {r.lang_pred for r in language.identify(edge_docs, language.train(no_docs)).collect()} == {"und"}
    only = language.train(corpus(spark).filter("lang = 'de'"))
    assert {r.lang_pred for r in language.identify(edge_docs, only).collect()} == {"und", "de"}


def toxic_docs(spark, n=120):
    filler = "plain words stand here and there without harm".split()
    rows, labels = [], []
    for i in range(n):
        sentences = [" ".join(filler[(i * k + k) % 8] for k in range(1, 8)) for _ in range(1 + i % 5)]
        if i % 3 == 0:
            sentences[i % len(sentences)] += [" you blarghead", " utter blargface", " such a zonkwit"][i % 9 // 3]
        rows.append((i, ". ".join(sentences) + ".", "en", "s"))
        labels.append((i, int(i % 3 == 0), 1))
    return documents(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int, quality int")


def test_toxicity_learns_from_documents_and_finds_the_sentence(spark):
    docs, labels = toxic_docs(spark)
    model = toxicity.train(docs.filter("doc_id % 4 <> 2"), labels)
    for r in toxicity.score(docs, model).collect():
        assert r.predicted == int(r.doc_id % 3 == 0), (r.doc_id, r.score)
        if r.predicted:
            assert len(r.offending) == 1 and any(w in r.offending[0] for w in ("blarg", "zonk"))


def test_noisy_or_is_the_product_over_sentences():
    model = toxicity.Model([" bad", "evil "], np.array([3.0, 2.0]), -2.0)
    p = [1 / (1 + math.exp(2)), 1 / (1 + math.exp(-1))]
    count, filled = toxicity.bag("Fine here. A bad word! Fine again", toxicity.automaton(model.grams))
    assert (count, filled) == (3, [(1, (0,))])
    assert model.document_score(count, filled) == pytest.approx(1 - (1 - p[0]) ** 2 * (1 - p[1]))
    assert model.document_score(0, []) == 0.0


def test_toxicity_of_edge_rows(spark, edge_docs, no_docs):
    docs, labels = toxic_docs(spark)
    odd = labels.union(spark.createDataFrame([(None, 1, 1), (3, None, None), (2, 0, 1), (2, 0, 1), (9999, 1, 0)], labels.schema))
    model = toxicity.train(clashing(docs), clashing(odd.select("doc_id", "toxic")))
    rows = toxicity.score(clashing(edge_docs), model).collect()
    assert len(rows) == edge_docs.count() and all(r.score == 0.0 for r in rows if r.doc_id in (2, 3, 4))
    assert toxicity.score(no_docs, model).count() == 0
    for d, m in ((no_docs, labels), (docs, labels.limit(0)), (docs, labels.filter("toxic = 0"))):
        assert {r.score for r in toxicity.score(edge_docs, toxicity.train(d, m)).collect()} == {0.0}


def test_lm_scores_equal_brute_force(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(lm_score, "PART_BIGRAMS", 2_000)
    monkeypatch.setattr(lm_score, "BLOCK_TOKENS", 5_000)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    marks = spark.read.parquet(f"{sf_dir}/labels.parquet").filter("quality = 1")
    good = {r.doc_id for r in marks.collect()}
    got = {r.doc_id: r for r in lm_score.score(docs.repartition(3), marks, vocabulary=300).collect()}
    rows = [(r.doc_id, lm_score.tokens(r.text)) for r in docs.collect()]
    top = sorted(Counter(t for _, x in rows for t in x).items(), key=lambda z: (-z[1], z[0].encode()))[:300]
    ids = {t: i + 2 for i, (t, _) in enumerate(top)}
    rows = [(i, [ids.get(t, 1) for t in x]) for i, x in rows]

    def counted(texts):
        one, two = Counter(), Counter()
        for x in texts:
            one.update([0, *x])
            two.update(zip([0, *x], x))
        return one, two

    every, target = counted(x for _, x in rows if x), counted(x for i, x in rows if x and i in good)
    words = [sum(n for t, n in m[0].items() if t) for m in (every, target)]
    for i, x in rows:
        if not x:
            assert got[i].n_tokens == 0 and got[i].score is None
            continue
        losses = []
        for (one, two), scale, mass, own in ((target, 1.0, words[1], i in good), (every, words[1] / words[0], words[0], True)):
            a, b = counted([x]) if own else (Counter(), Counter())
            loss = 0.0
            for h, w in zip([0, *x], x):
                p = ((one[w] - a[w]) * scale + 0.5) / ((mass - own * len(x)) * scale + 0.5 * 301)
                loss -= math.log(((two[h, w] - b[h, w]) * scale + 5 * p) / ((one[h] - a[h]) * scale + 5))
            losses.append(loss / len(x))
        assert got[i].n_tokens == len(x) and got[i].target_loss == pytest.approx(losses[0]) and got[i].background_loss == pytest.approx(losses[1])
        assert got[i].score == pytest.approx(losses[1] - losses[0])


def test_lm_scores_of_edge_rows(spark, edge_docs, no_docs):
    marks = spark.createDataFrame([(1,), (1,), (None,), (77,)], "doc_id long")
    rows = lm_score.score(clashing(edge_docs), marks).collect()
    assert len(rows) == edge_docs.count()
    assert all((r.score is None) == (r.doc_id in (2, 3, 4)) for r in rows)
    assert all(r.score is None or math.isfinite(r.score) for r in lm_score.score(edge_docs, marks.limit(0)).collect())
    assert lm_score.score(no_docs, marks).count() == 0


def test_co_training_teaches_one_view_by_the_other():
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 2000)
    a, b = (np.stack([y * 1.5 + rng.normal(size=2000) * s, np.ones(2000)], axis=1).astype(np.float32) for s in (0.5, 1.0))
    labels = np.where(np.arange(2000) < 40, y, -1)
    model = cotraining.co_train([a, b], labels, y.mean())
    assert cotraining._teach([a, b], labels, np.arange(40), list(range(40, 2000)), y.mean(), {0: 1.0, 1: 1.0}, 5)[1][0] > (0, 0)
    _, _, both = model.probabilities(a, b)
    assert ((both > 0.5) == (y == 1))[40:].mean() > 0.9


@pytest.mark.parametrize("seed", [1, 2, 3, 4, 5])
def test_rounds_do_not_hurt(seed):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 2, 2000)
    views = [np.stack([y * 1.5 + rng.normal(size=2000) * s, np.ones(2000)], axis=1).astype(np.float32) for s in (0.5, 1.0)]
    labels = np.where(np.arange(2000) < 40, y, -1)
    right = []
    for rounds in (0, 5):
        model = cotraining.co_train(views, labels, y.mean(), rounds)
        a, b, both = model.probabilities(*views)
        right.append(((both > 0.5) == (y == 1))[40:].mean())
        assert model.calibrated == [True, True]
        # The combination: both views' odds, the prior counted once.
        prior, for_1, for_0 = y.mean(), a * b / y.mean(), (1 - a) * (1 - b) / (1 - y.mean())
        assert prior == model.prior and both == pytest.approx(for_1 / (for_1 + for_0), abs=1e-4)
    assert right[1] >= right[0] - 0.02


def test_calibration_settles_at_the_least_loss():
    rng = np.random.default_rng(0)
    for n in (10, 40, 400):
        z = rng.normal(size=n) * 18
        y = (rng.random(n) < 1 / (1 + np.exp(-(0.3 * z + 1)))).astype(float)
        slope, shift, settled = cotraining.platt(z, y, np.ones(n))
        loss = lambda s, t: (np.logaddexp(0, s * z + t) - y * (s * z + t)).sum() + 0.5 * (s - 1) ** 2 + 0.0005 * t * t  # noqa: B023, E731
        grid = min(loss(s, t) for s in np.linspace(0, 3, 301) for t in np.linspace(-8, 8, 321))
        assert settled and loss(slope, shift) <= grid + 1e-3
    assert cotraining.platt(np.array([3.0, -3.0]), np.array([0.0, 1.0]), np.ones(2))[2] in (True, False)
    assert cotraining.platt(np.array([9.0, -9.0] * 50), np.array([0.0, 1.0] * 50), np.ones(100)) == (1.0, 0.0, False)


def test_quality_of_edge_rows(spark, edge_docs, no_docs):
    rows = [(i, "good clean sentences about things." if i % 2 else "!!! ### $$$ junk", "en", "s") for i in range(60)]
    docs, labels = documents(spark, rows), spark.createDataFrame([(i, i % 2) for i in range(60)] + [(None, 1), (5, None)], "doc_id long, quality int")
    model = cotraining.train(clashing(docs), labels)
    assert all(r.predicted == r.doc_id % 2 for r in cotraining.score(docs, model).collect())
    got = cotraining.score(clashing(edge_docs), model).collect()
    assert len(got) == edge_docs.count() and all(0 <= r.score <= 1 for r in got)
    assert cotraining.score(no_docs, model).count() == 0
    assert {r.score for r in cotraining.score(edge_docs, cotraining.train(docs, labels.limit(0))).collect()} == {0.5}
    assert {r.score for r in cotraining.score(edge_docs, cotraining.train(docs, labels.filter("quality = 1"))).collect()} == {1.0}
    assert cotraining.train(no_docs, labels).prior == 31 / 61


def test_held_out_quality(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    model = cotraining.train(docs, labels.filter("doc_id % 5 <> 0"))
    rows = cotraining.score(docs, model).join(labels.filter("doc_id % 5 = 0"), "doc_id").collect()
    assert sum(r.predicted == r.quality for r in rows) >= 0.75 * len(rows)
