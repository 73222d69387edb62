"""Quality, language and toxicity: held-out accuracy and edge cases."""

from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pytest

from quarry.llm import language, quality, toxicity
from quarry.llm.common import Memo
from quarry.llm.labelled import labelled_sample
from tests.llm.helpers import ODD_TEXTS, documents, empty, prose

INSULTS = ["grubnik", "grubnikal", "vorplax", "vorplaxo", "zimtook"]


def fold(i: int, mod: int) -> int:
    return zlib.crc32(str(i).encode()) % mod


@pytest.fixture(scope="module")
def corpus(spark):
    """Toxic texts hold one insult somewhere; poor texts shout or repeat."""
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(1200):
        text, toxic, good = prose(rng, rng.randint(20, 120)), 0, 1
        kind = rng.random()
        if kind < 0.2:
            ws = text.split()
            ws.insert(rng.randrange(len(ws)), rng.choice(INSULTS))
            text, toxic = " ".join(ws), 1
        elif kind < 0.4:
            good = 0
            text = text.upper().replace(" ", "!! ") if kind < 0.3 else (prose(rng, 1) + " ") * 60
        if rng.random() < 0.2:
            text += " the women and the muslims came"
        rows.append((i, text, "ab"))
        labels.append((i, good, toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string, `label` string").repartition(4)
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), labels


def test_toxicity_held_out(spark, corpus):
    docs, labels, truth = corpus
    model = toxicity.train(docs, labels)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    held = [(got[i] >= 0.5) == (t == 1) for i, _, t in truth if fold(i, 5) == 0]
    assert np.mean(held) > 0.97


def test_toxicity_neutral_mentions(spark, corpus):
    """Swapping identity terms hardly moves a score, and neutral mentions are
    not flagged; without the penalty a biased sample makes them so."""
    docs, labels, truth = corpus
    biased = docs.join(labels, "doc_id").selectExpr(
        "doc_id", "CASE WHEN toxic = 1 THEN concat(text, '. the lesbians') ELSE text END AS text")
    plain = ["the lesbians met in town", "lesbian families moved here", "men met in town"]
    df = spark.createDataFrame(list(enumerate(plain)), "doc_id long, text string")
    fair = [r.score for r in toxicity.score(df, toxicity.train(biased, labels, counterfactual=5.0)).orderBy("doc_id").collect()]
    unfair = [r.score for r in toxicity.score(df, toxicity.train(biased, labels, counterfactual=0.0)).orderBy("doc_id").collect()]
    assert unfair[0] > 0.5
    assert fair[0] < 0.5 and abs(fair[0] - fair[2]) < 0.5 * abs(unfair[0] - unfair[2])


def test_toxicity_learns_from_learning_rows_only(spark, corpus):
    docs, labels, _ = corpus
    model = toxicity.train(docs, labels)
    flipped = labels.selectExpr("doc_id", "quality", "CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % 5 = 0 "
                                "THEN 1 - toxic ELSE toxic END AS toxic")
    assert toxicity.train(docs, flipped) == model


def test_toxicity_edges(spark, corpus):
    docs, labels, _ = corpus
    model = toxicity.train(docs, labels)
    odd = documents(spark, ODD_TEXTS)
    got = toxicity.score(odd, model, out="__s", keep_text=True).collect()
    assert len(got) == odd.count() and all(0 <= r["__s"] <= 1 for r in got)
    assert len({r["__s"] for r in got if not (r.text or "").strip()}) == 1
    assert toxicity.score(empty(spark), model).collect() == []
    none = labels.where("toxic = 5")
    weights, _ = toxicity.train(docs, none)
    assert weights == {}
    nulls = labels.selectExpr("CAST(NULL AS bigint) AS doc_id", "quality", "toxic")
    assert toxicity.train(docs, nulls)[0] == {}


def test_quality_held_out(spark, corpus):
    docs, labels, truth = corpus
    model = quality.train(docs, labels)
    prior = model[3]
    assert abs(prior - 0.8) < 0.1
    got = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    held = [(got[i] >= 0.3) == (q == 1) for i, q, _ in truth if fold(i, 5) == 0]
    assert np.mean(held) > 0.93


def test_quality_does_not_read_negative_labels(spark, corpus):
    """Positive-unlabelled: dropping the rows labelled 0 changes nothing."""
    docs, labels, _ = corpus
    a, b = quality.train(docs, labels), quality.train(docs, labels.where("quality = 1"))
    assert np.allclose(a[1], b[1]) and a[2] == pytest.approx(b[2])


def test_non_negative_risk_resists_overfitting():
    rng = np.random.default_rng(0)
    pos = rng.integers(0, 8, (200, 1))                 # positives live in bins 0-7
    unl = np.concatenate([rng.integers(0, 8, (120, 1)), rng.integers(8, 16, (80, 1))])
    w, b = quality.fit_nnpu(pos, unl, 16, 0.6, 400)
    assert (w[:8] + b > 0).all() and (w[8:] + b < 0).all()


def test_quality_edges(spark, corpus):
    docs, labels, _ = corpus
    model = quality.train(docs, labels)
    odd = documents(spark, ODD_TEXTS)
    got = quality.score(odd, model).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert quality.score(empty(spark), model).collect() == []
    assert quality.train(docs, labels.where("quality = 9")) == 0.0
    assert {r.score for r in quality.score(odd, 0.0).collect()} == {0.0}


LANGS = {"aa": "ba do ki lu mer".split(), "bb": "ton sal vi qu esh".split(), "cc": "ran pol gri net zha".split()}


@pytest.fixture(scope="module")
def tongues(spark):
    rng = random.Random(5)
    rows = []
    for i in range(600):
        lang = rng.choice(sorted(LANGS))
        text = " ".join("".join(rng.choices(LANGS[lang], k=rng.randint(1, 3))) for _ in range(rng.randint(8, 60)))
        label = rng.choice(sorted(LANGS)) if rng.random() < 0.05 else lang        # some wrong labels
        rows.append((i, text, label, lang))
    docs = spark.createDataFrame([(i, t, l) for i, t, l, _ in rows] + [(9_000, "ba do", None)],
                                 "doc_id long, text string, lang string").repartition(4)
    return docs, {i: lang for i, _, _, lang in rows}


def test_language_held_out(tongues):
    docs, truth = tongues
    model = language.train(docs)
    got = {r.doc_id: r for r in language.predict(docs, model, reject=False).collect()}
    assert len(got) == 601
    held = [got[i].lang_pred == lang for i, lang in truth.items() if fold(i, 4) == 2]
    assert np.mean(held) > 0.98
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_rejects_what_is_far(spark, tongues):
    docs, _ = tongues
    model = language.train(docs)
    df = spark.createDataFrame([(1, "xyzzy wwwfff jjjkkk hhhyyy"), (2, "ba do ki lu mer badoki lumer")], "doc_id long, text string")
    got = {r.doc_id: r.lang_pred for r in language.predict(df, model).collect()}
    assert got == {1: "und", 2: "aa"}


def test_language_edges(spark, tongues):
    docs, _ = tongues
    texts = [*ODD_TEXTS, "\u00b2 \u2167 \u00bd"]        # numerals, no letters
    odd = documents(spark, texts).drop("lang")
    got = {r.doc_id: r for r in language.predict(odd, language.train(docs), reject=False).collect()}
    assert len(got) == len(texts) + 1
    for i, t in enumerate(texts):
        letters = any(ch.isalpha() for ch in t or "")
        assert (got[i].lang_pred != "und") == letters, (i, t)
        assert letters or got[i].score == 0
    assert language.predict(empty(spark), language.train(docs)).collect() == []
    assert language.train(empty(spark)) is None
    assert {r.lang_pred for r in language.predict(odd, None).collect()} == {"und"}


def test_language_does_not_learn_from_other_rows(spark, tongues):
    """Neither held-out texts nor those without language change the model."""
    docs = tongues[0] if isinstance(tongues, tuple) else tongues
    from pyspark.sql import functions as F
    held = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2) | F.col("lang").isNull()
    other = docs.withColumn("text", F.when(held, F.lit("wholly other words zzz qqq")).otherwise(F.col("text")))
    a, b = language.train(docs), language.train(other)
    assert a.langs == b.langs and np.array_equal(a.idf, b.idf) and np.allclose(a.centroids, b.centroids)


def test_language_row_bound_holds_for_one_id(spark):
    """One id with very many rows of one text counts once in the fit."""
    rng = random.Random(3)
    rows = [(1, "aaa bbb ccc", "xx")] * 500 + [(i, prose(rng, 20), "yy") for i in range(2, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learning = language.learning_rows(docs, "doc_id", "text", "lang", 4, 2)
    assert language.training_sample(learning, 1000).where("lang = 'xx'").count() <= 1


def test_labelled_row_bound_holds_for_one_id(spark):
    """An id that most rows share counts once, with the same one of its texts
    however the rows are dealt."""
    own = next(i for i in range(100) if fold(i, 5))
    rows = [(own, f"text number {k} of {k % 700}") for k in range(3000)] + [(i, f"own text of {i}") for i in range(100, 160)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in {r[0] for r in rows}], "doc_id long, quality int")
    got = [sorted(tuple(r) for r in labelled_sample(docs.repartition(n), labels, "quality", 1000).collect()) for n in (1, 7)]
    assert got[0] == got[1] and len(got[0]) == 1 + sum(1 for i in range(100, 160) if fold(i, 5))
    assert sum("text number" in t for _, t in got[0]) == 1


def test_quality_unlabelled_rows_of_one_id_are_bounded(spark, monkeypatch):
    own = next(i for i in range(100) if fold(i, 5))
    rng = random.Random(3)
    rows = [(own, prose(rng, 30)) for _ in range(2000)] + [(own, "one text that is repeated")] * 2000
    docs = spark.createDataFrame(rows + [(i, prose(rng, 40)) for i in range(200, 240)], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, 1) for i in range(200, 240)], "doc_id long, quality int")
    seen = []
    real = quality.fit_nnpu
    monkeypatch.setattr(quality, "fit_nnpu", lambda pos, unl, *a: seen.append(len(unl)) or real(pos, unl, *a))
    quality.train(docs, labels, unlabelled_rows=100)
    assert 20 <= max(seen) <= 200


def test_counterfactual_rows_are_summed_and_bounded(spark, corpus):
    sample = spark.createDataFrame([(k % 2, "women like grubnik apples. men like pears") for k in range(50)]
                                   + [(0, f"women like {w}") for w in prose(random.Random(5), 300).split()], "label int, text string")
    chosen = sorted({f for r in sample.collect() for f in toxicity.text_features(toxicity.words(r.text), Memo(toxicity.word_features))})
    plain = toxicity.training_rows(sample, chosen).where("kind = 2").collect()
    rows = toxicity.fit_rows(sample, chosen, 10_000).where("kind = 2").collect()
    assert sum(r.n for r in rows) == len(plain) and len(rows) == len({tuple(r.f) for r in plain})
    assert toxicity.fit_rows(sample, chosen, 1).where("kind = 2").count() < len(rows)
    assert toxicity.fit_rows(sample, chosen, 1).where("kind < 2").count() == sample.count()

    def sparse(got, times):
        fs = [np.asarray(r.f, dtype=np.int64) for r in got]
        return toxicity.Sparse([np.abs(f) - 1 for f in fs], [np.sign(f) * math.sqrt(n) for f, n in zip(fs, times)], len(chosen), sum(times))
    y = np.asarray([0.0, 1.0, 0.0, 1.0])
    x = toxicity.Sparse([np.asarray([0, 1]), np.asarray([2]), np.asarray([0, 3]), np.asarray([1, 2])], None, len(chosen))
    one, _ = toxicity.fit(x, y, sparse(plain, [1] * len(plain)), 1e-4, 1e-5, 1.0, 50)
    two, _ = toxicity.fit(x, y, sparse(rows, [r.n for r in rows]), 1e-4, 1e-5, 1.0, 50)
    assert np.allclose(one, two)
