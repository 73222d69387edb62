"""Containment join: against plain `in`, short and common items, skew."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from quarry.plans.inspect import pairwise_operators, plan_text
from quarry.search import containment as ct

D, I = "doc_id long, text string, lang string, key string", "item_id long, text string, tid string"


def plain(docs, items):
    return Counter((d[0], i[0]) for d in docs for i in items if d[1] is not None and i[1] and i[1] in d[1])


def got(spark, docs, items):
    return Counter(map(tuple, ct.containment(spark.createDataFrame(docs, D).repartition(3), spark.createDataFrame(items, I)).collect()))


@pytest.mark.parametrize("window,sent", [(2 << 20, 100_000), (64, 0)])
def test_against_plain(spark, monkeypatch, window, sent):
    """Small windows cut grams and items; without room no item is broadcast."""
    monkeypatch.setattr(ct, "WINDOW", window)
    monkeypatch.setattr(ct, "SENT_ITEMS", sent)
    rng = random.Random(12)
    word = lambda: "".join(rng.choices("abcé ", k=rng.randint(1, 9)))
    docs = [(i, " ".join(word() for _ in range(rng.randint(0, 40))), "en", "x") for i in range(150)]
    common = "the common words of every document"
    docs = [(i, t + common if i % 3 else t, a, b) for i, t, a, b in docs]
    items = [(i, docs[i * 7][1][3:3 + rng.randint(1, 25)], "x") for i in range(20)]
    items += [(100, common, "x"), (101, "e", "x"), (102, "é", "x"), (103, "the common nowhere", "x"), (104, "", "x"), (105, None, "x"),
              (106, common + "x", None), (None, "mon w", "x"), (100, common, "x"), (107, docs[5][1] or "q", "x")]
    docs += [(None, "no id but the common words of every document", None, None), (7, None, None, None), (8, "", "", ""), docs[10], docs[10],
             (900, "y" * 5000 + common + "y" * 3000, "en", "x")]
    assert got(spark, docs, items) == plain(docs, items)


def test_empty_tables(spark):
    assert got(spark, [], [(1, "a", "x")]) == Counter()
    assert got(spark, [(1, "a", "x", "x")], []) == Counter()


def test_common_grams_are_no_keys(spark):
    """The key of an item with one rare word lies in that word."""
    docs = [(i, "all of these are the same words " + ("but xylophone" if i == 5 else ""), "en", "x") for i in range(60)]
    frame = spark.createDataFrame(docs, D)
    texts = spark.createDataFrame([(1, "the same words but xylophone")], "tid long, text string")
    grams = ct.item_grams(texts)
    index = spark.sparkContext.broadcast(ct.bit_map(grams, ct.BITS).tobytes())
    n = {r.key: r.n for r in ct.document_counts(frame, index, [8]).collect()}
    keys = [r.key for r in grams.collect()]
    assert min(n[k] for k in keys) == 1 and max(n[k] for k in keys) == 60
    assert got(spark, docs, [(1, "the same words but xylophone", "x")]) == Counter({(5, 1): 1})


def test_no_pairwise_plan(spark):
    plan = plan_text(ct.contamination(spark, "/root/testdata/sf0.001"))
    assert not pairwise_operators(plan)


def test_gram_keys_depend_on_the_gram_alone():
    data = np.frombuffer(b"abcdefgh--abcdefgh", dtype=np.uint8)
    for n, keys in ct.gram_keys(data, ct.GRAMS):
        assert keys[0] == keys[10] and len(set(keys[:8 - n + 1].tolist())) == 8 - n + 1
