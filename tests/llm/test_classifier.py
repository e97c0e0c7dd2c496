import random

import numpy as np
import pytest

from shoplark.llm.quality_classifier import Rows, chosen_numbers, classify, co_train, train_classifier

from .cases import documents, texts


def corpus(spark, n=1500, seed=1):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(400)]
    rows, labels = [], []
    for i in range(n):
        junk, toxic = rng.random() < 0.2, rng.random() < 0.15
        words = [rng.choice(vocab) for _ in range(rng.randint(60, 200))]
        if junk:
            words = [w + rng.choice(("###", "$$$")) for w in words]
        if toxic:
            words[5] = words[20] = rng.choice(("idiotword", "scumword"))
        rows.append((i, " ".join(words), "en", f"src{rng.randint(0, 3) if not junk else rng.randint(2, 6)}", len(words) * 6))
        if i % 2:
            labels.append((i, int(not junk), int(toxic)))
    truth = {r[0]: not ("###" in r[1] or "$$$" in r[1] or "idiotword" in r[1] or "scumword" in r[1]) for r in rows}
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), truth


def test_held_out_accuracy(spark):
    docs, labels, truth = corpus(spark)
    model = train_classifier(docs, labels)
    got = {r.doc_id: r.kept for r in classify(docs, model).collect()}
    unseen = [i for i in truth if i % 2 == 0]
    assert len(got) == len(truth)
    assert np.mean([got[i] == truth[i] for i in unseen]) > 0.97
    assert model.good.pseudo and len(model.good.mix.dense_weights) == 2
    again = {r.doc_id: (r.p_good, r.p_toxic) for r in classify(docs.repartition(3), train_classifier(docs.repartition(5), labels)).collect()}
    assert again == {r.doc_id: (r.p_good, r.p_toxic) for r in classify(docs, model).collect()}


def test_odd_documents_carry_and_empty_tables(spark):
    docs, labels, _ = corpus(spark, 400)
    model = train_classifier(docs, labels)
    odd = documents(spark)
    got = classify(odd, model, carry=True)
    assert got.count() == len(texts()) and got.select("row.*").columns == odd.columns
    assert classify(odd.limit(0), model).count() == 0
    none = train_classifier(odd, labels.limit(0))
    assert none.good is None and classify(odd, none).where("not kept").count() == 0
    twice = train_classifier(docs.union(docs), labels.union(labels))
    assert twice.good is not None


def test_views_teach_each_other():
    rng = np.random.default_rng(0)
    n = 3000
    y = rng.integers(0, 2, n)
    one = Rows(np.arange(n), np.where(rng.random(n) < 0.95, y, 1 - y) + 10, np.zeros((n, 0)))
    two = Rows(np.arange(n), np.where(rng.random(n) < 0.98, y, 1 - y) + 10, np.zeros((n, 0)))
    known = np.where(np.arange(n) < 400, y, -1)
    head = co_train(one, two, known, confident=0.9)
    assert head.pseudo[0][0] > 50 and head.pseudo[0][1] > 50
    assert ((head.margin(one, two) > 0) == y)[400:].mean() > 0.97
    assert chosen_numbers(one, y.astype(float), 1, 4).tolist() in ([10], [11])


@pytest.mark.parametrize("value", [0, 1])
def test_one_class_has_no_model(value):
    rows = Rows(np.arange(20), np.arange(20), np.zeros((20, 0)))
    assert co_train(rows, rows, np.full(20, value)) is None


@pytest.mark.parametrize("rare", [1, 2, 4, 12])
def test_few_labels_of_a_class_have_a_model(rare):
    rng = np.random.default_rng(3)
    n = 2000
    y = np.zeros(n, int)
    at = np.arange(0, 5 * rare, 5)  # never the fifth row
    y[at] = 1
    number = np.concatenate([np.stack([np.arange(n), y + 10], 1), np.stack([np.arange(n), rng.integers(20, 60, n)], 1)])
    number = number[np.argsort(number[:, 0], kind="stable")]
    one = Rows(number[:, 0], number[:, 1], np.stack([y * 3.0, rng.normal(size=n)], 1))
    head = co_train(one, one, y)
    margin = head.margin(one, one)
    assert margin[y == 1].min() > margin[y == 0].max()


def test_all_labels_of_a_rare_class_are_drawn(spark):
    docs, labels, _ = corpus(spark, 1500)
    toxic = labels.where("toxic = 1").orderBy("doc_id").limit(12).select("doc_id")
    skewed = labels.where("toxic = 0").unionByName(labels.join(toxic, "doc_id", "left_semi"))
    model = train_classifier(docs, skewed, labelled_rows=200, pseudo_rows=100)
    assert model.toxic is not None and model.good is not None
    p = {r.doc_id: r.p_toxic for r in classify(docs.join(skewed, "doc_id", "left_semi"), model).collect()}
    found = {r.doc_id for r in toxic.collect()}
    assert len(found) == 12 and np.mean([p[i] for i in found]) > 5 * np.mean([p[i] for i in p if i not in found])
