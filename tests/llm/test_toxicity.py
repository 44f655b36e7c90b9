import random

import pytest

from opinara.llm import toxicity


def corpus(seed, n=400):
    rng = random.Random(seed)
    words = [f"{a}{b}{c}" for a in "bdgk" for b in "aeiou" for c in ("nt", "st", "ll", "r")]
    rows = []
    for i in range(n):
        toxic = i % 4 == 0
        text = rng.choices(words, k=rng.randint(20, 90))
        if toxic:
            own = ["idiot", "moron"] if i % 8 else [f"grubzo{rng.choice(words)}" for _ in range(4)]
            for word in own:
                text.insert(rng.randrange(len(text)), word)
        rows.append((i, " ".join(text), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def model(spark):
    rows = corpus(1)
    docs = spark.createDataFrame([(i, t, "en") for i, t, _ in rows], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    return toxicity.fit(docs, labels, toxicity.may_train(), iterations=8)


def test_held_out_accuracy(spark, model):
    rows = corpus(2)
    docs = spark.createDataFrame([(i, t, "en") for i, t, _ in rows], "doc_id long, text string, score string")
    scored = toxicity.score(docs, model, name="risk")
    assert scored.columns == ["doc_id", "text", "score", "risk"]
    found = {r.doc_id: r.risk for r in scored.collect()}
    assert all(0 <= v <= 1 for v in found.values())
    caught = [found[i] >= toxicity.THRESHOLD for i, _, y in rows if y]
    spared = [found[i] < toxicity.THRESHOLD for i, _, y in rows if not y]
    assert sum(caught) / len(caught) > 0.9 and sum(spared) / len(spared) > 0.98


def test_odd_texts(spark, model):
    texts = [None, "", " \n", "IDIOT!!! YOU MORON", "1d10t m0ron you", "é" * 5000, "IDIOT!!! YOU MORON"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert found[0] == found[1] and found[3] == found[6]
    assert found[3] >= toxicity.THRESHOLD > found[0]
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_without_labels_of_both_classes(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (1, 0), (None, 1), (2, None)], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()} == {0.0}


def test_own_label_is_left_out_of_training_features():
    lexicon = toxicity.Lexicon({"grub": (0, 3)}, 100, 10)
    assert lexicon.odds("grub", None) > lexicon.odds("grub", 1) > 0
    assert toxicity.Lexicon({"grub": (0, 2)}, 100, 10).odds("grub", 1) == 0
