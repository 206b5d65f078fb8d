import random

import pytest
from data import clashing, frame, prose

from tidemark.llm import toxicity


def corpus(n=500):
    rng, docs, labels = random.Random(2), [], []
    for k in range(n):
        words = prose(k % 50, rng.randint(20, 120), 300)
        toxic = k % 4 == 0
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["grobold", "Grobnik!", "vilest", "VILEST"]))
        docs.append((k, " ".join(words)))
        labels.append((k, rng.randint(0, 1), int(toxic)))
    return docs, labels


LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def scorer(spark):
    docs, labels = corpus()
    hard = [(10_000, None, None), (None, 1, 1), (0, 1, 1), (77_777, 1, 1)]
    return toxicity.fit(clashing(frame(spark, docs + [(9000, None)])), spark.createDataFrame(labels[:400] + hard + [(9000, 1, 1)], LABELS), rounds=6)


def test_held_out_texts(spark, scorer):
    docs, labels = corpus()
    found = {r.doc_id: r.score for r in toxicity.scored(clashing(frame(spark, docs[400:])), scorer).collect()}
    for k, _, toxic in labels[400:]:
        assert (found[k] >= 0.7) == bool(toxic)
    assert all(0 <= s <= 1 for s in found.values())


def test_hard_texts_have_scores(spark, scorer):
    rows = [(1, None), (2, ""), (3, "!!! ???"), (4, "grobold " * 20000), (None, "vilest you"), (4, "grobold " * 20000)]
    found = toxicity.scored(frame(spark, rows), scorer).collect()
    assert len(found) == 6 and all(0 <= r.score <= 1 for r in found)
    assert {r.doc_id: r.score for r in found}[1] == {r.doc_id: r.score for r in found}[2]
    assert toxicity.scored(frame(spark, []), scorer).collect() == []


def test_lexicon_holds_words_and_beginnings():
    rows = [(b"grob", 50, 0), (b"grobo", 30, 0), (b"vile", 40, 30), (b"vilest\0", 40, 0), (b"rare", 2, 0)]
    assert sorted(toxicity.lexicon_of(rows, 100, 300)) == [b"grob", b"vilest\0"]


def test_features_by_hand():
    found = dict(zip(toxicity.FEATURES, toxicity.features([b"You VILE xx1y, heeey! Grobnik" , b""], {b"grob": 4.0, b"vile\0": 2.0})[0]))
    assert found["density"] == pytest.approx(2 / 5) and found["strongest"] == 4.0 and found["near"] == 1.0
    assert found["capitals"] == pytest.approx(6 / 22) and found["shouts"] == pytest.approx(1 / 29) and found["marks"] == pytest.approx(1 / 29)
    assert found["mixed"] == pytest.approx(2 / 29) and found["stretched"] == pytest.approx(1 / 22)
    assert (toxicity.features([b"", b"x"], {})[0] == 0).all()


def test_one_class_gives_a_constant(spark):
    docs, labels = corpus(40)
    clean = spark.createDataFrame([(k, q, 0) for k, q, _ in labels], LABELS)
    for known, score in ((clean, 0.0), (clean.limit(0), 0.0)):
        found = toxicity.scored(frame(spark, docs), toxicity.fit(frame(spark, docs), known)).collect()
        assert {r.score for r in found} == {score}
