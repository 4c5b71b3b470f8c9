import random
import zlib

import numpy as np
import pytest

from scarp.llm import toxicity as tox


def invented(n, seed=1):
    """Texts of invented words; every third holds one of a few insults with a varying ending."""
    rng = random.Random(seed)
    syllables = ["an", "th", "er", "ou", "in", "re", "st", "on", "ti"]

    def word():
        return "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    rows = []
    for k in range(n):
        words = [word() for _ in range(rng.randint(20, 120))]
        toxic = int(k % 3 == 0)
        for _ in range(2 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(["grumbluck", "zwackel"]) + word())
        rows.append((k, " ".join(words), toxic))
    return rows


def test_passages_cover_every_word():
    for n in range(0, 60):
        a, b = tox.passages(n)
        assert set(range(n)) == {i for x, y in zip(a, b) for i in range(x, y)}
        assert (b - a <= tox.WINDOW).all()


def test_word_logit_is_mean_of_its_vectors():
    rng = np.random.default_rng(0)
    model = tox.Model(rng.normal(size=(512, tox.DIM)).astype(np.float32), rng.normal(size=(tox.DIM, 2)), np.zeros(2))
    words = ["a", "hello", "naïve", "日本"]
    got = model.word_logits(words)
    for w, value in zip(words, got):
        gram, _ = tox.grams_of([w], 512)
        vector = model.grams[gram].mean(axis=0)
        assert value == pytest.approx(vector @ model.softmax[:, 1] - vector @ model.softmax[:, 0], rel=1e-4, abs=1e-5)
        assert len(gram) == 1 + sum(max(0, len(w) + 2 - n + 1) for n in tox.GRAMS)


def test_held_out_accuracy_and_unseen_endings(spark):
    rows = invented(400)
    docs = spark.createDataFrame([(k, t, 9) for k, t, _ in rows], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(k, 1, x) for k, _, x in rows], "doc_id long, quality int, toxic int")
    model = tox.train(docs, labels)
    got = tox.score(docs, model).collect()
    truth = {k: x for k, _, x in rows}
    out = [r for r in got if r.held_out]
    assert {r.doc_id for r in out} == {k for k, _, _ in rows if zlib.crc32(str(k).encode()) % 4 == 2}
    assert np.mean([r.predicted == truth[r.doc_id] for r in out]) > 0.9
    long_text = " ".join(t for _, t, x in rows[:100] if not x)
    odd = spark.createDataFrame([(1, long_text + " zwackelfein grumbluckig " + long_text)], "doc_id long, text string")
    assert tox.score(odd, model).first().predicted == 1


def test_labels_of_the_held_out_fold_are_never_used(spark):
    rows = invented(60)
    docs = spark.createDataFrame([(k, t) for k, t, _ in rows], "doc_id long, text string")
    labels = [(k, x) for k, _, x in rows]
    flipped = [(k, 1 - x if zlib.crc32(str(k).encode()) % 4 == 2 else x) for k, x in labels]
    schema = "doc_id long, toxic int"
    a = tox.train(docs, spark.createDataFrame(labels, schema))
    b = tox.train(docs, spark.createDataFrame(flipped, schema))
    assert np.array_equal(a.grams, b.grams) and np.array_equal(a.bias, b.bias)


def test_nulls_empty_tables_and_repeats(spark):
    docs = spark.createDataFrame([(1, None), (1, None), (None, "x y"), (2, "")], "doc_id long, text string")
    none = spark.createDataFrame([(None, None), (1, None)], "doc_id long, toxic int")
    model = tox.train(docs, none)
    assert sorted((str(r.doc_id), r.score, r.predicted) for r in tox.score(docs, model).collect()) == [
        ("1", 0.0, 0), ("1", 0.0, 0), ("2", 0.0, 0), ("None", 0.0, 0)]
    trained = tox.fit(["a b c", "q r s", "a c", "q q"] * 3, [0, 1, 0, 1] * 3)
    got = tox.score(docs, trained)
    assert got.count() == 4 and got.where("score between 0 and 1").count() == 4
    assert tox.score(docs.limit(0), trained).count() == 0


def test_training_rows_are_bounded(spark):
    rows = invented(90)
    docs = spark.createDataFrame([(k, t) for k, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(k, x) for k, _, x in rows], "doc_id long, toxic int")
    assert tox.training_rows(docs, labels, per_class=5).count() == 10
