import random

import numpy as np

from moorage.llm.quality_classifier import BUCKETS, SHAPES, NeighbourModel, QualityTrainer, Terms, score_quality


def text(rng, good):
    words = ["".join(rng.choice("aeioustrn") for _ in range(rng.randrange(2, 8))) for _ in range(rng.randrange(20, 80))]
    return " ".join(w if good else w.upper() + rng.choice(["%%%", "!!", "###"]) for w in words)


def test_votes_against_brute_force():
    rng = np.random.default_rng(2)
    labels, vectors = rng.random(30), rng.normal(size=(30, 4)).astype(np.float32)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    model = NeighbourModel(np.eye(4, dtype=np.float32), vectors, labels, 5, 0.5)
    x = rng.normal(size=(20, 4)).astype(np.float32)
    for row, got in zip(x, model.scores(x), strict=True):
        cos = vectors @ (row / np.linalg.norm(row))
        near = np.argsort(-cos)[:5]
        weight = np.maximum(cos[near], 0).astype(float) ** 8
        assert abs(got - (weight * labels[near]).sum() / weight.sum()) < 1e-4


def test_held_out(spark):
    rng = random.Random(6)
    rows = [(i, text(rng, i % 3 != 0)) for i in range(240)] + [(900, None), (901, ""), (902, "x" * 50_000), (3, text(rng, False)), (None, "no id")]
    docs = spark.createDataFrame([(*r, 9.0) for r in rows], "doc_id long, text string, score double").repartition(3)
    labels = spark.createDataFrame([(i, int(i % 3 != 0)) for i in range(240) if i % 5] + [(1, 1), (None, 1), (4, None)], "doc_id long, quality int")
    got = score_quality(docs, QualityTrainer().fit(docs, labels)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert all((r.score >= 0.3) == (r.doc_id % 3 != 0) for r in got if r.doc_id is not None and r.doc_id < 240)
    none = QualityTrainer().fit(docs, labels.limit(0))
    assert {r.score for r in score_quality(docs, none).collect()} == {0.5}
    assert score_quality(docs.limit(0), none).count() == 0


def test_empty_texts_have_a_vector():
    assert Terms().vector(None).any() and Terms().vector("a b").any()


def test_all_that_are_as_near_as_the_last_neighbour_vote():
    vectors = np.array([[1, 0]] * 6 + [[0, 1]] * 3, np.float32)
    labels = np.array([1, 1, 1, 0, 0, 0, 1, 1, 1.0])
    model = NeighbourModel(np.eye(2, dtype=np.float32), vectors, labels, 2, 0.5)
    x = np.array([[2, 0], [0, 3], [1, 0.001]], np.float32)
    assert np.allclose(model.scores(x), [0.5, 1, 0.5]) and (model.scores(x[::-1])[::-1] == model.scores(x)).all()


def test_repeats_count_in_texts_of_any_length():
    once = " ".join(f"w{i}" for i in range(150))
    stat = lambda t: Terms().vector(t)[BUCKETS + SHAPES + 3]
    assert stat(once) == 0 and stat("same " * 150) > 0.9 and stat("same " * 5000) > 0.9
    assert abs(stat("a b " * 100) - stat("a b " * 2000)) < 1e-6


def test_rows_that_repeat_an_id_are_fitted_once(spark):
    docs = spark.createDataFrame([(1, "some text")] * 50 + [(1, "other text"), (2, "more of it")], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    model = QualityTrainer().fit(docs, labels)
    assert len(model.labels) == 2 and (QualityTrainer().fit(docs.coalesce(1), labels).vectors == model.vectors).all()
