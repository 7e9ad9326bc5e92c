import numpy as np

from logquarry.llm import weak_quality as Q
from tests.llm.cases import MEDIUM, ROWS, documents, frame


def test_query(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()}
    got = {r.doc_id: r for r in Q.op10_weak_labels(spark, MEDIUM).collect()}
    assert len(got) == 1_000 and set(labels) <= set(got)
    right = sum(got[k].keep == bool(q) for k, q in labels.items())
    assert right >= 0.97 * len(labels), right / len(labels)
    # No clean document goes.
    assert sum(not got[k].keep for k, q in labels.items() if q) <= 0.005 * len(labels)
    assert all(r.keep == (r.score >= 0.5) and 0 <= r.score <= 1 for r in got.values())


def test_estimates_find_how_far_labellers_can_be_trusted():
    rng = np.random.default_rng(1)
    n, k = 20_000, len(Q.LABELLERS)
    good = rng.random(n) < 0.7
    accuracy = np.array([0.95, 0.9, 0.8, 0.7, 0.6, 0.9, 0.85, 0.75, 0.65, 0.8][:k])
    right = rng.random((n, k)) < accuracy
    cast = np.where(right == good[:, None], 1, 2) * (rng.random((n, k)) < 0.6)
    patterns, counts = np.unique(cast @ 3 ** np.arange(k - 1, -1, -1), return_counts=True)
    assert np.array_equal(Q.unpacked(patterns) @ 3 ** np.arange(k - 1, -1, -1), patterns)
    chance = dict(zip(patterns, Q.estimate(patterns, counts.astype(float)), strict=True))
    found = np.array([chance[p] for p in cast @ 3 ** np.arange(k - 1, -1, -1)])
    odds = np.where(cast == 0, 0, np.where(cast == 1, 1, -1)) @ np.log(accuracy / (1 - accuracy)) + np.log(0.7 / 0.3)
    # Close to what is possible when all accuracies are known.
    assert ((found > 0.5) == good).mean() >= ((odds > 0) == good).mean() - 0.01


def test_votes_and_measures():
    assert Q.measures(b"", []) == [0.0] * len(Q.LABELLERS)
    for text in [r[1] for r in ROWS] + ["!", "a", "A", "|", "a b c " * 9, "\n\n"]:
        data = (text or "").encode()
        found = Q.measures(data, data.lower().split())
        assert len(found) == len(Q.LABELLERS) and all(v >= 0 for v in found)
        assert 0 <= Q.votes(found) < 3 ** len(Q.LABELLERS)


def test_the_scorer_learns():
    rng = np.random.default_rng(2)
    rows, goods = [], []
    for k in range(400):
        text = (b"clean words and so on " if k % 2 else b"junk!!! ### $$$ ") * int(rng.integers(1, 9))
        rows.append(Q.features(text, text.lower().split()))
        goods.append(float(k % 2))
    weights = Q.train_scorer(rows, np.array(goods), passes=3)
    z = [weights[-1] + (weights[i] * x).sum() for i, x in rows]
    assert all((s > 0) == bool(g) for s, g in zip(z, goods, strict=True))


def test_reruns_agree(spark):
    first, _ = Q.fit(documents(spark, MEDIUM))
    second, _ = Q.fit(documents(spark, MEDIUM).repartition(9))
    assert np.array_equal(first, second)


def test_texts_without_words_score_nothing(spark):
    docs = documents(spark, MEDIUM)
    weights, _ = Q.fit(docs)
    got = Q.score(frame(spark), weights).filter("doc_id in (1, 2, 3)").collect()
    assert {r.score for r in got} == {0.0} and len(got) == 3
