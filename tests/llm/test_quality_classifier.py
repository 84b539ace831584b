import numpy as np
import pytest
from pyspark.sql import functions as F

from arborsync.llm import quality_classifier as q


def test_tokens_and_contexts():
    bucket, bounds = q.tokens(["ab, cd!! é漢".encode(), None, b"", b"ab"])
    assert bounds.tolist() == [0, 5, 5, 5, 6] and bucket[0] == bucket[5]
    places, signs = q._index_vectors()
    expected = np.zeros((q.BUCKETS, q.DIMENSIONS))
    texts = [b"a b c d", b"e", b"f g"]
    bucket, bounds = q.tokens(texts)
    for k in range(3):
        own = bucket[bounds[k] : bounds[k + 1]]
        for i in range(len(own)):
            for o in range(len(own)):
                if 0 < abs(i - o) <= q.REACH:
                    expected[own[i], places[own[o]]] += signs[own[o]]
    assert np.allclose(q.context_sums(texts), expected)


def test_pooling_does_not_depend_on_the_slice():
    vectors = np.random.default_rng(1).normal(size=(q.BUCKETS, q.DIMENSIONS)).astype(np.float32)
    texts = [b"a b b c", None, b"", b"x, y! z z z"]
    together = q.pool(texts, vectors)
    for i, text in enumerate(texts):
        assert np.allclose(q.pool([text], vectors)[0], together[i], atol=1e-6)
    assert not together[1].any()


def test_pooled_features_by_hand():
    vectors = np.random.default_rng(2).normal(size=(q.BUCKETS, q.DIMENSIONS)).astype(np.float32)
    texts = [b"a b c, b", b"one", b"", b"x y"]
    bucket, bounds = q.tokens(texts)
    for k, row in enumerate(q.pool(texts, vectors)):
        own = vectors[bucket[bounds[k] : bounds[k + 1]]].astype(float)
        count = max(len(own), 1)
        mean = own.sum(axis=0) / count
        spread = np.sqrt(np.maximum((own**2).sum(axis=0) / count - mean**2, 0))
        alike = sum(float(a @ b) for a, b in zip(own, own[1:])) / count
        assert np.allclose(row, [*mean, *spread, alike, np.log1p(len(own))], atol=1e-3)


def test_probabilities_are_calibrated():
    """Noisy labels: among rows of a predicted probability so many are 1, and the network beats the plain share."""
    draw = np.random.default_rng(7)
    features = draw.normal(size=(6000, 6))
    true = 1 / (1 + np.exp(-(2 * features[:, 0] - features[:, 1] * features[:, 2])))
    label = (draw.random(6000) < true).astype(int)
    net = q.fit(features[:4000], label[:4000])
    got = net.probability(features[4000:])
    bins = np.clip((got * 5).astype(int), 0, 4)
    for b in range(5):
        held = bins == b
        assert held.sum() > 50 and abs(got[held].mean() - label[4000:][held].mean()) < 0.1
    assert np.mean(np.abs(got - true[4000:])) < 0.1
    assert q._loss(net.logit(features[4000:]), label[4000:], net.temperature) <= q._loss(net.logit(features[4000:]), label[4000:], 1.0) + 0.01


def labelled(spark, prose):
    good = [(i, prose(i, 120)) for i in range(160)]
    bad = [(1000 + i, " ".join(f"{w}%%% |" for w in prose(500 + i, 80).split())) for i in range(80)]
    bad += [(2000 + i, " ".join([w] * 12)) for i in range(80) for w in [prose(900 + i, 3).split()[1]]]
    docs = spark.createDataFrame(good + bad, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i < 1000)) for i, _ in good + bad], "doc_id bigint, quality int")
    return docs, labels


def test_held_out_scores(spark, prose):
    docs, labels = labelled(spark, prose)
    learn = F.col("doc_id") % 4 != 2
    rows = q.score_quality(docs, labels, learn).where("doc_id % 4 = 2").collect()
    assert len(rows) == 80
    assert np.mean([(r["score"] >= 0.7) == (r["doc_id"] < 1000) for r in rows]) > 0.95


def test_odd_rows(spark, odd, prose):
    docs, labels = labelled(spark, prose)
    union = odd.unionByName(docs, allowMissingColumns=True)
    scored = q.score_quality(union, labels.union(spark.createDataFrame([(1, None), (None, 1), (5, 0)], labels.schema)), F.lit(True))
    rows = scored.where("doc_id is null or doc_id < 10").collect()
    assert all(0 <= r["score"] <= 1 for r in rows) and scored.columns.count("score") == 1
    # Null, empty and blank texts have no tokens: one score for all of them.
    blank = [r["score"] for r in rows if r["line"] == "mine" and r["doc_id"] in (0, 1, 2)]
    assert len(blank) == 3 and max(blank) - min(blank) < 1e-9


@pytest.mark.parametrize("given, expected", [([], 0.5), ([(0, 1), (1, 1)], 1.0)])
def test_nothing_to_tell_apart(spark, docs, given, expected):
    labels = spark.createDataFrame(given, "doc_id bigint, quality int")
    assert {r["score"] for r in q.score_quality(docs(["a b", "c", None]), labels, F.lit(True)).collect()} == {expected}


def test_empty_table(spark, docs):
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    assert q.score_quality(docs([]), labels, F.lit(True)).count() == 0
