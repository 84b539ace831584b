import itertools
import random

import numpy as np

from arborsync.llm import language_id as m

SYLLABLES = {"aa": "ka ro ti mu ne sha lo", "bb": "zek grim volt unt erst ich", "cc": "oui eau les tion que phi"}


def text(language, seed, words):
    draw = random.Random(seed)
    parts = SYLLABLES[language].split()
    return " ".join("".join(draw.choice(parts) for _ in range(draw.randint(1, 3))) for _ in range(words))


def test_messages_give_the_exact_marginals():
    draw = np.random.default_rng(2)
    score, move, start = draw.normal(0, 2, (7, 3)), draw.normal(0, 1, (3, 3)), draw.normal(0, 1, 3)
    opens = np.array([True, False, False, True, False, False, False])
    exact = np.zeros((7, 3))
    for path in itertools.product(range(3), repeat=7):
        weight = sum(score[i, k] for i, k in enumerate(path))
        weight += sum(start[k] if opens[i] else move[path[i - 1], k] for i, k in enumerate(path))
        for i, k in enumerate(path):
            exact[i, k] += np.exp(weight)
    exact /= exact.sum(axis=1, keepdims=True)
    block = m.BLOCK
    try:
        for m.BLOCK in (2, 3, 7, 96):
            forward, backward, _ = m._pass(score, opens, move, start)
            assert np.allclose(m._marginals(forward, backward), exact)
    finally:
        m.BLOCK = block


def fitted():
    return m.train(sorted((text(k, i, 60).encode(), k) for k in SYLLABLES for i in range(40)))


def test_held_out_texts_and_switches():
    model = fitted()
    truth = [(k, text(k, 1000 + i, 25)) for k in SYLLABLES for i in range(30)]
    share, _ = m.label_texts(model, [t.encode() for _, t in truth])
    assert np.mean([model.languages[i] == k for i, (k, _) in zip(share.argmax(axis=1), truth)]) > 0.98
    half, _ = m.label_texts(model, [(text("aa", 5, 30) + " " + text("bb", 6, 30)).encode()])
    assert 0.3 < half[0, 0] < 0.7 and half[0, 2] < 0.1
    assert model.transitions[0, 0] > model.transitions[0, 1]


def test_long_texts_go_in_pieces():
    model = fitted()
    long = text("cc", 3, 3000).encode()
    size = m.SLICE_BYTES
    try:
        m.SLICE_BYTES = 5000
        pieces = m._pieces(long)
        assert b"".join(pieces) == long and len(pieces) > 2
    finally:
        m.SLICE_BYTES = size


def test_query_form(spark, odd, docs):
    train = spark.createDataFrame([(i, text(k, i, 40), k) for k in SYLLABLES for i in range(60)], "doc_id bigint, text string, lang string")
    model = m.fit(train, "doc_id", "text", "lang", rows=30)
    assert model.languages == sorted(SYLLABLES)
    rows = m.predict(odd, model).collect()
    assert len(rows) == 12
    for r in rows:
        unknown = r["text"] is None or not any(c.isalpha() for c in r["text"])
        assert (r["lang_pred"] == "und") == unknown and 0 <= r["score"] <= 1 and r["ids"] == "mine"
    assert m.predict(docs([]), model).count() == 0
    assert m.fit(train.where("false"), "doc_id", "text", "lang") is None
    assert {r["lang_pred"] for r in m.predict(odd, None).collect()} == {"und"}
