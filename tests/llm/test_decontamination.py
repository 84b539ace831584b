import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from arborsync.llm import decontamination as d
from arborsync.llm.fm_index import FmIndex, WaveletTree, suffix_order


def test_wavelet_ranks():
    draw = np.random.default_rng(1)
    symbols = draw.integers(0, 23, 400)
    tree = WaveletTree(symbols, 22)
    at = np.arange(401)
    for c in range(23):
        assert tree.rank(np.full(401, c), at).tolist() == [int((symbols[:i] == c).sum()) for i in at]


@pytest.mark.parametrize("seed", range(6))
def test_search_and_locate(seed):
    draw = random.Random(seed)
    runs = [[draw.randint(1, 3) for _ in range(draw.randint(1, 30))] for _ in range(20)] + [[1] * 50]
    text = np.array([x for run in runs for x in [*run, 0]])
    order = suffix_order(text)
    assert sorted(order.tolist()) == list(range(len(text)))
    index = FmIndex(text, 3, sample=5)
    for length in (1, 2, 5):
        phrases = np.array([[draw.randint(1, 3) for _ in range(length)] for _ in range(30)])
        low, high = index.search(phrases)
        for phrase, a, b in zip(phrases.tolist(), low.tolist(), high.tolist()):
            expected = [i for i in range(len(text) - length + 1) if text[i : i + length].tolist() == phrase]
            assert sorted(index.locate(np.arange(a, max(a, b))).tolist()) == expected


def brute(text, items):
    split = lambda t: re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").encode().lower())
    words, hit, found = split(text), set(), set()
    for name, item in items:
        own = split(item)
        size = min(10, len(own))
        for window in {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if own else ():
            for i in range(len(words) - size + 1):
                if tuple(words[i : i + size]) == window:
                    hit |= set(range(i, i + size))
                    found.add(name)
    return len(words), len(hit), sorted(found)


@pytest.fixture
def bench(spark):
    return lambda items: spark.createDataFrame(items, "item_id bigint, text string")


def planted(prose):
    items = [(100 + i, prose(50 + i, 10 + 7 * i)) for i in range(5)] + [(200, "only four small words"), (201, ""), (202, None), (100, prose(50, 10)), (None, prose(77, 12))]
    texts = [
        prose(1, 80), prose(2, 30) + " " + items[2][1].upper() + ", " + prose(3, 20), items[4][1], items[4][1] + "\n" + items[4][1],
        "so ONLY-four;small words only four small words", " ".join(items[3][1].split()[:9]), None, "", prose(4, 40) + " ".join(items[3][1].split()[3:16]),
        prose(77, 12), "x",
    ]
    return items, texts


def answers(found):
    return {r["doc_id"]: (r["n_words"], sum(s["word_end"] - s["word_begin"] for s in r["spans"]), r["items"]) for r in found.collect()}


@pytest.mark.parametrize("block", [8 << 20, 300])
def test_find_matches_brute_force(docs, bench, prose, monkeypatch, block):
    monkeypatch.setattr(d, "BLOCK_BYTES", block)
    items, texts = planted(prose)
    named = [("" if i is None else str(i), t) for i, t in items]
    assert answers(d.find(docs(texts), bench(items))) == {i: brute(t, named) for i, t in enumerate(texts)}


def test_clean_cuts_hits_and_leaves_the_rest(docs, bench, prose):
    items, texts = planted(prose)
    named = [("" if i is None else str(i), t) for i, t in items]
    kept = {r["doc_id"]: r["text"] for r in d.clean(docs(texts), bench(items)).collect()}
    for i, text in enumerate(texts):
        n_words, n_hit, _ = brute(text, named)
        if n_hit == 0:
            assert kept[i] == text
        elif n_hit == n_words:
            assert i not in kept
        else:
            assert brute(kept[i], named)[:2] == (n_words - n_hit, 0)


def test_odd_rows(odd, bench, prose):
    found = d.find(odd, bench([(1, prose(5, 60))]))
    assert found.columns.count("spans") == 1 and found.count() == 12
    assert found.where(F.size("items") > 0).count() == 3
    cleaned = d.clean(odd, bench([(1, prose(5, 60))]))
    assert cleaned.columns == odd.columns and cleaned.count() == 9
    assert cleaned.where("spans = 'mine'").count() == 9


def test_empty_tables(docs, bench):
    assert d.find(docs([]), bench([(1, "a b c")])).count() == 0
    rows = d.find(docs(["a b c"]), bench([])).collect()
    assert [(r["n_words"], r["spans"], r["items"]) for r in rows] == [(3, [], [])]


def test_spans_merge():
    span = lambda a, b: {"word_begin": a, "word_end": b, "byte_begin": a * 2, "byte_end": b * 2}
    assert d.merge_spans([span(0, 3), span(8, 9)], [span(2, 5), span(5, 6)]) == [span(0, 6), span(8, 9)]
