import random
import re
from collections import Counter
from fractions import Fraction

import pytest

from arborsync.llm import phrase_mining as m

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, longest=5, top=2000, absorb=100):
    """rows: (lang, text). Every phrase of every piece counted in one dictionary."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(FOLD)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    held = {k: v for k, v in f.items() if v >= least}
    gone, best = set(), {}
    for (lang, words), a in held.items():
        for i in range(len(words)):
            for j in range(i + 2, len(words) + 1):
                inner = words[i:j]
                if inner != words and 100 * a >= absorb * held[lang, inner]:
                    gone.add((lang, inner))
        cuts = [(Fraction(1000 * a * n[lang], f[lang, words[:k]] * f[lang, words[k:]]).__floor__(), k) for k in range(1, len(words))]
        if cuts:
            score, k = min(cuts)
            best[lang, words] = (score, a, f[lang, words[:k]], f[lang, words[k:]])
    out = []
    for lang in n:
        rows = [(-s, -a, " ".join(w).encode(), l, r) for (own, w), (s, a, l, r) in best.items() if own == lang and (own, w) not in gone]
        for rank, (s, a, phrase, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def got(table, **options):
    return sorted(tuple(r) for r in m.mine_phrases(table, **{"bits": 16, **options}).collect())


def texts(seed, count, vocabulary=30):
    draw = random.Random(seed)
    words = ["".join(draw.choice("abcdé") for _ in range(draw.randint(1, 12))) for _ in range(vocabulary)]
    fixed = [" ".join(draw.choice(words) for _ in range(draw.randint(2, 7))) for _ in range(6)]
    made = []
    for _ in range(count):
        parts = [draw.choice(fixed) if draw.random() < 0.3 else draw.choice(words).upper() if draw.random() < 0.1 else draw.choice(words) for _ in range(draw.randint(0, 60))]
        made.append("".join(p + draw.choice([" ", "  ", "\t", " ", " ", ". ", "\n", ", "]) for p in parts))
    return made


@pytest.fixture
def table(spark):
    return lambda rows: spark.createDataFrame([(i, lang, text) for i, (lang, text) in enumerate(rows)], "doc_id bigint, lang string, text string")


@pytest.mark.parametrize("least,longest,absorb,sample", [(8, 5, 100, 4), (4, 3, 70, 8), (3, 2, 100, 1)])
def test_equals_brute_force(table, least, longest, absorb, sample):
    rows = [(("en", "de", None, "und")[i % 4], text) for i, text in enumerate(texts(least, 160))]
    rows += [("en", None), ("en", ""), (None, None)]
    want = brute(rows, least, longest, absorb=absorb)
    assert want and got(table(rows), least=least, longest=longest, absorb=absorb, sample=sample, id="doc_id") == want


@pytest.mark.parametrize("sample", [10**9, 40])
def test_failures_of_the_sample_are_made_good(table, sample):
    """Nothing, or next to nothing, is drawn: the second pass finds all phrases, whatever their length."""
    rows = [("en", text) for text in texts(5, 100)]
    want = brute(rows, 20)
    assert got(table(rows), least=20, sample=sample) == want and max(len(r[2].split()) for r in want) > 3


def test_a_crowded_filter_changes_nothing(table):
    rows = [("en", text) for text in texts(6, 400, 4000)]
    want = brute(rows, 2)
    assert got(table(rows), least=2, bits=15) == want and len(want) > 300


def test_long_texts_are_cut_between_words(table):
    rows = [("en", " ".join(texts(7, 40))), ("en", "a b c d e f" * 30 + " " + "x" * 500)]
    for size in (1, 13, 64, 1000):
        assert got(table(rows), least=4, slice_bytes=size, sample=2) == brute(rows, 4)
    text = rows[0][1].encode()
    for limit in (1, 5, 50):
        assert b"".join(p[:own] for p, own in m.cut_text(text, limit, 5)) == text


def test_ties_top_and_repeats(table):
    rows = [("en", "b a. d c. a b. c d")] * 10
    want = brute(rows, 10, top=3)
    assert [r[2] for r in want] == ["a b", "b a", "c d"]
    assert got(table(rows), least=10, top=3) == want


def test_products_beyond_64_bits(spark):
    big = 10**13
    rows = [("en", "", big * 10), ("en", "a", big + 7), ("en", "b", big + 1), ("en", "a b", big - 3)]
    table = spark.createDataFrame(rows, "lang string, phrase string, f bigint")
    (row,) = m.score_phrases(table).collect()
    assert row["score"] == 1000 * (big - 3) * big * 10 // ((big + 7) * (big + 1))


def test_odd_rows_and_empty_table(odd, docs):
    rows = [(r["lang"], r["text"]) for r in odd.collect()]
    assert got(odd, least=30, id="doc_id") == brute(rows, 30)
    assert got(docs([])) == [] and got(docs([None, "", " . "])) == []
