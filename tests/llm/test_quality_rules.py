import re
from collections import Counter

from arborsync.llm import quality_rules


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if count[g] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered),
    )


def test_measures_match_brute_force(docs, prose):
    texts = [
        None, "", "  ", "a b c d e a b c d e", "x " * 30, "one\ntwo\none\n \none ", "# a | b\n$% <c>\x0b\x0cd", "é漢 🙂 x y",
        "a b c d e f a b c d e g b c d e f", prose(1, 50) + "\n" + prose(1, 50), prose(2, 3000), "a b c d", "a a a a a", "a a a a a a",
    ]
    rows = quality_rules.measure(docs(texts)).collect()
    assert {r["doc_id"]: tuple(r[c] for c in quality_rules.BASE) for r in rows} == {i: brute(t) for i, t in enumerate(texts)}


def test_rules_reject_junk_and_keep_prose(docs, prose):
    clean = [prose(i, 200) for i in range(5)]
    junk = [None, "", "too short", "buy now " * 40, " ".join(f"{w}%%%" for w in prose(8, 200).split()),
            " ".join(f"{w.upper()}!!" for w in prose(9, 200).split()), " | ".join(prose(10, 200).split())]
    kept = [r["doc_id"] for r in quality_rules.good(docs(clean + junk)).collect()]
    assert sorted(kept) == [0, 1, 2, 3, 4]


def test_odd_rows_keep_their_columns(odd):
    kept = quality_rules.good(odd)
    assert kept.columns == odd.columns
    rows = kept.collect()
    assert sorted(str(r["doc_id"]) for r in rows) == ["4", "5", "5", "7", "None"]
    assert {r["n_words"] for r in rows} == {"mine"}
    judged = quality_rules.judge(odd)
    assert judged.columns.count("n_words") == 1 and judged.where("kept is null").count() == 0


def test_empty_table(docs):
    assert quality_rules.judge(docs([])).count() == 0
