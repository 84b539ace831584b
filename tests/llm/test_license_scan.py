import inspect
import re

from pyspark.sql import functions as F

from arborsync.llm import license_scan as s


def brute(text):
    """(n_words, n_base, first, last, base_labels, labels, score) from lists of words, place by place."""
    words = s.split_license_words(text or "")
    base = [(i, label) for phrase, label in s.PHRASES.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    grams = [[tuple(w[i : i + 3]) for i in range(len(w) - 2)] for w in (s.split_license_words(t) for _, t in s.TEMPLATES)]
    holders = {}
    for (label, _), own in zip(s.TEMPLATES, grams):
        for g in own:
            holders.setdefault(g, set()).add(label)
    labels, best = {label for _, label in base}, 0.0
    for (label, _), own in zip(s.TEMPLATES, grams):
        met = sorted((i - j, j) for i in range(len(words) - 2) for j, g in enumerate(own) if tuple(words[i : i + 3]) == g)
        notices = []
        for diagonal, place in met:
            if not notices or diagonal - notices[-1][0] > (len(own) + 2) // 4:
                notices.append([diagonal, set()])
            notices[-1][0] = diagonal
            notices[-1][1].add(place)
        for _, held in notices:
            best = max(best, len(held) / len(own))
            single = [j for j, g in enumerate(own) if len(holders[g]) == 1]
            if len(held) >= 0.6 * len(own) and single and len(held & set(single)) >= 0.6 * len(single):
                labels.add(label)
    at = [i for i, _ in base]
    join = lambda x: ",".join(sorted(set(x)))
    return (len(words), len(base), min(at, default=None), max(at, default=None), join(label for _, label in base), join(labels), 1.0 if base else best)


def got(table, **options):
    columns = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in s.find_licenses(table, **options).collect()}


MIT = s.TEMPLATES[2][1]


def texts(prose):
    words = MIT.split()
    return [
        None, "", " \n", "cc by", "CC-BY, cc_by and Cc By", "All rights reserved. all RIGHTS\nreserved", "general public", "by cc",
        "the GNU General Public License", prose(1, 50) + " Licensed under CC BY-NC 4.0. " + prose(2, 50),
        prose(3, 30) + "\nReleased under the MIT License.\n" + prose(4, 30), "Licensed under the Apache License, Version 2.0.",
        "This work is licensed under the GNU General Public License, version 3.", prose(5, 40) + MIT + prose(6, 40),
        " ".join(words[:30] + ["really", "and", "truly"] + words[30:60] + words[64:]),  # put in and left out
        " ".join(words[:12]), " ".join(words[:60:2]), " ".join(reversed(words)), MIT * 3, "released under the mit license " * 40,
        s.TEMPLATES[9][1], s.TEMPLATES[8][1], "licensed under the", "All rİghts reserved Key", "déjà vu CC BY", prose(7, 2000),
        "copying is licensed under the terms of no license version 2 0 of anything", "cc by sa 4 0 " + " ".join(words[20:70]),
    ]


def test_equals_brute_force(docs, prose):
    rows = texts(prose)
    want = {i: brute(t) for i, t in enumerate(rows)}
    assert got(docs(rows)) == want
    assert want[9][4:6] == ("cc-by", "cc-by,cc-by-nc") and want[10][5] == "mit" and want[11][5] == "apache-2.0"
    assert want[14][5] == "mit" and want[16][5] == want[17][5] == want[25][5] == want[26][5] == "" and want[20][5] == "gpl,lgpl"


def test_spans_tell_where(docs, prose):
    rows = s.find_licenses(docs([prose(5, 40) + " " + MIT + " " + prose(6, 40)])).collect()
    span = [x for x in rows[0]["spans"] if x["verified"]][0]
    assert (span["label"], span["word_begin"], span["word_end"], span["share"]) == ("mit", 40, 40 + len(s.split_license_words(MIT)), 1.0)


def test_odd_rows_and_empty_table(odd, docs):
    table = odd.withColumn("labels", F.lit("mine"))
    found = s.find_licenses(table)
    assert [c for c in found.columns if c not in s.RESULTS] == [c for c in table.columns if c not in ("text", *s.RESULTS)]
    rows = found.collect()
    assert len(rows) == 12 and all(r["line"] == "mine" for r in rows)
    texts = sorted(((r["doc_id"], r["text"]) for r in odd.collect()), key=str)
    assert sorted((r["doc_id"], r["n_words"]) for r in rows if r["doc_id"] is not None) == sorted((i, brute(t)[0]) for i, t in texts if i is not None)
    assert s.find_licenses(docs([])).count() == 0


def test_runs_in_the_jvm(docs):
    plan = s.find_licenses(docs(["cc by"])).select("doc_id", "labels")._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|RDD", plan.replace("LocalTableScan", ""))
    assert not re.search("udf|pandas|arrow|rdd", inspect.getsource(s), re.IGNORECASE)
