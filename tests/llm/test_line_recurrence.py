"""Which lines recur: how many texts it takes, short lines, all pairs of a leaf, numbers."""

import itertools
import math
import random

from arborsync.llm import line_templates as t


def left(docs):
    return {r["doc_id"]: r["text"] for r in t.deduplicate_lines(docs).collect()}


def test_passage_in_exactly_two_texts(docs, prose):
    passage = prose(900, 60).replace("\n", " ")
    wrapped = prose(901, 60)
    rows = [(1, prose(1, 30) + "\n" + passage), (2, passage + "\n" + prose(2, 30)), (3, prose(3, 30) + "\n" + wrapped), (4, wrapped + "\n" + prose(4, 30))]
    rows += [(5, prose(5, 30)), (6, prose(5, 30))]
    assert left(docs(rows)) == {**dict(rows), 2: prose(2, 30), 4: prose(4, 30)}


def test_short_lines_and_scripts_without_spaces(docs, prose):
    chinese = "本网站的所有内容均受版权法保护未经许可不得转载"
    rows = [(i, prose(i, 30) + "\nAll rights reserved." + ("\nrare end" if i < 4 else "") + ("\n" + chinese if i > 5 else "")) for i in range(8)]
    got = left(docs(rows))
    assert [i for i, text in got.items() if "All rights reserved." in text] == [0]
    assert [i for i, text in got.items() if "rare end" in text] == [0, 1, 2, 3]
    assert [i for i, text in got.items() if chinese in text] == [6]
    assert all(text.startswith(prose(i, 30)) for i, text in got.items())
    assert t.parse_lines([b"one"], least=1)["offsets"].tolist() == [0, 0]


def grouped(pairs, nodes):
    """The least member of each node's group."""
    root = {n: n for n in nodes}
    for a, b in pairs:
        low, high = sorted((root[a], root[b]))
        root = {n: low if r == high else r for n, r in root.items()}
    return root


def test_all_pairs_of_a_leaf_are_compared(spark, docs):
    draw = random.Random(5)
    lines = []
    for size in (5, 7, 8, 9, 10, 11, 17):
        for _ in range(60):
            lines.append("one two three " + " ".join(draw.choice("abc") for _ in range(size - 3)))
    lines = sorted(set(lines))
    found = t.parse_lines([x.encode() for x in lines], least=1)
    name = [found["line"][16 * i : 16 * i + 16] for i in range(len(lines))]
    parts = [found["values"][a:b].tolist() for a, b in zip(found["offsets"], found["offsets"][1:])]
    rows = [(int(leaf), line, own) for leaf, line, own in zip(found["leaf"], name, parts)]
    table = spark.createDataFrame(rows, "leaf bigint, line binary, segments array<int>")
    got = [(bytes(r["a"]), bytes(r["b"])) for r in t._alike(table, 0.75).collect()]
    want = [
        (x[1], y[1]) for x, y in itertools.combinations(rows, 2)
        if x[0] == y[0] and sum(p == q for p, q in zip(x[2], y[2])) >= math.ceil(0.75 * len(x[2]))
    ]
    assert grouped(got, name) == grouped(want, name) and len(set(grouped(want, name).values())) < len(lines)


def test_frequent_lines_do_not_hide_a_template(docs, prose):
    line = "one two three a1 b c d e f g h".replace("a1", "a").split()
    variants = [" ".join(line[:8] + [*tail]) for tail in (["f", "g", "w"], ["f", "y", "h"], ["z", "g", "h"])]
    models = ["one two three a b c d e q r s", "one two three m n o p u f g h"]
    rows = [(i, prose(i, 30) + "\n" + v) for i, v in enumerate(variants)]
    rows += [(10 + i, prose(10 + i, 30) + "\n" + models[i % 2]) for i in range(10)]
    got = left(docs(rows))
    assert [i for i in range(3) if variants[i] in got[i]] == [0]
    assert [i for i in range(10, 20) if "one two three" in got[i]] == [10, 11]


def same(one, other):
    found = t.parse_lines([one.encode(), other.encode()], least=1)["line"]
    return found[:16] == found[16:32]


def test_fields_are_numbers_only():
    assert same("took 12 ms for node7 at 10:31", "took 3,250.75 ms for node12 at 9:05")
    assert same("session 9f3ab2c1 closed by peer", "session 04d closed by peer")
    assert same("the total is price=12 here", "the total is price=7 here")
    assert not same("the total is price=12 here", "the total is qty=7 here")
    assert not same("x é12 a b", "x è12 a b")
    assert not same("2019 31.5 44 12", "2020 31.5 44 12") and same("2019 31.5 44 12", "2019  31.5 44 12")
    assert not same("| 12 | 13 |", "| 12 | 14 |") and not same("12", "13")
    found = t.parse_lines([b"7 8 9 1 2 3 4 5 6 7 8\nthe 1 is not a 2 but 3 of the rest"])
    assert found["offsets"].tolist() == [0, 0, 8]


def test_tables_of_numbers_stay(docs, prose):
    draw = random.Random(6)
    table = lambda: "\n".join(" ".join(str(draw.randrange(10_000)) for _ in range(4)) for _ in range(10))
    # Zeros and ones of one leaf that differ in one number.
    flags = lambda i: "\n".join("0 0 0 " + " ".join(str(int(k == i * 4 + j)) for k in range(16)) for j in range(4))
    rows = [(i, prose(i, 30) + "\n" + table()) for i in range(4)] + [(10 + i, prose(10 + i, 30) + "\n" + flags(i)) for i in range(4)]
    shared = "\n1999 28.5 41 11"
    rows += [(20, prose(20, 30) + shared), (21, prose(21, 30) + shared)]
    assert left(docs(rows)) == {**dict(rows), 21: prose(21, 30)}
