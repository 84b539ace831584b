import re
from collections import defaultdict

import pytest

from arborsync.llm import line_templates as t


def left(docs):
    return {r["doc_id"]: r["text"] for r in t.deduplicate_lines(docs).collect()}


def masked(line):
    """The shipped reading of one line: numbers are fields where half of the tokens are words."""
    tokens = re.split("[ \\t\\x0b\\f\\r]+", line.strip(" \t\x0b\f\r"))
    words = sum(any(c.isalpha() for c in w) and not any(c in "0123456789" for c in w) for w in tokens)
    if 2 * words < len(tokens):
        return tuple(tokens)
    number = re.compile("(?<![0-9A-Za-z\\x80-\U0010ffff])(?=[0-9A-Fa-f]*[0-9])[0-9A-Fa-f]+(?![0-9A-Za-z\\x80-\U0010ffff])|[0-9]+")
    return tuple(re.sub("0+", "0", re.sub("0(?:[.,]?0)*", "0", number.sub("0", w))) for w in tokens)


def brute(texts):
    """Without merging by likeness: lines that recur in two different texts (five, if short) stay in the first text only."""
    held = defaultdict(list)
    for i, text in texts:
        for line in (text or "").split("\n"):
            if line.strip() and text not in [x for _, x in held[masked(line)]]:
                held[masked(line)].append((i, text))

    def needs(line):
        tokens = masked(line)
        return 5 if len(tokens) < 4 and sum(len(w.encode()) for w in tokens) < 30 else 2

    out = {}
    for i, text in texts:
        if text is None:
            out[i] = None
            continue
        lines = text.split("\n")
        kept = [x for x in lines if not x.strip() or len(held[masked(x)]) < needs(x) or held[masked(x)][0][1] == text]
        if kept == lines or "".join(kept).strip():
            out[i] = "\n".join(kept)
    return out


@pytest.fixture(scope="module")
def planted(prose):
    passage = prose(500, 60).replace("\n", " ")
    rows = [(i, prose(i, 60)) for i in range(4)]
    rows += [(10 + i, prose(10 + i, 30) + "\n" + passage + "\n" + prose(30 + i, 30)) for i in range(5)]
    rows += [(40 + i, f"Request 8{i}7 served by node{i} in {i * 3}ms\n" + prose(40 + i, 40)) for i in range(4)]
    rows += [(60, prose(60, 40)), (61, prose(60, 40)), (62, prose(60, 40)), (63, prose(60, 40))]
    rows += [(70, "All the same line here"), (71, "All the same line here\nAll the same line here"), (72, "x\nAll the same line here"), (73, None), (74, "")]
    rows += [(80 + i, "the end\n" + prose(80 + i, 20)) for i in range(4)]
    rows += [(90 + i, "one short end\n" + prose(90 + i, 20)) for i in range(5)]
    rows += [(100 + i, "exactly four plain words\n" + prose(100 + i, 20)) for i in range(2)]
    rows += [(110 + i, "a" * 26 + " bc d\n" + prose(110 + i, 20)) for i in range(4)]
    rows += [(120 + i, "a" * 27 + " bc d\n" + prose(120 + i, 20)) for i in range(2)]
    rows += [(130 + i, f"only half {i} {i * 7}\n" + prose(130 + i, 20)) for i in range(2)]
    rows += [(140 + i, f"less {i} {i * 7} {i * 5}\n" + prose(140 + i, 20)) for i in range(2)]
    rows += [(150 + i, f"paid 1{i},000.5{i} at shop{i}a by card {i}af\n" + prose(150 + i, 20)) for i in range(2)]
    return rows


def test_matches_brute_force(docs, planted):
    assert left(docs(planted)) == brute(planted)


def test_variable_fields_share_a_template(docs, prose):
    line = "Connection from host {} was closed by remote peer after {} seconds of idle time today"
    rows = [(i, prose(i, 30) + "\n" + line.format(name, "seven")) for i, name in enumerate(("alpha", "beta", "gamma", "delta"))]
    got = left(docs(rows))
    assert got[0] == rows[0][1] or sum(line.split("{}")[0] in v for v in got.values()) == 1
    assert sum("Connection from host" in v for v in got.values()) == 1


def test_copies_of_one_text_do_not_make_a_template(docs, prose):
    rows = [(i, prose(1, 50)) for i in range(6)] + [(9, prose(2, 50))]
    assert left(docs(rows)) == dict(rows)


def test_odd_rows(odd):
    kept = t.deduplicate_lines(odd)
    assert kept.columns == odd.columns
    assert kept.count() == 12 and kept.where("line = 'mine'").count() == 12


def test_empty_table(docs):
    assert t.deduplicate_lines(docs([])).count() == 0


def test_long_texts_are_cut_at_line_ends(prose):
    import tracemalloc

    import pyarrow as pa

    texts = [b"a b c d\n\nlast one\n", None, b"", prose(1, 300).encode(), b"x" * 900 + b"\n" + b"y z"]
    for limit in (1, 7, 100, 1 << 20):
        batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.binary())], names=["_bytes"])
        got = {}
        for pieces in t.line_slices(batch, "_bytes", limit):
            for row, line, piece in pieces:
                for i, one in enumerate(piece.split(b"\n")):
                    got[row, line + i] = one
        assert got == {(r, i): one for r, x in enumerate(texts) for i, one in enumerate((x or b"").split(b"\n"))}

    # A text of 64 MB needs its own size, and little more, at a time.
    text = b"\n".join([b"some 12 words of a line, " + str(i).encode() for i in range(2_000_000)])
    batch = pa.RecordBatch.from_arrays([pa.array([7]), pa.array([b"k"]), pa.array([text], pa.binary())], names=["doc_id", "key", "_bytes"])
    tracemalloc.start()
    rows = sum(out.num_rows for out in t._parse(t.LEADING, t.SEGMENTS, 1)(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 2_000_000 and len(text) > 60 << 20 and peak < len(text) + 60 * (1 << 20)


def test_lines_and_segments():
    found = t.parse_lines([b"a b c d e\nshort one\n\nx1 b c d e", None, b"", b"a b c d e"])
    assert found["text"].tolist() == [0, 0, 3] and found["line_no"].tolist() == [0, 3, 0]
    assert found["line"][:16] == found["line"][32:48] != found["line"][16:32]
    assert found["offsets"].tolist() == [0, 2, 4, 6]
