import random
from collections import Counter, defaultdict

import pytest

from arborsync.llm import jaccard_join as j
from arborsync.llm.components import connected_components
from arborsync.llm.groups import map_groups


def grams(text):
    words = text.split()
    size = min(5, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


def brute(pairs):
    """(doc_id, class_id, n_links, n_copies) of (doc_id, text) rows with words."""
    ids = defaultdict(list)
    for i, text in pairs:
        ids[text].append(i)
    texts = list(ids)
    sets = [grams(t) for t in texts]
    near = [[k for k in range(len(texts)) if k != i and len(sets[i] & sets[k]) >= 0.8 * len(sets[i] | sets[k])] for i in range(len(texts))]
    group = {}
    for i in range(len(texts)):
        todo, met = [i], {i}
        while todo:
            for k in near[todo.pop()]:
                if k not in met:
                    met.add(k)
                    todo.append(k)
        group[i] = min(min(ids[texts[k]]) for k in met)
    return sorted((d, group[i], len(near[i]), len(ids[t])) for i, t in enumerate(texts) for d in ids[t])


def changed(text, seed, times):
    draw = random.Random(seed)
    words = text.split(" ")
    for _ in range(times):
        words[draw.randrange(len(words))] = f"w{draw.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def planted(prose):
    base = [prose(i, 120) for i in range(6)]
    rows = [(i, b) for i, b in enumerate(base)] + [(10 + i, base[0]) for i in range(3)]
    rows += [(100 + i, changed(base[1], i, 1 + i % 3)) for i in range(40)]
    rows += [(200 + i, changed(base[2], i, 9)) for i in range(5)]
    chain = base[3]
    for i in range(6):  # neighbours are similar, ends are not
        chain = changed(chain, 300 + i, 2)
        rows.append((300 + i, chain))
    rows += [(400, "a b c"), (401, "a b c"), (402, "a b"), (403, "a b c d e"), (404, base[4] + " " + base[5]), (405, prose(7, 3000)), (406, prose(7, 3000) + " end")]
    return rows


def answers(found):
    return sorted((r["doc_id"], r["class_id"], r["n_links"], r["n_copies"]) for r in found.collect())


@pytest.mark.parametrize("grams_in_block, texts_in_block", [(300_000, 512), (400, 7)])
def test_matches_brute_force(docs, planted, monkeypatch, grams_in_block, texts_in_block):
    monkeypatch.setattr(j, "BLOCK_SHINGLES", grams_in_block)
    monkeypatch.setattr(j, "BLOCK_TEXTS", texts_in_block)
    assert answers(j.similar_texts(docs(planted))) == brute(planted)


def test_one_stays_of_each_class(docs, planted):
    expected = sorted({c for _, c, _, _ in brute(planted)})
    assert sorted(r["doc_id"] for r in j.one_per_class(docs(planted)).collect()) == expected


def test_odd_rows(odd, prose):
    rows = j.similar_texts(odd).collect()
    assert len(rows) == 12
    assert sorted((r["doc_id"], r["class_id"], r["n_copies"]) for r in rows if r["doc_id"] in (5, 7)) == [(5, 5, 3), (5, 5, 3), (7, 5, 3)]
    assert all(r["class_id"] == r["doc_id"] and r["n_links"] == 0 for r in rows if r["doc_id"] in (None, 0, 1, 2, 3, 4, 8, 9))
    kept = j.one_per_class(odd)
    assert kept.columns == odd.columns
    assert Counter(str(r["doc_id"]) for r in kept.collect()) == Counter(["0", "1", "2", "3", "4", "5", "None", "None", "8", "9"])


def test_empty_table(docs):
    assert j.similar_texts(docs([])).count() == 0
    assert j.one_per_class(docs([])).count() == 0


def test_bands_reach_the_recall():
    for threshold, recall in ((0.8, 0.9999), (0.5, 0.9), (0.9, 0.99)):
        bands, rows = j.choose_bands(threshold, recall)
        assert 1 - (1 - threshold**rows) ** bands >= recall and bands * rows <= 128
    with pytest.raises(ValueError):
        j.choose_bands(0.05, 0.999999, 16)


def test_components(spark):
    draw = random.Random(4)
    edges = [(i, i + 1) for i in range(40)] + [(100 + draw.randrange(30), 100 + draw.randrange(30)) for _ in range(25)] + [(7, 7), (0, 1), (None, 3)]
    root = {x: x for e in edges for x in e if x is not None}
    for _ in range(60):
        for a, b in edges:
            if a is not None:
                root[a] = root[b] = min(root[a], root[b])
    got = {r["node"]: r["label"] for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {k: v for k, v in root.items()}


def test_groups_cross_batches(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        import pyarrow as pa

        rows = [(f"k{i % 9}", i) for i in range(200)]
        add = lambda t: pa.RecordBatch.from_arrays([t.column(0)[:1].combine_chunks(), pa.array([sum(t.column(1).to_pylist())])], names=["key", "total"])
        got = map_groups(spark.createDataFrame(rows, "key string, n bigint"), "key", add, "key string, total bigint").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert sorted((r["key"], r["total"]) for r in got) == sorted((f"k{k}", sum(range(k, 200, 9))) for k in range(9))
