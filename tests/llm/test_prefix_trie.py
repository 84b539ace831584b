import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from arborsync.llm import prefix_trie as p

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def brute(conversations):
    """conversations: id -> [(role, text)]. The trie as a dictionary of prefixes."""
    members, ends = {}, {}
    for c, turns in conversations.items():
        turns = tuple((r or "", t or "") for r, t in turns)
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
        ends.setdefault(turns, []).append(c)
    children = {}
    for key in members:
        if key:
            children.setdefault(key[:-1], []).append(key)
    totals = {}
    for key in sorted(members, key=len, reverse=True):
        own = (len(members[key]) - 1) * len(key[-1][1].encode()) if key else 0
        below = [totals[k] for k in children.get(key, ())]
        totals[key] = (sum(b[0] for b in below) or 1, own + sum(b[1] for b in below))
    return sorted(
        (min(m), len(k), min(members[k[:-1]]) if k else -1, len(m), len(children.get(k, ())), *totals[k],
         hashlib.sha256(",".join(map(str, sorted(ends.get(k, ())))).encode()).hexdigest()) for k, m in members.items())


def rows_of(trie):
    return sorted((r["conv_id"], r["depth"], -1 if r["parent_conv_id"] is None else r["parent_conv_id"], *tuple(r)[3:]) for r in trie.collect())


@pytest.fixture
def table(spark):
    return lambda conversations: spark.createDataFrame(
        [(c, i, role, text) for c, turns in conversations.items() for i, (role, text) in enumerate(turns)], SCHEMA)


def trie(table, conversations, blank=(), **options):
    turns = p.hashed_turns(table)
    ids = turns.select("conv_id").union(table.sparkSession.createDataFrame([(c,) for c in blank], "conv_id bigint"))
    return rows_of(p.prefix_trie(turns, ids, **options))


def drawn(seed, count, longest=7, letters="ab"):
    draw = random.Random(seed)
    return {c * 3 - 40: [(draw.choice(("user", "assistant")), draw.choice(letters) * draw.randint(1, 2)) for _ in range(draw.randint(1, longest))] for c in range(count)}


@pytest.mark.parametrize("block", [1, 5, 40, 1 << 18])
def test_equals_brute_force(table, block):
    held = drawn(block, 150)
    assert trie(table(held), held, blank=(-2, 5_000), block_turns=block) == brute({**held, -2: [], 5_000: []})


def test_long_conversations_are_cut_into_segments(table):
    held = drawn(8, 120, 20, "a")
    held |= {1000 + i: held[2] for i in range(40)} | {2000 + i: held[-40 + 3 * i] + held[-40] for i in range(20)}
    for block in (4, 1 << 18):
        assert trie(table(held), held, blank=(7_000,), block_turns=block, segment=3) == brute({**held, 7_000: []})


def test_segments_at_their_shipped_size(table):
    draw = random.Random(1)
    long = [("user", draw.choice("xyz")) for _ in range(200)]
    held = {1: long, 2: long[:64], 3: long[:128], 4: long[:65], 5: long[:64], 6: long[:150] + [("user", "q")], 9: long, 0: long[:63]}
    assert trie(table(held), held) == brute(held)


def test_groups_of_copies_over_many_ranges(table, spark):
    held = {c: [("user", "hello"), ("assistant", "same")] for c in range(400)} | {1000 + c: [("user", "hello"), ("assistant", str(c % 9))] for c in range(200)}
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        got = trie(table(held), held, block_turns=20)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    assert got == brute(held)


def test_stretches_against_a_scan():
    draw = np.random.default_rng(3)
    for rows in (1, 2, 3, 7, 8, 9, 40):
        lcp = np.concatenate(([-1], draw.integers(-1, 4, rows - 1), [-1]))
        row, depth = map(np.array, zip(*itertools.product(range(rows), range(5))))
        left, right = p.stretches(lcp, row, depth)
        for i, d, low, high in zip(row, depth, left, right):
            a = b = i
            while a > 0 and lcp[a] >= d:
                a -= 1
            while b < rows - 1 and lcp[b + 1] >= d:
                b += 1
            assert (low, high) == (a, b)


def test_rebuilt_conversations(table):
    held = drawn(4, 60, 12)
    turns = p.hashed_turns(table(held))
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    got = rows_of(p.prefix_trie(p.rebuilt(turns, head, F.col("conv_id") - F.col("conv_id") % 5, 8), turns.select("conv_id")))
    want = {}
    for c, own in held.items():
        h = zlib.crc32(str(c).encode()) % 9
        source = c - int(np.fmod(c, 5))
        want[c] = held.get(source, [])[:h] + own[h:]
    assert got == brute(want) and any(not turns for turns in want.values())


def test_nulls_ties_repeats_and_order(spark):
    rows = [
        (1, None, "user", "first"), (1, 5, None, None), (1, 2, "user", "x"), (2, 1, "user", "first"), (2, 2, "user", "x"), (2, 9, "", ""),
        (3, 4, "b", "y"), (3, 4, "a", "y"), (4, 4, "a", "y"), (4, 4, "b", "y"), (5, 1, "a", "y"), (5, 1, "a", "y"), (None, 1, "user", "lost"),
        (6, 0, "user", "é" * 70_000),
    ]
    table = spark.createDataFrame([(*r, "mine", 7) for r in rows], SCHEMA + ", node string, depth bigint")
    turns = p.hashed_turns(table)
    got = rows_of(p.prefix_trie(turns, turns.select("conv_id")))
    digest = lambda r, t: hashlib.md5(f"{len(r.encode())}:{r}{t}".encode()).hexdigest()
    tied = sorted([("a", "y"), ("b", "y")], key=lambda x: digest(*x))
    first = [("user", "first"), ("user", "x"), ("", "")]
    assert got == brute({1: first, 2: first, 3: tied, 4: tied, 5: [("a", "y")] * 2, 6: [("user", "é" * 70_000)]})


def test_empty_table(spark):
    turns = p.hashed_turns(spark.createDataFrame([], SCHEMA))
    assert p.prefix_trie(turns, turns.select("conv_id")).count() == 0
    blank = spark.createDataFrame([(4,), (2,), (None,)], "conv_id bigint")
    assert rows_of(p.prefix_trie(turns, blank)) == brute({2: [], 4: []})
