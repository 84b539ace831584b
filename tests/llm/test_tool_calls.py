import json
import random

import pytest

from arborsync.llm import tool_calls as t

CALLS = "conversation bigint, id string, position bigint, tool string, arguments string, needs array<string>"
RESULTS = "conversation bigint, id string, position bigint, content string"
SCHEMAS = {
    "add": {"properties": {"a": {"type": "number", "minimum": 0}, "b": {"type": ["number", "null"]}}, "required": ["a", "b"], "additionalProperties": False},
    "say": {"properties": {"text": {"type": "string", "minLength": 2, "maxLength": 4}, "tone": {"enum": ["low", 7]}, "all": {"type": "boolean"}}},
}


@pytest.fixture
def link(spark):
    def run(calls, results=()):
        linked = t.link_calls(spark.createDataFrame(calls, CALLS), spark.createDataFrame(list(results), RESULTS), SCHEMAS)
        return {(r["conversation"], r["kind"], r["position"]): r for r in linked.collect()}

    return run


def test_links_statuses_and_canonical_json(link):
    rows = link(
        [(1, "x", 0, "add", '{"b": 2.50, "a":1}', []), (1, "y", 2, "say", '{"text":"é/\\"q"}', ["x"]), (1, "x", 4, "add", "{}", []), (1, None, 5, "say", "oops", None)],
        [(1, "x", 1, "3.5"), (1, "zz", 3, "lost"), (2, "x", 0, "other talk"), (1, "x", 6, "again"), (1, None, 7, None)],
    )
    status = {k: r["status"] for k, r in rows.items()}
    assert status == {
        (1, "call", 0): "linked", (1, "call", 2): "unanswered", (1, "call", 4): "duplicate", (1, "call", 5): "unanswered",
        (1, "result", 1): "linked", (1, "result", 3): "orphan", (2, "result", 0): "orphan", (1, "result", 6): "duplicate", (1, "result", 7): "orphan",
    }
    assert rows[1, "call", 0]["json"] == '{"arguments":{"a":1,"b":2.5},"id":"x","kind":"call","needs":[],"tool":"add"}'
    assert rows[1, "call", 5]["json"] == '{"arguments":"oops","kind":"call","tool":"say"}'
    assert json.loads(rows[1, "call", 2]["json"])["arguments"] == {"text": 'é/"q'}
    assert rows[1, "result", 1]["step"] == rows[1, "call", 0]["step"] == 1
    assert rows[1, "call", 4]["step"] is None and rows[1, "result", 3]["step"] is None


def test_order_follows_needs(link):
    rows = link([
        (1, "a", 0, "say", "{}", ["c"]), (1, "b", 1, "say", "{}", []), (1, "c", 2, "say", "{}", ["b"]), (1, "d", 3, "say", "{}", ["a", "b", "gone"]),
        (2, "p", 0, "say", "{}", ["q"]), (2, "q", 1, "say", "{}", ["p"]), (2, "r", 2, "say", "{}", []),
        (3, "m", 0, "say", "{}", []), (3, "n", 1, "say", "{}", ["m"]), (None, "s", 0, "say", "{}", ["s"]),
    ])
    step = {r["id"]: r["step"] for r in rows.values()}
    assert [step[k] for k in "bcad"] == [1, 2, 3, 4] and [step[k] for k in "mn"] == [1, 2] and step["r"] == 1
    errors = {r["id"]: r["errors"] for r in rows.values()}
    assert errors["d"] == ["needs gone: missing"]
    assert errors["p"] == errors["q"] == errors["s"] == ["needs: cyclic"] and errors["r"] == []


@pytest.mark.parametrize("tool, arguments, errors", [
    ("add", '{"a":1,"b":null}', []), ("add", '{"a":-1,"b":"x"}', ["a: minimum", "b: not number or null"]),
    ("add", '{"a":1}', ["b: missing"]), ("add", '{"a":1,"b":2,"c":3}', ["c: not allowed"]), ("add", "[1]", ["arguments: not a JSON object"]),
    ("add", None, ["arguments: not a JSON object"]), ("add", '{"a":1,"a":2}', ["arguments: not a JSON object"]), ("add", "", ["arguments: not a JSON object"]),
    ("say", '{"text":"a","tone":"high"}', ["text: minLength", "tone: not in enum"]), ("say", '{"text":"abcde","tone":7}', ["text: maxLength"]),
    ("say", '{"all":"yes","text":5}', ["all: not boolean", "text: not string"]), ("none", "{}", ["tool: unknown"]), (None, "{}", ["tool: unknown"]),
])
def test_schema_errors(link, tool, arguments, errors):
    (row,) = link([(1, "x", 0, tool, arguments, None)]).values()
    assert row["errors"] == errors and row["n_errors"] == len(errors)


def test_one_conversation_may_hold_most_calls(link, spark):
    calls = [(1, f"c{i}", i, "say", "{}", [f"c{i - 1}"] if i else []) for i in range(500)] + [(2, "z", 0, "say", "{}", [])]
    rows = link(calls)
    assert [rows[1, "call", i]["step"] for i in range(500)] == list(range(1, 501)) and rows[2, "call", 0]["step"] == 1


def test_repeated_rows_and_empty_tables(link, spark):
    linked = t.link_calls(
        spark.createDataFrame([(1, "x", 0, "say", "{}", []), (1, "x", 0, "say", "{}", [])], CALLS), spark.createDataFrame([], RESULTS), SCHEMAS)
    assert [(r["status"], r["step"]) for r in linked.collect()] == [("unanswered", 1)] * 2
    assert link([]) == {}


def brute_levels(needs):
    """Longest way of needs of each call, None on or behind a circle."""
    level, open_calls = {}, dict(needs)
    while True:
        free = [k for k, n in open_calls.items() if all(x in level for x in n)]
        if not free:
            return level | {k: None for k in open_calls}
        level |= {k: 1 + max((level[x] for x in open_calls[k]), default=-1) for k in free}
        open_calls = {k: n for k, n in open_calls.items() if k not in free}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_levels_of_random_needs(spark, seed):
    draw = random.Random(seed)
    needs, nodes, edges = {}, [], []
    for c in range(12):
        keys = [f"{c}-{i}" for i in range(draw.choice([1, 5, 25]))]
        for i, key in enumerate(keys):
            back = keys[:i] if c % 3 else keys
            needs[key] = set(draw.sample(back, min(len(back), draw.choice([0, 1, 1, 1, 2, 3]))))
            nodes.append((str(c), key, draw.randrange(10)))
            edges += [(str(c), key, n) for n in needs[key]]
    found = t.topological_levels(
        spark.createDataFrame(nodes, "conversation string, key string, position bigint"), spark.createDataFrame(edges, "conversation string, key string, needs string"))
    got = {r["key"]: (r["conversation"], None if r["cyclic"] else r["level"]) for r in found.collect()}
    position = {k: p for _, k, p in nodes}
    late = {c for c, k, n in edges if position[n] >= position[k]}
    want = brute_levels(needs)
    assert got == {k: (c, want[k] if c in late else 0) for c, k, _ in nodes} and late


def test_a_long_chain_in_reverse_takes_few_rounds(spark, monkeypatch):
    rounds = []
    original = t.stage
    monkeypatch.setattr(t, "stage", lambda df, label: rounds.append(label) or original(df, label))
    n = 10_000
    nodes = spark.range(n).selectExpr("'c' as conversation", "cast(id as string) as key", "id as position")
    edges = spark.range(n - 1).selectExpr("'c' as conversation", "cast(id as string) as key", "cast(id + 1 as string) as needs")
    found = t.topological_levels(nodes, edges)
    assert found.where(f"level = {n} - 1 - cast(key as bigint)").count() == n
    assert rounds.count("free") <= 20


def test_ties_and_further_columns(spark):
    calls = spark.createDataFrame([(1, "x", 0, "say", "{}", ["b"], "mine"), (1, "x", 0, "say", "{}", ["a"], "mine"), (1, "y", 0, "say", "{}", [], "mine")], CALLS + ", status string")
    results = spark.createDataFrame([(1, "x", 0, "2", 5), (1, "x", 0, "1", 5)], RESULTS + ", step int")
    rows = sorted((r["kind"], r["id"], r["status"], r["json"]) for r in t.link_calls(calls, results, SCHEMAS).collect())
    assert [r[2] for r in rows] == ["duplicate", "linked", "unanswered", "duplicate", "linked"] or [r[2] for r in rows] == ["linked", "duplicate", "unanswered", "linked", "duplicate"]
    assert [r[3] for r in rows if r[2] == "linked"] == ['{"arguments":{},"id":"x","kind":"call","needs":["a"],"tool":"say"}', '{"content":"1","id":"x","kind":"result"}']
