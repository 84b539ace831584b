import random

import pytest

from arborsync.operators import graph

COMMITS = "repo_id string, sha string, parents array<string>"


def random_history(rng, repo, n):
    """Random DAG: long runs, forks and merges; now and then a parent that was never ingested."""
    rows, tips = [], []
    for i in range(n):
        sha = f"{repo}-{rng.randrange(10**6):06d}-{i}"
        if not tips or rng.random() < 0.03:
            parents = ["missing"] if rng.random() < 0.5 else []
        elif rng.random() < 0.7:
            parents = [tips[-1]]
        else:
            parents = rng.sample(tips[-30:], min(len(tips), rng.choice([1, 2, 2, 3])))
        rows.append((repo, sha, parents))
        tips.append(sha)
    return rows


def ancestors(rows):
    parents = {sha: ps for _, sha, ps in rows}
    found = {}
    for _, sha, ps in rows:
        found[sha] = {sha}.union(*[found[p] for p in ps if p in parents])
    return found


@pytest.mark.parametrize("seed", [1, 2])
def test_random_graphs(spark, seed, monkeypatch):
    monkeypatch.setattr(graph, "BLOCK", 7)
    rng = random.Random(seed)
    histories = {r: random_history(rng, r, n) for r, n in (("a", 150), ("b", 40), ("c", 1))}
    commits = spark.createDataFrame([row for rows in histories.values() for row in rows], COMMITS)
    known = {repo: ancestors(rows) for repo, rows in histories.items()}

    index = graph.chain_index(commits)
    places = {(r["chain"], r["pos"]) for r in index.collect()}
    assert len(places) == commits.count()

    pairs, expected = [], {}
    for repo, rows in histories.items():
        shas = [sha for _, sha, _ in rows]
        for _ in range(12):
            old, new = rng.choice(shas), rng.choice(shas)
            reach = known[repo]
            expected[repo, old, new] = (old in reach[new], len(reach[new] - reach[old]))
        expected[repo, "nowhere", shas[-1]] = (False, None)
    pairs = spark.createDataFrame(list(expected), "repo_id string, old_sha string, new_sha string")
    got = graph.compare_commits(pairs, commits, index).collect()
    assert {(r["repo_id"], r["old_sha"], r["new_sha"]): (r["is_reachable"], r["distance"]) for r in got} == expected

    heads = spark.createDataFrame([(repo, rows[-1][1]) for repo, rows in histories.items()], "repo_id string, head string")
    listed = {(r["repo_id"], r["sha"]) for r in graph.ancestors(heads, commits, index).collect()}
    assert listed == {(repo, sha) for repo, rows in histories.items() for sha in known[repo][rows[-1][1]]}


@pytest.mark.parametrize("seed", [3, 4])
def test_an_index_grown_in_ingests(spark, tmp_path, seed):
    """Commits placed in four ingests, one of them twice: the same answers, and stored places never move."""
    rng = random.Random(seed)
    histories = {r: random_history(rng, r, n) for r, n in (("a", 160), ("b", 30))}
    path, places = str(tmp_path / "index"), {}
    for segment in (0, 1, 2, 2, 3):
        rows = [row for rows in histories.values() for row in rows[len(rows) * segment // 4 : len(rows) * (segment + 1) // 4]]
        again = [rows[0] for rows in histories.values()] if segment == 3 else []
        graph.ingest_commits(spark.createDataFrame(rows + again, COMMITS), path, segment)
        got = {(r["repo_id"], r["sha"]): (r["chain"], r["pos"]) for r in graph.read_index(spark, path).places.collect()}
        assert all(got[k] == v for k, v in places.items()) and len(set(got.values())) == len(got)
        places = got
    index = graph.read_index(spark, path)
    assert index.places.count() == len(places) == 190
    ends = {}
    for (_, sha), (chain, pos) in places.items():
        ends.setdefault(chain, []).append(pos)
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in ends.values())
    pairs, expected = [], {}
    for repo, rows in histories.items():
        reach, shas = ancestors(rows), [sha for _, sha, _ in rows]
        for _ in range(15):
            old, new = rng.choice(shas), rng.choice(shas)
            expected[repo, old, new] = (old in reach[new], len(reach[new] - reach[old]))
        expected[repo, "nowhere", shas[-1]] = (False, None)
    pairs = spark.createDataFrame(list(expected), "repo_id string, old_sha string, new_sha string")
    got = graph.compare_commits(pairs, None, index).collect()
    assert {(r["repo_id"], r["old_sha"], r["new_sha"]): (r["is_reachable"], r["distance"]) for r in got} == expected


def test_an_ingest_goes_on_where_a_chain_ends(spark, tmp_path):
    path = str(tmp_path / "index")
    line = [("r", f"{i:03d}", [f"{i - 1:03d}"] if i else []) for i in range(50)]
    graph.ingest_commits(spark.createDataFrame(line[:40], COMMITS), path, 0)
    side = [("r", f"s{i}", ["039" if i == 0 else f"s{i - 1}"]) for i in range(3)]
    graph.ingest_commits(spark.createDataFrame(line[40:] + side, COMMITS), path, 1)
    places = {r["sha"]: (r["chain"], r["pos"]) for r in graph.read_index(spark, path).places.collect()}
    assert places["049"] == ("000", 50) and places["s2"] == ("s0", 3)  # the heavier branch goes on
    # A commit behind the middle of a chain starts its own.
    graph.ingest_commits(spark.createDataFrame([("r", "late", ["020"]), ("x", "alone", ["049"])], COMMITS), path, 2)
    index = graph.read_index(spark, path)
    places = {(r["repo_id"], r["sha"]): (r["chain"], r["pos"]) for r in index.places.collect()}
    assert places["r", "late"] == ("late", 1) and places["x", "alone"] == ("alone", 1)
    heads = spark.createDataFrame([("r", "late"), ("x", "alone")], "repo_id string, head string")
    assert graph.ancestors(heads, None, index).groupBy("head").count().collect() and graph.ancestors(heads, None, index).count() == 23


def test_long_chain_takes_few_rounds(spark, monkeypatch):
    rounds = []
    original = graph.stage
    monkeypatch.setattr(graph, "stage", lambda df, label: rounds.append(label) or original(df, label))
    n = 3000
    rows = [("r", f"{i:05d}", [f"{i - 1:05d}"] if i else []) for i in range(n)]
    index = graph.chain_index(spark.createDataFrame(rows, COMMITS))
    assert index.where("pos = 3000").first()["sha"] == f"{n - 1:05d}"
    assert index.select("chain").distinct().count() == 1
    assert rounds.count("chains") <= 8


def test_main_line_is_not_broken_by_dead_ends(spark, monkeypatch):
    """Dead-end branches and merges all along a history cost no rounds of their own."""
    n = 600
    rows = []
    for i in range(n):
        parents = [f"{i - 1:05d}"] if i else []
        if i > 3 and i % 11 == 3:
            parents = [f"{i - 2:05d}"]
        elif i > 3 and i % 5 == 0:
            parents = [f"{i - 1:05d}", f"{i - 4:05d}"]
        rows.append(("r", f"{i:05d}", parents))
    known = ancestors(rows)
    commits = spark.createDataFrame(rows, COMMITS)
    index = graph.chain_index(commits)
    rounds = []
    original = graph.stage
    monkeypatch.setattr(graph, "stage", lambda df, label: rounds.append(label) or original(df, label))
    old, new = f"{n // 2:05d}", f"{n - 1:05d}"
    pairs = spark.createDataFrame([("r", old, new)], "repo_id string, old_sha string, new_sha string")
    row = graph.compare_commits(pairs, commits, index).first()
    assert (row["is_reachable"], row["distance"]) == (old in known[new], len(known[new] - known[old]))
    assert rounds.count("reach") <= 5


def test_plan_modes(spark):
    from arborsync.plans.sync_plan import plan_syncs

    rows = [("r", f"{i:05d}", [f"{i - 1:05d}"] if i else []) for i in range(1100)]
    commits = spark.createDataFrame(rows, COMMITS)
    head = "01099"
    cases = {
        "none": (None, 0, "full", "first_sync"), "same": (head, 0, "noop", "unchanged"),
        "retry": (head, 3, "incremental", "retry_only"), "edge": ("00099", 0, "incremental", "changes"),
        "far": ("00098", 0, "incremental", "changes"), "lost": ("gone", 0, "full", "history_rewritten"),
    }
    sources = spark.createDataFrame([(c, "r", head) for c in cases], "config_hash string, repo_id string, head_sha string")
    state = spark.createDataFrame([(c, v[0], v[1]) for c, v in cases.items()], "config_hash string, last_sha string, n_failed long")
    got = {r["config_hash"]: (r["mode"], r["reason"], r["distance"]) for r in plan_syncs(sources, state, commits).collect()}
    assert {c: v[:2] for c, v in got.items()} == {c: v[2:] for c, v in cases.items()}
    assert got["edge"][2] == 1000 and got["far"][2] == 1001 and got["same"][2] == 0 and got["lost"][2] is None


@pytest.mark.parametrize("seed", [5, 6])
def test_a_pass_over_repositories_answers_like_rounds(spark, tmp_path, monkeypatch, seed):
    """Repositories within the limits of a pass, beyond them and of both kinds: one index, one set of answers."""
    monkeypatch.setattr(graph, "PUSHED_KEYS", 0)
    rng = random.Random(seed)
    histories = {f"r{i}": random_history(rng, f"r{i}", n) for i, n in enumerate((90, 25, 25, 3, 1))}
    known = {repo: ancestors(rows) for repo, rows in histories.items()}
    pairs, told = {}, []
    for repo, rows in histories.items():
        shas = [sha for _, sha, _ in rows]
        for _ in range(6):
            old, new = rng.choice(shas), rng.choice(shas)
            pairs[repo, old, new] = (old in known[repo][new], len(known[repo][new] - known[repo][old]))
        pairs[repo, "nowhere", shas[0]] = pairs[repo, shas[0], "nowhere"] = (False, None)
    asked = spark.createDataFrame(list(pairs), "repo_id string, old_sha string, new_sha string")
    for rows_in_pass in (50_000, 30, 0):
        monkeypatch.setattr(graph, "PASS_ROWS", rows_in_pass)
        path = str(tmp_path / str(rows_in_pass))
        for segment in (0, 1):
            rows = [row for rows in histories.values() for row in (rows[len(rows) // 2:] if segment else rows[: len(rows) // 2])]
            graph.ingest_commits(spark.createDataFrame(rows, COMMITS), path, segment)
        index = graph.read_index(spark, path)
        told.append([sorted(map(tuple, t.drop("segment").collect())) for t in (index.places, index.links, index.tails)])
        got = graph.compare_commits(asked, None, index).collect()
        assert {(r["repo_id"], r["old_sha"], r["new_sha"]): (r["is_reachable"], r["distance"]) for r in got} == pairs
        heads = asked.select("repo_id", asked.new_sha.alias("head")).distinct()
        listed = {(r["repo_id"], r["head"], r["sha"]) for r in graph.ancestors(heads, None, index).collect()}
        assert listed == {(repo, new, sha) for repo, _, new in pairs if new != "nowhere" for sha in known[repo][new]}
    assert told[0] == told[1] == told[2]


def test_small_repositories_take_no_rounds(spark, tmp_path, monkeypatch):
    """What is written does not grow with the length of a history: every table once, whatever the depth."""
    labels = []
    original = graph.stage
    monkeypatch.setattr(graph, "stage", lambda df, label: labels.append(label) or original(df, label))
    monkeypatch.setattr(graph, "PUSHED_KEYS", 10)
    rows = [(f"r{r}", f"{r}-{i:03d}", [f"{r}-{i - 1 - (i > 1 and i % 5 == 1):03d}"] if i else []) for r in range(20) for i in range(40)]
    for segment in (0, 1):
        part = [row for row in rows if (int(row[1][-3:]) >= 37) == segment]
        graph.ingest_commits(spark.createDataFrame(part, COMMITS), str(tmp_path / "index"), segment)
    pairs = [(f"r{r}", f"{r}-036", f"{r}-039") for r in range(20)]
    asked = spark.createDataFrame(pairs, "repo_id string, old_sha string, new_sha string")
    got = graph.compare_commits(asked, None, graph.read_index(spark, str(tmp_path / "index"))).collect()
    assert len(got) == 20 and all(r["is_reachable"] and r["distance"] == 3 for r in got)
    assert not {"sizes", "chains", "reach"} & set(labels)
    assert len(labels) <= 11
