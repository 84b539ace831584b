import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from arborsync.operators import history


def rows(seed, n=300):
    rng = random.Random(seed)
    times = [datetime(1960, 1, 1) + timedelta(days=rng.randrange(20_000), microseconds=rng.randrange(10**6)) for _ in range(40)]
    commits = [(rng.choice("rs"), f"{rng.choice(['aaaaaaaaaa', '', 'b', 'é'])}{i}", rng.choice(times), f"me{i}", f"m{i}\nmore") for i in range(n)]
    touches = [(r, f"p{rng.randrange(25)}", sha) for r, sha, *_ in commits for _ in range(rng.randint(0, 3))] + [("r", "p1", "unknown")]
    return commits, touches


def brute(commits, touches):
    told = {(r, sha): (ts, sha.encode(), author, message) for r, sha, ts, author, message in commits}
    newest = {}
    for r, path, sha in touches:
        if (r, sha) in told:
            newest[r, path] = max(newest.get((r, path), (datetime.min,)), told[r, sha])
    return {k: (sha.decode(), ts, author, message.split("\n")[0]) for k, (ts, sha, author, message) in newest.items()}


def shown(df):
    columns = ("last_commit_sha", "last_commit_time", "last_commit_author", "last_commit_message")
    return {(r["repo_id"], r["path"]): tuple(r[c] for c in columns) for r in df.collect()}


def tables(spark, commits, touches, kind):
    made = spark.createDataFrame(commits, f"repo_id string, sha string, ts timestamp_ntz, author string, message string")
    return made.withColumn("ts", F.col("ts").cast(kind)), spark.createDataFrame(touches, "repo_id string, path string, sha string")


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_newest_commit_with_ties(spark, kind):
    commits, touches = rows(1)
    held, touched = tables(spark, commits, touches, kind)
    got = {k: (a, b.replace(tzinfo=None), c, d) for k, (a, b, c, d) in shown(history.last_commit_per_file(touched, held.withColumn("ts", F.col("ts")))).items()}
    assert got == brute(commits, touches)
    plan = history.last_commit_per_file(touched, held)._jdf.queryExecution().toString()
    assert "HashAggregate(keys=[repo_id" in plan and "SortAggregate" not in plan


def test_state_plus_new_touches_equals_the_full_run(spark, tmp_path):
    commits, touches = rows(2)
    path = str(tmp_path / "state")
    schema = None
    for segment in (0, 1, 2, 2):
        part = commits[100 * segment : 100 * segment + 100]
        own = {(r, sha) for r, sha, *_ in part}
        held, touched = tables(spark, part, [t for t in touches if (t[0], t[2]) in own], "timestamp_ntz")
        history.ingest_touches(touched, held, path, segment)
        schema = history.last_commit_per_file(touched, held).schema
    want = brute(commits, touches)
    assert shown(history.stored_last_commits(spark, path, schema)) == want
    wanted = spark.createDataFrame([("r", "p1"), ("s", "p2"), ("r", "none")], "repo_id string, path string")
    some = shown(history.stored_last_commits(spark, path, schema, wanted))
    assert some == {k: v for k, v in want.items() if k in {("r", "p1"), ("s", "p2")}} and some


def test_an_ingest_shuffles_no_touch_of_other_commits(spark, tmp_path, monkeypatch):
    """Five ingests by month bring each touch once, to the ingest of its commit."""
    from arborsync.sources import virtual

    months = [datetime(1995, 1 + i % 12, 3) for i in range(60)]
    spark.createDataFrame([(i, t, "1-URGENT", "O") for i, t in enumerate(months)], "o_orderkey long, o_orderdate timestamp_ntz, o_orderpriority string, o_orderstatus string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(i % 60, i % 7) for i in range(200)], "l_orderkey long, l_partkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    brought, original = [], history.ingest_touches
    monkeypatch.setattr(history, "ingest_touches", lambda touched, *rest: brought.append(touched.count()) or original(touched, *rest))
    found = shown(virtual.last_commits(spark, str(tmp_path)))
    assert sum(brought) == 200
    assert found == shown(history.last_commit_per_file(virtual.touches(spark, str(tmp_path)), virtual.touch_commits(spark, str(tmp_path))))


def test_codes_need_no_sort_of_commits(spark):
    """Times and first bytes rarely agree; only then are commits sorted for their codes."""
    commits = [("r", f"{i:040x}"[::-1], datetime(2000, 1, 1), "me", "m") for i in range(50)]
    touches = [("r", f"p{i % 5}", sha) for i, (_, sha, *_) in enumerate(commits)]
    held, touched = tables(spark, commits, touches, "timestamp_ntz")
    newest = history.last_commit_per_file(touched, held)
    assert "Window" not in newest._jdf.queryExecution().toString()
    assert shown(newest) == brute(commits, touches)


def test_history_counts_a_touch_told_twice_once(spark):
    commits = [("r", f"c{i}", datetime(2000, 1, 1 + i // 2), "me", "m") for i in range(8)]
    touches = [("r", "p", f"c{i}") for i in range(8) for _ in range(3)]
    held, touched = tables(spark, commits, touches, "timestamp_ntz")
    found = history.file_history(touched, held, 5)
    assert sorted((r["n"], r["sha"]) for r in found.collect()) == [(i + 1, f"c{7 - i}") for i in range(5)]
    assert "Aggregate" not in found._jdf.queryExecution().toString()
