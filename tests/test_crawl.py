import random
from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from arborsync import schemas
from arborsync.operators.batching import assign_batches, batch_progress
from arborsync.plans import crawl, metrics
from arborsync.plans import state as sync_state
from arborsync.plans.crawl import Repository


def outcomes(spark, kinds, key="c"):
    rows = [(key, f"{i:05d}", k, k == "read_error") for i, k in enumerate(kinds)]
    return spark.createDataFrame(rows, "config_hash string, path string, outcome string, is_transient boolean")


def progress(spark, kinds):
    sources = spark.createDataFrame([("c",)], "config_hash string")
    rows = batch_progress(assign_batches(outcomes(spark, kinds)), sources).orderBy("batch_no").collect()
    return [(r["documents"], r["failed"], r["completed"], r["total"], r["status"]) for r in rows]


def test_batches_close_at_their_fiftieth_success(spark):
    assert progress(spark, ["ok"] * 120) == [
        (50, 0, 50, 120, "processing"), (50, 0, 100, 120, "processing"), (20, 0, 120, 120, "completed"),
    ]
    assert [p[:3] for p in progress(spark, ["ok"] * 100)] == [(50, 0, 50), (50, 0, 100)]
    assert [p[:3] for p in progress(spark, ["ok"] * 100 + ["binary"] * 3)] == [(50, 0, 50), (50, 0, 100), (0, 0, 103)]
    assert progress(spark, ["not_found"] * 2) == [(0, 0, 2, 2, "completed")]
    assert progress(spark, ["ok", "ok", "read_error"] * 3) == [(6, 3, 9, 9, "completed")]
    assert progress(spark, []) == [(0, 0, 0, 0, "completed")]


@pytest.mark.parametrize("seed", [1, 40])
def test_batches_follow_the_loop(spark, seed):
    rng = random.Random(seed)
    kinds = [rng.choice(["ok", "ok", "binary", "read_error"]) for _ in range(400)]
    expected, batch, good = [], 0, 0
    for kind in kinds:
        expected.append(batch)
        good += kind == "ok"
        if good == 50:
            batch, good = batch + 1, 0
    rows = assign_batches(outcomes(spark, kinds)).orderBy("path").collect()
    assert [r["batch_no"] for r in rows] == expected
    assert [r["attempted"] for r in rows] == list(range(1, 401))


def repository(spark, files_by_commit, state=(), failed=(), errors=(), subdir="", extensions=""):
    """One repository with a straight history of the given snapshots {path: bytes}."""
    shas = [f"c{i}" for i in range(len(files_by_commit))]
    tree, blobs = [], {}
    for sha, files in zip(shas, files_by_commit):
        for path, content in files.items():
            blob = f"blob-{hash(content)}"
            blobs[blob] = (blob, None if path in errors else bytearray(content), "io" if path in errors else None)
            tree.append(("r", sha, path, "120000" if path.endswith(".link") else "100644", blob, len(content)))
    commits = [("r", sha, shas[i - 1 : i] if i else []) for i, sha in enumerate(shas)]
    make = spark.createDataFrame
    return Repository(
        sources=make([("r", "https://x/r.git", None, subdir, extensions)], schemas.SOURCES),
        refs=make([("r", "refs/remotes/origin/main", "remote", shas[-1])], schemas.REFS),
        commits=make(commits, "repo_id string, sha string, parents array<string>"),
        tree=make(tree, schemas.TREE_ENTRIES),
        blobs=make(list(blobs.values()), schemas.BLOBS),
        sync_state=make(list(state), schemas.SYNC_STATE),
        failed_paths=make(list(failed), schemas.FAILED_PATHS),
    )


FIRST = {"docs/a.md": b"a", "docs/b.md": b"b", "docs/c.md": b"c", "x.bin": b"MZ", "l.link": b"docs/a.md", ".git/config": b"z"}
SECOND = {"docs/a.md": b"a2", "docs/moved.md": b"b", "docs/new.md": b"n", "x.bin": b"MZ", "bad.md": b"\xff"}


def read_state(spark, out):
    state = spark.read.parquet(f"{out}/sync_state")
    failed = spark.read.schema("config_hash string, path string, reason string, sync_id long").parquet(f"{out}/failed_paths")
    return (
        [(r["config_hash"], r["sync_id"], r["head_sha"]) for r in state.collect()],
        [(r["config_hash"], r["sync_id"], r["path"], r["reason"]) for r in failed.collect()],
    )


def documents(result):
    return {r["title"]: r["content"] for r in result.documents.collect()}


def test_full_then_incremental_equals_full(spark, tmp_path):
    out = str(tmp_path / "out")
    first = crawl.run_crawl(repository(spark, [FIRST]), out, 1)
    held = documents(first)
    assert held == {"docs/a.md": "a", "docs/b.md": "b", "docs/c.md": "c"}

    state, failed = read_state(spark, out)
    second_repo = repository(spark, [FIRST, SECOND], state, failed)
    second = crawl.run_crawl(second_repo, out, 2)
    assert second.plan.first()["mode"] == "incremental"
    for row in second.deletes.collect():
        held.pop(row["path"])
    tried = second.attempts.count()
    fresh = documents(second)
    held.update(fresh)
    assert held == documents(crawl.crawl(repository(spark, [SECOND])))
    assert held == {"docs/a.md": "a2", "docs/moved.md": "b", "docs/new.md": "n"}

    # A repeated sync with the same state writes the same folders again.
    again = crawl.run_crawl(second_repo, out, 2)
    assert documents(again) == fresh
    assert spark.read.parquet(f"{out}/batches/sync_id=2").count() == again.attempts.count() == tried

    # Nothing changed since: no work, state untouched.
    state, failed = read_state(spark, out)
    third = crawl.crawl_outcomes(repository(spark, [FIRST, SECOND], state, failed))
    assert third.plan.first()["mode"] == "noop" and third.attempts.count() == 0
    assert sync_state.next_state(third.plan, 3).count() == 0


def test_document_columns(spark):
    row = crawl.crawl(repository(spark, [{"a.md": "é".encode()}])).documents.first()
    assert row["source_url"] == f"git:{row['config_hash']}:a.md"
    assert row["description"] == "Git: https://x/r.git @ main" and row["content"] == "é"


def test_failed_paths_come_back(spark, tmp_path):
    out = str(tmp_path / "out")
    files = {"a.md": b"1", "b.md": b"2", "gone.md": b"3"}
    crawl.run_crawl(repository(spark, [files], errors=("b.md", "gone.md")), out, 1)
    state, failed = read_state(spark, out)
    assert sorted(f[2] for f in failed) == ["b.md", "gone.md"]
    # Same head, still failed paths: only these are tried again, and one works now.
    retry = crawl.crawl_outcomes(repository(spark, [files], state, failed, errors=("gone.md",)))
    assert retry.plan.first()["reason"] == "retry_only"
    assert {r["path"]: r["outcome"] for r in retry.attempts.collect()} == {"b.md": "ok", "gone.md": "read_error"}
    # Gone in the next commit: a permanent skip that leaves the list.
    later = crawl.crawl_outcomes(repository(spark, [files, {"a.md": b"1", "b.md": b"2"}], state, failed))
    assert {r["path"]: r["outcome"] for r in later.attempts.collect()} == {"b.md": "ok", "gone.md": "not_found"}
    assert sync_state.next_failed(later.attempts, 2).count() == 0
    counted = metrics.sync_metrics(later.plan, later.attempts, later.deletes, datetime(2024, 1, 1), datetime(2024, 1, 2)).first()
    assert (counted["files_added"], counted["files_deleted"], counted["files_skipped"]) == (1, 1, 1)


def test_filters_and_edges_of_a_rename(spark):
    repo = repository(spark, [{"in/a.md": b"1", "out/b.md": b"2", "in/c.py": b"3"}], subdir="/in/ ", extensions="MD")
    result = crawl.crawl(repo)
    assert documents(result) == {"in/a.md": "1"}
    state = [(result.plan.first()["config_hash"], 1, "c0")]
    moved = {"out/a.md": b"1", "in/b.md": b"2", "in/c.py": b"3"}
    after = crawl.crawl(
        repository(spark, [{"in/a.md": b"1", "out/b.md": b"2", "in/c.py": b"3"}, moved], state, subdir="/in/ ", extensions="MD")
    )
    assert documents(after) == {"in/b.md": "2"}
    assert [r["path"] for r in after.deletes.collect()] == ["in/a.md"]


def test_full_sync_reports_what_is_gone(spark):
    repo = repository(spark, [{"a.md": b"1"}])
    key = crawl.plan(repo).first()["config_hash"]
    attempts = [(key, 1, "a.md", "ok"), (key, 1, "old.md", "ok"), (key, 1, "bad.md", "binary"), (key, 1, "late.md", "ok"), ("other", 1, "x", "ok"),
                (key, 1, "gone.md", "ok"), (key, 3, "back.md", "ok")]
    deletes = [(key, 2, "gone.md"), (key, 3, "back.md")]
    told = replace(
        repo, attempts=spark.createDataFrame(attempts, schemas.ATTEMPTS), deletes=spark.createDataFrame(deletes, schemas.DELETES))
    result = crawl.crawl_outcomes(told)
    assert sorted(tuple(r) for r in result.deletes.collect()) == sorted([(key, "back.md"), (key, "late.md"), (key, "old.md"), ("other", "x")])


def test_documents_that_cannot_be_read_any_more_go(spark, tmp_path):
    """Text that turns binary or invalid UTF-8 loses its document in both modes; a failed read does not."""
    first = {"a.md": b"a", "b.md": b"b", "c.md": b"c", "d.md": b"d"}
    second = {"a.md": b"\x00", "b.md": b"\xff", "c.md": b"later", "d.md": b"d"}
    for mode in ("incremental", "full"):
        out = str(tmp_path / mode)
        held = documents(crawl.run_crawl(repository(spark, [first]), out, 1))
        state, failed = read_state(spark, out)
        repo = repository(spark, [first, second], state if mode == "incremental" else [(state[0][0], 1, "lost")], failed, errors=("c.md",))
        result = crawl.run_crawl(repo, out, 2)
        assert result.plan.first()["mode"] == mode
        assert sorted(r["path"] for r in result.deletes.collect()) == ["a.md", "b.md"]
        for row in result.deletes.collect():
            held.pop(row["path"])
        assert held | documents(result) == {"c.md": "c", "d.md": "d"}
        assert spark.read.parquet(f"{out}/metrics/sync_id=2").first()["files_deleted"] == 2


def test_documents_of_dropped_settings_go(spark, tmp_path):
    out = str(tmp_path / "out")
    crawl.run_crawl(repository(spark, [FIRST]), out, 1)
    old = {r["config_hash"] for r in spark.read.parquet(f"{out}/sync_state").collect()}
    state, failed = read_state(spark, out)
    second = crawl.run_crawl(repository(spark, [FIRST], state, failed, subdir="docs", extensions=".md"), out, 2)
    assert second.plan.first()["reason"] == "first_sync"
    assert {(r["config_hash"], r["path"]) for r in second.deletes.collect()} == {(h, p) for h in old for p in ("docs/a.md", "docs/b.md", "docs/c.md")}
    state, failed = read_state(spark, out)
    third = crawl.run_crawl(repository(spark, [FIRST], state, failed, subdir="docs", extensions=".md"), out, 3)
    assert third.deletes.count() == 0


@pytest.mark.parametrize("history", ["kept", "rewritten", "pruned"])
def test_deletes_do_not_depend_on_the_mode(spark, tmp_path, history):
    """The same trees give the same deletes, whether the old commit is an ancestor, unknown or no longer stored."""
    out = str(tmp_path / "out")
    crawl.run_crawl(repository(spark, [FIRST]), out, 1)
    state, failed = read_state(spark, out)
    repo = repository(spark, [FIRST, SECOND], state, failed)
    if history == "rewritten":
        repo = replace(repo, commits=spark.createDataFrame([("r", "c0", []), ("r", "c1", [])], "repo_id string, sha string, parents array<string>"))
    if history == "pruned":
        repo = replace(repo, tree=repo.tree.where("commit_sha = 'c1'"))
    result = crawl.run_crawl(repo, out, 2)
    reason = {"kept": "changes", "rewritten": "history_rewritten", "pruned": "snapshot_missing"}[history]
    assert result.plan.first()["reason"] == reason
    assert sorted(r["path"] for r in result.deletes.collect()) == ["docs/b.md", "docs/c.md"]
    row = spark.read.parquet(f"{out}/metrics/sync_id=2").first()
    assert row["files_deleted"] == 2 and row["duration_seconds"] > 0 and row["finished_at"] > row["started_at"]


def test_no_failure_is_lost(spark):
    rows = spark.range(12_000).select(
        F.lit("c").alias("config_hash"), F.format_string("p%05d", "id").alias("path"),
        F.lit("read_error").alias("outcome"), F.lit(True).alias("is_transient"))
    assert sync_state.next_failed(rows, 1).count() == 12_000


def test_stored_failed_lists(evaluate):
    stored = ['["a","b"]', "", None, "{", '{"k": 1}', "[]"]
    got = evaluate(stored, lambda c: F.size(sync_state.parse_failed_list(c)))
    assert got == [2, 0, 0, 0, 0, 0]
