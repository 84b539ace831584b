import random
import re

import pytest

from arborsync.operators import intervals

TREE = "repo_id string, path string, mode string, blob_sha string, size bigint"


def ingest(spark, store, snapshots, segment):
    """snapshots: repo -> (position, {path: blob})."""
    rows = [(r, p, "100644", b, len(b)) for r, (_, files) in snapshots.items() for p, b in files.items()]
    at = spark.createDataFrame([(r, n) for r, (n, _) in snapshots.items()], "repo_id string, position bigint")
    intervals.ingest_snapshots(spark.createDataFrame(rows, TREE), at, store, segment)


def rebuilt(spark, store, repo, position):
    at = spark.createDataFrame([(repo, position)], "repo_id string, position bigint")
    rows = intervals.files_at(spark, store, at).collect()
    assert len({r["path"] for r in rows}) == len(rows)
    return {r["path"]: r["blob_sha"] for r in rows}


@pytest.mark.parametrize("seed", [1, 2])
def test_every_snapshot_can_be_rebuilt(spark, tmp_path, seed):
    rng, store = random.Random(seed), str(tmp_path / "store")
    kept, files, stored_rows = {}, {"a": {}, "b": {}}, 0
    for segment in range(1, 6):
        now = {}
        for repo in rng.sample("ab", rng.choice([1, 2])):
            state = {p: b for p, b in files[repo].items() if rng.random() > 0.1}
            state |= {f"d{rng.randrange(5)}/f{rng.randrange(30)}": f"b{rng.randrange(9)}" for _ in range(8)}
            if segment == 4:
                state = {}
            stored_rows += sum(files[repo].get(p) != b for p, b in state.items())
            files[repo] = state
            now[repo] = kept[repo, segment * 10] = (segment * 10, state)
        for _ in range(1 + (segment == 3)):  # a repeated ingest changes nothing
            ingest(spark, store, now, segment)
    for (repo, position), (_, state) in kept.items():
        assert rebuilt(spark, store, repo, position) == rebuilt(spark, store, repo, position + 5) == state
    assert intervals.read_intervals(spark, store).count() == stored_rows


def test_only_buckets_of_asked_repositories_are_read(spark, tmp_path):
    store = str(tmp_path / "store")
    ingest(spark, store, {f"r{i}": (1, {"x": "1", "y": "2"}) for i in range(20)}, 1)
    at = spark.createDataFrame([("r3", 1)], "repo_id string, position bigint")
    found = intervals.files_at(spark, store, at)
    assert found.count() == 2
    assert re.search(r"PartitionFilters: \[[^\]]*bucket#\d+ (=|IN)", found._jdf.queryExecution().executedPlan().toString())
    assert intervals.read_intervals(spark, str(tmp_path / "none")).count() == 0
