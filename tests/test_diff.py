import json
import random

import pytest
from pyspark.sql import functions as F

from arborsync.operators import actions, diff, export, upsert

TREE = "repo_id string, path string, blob_sha string, mode string"


def tree(spark, files, repo="r", mode="100644"):
    return spark.createDataFrame([(repo, p, b, mode) for p, b in files.items()], TREE)


def changes(spark, old, new, **options):
    out = diff.changeset(tree(spark, old), tree(spark, new), **options)
    return sorted((r["status"], r["old_path"], r["new_path"]) for r in out.collect())


def test_documented_deletion_example(spark):
    old = {"A.txt": "1", "B.txt": "2", "C.txt": "3"}
    new = {"A.txt": "1", "C.txt": "9", "D.txt": "4"}
    assert changes(spark, old, new) == [("A", None, "D.txt"), ("D", "B.txt", None), ("M", "C.txt", "C.txt")]


def test_three_file_repository_with_one_more(spark):
    old = {"docs/readme.md": "1", "docs/guide.txt": "2", "src/main.py": "3"}
    assert changes(spark, old, {**old, "docs/new_file.md": "4"}) == [("A", None, "docs/new_file.md")]
    assert changes(spark, old, old) == []
    assert len(changes(spark, {}, old)) == 3 and len(changes(spark, old, {})) == 3


def test_equal_blobs_pair_in_path_order(spark):
    old = {"a": "x", "b": "x", "c": "x", "keep": "x"}
    new = {"p": "x", "q": "x", "keep": "x"}
    expected = [("D", "c", None), ("R", "a", "p"), ("R", "b", "q")]
    assert changes(spark, old, new) == expected


def test_mode_change_is_a_modification(spark):
    out = diff.changeset(tree(spark, {"a": "x"}), tree(spark, {"a": "x"}, mode="100755")).collect()
    assert [r["status"] for r in out] == ["M"]


def random_tree(rng, n):
    return {f"d{rng.randrange(4)}/f{rng.randrange(n)}": f"b{rng.randrange(12)}" for _ in range(n)}


def model(old, new):
    gone = sorted(p for p in old if p not in new)
    came = sorted(p for p in new if p not in old)
    out = [("M", p, p) for p in old if p in new and old[p] != new[p]]
    for blob in set(old.values()) | set(new.values()):
        left, right = [p for p in gone if old[p] == blob], [p for p in came if new[p] == blob]
        pairs = min(len(left), len(right))
        out += [("R", a, b) for a, b in zip(left, right)]
        out += [("D", a, None) for a in left[pairs:]] + [("A", None, b) for b in right[pairs:]]
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [1, 5])
def test_random_trees_and_application(spark, seed):
    rng = random.Random(seed)
    old, new = random_tree(rng, 200), random_tree(rng, 200)
    found = diff.changeset(tree(spark, old), tree(spark, new)).collect()
    got = [(r["status"], r["old_path"], r["new_path"]) for r in found]
    assert sorted(got, key=str) == model(old, new)
    # apply(old, changes) = new
    state = dict(old)
    for r in found:
        if r["old_path"]:
            state.pop(r["old_path"])
    for r in found:
        if r["new_path"]:
            state[r["new_path"]] = r["new_blob"]
    assert state == new


def rename_rows(spark):
    rows = [
        ("r", "R", "in/a.md", "in/b.md", "1", "1"), ("r", "R", "in/a.md", "out/b.md", "1", "1"),
        ("r", "R", "out/a.md", "in/b.md", "1", "1"), ("r", "R", "out/a.md", "out/b.md", "1", "1"),
        ("r", "A", None, "in/c.md", None, "2"), ("r", "D", "out/c.md", None, "2", None), ("r", "M", "in/d.txt", "in/d.txt", "3", "4"),
    ]
    return spark.createDataFrame(rows, "repo_id string, status string, old_path string, new_path string, old_blob string, new_blob string")


def test_rename_filter(spark):
    rows = rename_rows(spark)
    assert diff.filter_changes_raw(rows, "in", [".md"]).count() == 4
    seen = diff.filter_changes(rows, "in", [".md"]).collect()
    assert sorted((r["status"], r["old_path"], r["new_path"]) for r in seen) == [
        ("A", None, "in/b.md"), ("A", None, "in/c.md"), ("D", "in/a.md", None), ("R", "in/a.md", "in/b.md"),
    ]


def test_actions(spark):
    rows = rename_rows(spark).where("status <> 'R' or (old_path = 'in/a.md' and new_path = 'in/b.md')")

    def shown(df):
        return sorted((r["action"], r["path"]) for r in df.collect())

    assert shown(actions.sync_actions(rows)) == [
        ("add", "in/b.md"), ("add", "in/c.md"), ("delete", "in/a.md"), ("delete", "out/c.md"), ("update", "in/d.txt"),
    ]
    assert shown(actions.sync_actions(rows, False)) == [
        ("add", "in/c.md"), ("delete", "out/c.md"), ("update", "in/b.md"), ("update", "in/d.txt"),
    ]
    assert shown(actions.upserts_and_deletes(rows))[:2] == [("delete", "in/a.md"), ("delete", "out/c.md")]
    assert diff.affected_paths(rows).count() == 5


def test_export_in_parts_and_back(spark):
    rows = rename_rows(spark).where("status <> 'R'").withColumn("new_path", F.concat("new_path", F.lit("é")))
    for part in (1, 2, 100):
        out = export.export_changesets(rows, part)
        parts = [json.loads(r["changeset"]) for r in out.collect()]
        assert sum(len(p["added"]) + len(p["modified"]) + len(p["deleted"]) for p in parts) == 3
        back = export.import_changesets(out).collect()
        assert ("A", "in/c.mdé") in {(r["status"], r["new_path"]) for r in back}
    sparse = spark.createDataFrame([("r", '{"renamed": [["a", "b"]]}')], "repo_id string, changeset string")
    assert [tuple(r) for r in export.import_changesets(sparse).collect()] == [("r", "R", "a", "b")]


def test_upsert_replaces_and_never_duplicates(spark):
    columns = "source_url string, content string"
    table = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], columns)
    fresh = spark.createDataFrame([("b", "9"), ("d", "4")], columns)
    gone = spark.createDataFrame([("c",), ("b",)], "source_url string")
    after = upsert.apply_upsert(table, fresh, gone)
    expected = [("a", "1"), ("b", "9"), ("d", "4")]
    assert sorted(map(tuple, after.collect())) == expected
    assert sorted(map(tuple, upsert.apply_upsert(after, fresh, gone).collect())) == expected


def test_latest_versions(spark):
    rows = [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "y"), ("b", 1, "z")]
    out = upsert.latest_versions(spark.createDataFrame(rows, "source_url string, sync_id long, content string"))
    assert sorted(map(tuple, out.select("source_url", "content").collect())) == [("a", "y"), ("b", "z")]
