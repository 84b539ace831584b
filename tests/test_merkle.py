import random

import pytest
from pyspark.sql import functions as F

from arborsync.operators import diff, merkle
from arborsync.sources import keyed

TREE = "repo_id string, commit_sha string, path string, mode string, blob_sha string, size bigint"


def rows(snapshots, repo="r"):
    return [(repo, sha, path, "100755" if blob.endswith("x") else "100644", blob, len(blob)) for sha, files in snapshots.items() for path, blob in files.items()]


def random_files(rng, n):
    files = {}
    for _ in range(n):
        folder = "/".join(rng.choice("ab") for _ in range(rng.randint(0, 4)))
        files[f"{folder}/f{rng.randrange(n)}".lstrip("/")] = f"b{rng.randrange(9)}{rng.choice(['', 'x'])}"
    return files


def edited(rng, files):
    out = {p: b for p, b in files.items() if rng.random() > 0.1}
    for path in list(out)[::9]:
        out[path] += "n"
    out |= {f"new/{i}/x": "b1" for i in range(3)}
    first = next(iter(out))
    blob = out.pop(first)
    out[f"{first}/now/a/folder"] = blob
    return out


def shown(changes):
    return sorted(tuple(r) for r in changes.select("repo_id", "status", "old_path", "new_path", "old_blob", "new_blob").collect())


def plain(tree, old, new):
    side = lambda sha: tree.where(F.col("commit_sha") == sha)
    return diff.changeset(side(old), side(new))


def pairs_of(roots, old, new):
    side = lambda sha, name: roots.where(F.col("commit_sha") == sha).select("repo_id", F.col("tree_id").alias(name))
    return side(old, "old_tree").join(side(new, "new_tree"), "repo_id", "full_outer")


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_the_plain_comparison(spark, seed):
    rng = random.Random(seed)
    one, two = random_files(rng, 120), random_files(rng, 60)
    data = rows({"old": one, "new": edited(rng, one)}) + rows({"old": two, "new": two}, "same") + rows({"new": two}, "came") + rows({"old": two}, "went")
    tree = spark.createDataFrame(data, TREE)
    entries, roots = merkle.fold_snapshots(tree)
    assert roots.count() == 6 and {r["files"] for r in roots.where("repo_id <> 'r'").collect()} == {len(two)}
    got = shown(merkle.merkle_changeset(pairs_of(roots, "old", "new"), entries))
    assert got == shown(plain(tree, "old", "new")) and {r[0] for r in got} == {"r", "came", "went"}


def test_equal_folders_are_stored_once(spark):
    files = {f"d{i}/same.txt": "x" for i in range(5)} | {"d5/same.txt": "y"}
    entries, roots = merkle.fold_snapshots(spark.createDataFrame(rows({"a": files, "b": files}), TREE))
    assert entries.where("kind = 'blob'").count() == 2 and entries.where("kind = 'tree'").count() == 6
    assert roots.select("tree_id").distinct().count() == 1 and roots.count() == 2
    swapped = {"d0/same.txt": "y"} | {f"d{i}/same.txt": "x" for i in range(1, 6)}
    _, other = merkle.fold_snapshots(spark.createDataFrame(rows({"a": swapped}), TREE))
    assert other.first()["tree_id"] != roots.first()["tree_id"]


def test_empty_trees(spark):
    entries, roots = merkle.fold_snapshots(spark.createDataFrame([], TREE))
    assert entries.count() == roots.count() == 0
    nothing = spark.createDataFrame([("r", None, None)], "repo_id string, old_tree string, new_tree string")
    assert merkle.merkle_changeset(nothing, entries).count() == 0


def scanned(df):
    """Rows that Parquet scans of an executed plan gave to Spark."""
    df.collect()

    def walk(plan):
        name = plan.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            return walk(plan.executedPlan())
        own = plan.metrics().get("numOutputRows").get().value() if name.startswith("Scan parquet") else 0
        if "QueryStage" in name:
            own += walk(plan.plan())
        return own + sum(walk(plan.children().apply(i)) for i in range(plan.children().size()))

    return walk(df._jdf.queryExecution().executedPlan())


def test_rows_read_follow_the_change(spark, tmp_path):
    """A thousand folders, three files changed: only the folders on the way to them are read."""
    path = str(tmp_path / "store")
    base = spark.range(100_000).select(
        F.lit("r").alias("repo_id"), F.lit("c1").alias("commit_sha"), F.format_string("p%03d/q%d/f%02d", F.col("id") % 100, F.floor(F.col("id") / 100) % 10, F.floor(F.col("id") / 1000)).alias("path"),
        F.lit("100644").alias("mode"), F.sha2(F.col("id").cast("string"), 256).alias("blob_sha"), F.lit(1).cast("bigint").alias("size"))
    changed = F.when(F.col("path").isin("p003/q1/f01", "p050/q2/f07", "p051/q2/f07"), F.lit("other")).otherwise(F.col("blob_sha"))
    merkle.store_snapshots(base, path, 1)
    merkle.store_snapshots(base.withColumns({"commit_sha": F.lit("c2"), "blob_sha": changed}), path, 2)
    held = spark.read.parquet(f"{path}/entries")
    # The second ingest adds the root, three folders below it and three below those.
    assert held.where("segment = 2").select("folder_id").distinct().count() == 7
    pairs = pairs_of(merkle.read_roots(spark, path), "c1", "c2")
    asked = []
    read = merkle.stored_folders(spark, path)

    def folders(wanted):
        rows = read(wanted)
        asked.append((rows.count(), scanned(rows)))
        return rows

    found = merkle.merkle_changeset(pairs, folders).collect()
    assert sorted((r["status"], r["new_path"]) for r in found) == [("M", "p003/q1/f01"), ("M", "p050/q2/f07"), ("M", "p051/q2/f07")]
    total = held.count()
    assert [n for n, _ in asked] == [200, 60, 600] and total > 100_000
    # Two sides of seven folders, each a page or two.
    assert sum(n for _, n in asked) < 14 * 2 * keyed.PAGE_ROWS < total / 7


def test_keyed_segments(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "blob_sha string, content string"
    make = lambda low, high: spark.range(low, high).select(F.sha2(F.col("id").cast("string"), 256).alias("blob_sha"), F.repeat(F.col("id").cast("string"), 200).alias("content"))
    kind = make(0, 1).schema
    keyed.append_new(make(0, 8000), path, "blob_sha", 1, 1 << 18)
    for _ in range(2):  # a repeated ingest replaces its segment
        keyed.append_new(make(7900, 8080), path, "blob_sha", 2, 1 << 18)
    table = keyed.read_segments(spark, path, kind)
    assert table.count() == 8080 and table.where("segment = 2").count() == 80
    keys = lambda low, high: make(low, high).select("blob_sha")
    late = keyed.rows_with_keys(table, "blob_sha", keys(8000, 8080))
    assert sorted(r["content"] for r in late.collect()) == sorted(str(i) * 200 for i in range(8000, 8080))
    assert scanned(late) < 400  # one per cent of the table, and next to no row group beside it
    many = keyed.rows_with_keys(table, "blob_sha", keys(8000, 8080), pushed=10)
    assert many.count() == 80 and "segment" in many.columns and scanned(many.select("content")) <= 80
    assert keyed.rows_with_keys(table, "blob_sha", keys(0, 0)).count() == 0
    assert keyed.read_segments(spark, str(tmp_path / "none"), kind).count() == 0 and schema


def test_blobs_move_once_into_a_segment(spark, tmp_path):
    """One shuffle makes keys distinct and puts them in order; what is stored stays out."""
    path = str(tmp_path / "blobs")
    rows = spark.range(200).selectExpr("cast(id % 50 as string) as blob_sha", "cast(cast(id % 50 as string) as binary) as content")
    plan = rows.repartitionByRange("blob_sha").dropDuplicates(["blob_sha"]).sortWithinPartitions("blob_sha")
    assert plan._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
    keyed.append_new(rows.where("blob_sha < '3'"), path, "blob_sha", 0, once=True)
    keyed.append_new(rows, path, "blob_sha", 1, once=True)
    held = spark.read.parquet(path)
    assert held.count() == held.select("blob_sha").distinct().count() == 50
