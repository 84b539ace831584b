import os

from pyspark.sql import functions as F

from arborsync.operators import history, listing, snapshot
from arborsync import schemas, session
from arborsync.functions import content as tests
from arborsync.operators.content import attach_content, needed_blobs, read_outcomes, read_texts
from arborsync.sources import directory, keyed, tables
from arborsync.staging import stage
from arborsync.streaming import events, sink


def make_files(root):
    files = {
        "readme.md": b"x", "__init__.py": b"", ".github/x.yml": b"y", "pkg/_private.py": b"z", "pkg/deep/er/f.txt": b"f",
        ".git/config": b"no", "sub/.git/HEAD": b"no", "big.txt": b"b" * 100, "bin": b"\x00\xff",
    }
    for path, content in files.items():
        target = root / path
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(content)
    os.symlink("readme.md", root / "link")
    return {p: c for p, c in files.items() if ".git/" not in p}


def test_directory_source_sees_hidden_names(spark, tmp_path):
    files = make_files(tmp_path)
    tree, blobs = directory.ingest_directory(spark, str(tmp_path), "local", "now", limit=50)
    rows = {r["path"]: r for r in tree.collect()}
    assert set(rows) == set(files) | {"link"}
    assert rows["link"]["mode"] == "120000" and rows["big.txt"]["size"] == 100
    content = {r["blob_sha"]: bytes(r["content"] or b"") for r in blobs.collect()}
    assert content[rows["pkg/deep/er/f.txt"]["blob_sha"]] == b"f"
    assert rows["__init__.py"]["blob_sha"] in content
    outcomes = {r["path"]: r["outcome"] for r in read_outcomes(tree, blobs).collect()}
    assert outcomes["big.txt"] == "too_large" and outcomes["bin"] == "binary" and outcomes["readme.md"] == "ok"
    everything, _ = directory.ingest_directory(spark, str(tmp_path), "local", "now")
    assert everything.count() == len(files) + 1


def test_unreadable_folder_is_a_row(spark, tmp_path):
    files = directory.list_directory(spark, str(tmp_path / "nowhere"))
    (row,) = files.collect()
    assert "No such file" in row["read_error"]
    tree, blobs = directory.ingest_directory(spark, str(tmp_path / "nowhere"), "local", "now")
    assert tree.count() == 1 and "No such file" in blobs.first()["read_error"]


def test_unreadable_file_is_a_row(spark, tmp_path):
    files = spark.createDataFrame([("nowhere", "100644", 1)], "path string, mode string, size long")
    row = directory.read_directory(files, str(tmp_path)).first()
    assert row["content"] is None and "No such file" in row["read_error"]


def test_tree_layout_prunes(spark, tmp_path):
    rows = spark.range(1000).select(
        F.lit("r").alias("repo_id"), F.lit("c").alias("commit_sha"),
        F.format_string("d%02d/f%04d", F.col("id") % 50, F.col("id")).alias("path"),
    )
    path = str(tmp_path / "tree")
    tables.write_tree(rows, path, 8)
    stored = spark.read.parquet(path)
    assert stored.count() == 1000
    spans = stored.groupBy(F.input_file_name().alias("f")).agg(F.min("path").alias("a"), F.max("path").alias("b")).collect()
    ordered = sorted((r["a"], r["b"]) for r in spans)
    assert len(ordered) > 4 and all(x[1] < y[0] for x, y in zip(ordered, ordered[1:]))


def test_bucketed_blobs_join_without_moving_content(spark, tmp_path):
    blobs = spark.range(200).select(F.sha2(F.col("id").cast("string"), 256).alias("blob_sha"), F.lit("c").alias("content"))
    spark.sql(f"create database if not exists t_blobs location '{tmp_path}/db'")
    tables.write_blobs(blobs, "t_blobs.blobs", 4)
    try:
        files = blobs.select("blob_sha", F.lit("p").alias("path"))
        joined = files.hint("merge").join(spark.table("t_blobs.blobs"), "blob_sha")
        assert joined.count() == 200
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan
    finally:
        spark.sql("drop database t_blobs cascade")


def test_document_rerun_replaces_its_partitions(spark, tmp_path):
    path = str(tmp_path / "docs")
    rows = spark.createDataFrame([("c1", "a"), ("c2", "b")], "config_hash string, content string")
    tables.write_documents(rows, path, 1)
    tables.write_documents(rows.where("config_hash = 'c1'"), path, 2)
    tables.write_documents(rows.where("config_hash = 'c1'"), path, 2)
    assert spark.read.parquet(path).count() == 3


def test_listing_pages_cover_everything_once(spark):
    rows = [(f"F{i % 7}/x{i}", f"{'B' if i % 2 else 'b'}{i:02d}", i, "folder" if i % 3 == 0 else "file") for i in range(45)]
    entries = spark.createDataFrame([("r", *row) for row in rows], "repo_id string, id string, name string, size long, type string")
    seen, token = [], None
    while True:
        page = listing.listing_page(entries, 20, after=token)
        seen += [r["id"] for r in page.orderBy("n").collect()]
        token = listing.page_token(page)
        if token is None:
            break
    expected = [r[0] for r in sorted(rows, key=lambda r: (r[3] != "folder", r[1].lower(), r[0]))]
    assert seen == expected
    assert listing.listing_page(entries, 45).first()["is_truncated"] is False
    assert listing.listing_page(entries, 0).count() == 45


def test_tree_flatten_shared_folder(spark):
    entries = spark.createDataFrame(
        [("root", "a", "tree", "s", None), ("root", "b", "tree", "s", None), ("s", "f", "blob", "1", 1),
         ("root", "top", "blob", "2", 2), ("root", "sub", "commit", "x", None), ("s", "t", "tree", "e", None)],
        "parent_id string, name string, kind string, child_id string, size long",
    )
    roots = spark.createDataFrame([("r", "root")], "repo_id string, tree_id string")
    assert sorted(r["path"] for r in snapshot.flatten_trees(entries, roots).collect()) == ["a/f", "b/f", "top"]


def test_missing_subtree_and_lookup(spark):
    tree = spark.createDataFrame(
        [("r", "d/a", "100644", "1", 1), ("r", "s", "160000", "2", 0)],
        "repo_id string, path string, mode string, blob_sha string, size long",
    )
    assert snapshot.subtree(tree, "nowhere").count() == 0
    assert [r["path"] for r in snapshot.list_files(tree).collect()] == ["d/a"]
    wanted = spark.createDataFrame([("r", "d/a"), ("r", "x")], "repo_id string, path string")
    assert {r["path"]: r["found"] for r in snapshot.lookup_files(wanted, tree).collect()} == {"d/a": True, "x": False}


def test_history_limits_rows_before_the_shuffle(spark):
    touches = spark.range(3000).select(
        F.lit("r").alias("repo_id"), F.concat(F.lit("hot"), F.col("id") % 1).alias("path"),
        F.col("id").cast("string").alias("sha"),
    )
    commits = spark.range(3000).select(
        F.lit("r").alias("repo_id"), F.col("id").cast("string").alias("sha"),
        F.timestamp_seconds(F.col("id") / 2).alias("ts"), F.lit("me").alias("author"), F.lit("m\nmore").alias("message"),
    )
    out = history.file_history(touches, commits, 3)
    assert "WindowGroupLimit" in out._jdf.queryExecution().toString()
    assert [(r["n"], r["sha"], r["message"]) for r in out.orderBy("n").collect()] == [(1, "2999", "m"), (2, "2998", "m"), (3, "2997", "m")]


def scanned(df):
    """Rows that Parquet scans of an executed plan gave to Spark."""
    df.collect()

    def walk(plan):
        name = plan.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            return walk(plan.executedPlan())
        own = plan.metrics().get("numOutputRows").get().value() if name.startswith("Scan parquet") and "content" in plan.toString() else 0
        if "QueryStage" in name:
            own += walk(plan.plan())
        return own + sum(walk(plan.children().apply(i)) for i in range(plan.children().size()))

    return walk(df._jdf.queryExecution().executedPlan())


def test_a_small_sync_reads_little_content(spark, tmp_path):
    """Blobs of 3000 files, 30 of them added last: reading these leaves out the row groups of all others."""
    path = str(tmp_path / "blobs")
    make = lambda low, high: spark.range(low, high).select(
        F.sha2(F.col("id").cast("string"), 256).alias("blob_sha"), F.encode(F.repeat(F.col("id").cast("string"), 300), "UTF-8").alias("content"),
        F.lit(None).cast("string").alias("read_error"))
    for segment, (low, high) in enumerate(((0, 2970), (2900, 3000))):
        keyed.append_new(make(low, high), path, "blob_sha", segment, 1 << 17)
    blobs = keyed.read_segments(spark, path, schemas.BLOBS)
    files = make(2970, 3000).select("blob_sha", F.lit("f").alias("path"), F.lit(1).alias("size"))
    read = attach_content(files, blobs)
    assert sorted(bytes(r["content"])[:4] for r in read.collect()) == [str(i).encode() for i in range(2970, 3000)]
    assert scanned(needed_blobs(files, blobs)) < 300
    every = make(0, 3000).select("blob_sha", F.lit("f").alias("path"))
    assert attach_content(every, blobs).where("found").count() == 3000


def test_listed_sizes_spare_reading(spark):
    rows = [("big", "b1", 10), ("small", "b2", 2), ("lies", "b3", 2), ("a/../x", "b1", 10), ("gone", "b9", 1)]
    files = spark.createDataFrame(rows, "path string, blob_sha string, size long")
    blobs = spark.createDataFrame([("b1", b"\x00" * 10, None), ("b2", b"ok", None), ("b3", b"0123456789", None)], schemas.BLOBS)
    want = {"big": "too_large", "small": "ok", "lies": "too_large", "a/../x": "bad_path", "gone": "not_found"}
    texts = read_texts(files, blobs, 5, by_size=True)
    assert {r["path"]: r["outcome"] for r in texts.collect()} == {**want, "a/../x": tests.BAD_PATH}
    assert {r["path"]: r["bytes"] for r in read_outcomes(files, blobs, 5, by_size=True).collect()}["big"] == 10
    assert {r["path"]: r["outcome"] for r in read_texts(files, blobs, 5).collect()}["big"] == "binary"


def test_clear_work_deletes_staged_tables(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "work_root", lambda _: str(tmp_path))
    stage(spark.range(3), "kept")
    assert any(tmp_path.rglob("*.parquet"))
    session.clear_work(spark)
    assert not any(tmp_path.rglob("*.parquet"))


def test_merged_batches_read_like_all_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sink, "MERGE_EVERY", 3)
    table, schema = str(tmp_path / "t"), spark.createDataFrame([], "path string, latest long").schema
    newest = {}
    for batch in range(8):
        rows = [(f"p{(batch * 2 + i) % 5}", batch * 10 + i) for i in range(2)]
        newest |= dict(rows)
        for _ in range(2):  # a repeated batch changes nothing
            sink.merge_batches(spark, table, schema, events._newest, batch)
            sink.write_batch(spark.createDataFrame(rows, schema), table, batch)
    assert sink._bases(spark, table) == [3, 6]
    got = events._newest(sink.read_batches(spark, table, schema)).collect()
    assert {r["path"]: r["latest"] for r in got} == newest
    assert sink.read_batches(spark, table, schema, before=2).count() == 4
