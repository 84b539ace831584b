import os

from pyspark.sql import functions as F

from arborsync.sources import directory_source as source


def make(root):
    files = {"readme.md": b"x", "__init__.py": b"", ".github/x.yml": b"y", "pkg/_private.py": b"z", "pkg/deep/er/f.txt": b"f", "pkgs/q": b"q", "bin": b"\x00\xff", ".git/config": b"no"}
    for path, content in files.items():
        (root / path).parent.mkdir(parents=True, exist_ok=True)
        (root / path).write_bytes(content)
    os.symlink("readme.md", root / "link")
    return {p: c for p, c in files.items() if not p.startswith(".git/")}


def load(spark, root, **options):
    return source.load_directory(spark, str(root), **options)


def content(df):
    return {r["path"]: None if r["content"] is None else bytes(r["content"]) for r in df.collect()}


def test_all_files_dot_files_included(spark, tmp_path):
    files = make(tmp_path)
    found = load(spark, tmp_path)
    assert content(found) == {**files, "link": None}
    assert {r["path"]: r["mode"] for r in found.collect()}["link"] == "120000"
    assert found.rdd.getNumPartitions() >= 7
    (missing,) = load(spark, tmp_path / "nowhere").collect()
    assert "No such file" in missing["read_error"]


def test_filters_spare_reading(spark, tmp_path):
    files = make(tmp_path)
    found = lambda: load(spark, tmp_path)
    below = found().where(F.col("path").startswith("pkg/"))
    assert content(below) == {p: c for p, c in files.items() if p.startswith("pkg/")}
    assert content(found().where(F.col("path").startswith("pk"))) == {p: c for p, c in files.items() if p.startswith("pk")}
    assert content(found().where("path = 'pkg/deep/er/f.txt'")) == {"pkg/deep/er/f.txt": b"f"}
    assert content(found().where("path = 'pkg'")) == {} == content(found().where("path = 'no/such'"))
    assert found().join(below.select("path"), "path", "left_anti").count() == 9 - 3 + 1 - 1
    reader = source.FolderReader(str(tmp_path), None)
    list(reader.pushFilters([source.StringStartsWith(("path",), "pkg/d")]))
    assert [p.path for p in reader.partitions()] == ["pkg/_private.py", "pkg/deep"]
    assert [r[0] for p in reader.partitions() for r in reader.read(p)] == ["pkg/deep/er/f.txt"]


def test_manifest_in_ranges(spark, tmp_path, monkeypatch):
    files = make(tmp_path / "data")
    manifest = tmp_path / "manifest"
    names = ["readme.md", "pkg/deep/er/f.txt", "gone", "bin"]
    manifest.write_text("\n".join(names) + "\nunfinished")
    got = {r["path"]: r["read_error"] for r in load(spark, tmp_path / "data", manifest=str(manifest)).collect()}
    assert set(got) == set(names) and "No such file" in got["gone"] and got["bin"] is None and files
    for size in (1, 3, 7, 100):
        monkeypatch.setattr(source, "MANIFEST_BYTES", size)
        reader = source.FolderReader(str(tmp_path / "data"), str(manifest))
        assert [r[0] for p in reader.partitions() for r in reader.read(p)] == names


def test_stream_takes_new_lines(spark, tmp_path):
    make(tmp_path / "data")
    manifest, out = tmp_path / "manifest", str(tmp_path / "out")
    source.register(spark)
    seen = []
    for lines in ("readme.md\nbin\npk", "g/deep/er/f.txt\n", "", "__init__.py\n"):
        with open(manifest, "a") as handle:
            handle.write(lines)
        stream = spark.readStream.format("directory").option("manifest", str(manifest)).load(str(tmp_path / "data"))
        stream.select("path").writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start().awaitTermination(60)
        seen.append(sorted(r["path"] for r in spark.read.schema("path string").parquet(out).collect()))
    assert seen == [["bin", "readme.md"], ["bin", "pkg/deep/er/f.txt", "readme.md"]] + [["bin", "pkg/deep/er/f.txt", "readme.md"]] + [["__init__.py", "bin", "pkg/deep/er/f.txt", "readme.md"]]
