"""A shared directory as a source: every file below a folder, dot-files included.

Spark's own file source hides names that start with ``_`` or ``.``, so folders
are listed and files read by small Python readers inside tasks. Folders are
listed level by level, spread over tasks; file contents never pass the driver.
"""

from __future__ import annotations

import os
import stat
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arborsync.functions.content import SYMLINK_MODE, TOO_LARGE, is_too_large
from arborsync.staging import stage

# A chunk of rows or bytes handed to Arrow at a time.
CHUNK_ROWS = 10_000
CHUNK_BYTES = 32 * 1024 * 1024
SKIPPED_FOLDER = ".git"

# The mode of a folder that could not be listed: it stands in the tree with its read error.
UNREADABLE_MODE = "040000"

ENTRY_COLUMNS = "path string, is_folder boolean, mode string, size bigint, read_error string"
CONTENT_COLUMNS = "path string, mode string, size bigint, content binary, read_error string"


def _list_folders(root: str):
    """Reader of one level: paths of folders in, their entries out."""

    def entries(folder: str) -> Iterator[tuple]:
        try:
            listing = os.scandir(os.path.join(root, folder))
        except OSError as problem:
            yield folder or ".", False, UNREADABLE_MODE, 0, str(problem)
            return
        with listing:
            for item in listing:
                path = f"{folder}/{item.name}" if folder else item.name
                status = item.stat(follow_symlinks=False)
                if item.is_dir(follow_symlinks=False):
                    if item.name != SKIPPED_FOLDER:
                        yield path, True, "040000", 0, None
                elif item.is_symlink():
                    yield path, False, SYMLINK_MODE, status.st_size, None
                elif stat.S_ISREG(status.st_mode):
                    yield path, False, "100755" if status.st_mode & 0o100 else "100644", status.st_size, None

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["path", "is_folder", "mode", "size", "read_error"]
        rows: list[tuple] = []
        for batch in batches:
            for folder in batch["path"]:
                for entry in entries(folder):
                    rows.append(entry)
                    if len(rows) >= CHUNK_ROWS:
                        yield pd.DataFrame(rows, columns=columns)
                        rows = []
        yield pd.DataFrame(rows, columns=columns)

    return read


def list_directory(spark: SparkSession, root: str, tasks: int | None = None) -> DataFrame:
    """``path, mode, size, read_error`` of every file below ``root``, a folder all executors see.

    A folder that cannot be listed is a row with its error, so that its files are not taken for deleted.
    """
    tasks = tasks or spark.sparkContext.defaultParallelism
    level = spark.createDataFrame([("",)], "path string")
    files = None
    while True:
        entries = stage(level.repartition(tasks).mapInPandas(_list_folders(root), ENTRY_COLUMNS), "listing")
        found = entries.where("NOT is_folder").select("path", "mode", "size", "read_error")
        files = found if files is None else files.unionByName(found)
        level = entries.where("is_folder").select("path")
        if level.isEmpty():
            return files


def _read_files(root: str):
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["path", "mode", "size", "content", "read_error"]
        rows: list[tuple] = []
        held = 0
        for batch in batches:
            for path, mode, size in zip(batch["path"], batch["mode"], batch["size"]):
                content, error = None, None
                try:
                    with open(os.path.join(root, path), "rb") as handle:
                        content = handle.read()
                except OSError as problem:
                    error = str(problem)
                rows.append((path, mode, size, content, error))
                held += len(content or b"")
                if held >= CHUNK_BYTES or len(rows) >= CHUNK_ROWS:
                    yield pd.DataFrame(rows, columns=columns)
                    rows, held = [], 0
        yield pd.DataFrame(rows, columns=columns)

    return read


def read_directory(files: DataFrame, root: str, limit: int | None = None) -> DataFrame:
    """``path, mode, size, content, read_error``; a failed read is a row, not a failed job.

    Links are not followed and, with a limit, files over it not opened: they keep a null content;
    the error of a file over the limit is ``too_large``.
    """
    known = files if "read_error" in files.columns else files.withColumn("read_error", F.lit(None).cast("string"))
    too_large = is_too_large(F.col("size"), limit) & (F.col("mode") != SYMLINK_MODE)
    readable = (F.col("mode") != SYMLINK_MODE) & F.col("read_error").isNull() & ~too_large
    opened = known.where(readable).select("path", "mode", "size").mapInPandas(_read_files(root), CONTENT_COLUMNS)
    closed = known.where(~readable).select(
        "path", "mode", "size", F.lit(None).cast("binary").alias("content"),
        F.when(too_large, TOO_LARGE).otherwise(F.col("read_error")).alias("read_error"),
    )
    return opened.unionByName(closed)


def write_directory(files: DataFrame, root: str) -> DataFrame:
    """Write ``content`` to ``path`` below ``root``, a folder all executors see; gives ``path, size`` once run.

    A repeated task writes the same file again; each file appears whole.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                place = os.path.join(root, path)
                os.makedirs(os.path.dirname(place), exist_ok=True)
                with open(f"{place}.{os.getpid()}~", "wb") as handle:
                    handle.write(content)
                os.replace(handle.name, place)
            yield pd.DataFrame({"path": batch["path"], "size": [len(c) for c in batch["content"]]})

    return files.select("path", "content").mapInPandas(write, "path string, size bigint")


def ingest_directory(
    spark: SparkSession, root: str, repo_id: str, commit_sha: str, limit: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """(tree rows, blobs) of a directory, in the engine's own tables."""
    read = stage(read_directory(list_directory(spark, root), root, limit), "files")
    unread = F.sha2(F.concat(F.lit("unread:"), "path", F.lit(":"), F.col("size").cast("string")), 256)
    keyed = read.withColumn("blob_sha", F.coalesce(F.sha2("content", 256), unread))
    tree = keyed.select(
        F.lit(repo_id).alias("repo_id"), F.lit(commit_sha).alias("commit_sha"), "path", "mode", "blob_sha", "size"
    )
    blobs = keyed.where("content IS NOT NULL OR read_error IS NOT NULL")
    return tree, blobs.select("blob_sha", "content", "read_error").dropDuplicates(["blob_sha"])
