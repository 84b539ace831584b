"""Snapshot scans: listing, sub-tree, point lookup, caps, history, tree flattening."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arborsync.functions import content, paths
from arborsync.operators.skew import lookup_join
from arborsync.staging import stage

SUBMODULE_MODE = "160000"
FOLDER_MODE = "040000"


def snapshot(tree: DataFrame, commits: DataFrame) -> DataFrame:
    """File rows of ``tree`` at the given (repo_id, commit_sha) pairs."""
    return files_only(tree).join(commits.select("repo_id", "commit_sha"), ["repo_id", "commit_sha"], "left_semi")


def files_only(tree: DataFrame) -> DataFrame:
    """Blobs; folders and submodule links are no files."""
    return tree.where(~F.col("mode").isin(SUBMODULE_MODE, FOLDER_MODE))


def list_files(
    tree: DataFrame,
    subdir: str | Column = "",
    extensions: Sequence[str] | Column = (),
    exclude: Sequence[str] = (),
    max_bytes: int | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """Listing rows ``repo_id, path, name, size, type`` that pass all filters.

    Only metadata is read. ``max_files`` keeps the first files of each repository in path order;
    such a filter on row_number() cuts rows before the shuffle.
    """
    path = F.col("path")
    kept = files_only(tree).where(
        paths.passes_filter(path, subdir, extensions)
        & ~paths.is_excluded(path, exclude)
        & ~content.is_too_large(F.col("size"), max_bytes)
    )
    listing = kept.select(
        "repo_id", "path", paths.file_name(path).alias("name"), "size", F.lit("file").alias("type")
    )
    if not max_files:
        return listing
    in_order = Window.partitionBy("repo_id").orderBy("path")
    return listing.withColumn("_n", F.row_number().over(in_order)).where(F.col("_n") <= max_files).drop("_n")


def subtree(tree: DataFrame, subdir: str) -> DataFrame:
    """Files below a folder; a folder that does not exist gives no rows."""
    return list_files(tree, subdir=subdir)


def lookup_files(wanted: DataFrame, tree: DataFrame) -> DataFrame:
    """One row per wanted (repo_id, path); size null where the file is missing."""
    found = files_only(tree).select("repo_id", "path", "size", "blob_sha")
    return wanted.join(found, ["repo_id", "path"], "left").select(
        "repo_id", "path", paths.file_name(F.col("path")).alias("name"), "size",
        F.col("blob_sha").isNotNull().alias("found"),
    )


def with_skip_reason(tree: DataFrame, limit: int | None = None) -> DataFrame:
    return tree.withColumn(
        "skip_reason", content.skip_reason(F.col("path"), F.col("size"), F.col("mode"), limit)
    )


def with_history(files: DataFrame, last_commits: DataFrame) -> DataFrame:
    """Files with their newest commit, nulls where none touched them."""
    return files.join(last_commits, ["repo_id", "path"], "left")


def flatten_trees(entries: DataFrame, roots: DataFrame) -> DataFrame:
    """Full paths of all files below ``roots``.

    ``entries``: ``parent_id, name, kind (tree|blob), child_id, size``; ``roots``:
    ``repo_id, tree_id``. The loop walks folders only, one job per folder level;
    file names are joined on once, at the end, with large folders split.
    """
    entries = entries.select("parent_id", "name", "kind", "child_id", "size")
    folders = entries.where("kind = 'tree'").select(F.col("parent_id").alias("folder_id"), "name", "child_id")
    level = stage(
        roots.select("repo_id", F.col("tree_id").alias("folder_id"), F.lit("").alias("prefix")), "level"
    )
    reached = level
    while True:
        met = lookup_join(folders, level, ["folder_id"], how="inner")
        below = met.select(
            "repo_id",
            F.col("child_id").alias("folder_id"),
            F.concat("prefix", "name", F.lit("/")).alias("prefix"),
        )
        level = stage(below, "level")
        if level.isEmpty():
            break
        reached = reached.unionByName(level)
    files = entries.where("kind = 'blob'").withColumnRenamed("parent_id", "folder_id")
    # One folder can hold very many files: those rows are split where needed.
    placed = lookup_join(files, reached, ["folder_id"], how="inner")
    return placed.select(
        "repo_id", F.concat("prefix", "name").alias("path"), F.col("child_id").alias("blob_sha"), "size"
    )
