"""Change detection between two snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborsync.functions.paths import passes_filter
from arborsync.operators.numbering import number_rows
from arborsync.staging import stage

ADDED, MODIFIED, DELETED, RENAMED = "A", "M", "D", "R"
CHANGE_COLUMNS = ("repo_id", "status", "old_path", "new_path", "old_blob", "new_blob")


def compare_snapshots(old: DataFrame, new: DataFrame) -> DataFrame:
    """Paths that differ, before rename pairing. Content is never read.

    The join key holds the path, so a repository of any size spreads evenly.
    """
    before = old.select(
        "repo_id", "path", F.col("blob_sha").alias("old_blob"), F.col("mode").alias("old_mode")
    )
    after = new.select(
        "repo_id", "path", F.col("blob_sha").alias("new_blob"), F.col("mode").alias("new_mode")
    )
    same = F.col("old_blob").eqNullSafe(F.col("new_blob")) & F.col("old_mode").eqNullSafe(F.col("new_mode"))
    status = (
        F.when(F.col("old_blob").isNull(), ADDED).when(F.col("new_blob").isNull(), DELETED).otherwise(MODIFIED)
    )
    return (
        before.join(after, ["repo_id", "path"], "full_outer")
        .where(~same)
        .select("repo_id", "path", status.alias("status"), "old_blob", "new_blob")
    )


def pair_renames(changes: DataFrame) -> DataFrame:
    """Pair deleted and added paths of equal content one to one, in path order.

    ``changes`` comes from compare_snapshots, staged. The n-th deleted path of a
    blob meets the n-th added one; whatever is left over stays deleted or added.
    """
    moved = changes.where(F.col("status").isin(ADDED, DELETED)).select(
        "repo_id", "path", "status", F.coalesce("old_blob", "new_blob").alias("blob")
    )
    ranked = number_rows(
        moved, ["repo_id", "blob", "status"], ["path"], "rank",
    )
    path = F.col("path")
    paired = ranked.groupBy("repo_id", "blob", "rank").agg(
        F.max(F.when(F.col("status") == DELETED, path)).alias("old_path"),
        F.max(F.when(F.col("status") == ADDED, path)).alias("new_path"),
    )
    status = (
        F.when(F.col("old_path").isNull(), ADDED).when(F.col("new_path").isNull(), DELETED).otherwise(RENAMED)
    )
    moves = paired.select(
        "repo_id", status.alias("status"), "old_path", "new_path",
        F.when(F.col("old_path").isNotNull(), F.col("blob")).alias("old_blob"),
        F.when(F.col("new_path").isNotNull(), F.col("blob")).alias("new_blob"),
    )
    edits = changes.where(F.col("status") == MODIFIED).select(
        "repo_id", "status", path.alias("old_path"), path.alias("new_path"), "old_blob", "new_blob"
    )
    return edits.unionByName(moves)


def changeset(old: DataFrame, new: DataFrame) -> DataFrame:
    """All changes from ``old`` to ``new``, long form: one row per added, modified, deleted or renamed file."""
    return pair_renames(stage(compare_snapshots(old, new), "changes"))


def _sides(
    subdir: str | Column, extensions: Sequence[str] | Column
) -> tuple[Column, Column]:
    def side(name: str) -> Column:
        return F.coalesce(passes_filter(F.col(name), subdir, extensions), F.lit(False))

    return side("old_path"), side("new_path")


def filter_changes_raw(
    changes: DataFrame, subdir: str | Column = "", extensions: Sequence[str] | Column = ()
) -> DataFrame:
    """Keep changes with a matching path; a rename when either side matches."""
    old_ok, new_ok = _sides(subdir, extensions)
    return changes.where(old_ok | new_ok)


def filter_changes(
    changes: DataFrame, subdir: str | Column = "", extensions: Sequence[str] | Column = ()
) -> DataFrame:
    """Changes as seen through the filter.

    A rename into the filter is an addition there, one out of it a deletion.
    """
    old_ok, new_ok = _sides(subdir, extensions)
    renamed = F.col("status") == RENAMED
    seen = (
        F.when(renamed & old_ok & new_ok, RENAMED)
        .when(renamed & new_ok, ADDED)
        .when(renamed & old_ok, DELETED)
        .otherwise(F.col("status"))
    )
    kept = changes.where(old_ok | new_ok).withColumn("status", seen)
    return kept.withColumns(
        {
            "old_path": F.when(F.col("status") != ADDED, F.col("old_path")),
            "old_blob": F.when(F.col("status") != ADDED, F.col("old_blob")),
            "new_path": F.when(F.col("status") != DELETED, F.col("new_path")),
            "new_blob": F.when(F.col("status") != DELETED, F.col("new_blob")),
        }
    )


def change_counts(changes: DataFrame, keys: Sequence[str] = ("repo_id",)) -> DataFrame:
    counted = {"added": ADDED, "modified": MODIFIED, "deleted": DELETED, "renamed": RENAMED}
    return changes.groupBy(*keys).agg(
        *[F.count_if(F.col("status") == code).alias(name) for name, code in counted.items()]
    )


def with_change_flag(repos: DataFrame, changes: DataFrame) -> DataFrame:
    """Every repository with its number of changes, 0 for an empty change set."""
    totals = changes.groupBy("repo_id").agg(F.count("*").alias("n_changes"))
    return repos.join(totals, "repo_id", "left").withColumn(
        "n_changes", F.coalesce("n_changes", F.lit(0))
    )


def affected_paths(changes: DataFrame) -> DataFrame:
    """Each path touched by any change, both ends of a rename."""
    ends = F.explode(F.array("old_path", "new_path"))
    return changes.select("repo_id", ends.alias("path")).where("path IS NOT NULL").distinct()
