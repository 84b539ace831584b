"""What a change set means for the documents: actions, upserts, deletes, annotations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborsync.operators.diff import ADDED, DELETED, MODIFIED, RENAMED

ADD, UPDATE, DELETE, UPSERT = "add", "update", "delete", "upsert"


def _expand(changes: DataFrame, steps: dict[str, list[tuple[str, str]]]) -> DataFrame:
    """One row per (action, path) that a change stands for; no shuffle."""
    wanted: Column = F.array()
    for status, actions in steps.items():
        rows = F.array(
            *[F.struct(F.lit(a).alias("action"), F.col(side).alias("path")) for a, side in actions]
        )
        wanted = F.when(F.col("status") == status, rows) if status == next(iter(steps)) else wanted.when(
            F.col("status") == status, rows
        )
    return changes.select("repo_id", F.explode(wanted).alias("step")).select("repo_id", "step.action", "step.path")


def sync_actions(changes: DataFrame, rename_as_delete_add: bool = True) -> DataFrame:
    """``repo_id, action, path``; a rename is delete + add, or one update of the new path."""
    rename = [(DELETE, "old_path"), (ADD, "new_path")] if rename_as_delete_add else [(UPDATE, "new_path")]
    return _expand(
        changes,
        {
            ADDED: [(ADD, "new_path")],
            MODIFIED: [(UPDATE, "new_path")],
            DELETED: [(DELETE, "old_path")],
            RENAMED: rename,
        },
    )


def upserts_and_deletes(changes: DataFrame) -> DataFrame:
    """``repo_id, action, path`` with the two actions a document table needs."""
    return _expand(
        changes,
        {
            ADDED: [(UPSERT, "new_path")],
            MODIFIED: [(UPSERT, "new_path")],
            DELETED: [(DELETE, "old_path")],
            RENAMED: [(DELETE, "old_path"), (UPSERT, "new_path")],
        },
    )


def active_files(listing: DataFrame, changes: DataFrame) -> DataFrame:
    """Listing without deleted paths and rename sources."""
    gone = changes.where(F.col("status").isin(DELETED, RENAMED)).select(
        "repo_id", F.col("old_path").alias("path")
    )
    return listing.join(gone, ["repo_id", "path"], "left_anti")


def orphans(known: DataFrame, current: DataFrame) -> DataFrame:
    """Known (repo_id, path) rows that the current snapshot no longer has."""
    return known.join(current.select("repo_id", "path"), ["repo_id", "path"], "left_anti")


def annotate_listing(listing: DataFrame, changes: DataFrame) -> DataFrame:
    """Listing with the status of each path: what happened to it, or ``unchanged``."""
    words = {ADDED: "added", MODIFIED: "modified", DELETED: "deleted", RENAMED: "renamed"}
    word = F.lit(None).cast("string")
    for code, text in words.items():
        word = F.when(F.col("status") == code, text).otherwise(word)
    marked = changes.select(
        "repo_id", F.coalesce("new_path", "old_path").alias("path"), word.alias("file_status")
    )
    return (
        listing.join(marked, ["repo_id", "path"], "left")
        .withColumn("status", F.coalesce("file_status", F.lit("unchanged")))
        .drop("file_status")
    )
