"""Per source: nothing to do, a full sync or an incremental one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborsync.operators.graph import CommitIndex, compare_commits
from arborsync.staging import stage

FULL, INCREMENTAL, NOOP = "full", "incremental", "noop"


def plan_syncs(
    sources: DataFrame,
    state: DataFrame,
    commits: DataFrame,
    index: DataFrame | CommitIndex | None = None,
    snapshots: DataFrame | None = None,
) -> DataFrame:
    """Add ``last_sha, n_failed, distance, mode, reason`` to sources with ``config_hash, repo_id, head_sha``.

    ``state``: ``config_hash, last_sha, n_failed`` (see load_state). A changed
    configuration has a new hash, so no state, so a full sync. Only sources whose
    head moved are looked up in the commit graph. A distance that cannot be told
    means a full sync, and so does an old snapshot that is not among ``snapshots``
    (``repo_id, commit_sha``, any number of rows each) where these are given. How far
    apart two commits are is told, but a comparison of snapshots costs the same at any
    distance, so it does not choose the mode.
    """
    known = sources.join(state, "config_hash", "left").withColumn(
        "n_failed", F.coalesce("n_failed", F.lit(0).cast("bigint"))
    )
    # One row per source, and read by every round of the graph walk.
    known = stage(known, "known")
    moved = (
        known.where("last_sha IS NOT NULL AND head_sha IS NOT NULL AND last_sha <> head_sha")
        .select("repo_id", F.col("last_sha").alias("old_sha"), F.col("head_sha").alias("new_sha"))
        .distinct()
    )
    compared = compare_commits(moved, commits, index).select(
        "repo_id", F.col("old_sha").alias("last_sha"), F.col("new_sha").alias("head_sha"),
        "is_reachable", F.col("distance").alias("_apart"),
    )
    kept = F.lit(True)
    if snapshots is not None:
        asked = moved.select("repo_id", F.col("old_sha").alias("commit_sha"))
        found = snapshots.join(asked, ["repo_id", "commit_sha"], "left_semi").distinct()
        compared = compared.join(
            found.select("repo_id", F.col("commit_sha").alias("last_sha"), F.lit(True).alias("_kept")), ["repo_id", "last_sha"], "left")
        kept = F.coalesce("_kept", F.lit(False))
    same = F.col("last_sha") == F.col("head_sha")
    distance = F.when(same, F.lit(0).cast("bigint")).otherwise(F.col("_apart"))
    reason = (
        F.when(F.col("head_sha").isNull(), "unresolved_ref")
        .when(F.col("last_sha").isNull(), "first_sync")
        .when(same & (F.col("n_failed") == 0), "unchanged")
        .when(same, "retry_only")
        .when(~F.coalesce("is_reachable", F.lit(False)), "history_rewritten")
        .when(F.col("distance").isNull(), "distance_unknown")
        .when(~kept, "snapshot_missing")
        .otherwise("changes")
    )
    mode = (
        F.when(F.col("reason").isin("unchanged", "unresolved_ref"), NOOP)
        .when(F.col("reason").isin("changes", "retry_only"), INCREMENTAL)
        .otherwise(FULL)
    )
    return (
        known.join(compared, ["repo_id", "last_sha", "head_sha"], "left")
        .withColumn("distance", distance)
        .withColumn("reason", reason)
        .withColumn("mode", mode)
        .drop("_apart", "is_reachable", "_kept")
    )
