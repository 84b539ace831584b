"""Sync state: what was synced last, and which paths failed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_syncs(sync_state: DataFrame) -> DataFrame:
    """``config_hash, last_sha, last_sync_id`` of each configuration's newest sync."""
    return sync_state.groupBy("config_hash").agg(
        F.max_by("head_sha", "sync_id").alias("last_sha"), F.max("sync_id").alias("last_sync_id")
    )


def failed_of_last_sync(sync_state: DataFrame, failed_paths: DataFrame) -> DataFrame:
    """Failed paths of the newest sync only: each sync replaces the list of the one before."""
    newest = last_syncs(sync_state).select("config_hash", F.col("last_sync_id").alias("sync_id"))
    return failed_paths.join(newest, ["config_hash", "sync_id"], "left_semi")


def load_state(sources: DataFrame, sync_state: DataFrame, failed_paths: DataFrame) -> DataFrame:
    """``config_hash, last_sha, n_failed`` for every source, null and 0 for a new one."""
    counts = (
        failed_of_last_sync(sync_state, failed_paths)
        .groupBy("config_hash")
        .agg(F.count("*").alias("n_failed"))
    )
    return (
        sources.select("config_hash")
        .join(last_syncs(sync_state), "config_hash", "left")
        .join(counts, "config_hash", "left")
        .select("config_hash", "last_sha", F.coalesce("n_failed", F.lit(0).cast("bigint")).alias("n_failed"))
    )


def parse_failed_list(stored: Column) -> Column:
    """Paths of a stored JSON list; anything missing or unreadable counts as an empty list."""
    empty = F.array().cast("array<string>")
    return F.coalesce(F.from_json(stored, "array<string>"), empty)


def next_state(plan: DataFrame, sync_id: int) -> DataFrame:
    """State rows of one sync: the head of every source that was not left alone."""
    return plan.where("mode <> 'noop'").select(
        "config_hash", F.lit(sync_id).cast("bigint").alias("sync_id"), "head_sha"
    )


def next_failed(attempts: DataFrame, sync_id: int) -> DataFrame:
    """The failed list of one sync: every transient failure, so that none is lost when the head moves on."""
    return attempts.where("is_transient").select(
        "config_hash", F.lit(sync_id).cast("bigint").alias("sync_id"), "path", F.col("outcome").alias("reason")
    )


def retry_queue(failed: DataFrame, sources: DataFrame, passes: Column) -> DataFrame:
    """Failed paths that still pass their source's filter."""
    return failed.select("config_hash", "path").join(sources, "config_hash").where(passes)
