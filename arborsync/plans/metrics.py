"""Counts of one sync per source."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborsync.functions.content import OK


def sync_metrics(
    plan: DataFrame, attempts: DataFrame, deletes: DataFrame, started: datetime, finished: datetime
) -> DataFrame:
    """``config_hash, sync_type, started_at, finished_at, duration_seconds, files_added, files_updated,
    files_deleted, files_skipped, errors``.

    Skipped are permanent reasons, errors transient ones. A source without work
    shows zeros. All sources of a sync run together, so they share its times.
    """
    ok = F.col("outcome") == OK
    outcomes = attempts.groupBy("config_hash").agg(
        F.count_if(ok & (F.col("action") == "add")).alias("files_added"),
        F.count_if(ok & (F.col("action") == "update")).alias("files_updated"),
        F.count_if(~ok & ~F.col("is_transient")).alias("files_skipped"),
        F.count_if("is_transient").alias("errors"),
    )
    deleted = deletes.groupBy("config_hash").agg(F.count("*").alias("files_deleted"))
    counts = ("files_added", "files_updated", "files_deleted", "files_skipped", "errors")
    return (
        plan.select("config_hash", F.col("mode").alias("sync_type"))
        .join(outcomes, "config_hash", "left")
        .join(deleted, "config_hash", "left")
        .select(
            "config_hash", "sync_type", F.lit(started).alias("started_at"), F.lit(finished).alias("finished_at"),
            F.lit((finished - started).total_seconds()).alias("duration_seconds"),
            *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in counts],
        )
    )
