"""Batches of successful files and the progress they report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborsync.functions.content import OK
from arborsync.operators.numbering import running_totals

BATCH_FILES = 50


def assign_batches(outcomes: DataFrame, batch_files: int = BATCH_FILES) -> DataFrame:
    """Add ``batch_no`` (from 0) and ``attempted`` (rank in the sync) to (config_hash, path, outcome) rows.

    A batch closes at its last success, so the batch of a row follows from the
    number of successes strictly before it; skips and failures ride along.
    """
    numbered = running_totals(
        outcomes, ["config_hash"], ["path"],
        {"_good_before": (F.col("outcome") == OK).cast("int"), "_rows_before": F.lit(1)},
    )
    return numbered.select(
        *outcomes.columns,
        F.floor(F.col("_good_before") / batch_files).cast("bigint").alias("batch_no"),
        (F.col("_rows_before") + 1).alias("attempted"),
    )


def batch_progress(batches: DataFrame, sources: DataFrame) -> DataFrame:
    """One message row per batch; a source without files gets a single completed one of 0/0."""
    per_batch = batches.groupBy("config_hash", "batch_no").agg(
        F.count_if(F.col("outcome") == OK).alias("documents"),
        F.count_if("is_transient").alias("failed"),
        F.max("attempted").alias("completed"),
    )
    totals = per_batch.groupBy("config_hash").agg(
        F.max("completed").alias("total"), F.max("batch_no").alias("last_batch")
    )
    zero = F.lit(0).cast("bigint")
    return (
        sources.select("config_hash")
        .join(totals, "config_hash", "left")
        .join(per_batch, "config_hash", "left")
        .select(
            "config_hash",
            F.coalesce("batch_no", zero).alias("batch_no"),
            F.coalesce("documents", zero).alias("documents"),
            F.coalesce("failed", zero).alias("failed"),
            F.coalesce("completed", zero).alias("completed"),
            F.coalesce("total", zero).alias("total"),
            F.when(F.col("batch_no") < F.col("last_batch"), "processing").otherwise("completed").alias("status"),
        )
    )
