"""Keyed stream state: the latest version of each path, and the paths whose last read failed.

Rows carry ``path, ts, seq, failed`` and payload columns. All state is a maximum
over the position (ts, seq), so neither arrival order nor replays matter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from arborsync.streaming.sink import merge_batches, read_batches, run_available, write_batch

POSITION = ("ts", "seq")


def latest_per_path(rows: DataFrame, payload: list[str]) -> DataFrame:
    """``path, latest``: a struct of the newest row's position and payload."""
    return rows.groupBy("path").agg(F.max(F.struct(*POSITION, *payload)).alias("latest"))


def last_outcomes(rows: DataFrame) -> DataFrame:
    """``path, last_failure, last_success``: the positions of the newest failed and the newest good read."""
    position = F.struct(*POSITION)
    return rows.groupBy("path").agg(
        F.max(F.when(F.col("failed"), position)).alias("last_failure"),
        F.max(F.when(~F.col("failed"), position)).alias("last_success"),
    )


def still_failing(outcomes: DataFrame) -> DataFrame:
    """The retry queue: paths that failed and were not read since."""
    return outcomes.where(
        F.col("last_failure").isNotNull()
        & (F.col("last_success").isNull() | (F.col("last_failure") > F.col("last_success")))
    )


def _newest(rows: DataFrame) -> DataFrame:
    """One row per path: every other column is a position or starts with one, so its maximum is the newest."""
    return rows.groupBy("path").agg(*[F.max(c).alias(c) for c in rows.columns if c != "path"])


def start_updates(state: DataFrame, output: str, checkpoint: str) -> StreamingQuery:
    """Write the changed keys of a streaming aggregate, one folder per micro-batch, merged now and then."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        merge_batches(batch.sparkSession, output, state.schema, _newest, batch_id)
        write_batch(batch, output, batch_id)

    return run_available(state, handle, checkpoint, mode="update")


def read_latest(spark: SparkSession, output: str, schema: StructType) -> DataFrame:
    """Newest version of every path over all batches."""
    updates = read_batches(spark, output, schema)
    return updates.groupBy("path").agg(F.max("latest").alias("latest")).select("path", "latest.*")


def read_retry_queue(spark: SparkSession, output: str, schema: StructType) -> DataFrame:
    updates = read_batches(spark, output, schema)
    merged = updates.groupBy("path").agg(
        F.max("last_failure").alias("last_failure"), F.max("last_success").alias("last_success")
    )
    return still_failing(merged).select(
        "path", F.col("last_failure.ts").alias("failed_at"), F.col("last_failure.seq").alias("seq")
    )
