"""Replay-safe sink: one folder per micro-batch, overwritten when the batch is repeated.

Now and then the batches so far are merged into a base, so that a reader opens one base and the few
batches behind it, however many there were.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from arborsync.sources.tables import read_or_empty

BATCH = "batch_id"
MERGE_EVERY = 50


def write_batch(rows: DataFrame, table: str, batch_id: int) -> None:
    rows.write.mode("overwrite").parquet(f"{table}/{BATCH}={batch_id}")


def _bases(spark: SparkSession, table: str) -> list[int]:
    """Numbers of the finished bases: each holds what the batches below its number said."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{table}_base")
    filesystem = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not filesystem.exists(folder):
        return []
    found = [s.getPath() for s in filesystem.listStatus(folder)]
    done = [p for p in found if filesystem.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted(int(p.getName().partition("=")[2]) for p in done)


def read_batches(
    spark: SparkSession, table: str, schema: StructType, before: int | None = None, merged_before: int | None = None
) -> DataFrame:
    """All written batches, or those before one. ``schema`` is without the batch column.

    ``merged_before`` leaves out bases of that number and above.
    """
    full = StructType([*schema.fields, StructField(BATCH, LongType(), True)])
    rows = read_or_empty(spark, table, full)
    rows = rows.where(F.col(BATCH) < before) if before is not None else rows
    usable = [
        b for b in _bases(spark, table)
        if (before is None or b <= before) and (merged_before is None or b < merged_before)
    ]
    if not usable:
        return rows
    base = spark.read.schema(full).parquet(f"{table}_base/upto={usable[-1]}")
    return base.select(*full.names).unionByName(rows.where(F.col(BATCH) >= usable[-1]))


def merge_batches(
    spark: SparkSession, table: str, schema: StructType, merge: Callable[[DataFrame], DataFrame], batch_id: int
) -> None:
    """Every MERGE_EVERY batches, write ``merge`` of all batches below ``batch_id`` as a base.

    ``merge`` takes and returns rows with the batch column. A repeated batch writes the same base again.
    """
    if batch_id and batch_id % MERGE_EVERY == 0:
        earlier = read_batches(spark, table, schema, before=batch_id, merged_before=batch_id)
        merge(earlier).write.mode("overwrite").parquet(f"{table}_base/upto={batch_id}")


def run_available(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> StreamingQuery:
    """Process everything that has arrived, one micro-batch at a time, then stop."""
    return (
        stream.writeStream.foreachBatch(handle)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
