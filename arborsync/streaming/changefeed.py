"""Change feed: each announced snapshot is compared with the one before it.

A snapshot is stored first (merkle.store_snapshots), then its announcement
(``repo_id, sync_id, commit_sha, files``, the number of its files) is dropped
into a folder, so a micro-batch always sees whole snapshots. Two snapshots are
compared from their top folders down, and folders that are the same in both are
not read: a micro-batch costs what changed, not what is stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from arborsync.operators.diff import MODIFIED
from arborsync.operators.merkle import merkle_changeset, read_roots, stored_folders
from arborsync.staging import stage
from arborsync.streaming.sink import BATCH, merge_batches, read_batches, run_available, write_batch

ANNOUNCEMENTS = StructType(
    [
        StructField("repo_id", StringType(), True),
        StructField("sync_id", LongType(), True),
        StructField("commit_sha", StringType(), True),
        StructField("files", LongType(), True),
    ]
)

CHANGES = StructType(
    [
        StructField("repo_id", StringType(), True),
        StructField("sync_id", LongType(), True),
        StructField("status", StringType(), True),
        StructField("old_path", StringType(), True),
        StructField("new_path", StringType(), True),
    ]
)


def read_announcements(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(ANNOUNCEMENTS).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def batch_steps(announced: DataFrame, heads: DataFrame) -> DataFrame:
    """``repo_id, sync_id, commit_sha, files, previous`` of the steps that newly announced snapshots make or change.

    ``heads``: announcements handled before. A snapshot's predecessor is the one with the greatest
    sync_id below its own, whenever either was announced; so a late one also changes the step of its
    successor, which is told again.
    """
    told = ("repo_id", "sync_id", F.struct("commit_sha", "files").alias("_told"))
    fresh = announced.select(*told, F.lit(True).alias("_fresh"))
    mine = fresh.select("repo_id").distinct()
    earlier = heads.join(mine, "repo_id", "left_semi").select(*told, F.lit(False).alias("_fresh"))
    known = fresh.unionByName(earlier).groupBy("repo_id", "sync_id").agg(
        F.max_by("_told", "_fresh").alias("_told"), F.max("_fresh").alias("_fresh")
    ).select("repo_id", "sync_id", "_told.*", "_fresh")
    in_order = Window.partitionBy("repo_id").orderBy("sync_id")
    lined_up = known.withColumns({
        "previous": F.lag("commit_sha").over(in_order), "_after_fresh": F.coalesce(F.lag("_fresh").over(in_order), F.lit(False)),
    })
    return lined_up.where("_fresh OR _after_fresh").select("repo_id", "sync_id", "commit_sha", "files", "previous")


def with_roots(steps: DataFrame, roots: DataFrame) -> DataFrame:
    """Add ``new_tree, stored`` (files of the stored snapshot, 0 where there is none) and ``old_tree`` to ``steps``."""
    key = ["repo_id", "commit_sha"]
    asked = steps.select(*key).union(steps.select("repo_id", F.col("previous").alias("commit_sha"))).distinct()
    known = stage(roots.join(asked, key, "left_semi"), "roots")
    new = known.select(*key, F.col("tree_id").alias("new_tree"), F.col("files").alias("stored"))
    old = known.select("repo_id", F.col("commit_sha").alias("previous"), F.col("tree_id").alias("old_tree"))
    found = steps.join(new, key, "left").join(old, ["repo_id", "previous"], "left")
    return found.withColumn("stored", F.coalesce("stored", F.lit(0).cast("bigint")))


def step_changes(steps: DataFrame, folders) -> DataFrame:
    """Change rows with their ``sync_id`` for ``steps`` (see with_roots); ``folders`` as for merkle.folder_changes."""
    step = F.concat_ws("\x1f", "repo_id", F.col("sync_id").cast("string")).alias("repo_id")
    changes = merkle_changeset(steps.select(step, "old_tree", "new_tree"), folders)
    return changes.select(
        F.split_part("repo_id", F.lit("\x1f"), F.lit(1)).alias("repo_id"),
        F.split_part("repo_id", F.lit("\x1f"), F.lit(2)).cast("bigint").alias("sync_id"),
        "status", "old_path", "new_path",
    )


def current_paths(feed: DataFrame) -> DataFrame:
    """``repo_id, path`` of the files that exist after all changes of the feed, replays included."""
    there = F.struct(F.col("new_path").alias("path"), F.lit(True).alias("exists"))
    gone = F.struct(F.col("old_path").alias("path"), F.lit(False).alias("exists"))
    # An edited file is on both sides of its row: only its new side counts.
    ends = F.when(F.col("status") == MODIFIED, F.array(there)).otherwise(F.array(there, gone))
    steps = feed.select("repo_id", "sync_id", F.explode(ends).alias("end")).where("end.path IS NOT NULL")
    last = steps.groupBy("repo_id", "end.path").agg(F.max_by("end.exists", "sync_id").alias("exists"))
    return last.where("exists").select("repo_id", "path")


def _last_told(heads: DataFrame) -> DataFrame:
    """One row per step: what the last batch said."""
    last = F.max(F.struct(BATCH, "commit_sha", "files")).alias("last")
    return heads.groupBy("repo_id", "sync_id").agg(last).select("repo_id", "sync_id", "last.*").select(*heads.columns)


def read_feed(spark: SparkSession, output: str) -> DataFrame:
    """``repo_id, sync_id, status, old_path, new_path``: of each step, what the last batch that told it said."""
    told = read_batches(spark, f"{output}/heads", ANNOUNCEMENTS).groupBy("repo_id", "sync_id").agg(F.max(BATCH).alias(BATCH))
    changes = read_batches(spark, f"{output}/changes", CHANGES)
    return changes.join(told, ["repo_id", "sync_id", BATCH], "left_semi").drop(BATCH)


def start_changefeed(announcements: DataFrame, store: str, output: str, checkpoint: str) -> StreamingQuery:
    """Write ``output/changes`` and ``output/heads``; a repeated micro-batch rewrites the same folders.

    ``store`` is a folder store; it is listed anew in every batch, so snapshots stored after the start
    are seen. A snapshot with other than the announced number of files there (none at all, where no
    number is given) fails the batch: it was announced before it was stored.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        merge_batches(spark, f"{output}/heads", ANNOUNCEMENTS, _last_told, batch_id)
        heads = read_batches(spark, f"{output}/heads", ANNOUNCEMENTS, before=batch_id)
        steps = stage(with_roots(batch_steps(batch, heads), read_roots(spark, store)), "steps")
        missing = steps.where(F.coalesce(F.col("files") != F.col("stored"), F.col("stored") == 0)).first()
        if missing:
            raise RuntimeError(f"snapshot {missing['commit_sha']} of {missing['repo_id']} is announced but not stored in full")
        write_batch(step_changes(steps, stored_folders(spark, store)), f"{output}/changes", batch_id)
        write_batch(steps.select("repo_id", "sync_id", "commit_sha", "files"), f"{output}/heads", batch_id)

    return run_available(announcements, handle, checkpoint)
