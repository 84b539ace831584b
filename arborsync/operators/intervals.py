"""Snapshots as intervals: a file is stored once for as long as it stays the same, not once for each snapshot.

Snapshots of a repository have positions in the order of their ingest. A row opened at a position holds until a
closing row names it; both are only ever added. What a snapshot costs to store follows what changed in it, and any
earlier one can be read back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arborsync.operators.skew import lookup_join
from arborsync.schemas import CLOSED_ROWS, OPENED_ROWS
from arborsync.sources.tables import read_or_empty
from arborsync.staging import stage

# Folders by repository: a read of some repositories opens theirs only.
BUCKETS = 64
_FILE = ("mode", "blob_sha", "size")


def bucket_of(repo: Column) -> Column:
    return F.pmod(F.xxhash64(repo), F.lit(BUCKETS)).cast("int")


def _write(rows: DataFrame, path: str, segment: int) -> None:
    placed = rows.withColumn("bucket", bucket_of(F.col("repo_id")))
    # A folder's rows are spread over files by path, so that a large repository is many tasks.
    ranged = placed.repartitionByRange("bucket", "repo_id", "path").sortWithinPartitions("bucket", "repo_id", "path")
    ranged.write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/segment={segment}")


def read_intervals(spark: SparkSession, store: str, repos: DataFrame | None = None, before: int | None = None) -> DataFrame:
    """``repo_id, path, mode, blob_sha, size, valid_from, valid_to``: a file holds from one position up to, not including, another.

    ``valid_to`` is null for files of the newest snapshot. ``repos`` (``repo_id``): read only the buckets of these.
    ``before`` leaves out segments from that number on.
    """
    opened, closed = read_or_empty(spark, f"{store}/opened", OPENED_ROWS), read_or_empty(spark, f"{store}/closed", CLOSED_ROWS)
    if before is not None:
        opened, closed = (t.where(F.col("segment") < before) for t in (opened, closed))
    if repos is not None:
        # As many as there are buckets, at most.
        used = [r[0] for r in repos.select(bucket_of(F.col("repo_id"))).distinct().collect()]
        opened, closed = (t.where(F.col("bucket").isin(used)) for t in (opened, closed))
    key = ["repo_id", "path", "valid_from"]
    return opened.select(*key, *_FILE).join(closed.select(*key, "valid_to"), key, "left").select(
        "repo_id", "path", *_FILE, "valid_from", "valid_to")


def files_at(spark: SparkSession, store: str, at: DataFrame) -> DataFrame:
    """``repo_id, position, path, mode, blob_sha, size`` of the snapshots ``at`` (``repo_id, position``, a written table)."""
    held = read_intervals(spark, store, at)
    met = lookup_join(held, at.select("repo_id", "position"), ["repo_id"], "inner")
    there = (F.col("valid_from") <= F.col("position")) & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col("position")))
    return met.where(there).select("repo_id", "position", "path", *_FILE)


def ingest_snapshots(tree: DataFrame, positions: DataFrame, store: str, segment: int) -> None:
    """Add one snapshot for each repository in ``positions`` (``repo_id, position``, greater than any before).

    ``tree``: ``repo_id, path, mode, blob_sha, size`` of these snapshots; a repository without rows has become
    empty. Repeating the ingest of a ``segment`` replaces what it wrote; segments are ingested in order.
    """
    spark = tree.sparkSession
    at = stage(positions.select("repo_id", "position"), "positions")
    held = read_intervals(spark, store, at, before=segment).where("valid_to IS NULL")
    now = F.struct(*_FILE)
    old = lookup_join(held, at, ["repo_id"], "inner").select("repo_id", "path", "position", "valid_from", now.alias("old"))
    new = lookup_join(tree, at, ["repo_id"], "inner").select("repo_id", "path", F.col("position").alias("_position"), now.alias("new"))
    changed = stage(
        old.join(new, ["repo_id", "path"], "full_outer").where(~F.col("old").eqNullSafe(F.col("new"))).withColumn(
            "position", F.coalesce("position", "_position")),
        "interval-changes")
    _write(changed.where("old IS NOT NULL").select("repo_id", "path", "valid_from", F.col("position").alias("valid_to")), f"{store}/closed", segment)
    _write(changed.where("new IS NOT NULL").select("repo_id", "path", F.col("position").alias("valid_from"), "new.*"), f"{store}/opened", segment)
