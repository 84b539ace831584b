"""Content joins and read outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborsync.functions import content as tests
from arborsync.functions import paths
from arborsync.functions.mime import with_mime_type
from arborsync.operators.skew import lookup_join
from arborsync.sources.keyed import SEGMENT, rows_with_keys
from arborsync.staging import stage


def needed_blobs(files: DataFrame, blobs: DataFrame) -> DataFrame:
    """The blobs some file points at.

    Cut down first: with few files the planner broadcasts their keys and no
    content is shuffled; with many, the join to come reuses this one's partitioning.
    Of blobs stored in segments (keyed.append_new) only those row groups or segments are
    read that hold a key some file points at. Their keys are written down for it first.
    """
    wanted = files.select("blob_sha").distinct()
    if SEGMENT in blobs.columns:
        return rows_with_keys(blobs, "blob_sha", stage(wanted, "wanted-blobs")).drop(SEGMENT)
    return blobs.join(wanted, "blob_sha", "left_semi")


def attach_content(files: DataFrame, blobs: DataFrame) -> DataFrame:
    """Files with ``content, read_error, found``; run after all path filters.

    Equal files share a blob, so the join key may be hot (empty files, licences).
    """
    stored = needed_blobs(files, blobs).select("blob_sha", "content", "read_error", F.lit(True).alias("found"))
    joined = lookup_join(files, stored, ["blob_sha"])
    return joined.withColumn("found", F.coalesce("found", F.lit(False)))


def blob_outcomes(blobs: DataFrame, limit: int | None = None) -> DataFrame:
    """``blob_sha, outcome, bytes`` of every blob: a scan that emits no content."""
    content = F.col("content")
    return blobs.select(
        "blob_sha",
        tests.read_outcome(content, F.lit(True), F.col("read_error"), limit).alias("outcome"),
        F.octet_length(content).cast("bigint").alias("bytes"),
    )


def _by_size(files: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """(files to read, files that their listed size makes too large, with the verdict)."""
    large = F.coalesce(F.col("size") > limit, F.lit(False))
    return files.where(~large), _with_verdict(files.where(large), F.lit(tests.TOO_LARGE))


def read_outcomes(files: DataFrame, blobs: DataFrame, limit: int | None = None, by_size: bool = False) -> DataFrame:
    """Files with ``outcome, is_transient, bytes``. Only the verdicts on blobs are shuffled, not the blobs.

    ``by_size``: as for read_texts; ``bytes`` is then the listed size.
    """
    if by_size and limit is not None:
        rest, large = _by_size(files, limit)
        return read_outcomes(rest, blobs, limit).unionByName(large.withColumn("bytes", F.col("size").cast("bigint")))
    verdicts = blob_outcomes(needed_blobs(files, blobs), limit)
    judged = lookup_join(files, verdicts, ["blob_sha"])
    return _with_verdict(judged, F.coalesce("outcome", F.lit(tests.NOT_FOUND)))


def _with_verdict(files: DataFrame, outcome: Column) -> DataFrame:
    climbs = paths.has_traversal(paths.normalize_path(F.col("path")))
    return files.withColumn("outcome", F.when(climbs, tests.BAD_PATH).otherwise(outcome)).withColumn(
        "is_transient", tests.is_transient(F.col("outcome"))
    )


def read_texts(files: DataFrame, blobs: DataFrame, limit: int | None = None, by_size: bool = False) -> DataFrame:
    """Files with ``outcome, is_transient, text``; text is null unless the outcome is ok.

    For jobs that want the content anyway: it is scanned and shuffled once. With ``by_size`` a file whose
    listed ``size`` is over the limit is too large without being read, whatever it holds.
    """
    if by_size and limit is not None:
        rest, large = _by_size(files, limit)
        return read_texts(rest, blobs, limit).unionByName(large.withColumn("text", F.lit(None).cast("string")))
    attached = attach_content(files, blobs)
    content = F.col("content")
    outcome = tests.read_outcome(content, F.col("found"), F.col("read_error"), limit)
    judged = _with_verdict(attached, outcome)
    text = F.when(F.col("outcome") == tests.OK, tests.decode_utf8(content))
    return judged.withColumn("text", text.cast("string")).drop("content", "read_error", "found")


def download_manifest(files: DataFrame, blobs: DataFrame) -> DataFrame:
    """Content of all chosen files in one join, with name and MIME type."""
    named = files.withColumn("file_name", paths.file_name(F.col("path")))
    return attach_content(with_mime_type(named), blobs)
