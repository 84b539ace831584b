"""Content tests and content joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arborsync.catalog import Catalog
from arborsync.catalog.fragments import FILES, PLANTED
from arborsync.functions import content as tests
from arborsync.operators import content as reading
from arborsync.session import new_work_path
from arborsync.sources import directory, directory_source, virtual
from arborsync.staging import stage

CATALOG = Catalog()

HELD_SQL = "doc_id % 9 not in (4, 5)"


def _new(spark: SparkSession, folder: str) -> DataFrame:
    return virtual.snapshot_pair(spark, folder, planted=True)[1]


@CATALOG.query(
    f"""with {PLANTED} select path, case when {HELD_SQL} then late_nul_is_text = 'binary' end as is_binary,
  case when {HELD_SQL} then outcome = 'binary' end as is_binary_anywhere from judged where version = 'new'"""
)
def classify_binary(spark: SparkSession, folder: str) -> DataFrame:
    """Every file: by its first 8192 bytes, and by all of them; null where no content is held."""
    attached = reading.attach_content(_new(spark, folder), virtual.planted_blobs(spark, folder))
    content = F.col("content")
    return attached.select(
        "path", F.when(content.isNotNull(), tests.is_binary(content, tests.SNIFF_BYTES)).alias("is_binary"),
        F.when(content.isNotNull(), tests.is_binary(content)).alias("is_binary_anywhere"),
    )


@CATALOG.query(
    f"""with {PLANTED} select path, case when {HELD_SQL} then doc_id % 9 not in (0, 3) end as is_utf8,
  case when {HELD_SQL} and doc_id % 9 not in (0, 3) then planted_bytes end as text_bytes,
  case when doc_id % 9 >= 7 then sha256(text) end as plain_sha from judged where version = 'new'"""
)
def classify_utf8(spark: SparkSession, folder: str) -> DataFrame:
    """Validity of every file, null where no content is held; the length of each valid text, plain texts by hash."""
    attached = reading.attach_content(_new(spark, folder), virtual.planted_blobs(spark, folder))
    content = F.col("content")
    text = tests.decode_utf8(content).cast("string")
    return attached.select(
        "path", F.when(content.isNotNull(), tests.is_utf8(content)).alias("is_utf8"),
        F.octet_length(text).cast("bigint").alias("text_bytes"),
        F.when(F.col("doc_id") % 9 >= 7, F.sha2(text, 256)).alias("plain_sha"),
    )


@CATALOG.query(
    f"""with {PLANTED} select path, outcome, outcome = 'read_error' as is_transient,
  case when {HELD_SQL} then size end as bytes from judged where version = 'new'"""
)
def read_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    judged = reading.read_outcomes(_new(spark, folder), virtual.planted_blobs(spark, folder))
    return judged.select("path", "outcome", "is_transient", "bytes")


@CATALOG.query(
    f"""with {PLANTED} select path, doc_id % 9 <> 4 as found,
  case when doc_id % 9 = 5 then 'Input/output error' end as read_error,
  case when {HELD_SQL} then size end as bytes from judged where version = 'new'"""
)
def content_attach(spark: SparkSession, folder: str) -> DataFrame:
    attached = reading.attach_content(_new(spark, folder), virtual.planted_blobs(spark, folder))
    return attached.select(
        "path", "found", "read_error", F.octet_length("content").cast("bigint").alias("bytes")
    )


@CATALOG.query(
    f"""with {PLANTED} select path, case when outcome = 'ok' and size > 20000 then 'too_large' else outcome end as outcome,
  case when outcome = 'ok' and size <= 20000 then content end as text from judged where version = 'new'"""
)
def read_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Whole texts of readable files, with a limit of 20,000 bytes."""
    read = reading.read_texts(_new(spark, folder), virtual.planted_blobs(spark, folder), 20_000)
    return read.select("path", "outcome", "text")


@CATALOG.query(
    f"""with {PLANTED} select path, case when size > 20000 then 'too_large' else outcome end as outcome,
  case when outcome = 'ok' and size <= 20000 then content end as text from judged where version = 'new'"""
)
def read_texts_by_size(spark: SparkSession, folder: str) -> DataFrame:
    """The same limit by the size that the tree lists: larger files are not read at all."""
    read = reading.read_texts(_new(spark, folder), virtual.planted_blobs(spark, folder), 20_000, by_size=True)
    return read.select("path", "outcome", "text")


@CATALOG.query(
    f"""with {PLANTED} select path, string_split(path, '/')[-1] as file_name,
  case doc_id % 6 when 0 then 'text/markdown' when 1 then 'text/plain' when 2 then 'text/x-python'
    when 3 then 'application/json' when 4 then 'application/x-tar' else 'text/plain' end as mime_type,
  doc_id % 9 <> 4 as found, case when {HELD_SQL} then size end as bytes
from judged where version = 'new'"""
)
def download_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Every file of the new snapshot as a download, in one join."""
    manifest = reading.download_manifest(_new(spark, folder), virtual.planted_blobs(spark, folder))
    return manifest.select(
        "path", "file_name", "mime_type", "found", F.octet_length("content").cast("bigint").alias("bytes")
    )


@CATALOG.query(
    f"""with {FILES}
select path, octet_length(encode(text)) as size, sha256(text) as blob_sha, starts_with(path, 'src3/') as in_folder from files"""
)
def ingest_directory(spark: SparkSession, folder: str) -> DataFrame:
    """Every document written as a file and read back through the data source, one folder once more by a filter."""
    root = new_work_path(spark, "directory").removeprefix("file://").removeprefix("file:")
    docs = virtual.files(spark, folder).select("path", F.encode("text", "UTF-8").alias("content"))
    stage(directory.write_directory(docs, root), "written-files")
    files, again = (directory_source.load_directory(spark, root) for _ in range(2))
    part = again.where(F.col("path").startswith("src3/")).select("path", F.lit(True).alias("in_folder"))
    return files.join(part, "path", "left").select(
        "path", "size", F.sha2("content", 256).alias("blob_sha"), F.coalesce("in_folder", F.lit(False)).alias("in_folder"))
