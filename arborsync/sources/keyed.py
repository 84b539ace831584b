"""Tables looked up by a key without order, such as a content hash: written in segments, read by few keys.

A segment holds what one ingest added, sorted by key, with a Bloom filter per row group. Few keys are pushed into
the scan as equalities: a row group whose filter has none of them is not read, nor are pages of others that cannot
hold one. What a sync needs was mostly added lately, so of old segments nothing but filters is read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from arborsync.sources.tables import read_or_empty

SEGMENT = "segment"

# Bytes of a row group, and of a page, of which only those that may hold a key are read.
ROW_GROUP_BYTES, PAGE_BYTES, PAGE_ROWS = 16 << 20, 64 << 10, 500
# A row group that holds none of a thousand keys is kept by mistake once in ten times at this share.
FALSE_HITS = 0.0001
GROUP_KEYS = 50_000
# At most so many keys come to the driver and into the filter of a scan.
PUSHED_KEYS = 1000


def write_segment(
    rows: DataFrame, path: str, key: str, segment: int, row_group_bytes: int = ROW_GROUP_BYTES, once: bool = False
) -> None:
    """Write ``rows`` as one segment; writing a segment again replaces it, so a repeated ingest does no harm.

    ``once`` keeps one row of each key. Equal keys meet in one range, so wide rows move once for that and the order.
    """
    bloom = "parquet.bloom.filter"
    ranged = rows.repartitionByRange(key)
    (
        (ranged.dropDuplicates([key]) if once else ranged).sortWithinPartitions(key)
        .write.mode("overwrite")
        .option("compression", "zstd")
        .option(f"{bloom}.enabled#{key}", "true")
        .option(f"{bloom}.expected.ndv#{key}", str(GROUP_KEYS))
        .option(f"{bloom}.fpp#{key}", str(FALSE_HITS))
        .option("parquet.block.size", str(row_group_bytes))
        .option("parquet.page.size", str(min(PAGE_BYTES, row_group_bytes)))
        .option("parquet.page.row.count.limit", str(PAGE_ROWS))
        .parquet(f"{path}/{SEGMENT}={segment}")
    )


def append_new(
    rows: DataFrame, path: str, key: str, segment: int, row_group_bytes: int = ROW_GROUP_BYTES, once: bool = False
) -> None:
    """Write the rows whose key no other segment holds, with ``once`` one of each; of the stored table only the keys are read."""
    spark = rows.sparkSession
    held = read_segments(spark, path, rows.schema).where(F.col(SEGMENT) != segment).select(key)
    # Next to an empty table a join would still move all rows.
    fresh = rows if held.isEmpty() else rows.join(held, key, "left_anti")
    write_segment(fresh, path, key, segment, row_group_bytes, once)


def read_segments(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The whole table with its ``segment``; empty where none was written."""
    return read_or_empty(spark, path, StructType([*schema.fields, StructField(SEGMENT, LongType(), True)]))


def any_of(column: Column, values: Sequence) -> Column:
    """Equality with one of ``values``, as a tree of plain equalities: each reaches the Bloom filters.

    A list longer than a session setting would be pushed as its least and greatest value only.
    """
    terms = [column == F.lit(v) for v in values] or [F.lit(False)]
    while len(terms) > 1:
        terms = [a | b for a, b in zip(terms[::2], terms[1::2])] + ([terms[-1]] if len(terms) % 2 else [])
    return terms[0]


def rows_with_keys(table: DataFrame, key: str, wanted: DataFrame, pushed: int = PUSHED_KEYS, also: Sequence[str] = ()) -> DataFrame:
    """Rows of ``table`` whose ``key``, and columns ``also``, are in ``wanted`` (a written table or cheap to make twice).

    Up to ``pushed`` keys are pushed into the scan. With more, hashes of the key column alone tell which segments
    may hold any, and only those are read. The result is the same.
    """
    wanted = wanted.select(key, *also)
    few = [r[0] for r in wanted.where(F.col(key).isNotNull()).select(key).limit(pushed + 1).collect()]
    if len(few) <= pushed:
        found = table.where(any_of(F.col(key), sorted(set(few))))
        return found.join(wanted, [key, *also], "left_semi") if also else found
    if SEGMENT in table.columns:
        hashed = F.xxhash64(key).alias("_hash")
        used = table.select(hashed, SEGMENT).join(wanted.select(hashed), "_hash", "left_semi").select(SEGMENT).distinct().collect()
        table = table.where(F.col(SEGMENT).isin([r[0] for r in used]))
    return table.join(wanted, [key, *also], "left_semi")
