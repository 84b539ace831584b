"""A table kept in ranges of its key's hash, of which an upsert rewrites only those that it touches.

Each version of the table writes the touched ranges below its own number and then a manifest of all ranges: which
version holds each, and how many rows. Readers go by the newest finished manifest, so they see a version whole or
not at all, files of untouched ranges keep their names, and a repeated version replaces what it wrote. A range
that grew too large is split by the next digits of the hash.
"""

from __future__ import annotations

from math import ceil, log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from arborsync.operators.upsert import apply_upsert
from arborsync.staging import stage

RANGE, VERSION = "key_range", "version"
# A range of more rows is split; one task writes a range.
RANGE_ROWS = 100_000

MANIFEST = StructType([StructField(RANGE, StringType(), False), StructField("held_by", LongType(), False), StructField("rows", LongType(), False)])


def _hash(key: Column) -> Column:
    return F.md5(key.cast("string").cast("binary"))


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the finished versions."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    folder = hadoop(f"{path}/manifest")
    filesystem = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not filesystem.exists(folder):
        return []
    found = [s.getPath() for s in filesystem.listStatus(folder)]
    return sorted(int(p.getName().partition("=")[2]) for p in found if filesystem.exists(hadoop(p, "_SUCCESS")))


def _manifest(spark: SparkSession, path: str, before: int | None = None) -> dict[str, tuple[int, int]]:
    """Range -> (version that holds it, rows) of the newest version, or the newest below ``before``; a range for
    some ``RANGE_ROWS`` / 16 rows of the table or more."""
    usable = [v for v in _versions(spark, path) if before is None or v < before]
    if not usable:
        return {}
    rows = spark.read.schema(MANIFEST).parquet(f"{path}/manifest/{VERSION}={usable[-1]}").collect()
    return {r[RANGE]: (r["held_by"], r["rows"]) for r in rows}


def _read(spark: SparkSession, path: str, schema: StructType, ranges: dict[str, tuple[int, int]]) -> DataFrame:
    folders = [f"{path}/data/{VERSION}={v}/{RANGE}={r}" for r, (v, n) in ranges.items() if n]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*folders)


def read_ranged(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table as of its newest finished version."""
    return _read(spark, path, schema, _manifest(spark, path))


def _range_of(key: Column, ranges: list[str]) -> Column:
    """The range of a key: ranges are the letter r and leading digits of hashes, and none leads another."""
    digits = _hash(key)
    found = F.lit("r")
    for length in sorted({len(r) - 1 for r in ranges}):
        held = [r[1:] for r in ranges if len(r) == length + 1]
        at = F.substring(digits, 1, length) if length else F.lit("")
        found = F.when(at.isin(held), F.concat(F.lit("r"), at)).otherwise(found)
    return found


def upsert_ranged(
    path: str, upserts: DataFrame, deletes: DataFrame | None, version: int, key: str = "source_url", newest: str = "sync_id",
    range_rows: int = RANGE_ROWS,
) -> None:
    """Write version ``version`` of the table: ``upserts`` replace their keys, ``deletes`` (``key``) remove theirs.

    The first version makes the table, with the columns of ``upserts``. Only ranges that hold a touched key are read and written.
    """
    spark, schema = upserts.sparkSession, upserts.schema
    held = _manifest(spark, path, before=version)
    ranges = sorted(held) or ["r"]
    place = _range_of(F.col(key), ranges)
    fresh = stage(upserts.withColumn(RANGE, place), "upserts")
    touched = fresh.select(RANGE)
    gone = None
    if deletes is not None:
        gone = stage(deletes.select(key).distinct().withColumn(RANGE, place), "deletes")
        touched = touched.union(gone.select(RANGE))
    names = {r[0] for r in touched.distinct().collect()}
    old = _read(spark, path, schema, {r: held[r] for r in names if r in held})
    rows = stage(
        apply_upsert(old, fresh.select(*schema.names), gone.select(key) if gone is not None else None, newest, key).withColumn(RANGE, place), "touched-ranges")
    sizes = {r[RANGE]: r["count"] for r in rows.groupBy(RANGE).count().collect()}
    # Hashes are even, so so many further digits bring a range below the limit, or nearly.
    deeper = {r: ceil(log(n / range_rows, 16)) for r, n in sizes.items() if n > range_rows}
    split = F.col(RANGE)
    for more in sorted(set(deeper.values())):
        longer = F.concat(F.lit("r"), F.expr(f"substring(md5(cast(cast(`{key}` as string) as binary)), 1, length({RANGE}) - 1 + {more})"))
        split = F.when(F.col(RANGE).isin([r for r, m in deeper.items() if m == more]), longer).otherwise(split)
    placed = rows.withColumn(RANGE, split)
    target = f"{path}/data/{VERSION}={version}"
    placed.repartition(RANGE).write.mode("overwrite").partitionBy(RANGE).parquet(target)
    written = {r[RANGE]: (version, r["count"]) for r in placed.groupBy(RANGE).count().collect()}
    kept = {r: v for r, v in held.items() if r not in names}
    # Of a range that was split every part is named, those without rows too: keys of the future belong there.
    parts = {r + f"{i:0{more}x}" for r, more in deeper.items() for i in range(16**more)}
    empty = {r: (version, 0) for r in (names - set(deeper)) | parts if r not in written}
    whole = [(r, v, n) for r, (v, n) in {**kept, **empty, **written}.items()]
    spark.createDataFrame(whole, MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/{VERSION}={version}")
