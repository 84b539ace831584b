"""Layout of the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def write_tree(tree: DataFrame, path: str, files_per_write: int | None = None) -> None:
    """Tree rows in (repository, commit, path) order.

    The range cut splits a huge repository over many files, and the order lets
    min/max statistics prune a repository, a commit or a sub-folder.
    """
    key = ["repo_id", "commit_sha", "path"]
    ranged = (
        tree.repartitionByRange(files_per_write, *key) if files_per_write else tree.repartitionByRange(*key)
    )
    ranged.sortWithinPartitions(*key).write.mode("append").parquet(path)


def write_blobs(blobs: DataFrame, table: str, buckets: int) -> None:
    """Blobs bucketed by their key, so that joins to them move only the file rows."""
    (
        blobs.repartition(buckets, "blob_sha")
        .write.mode("overwrite")
        .bucketBy(buckets, "blob_sha")
        .sortBy("blob_sha")
        .saveAsTable(table)
    )


def write_documents(documents: DataFrame, path: str, sync_id: int) -> None:
    """Documents of one sync; a rerun of the sync replaces its own partitions only."""
    (
        documents.withColumn("sync_id", F.lit(sync_id).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("sync_id", "config_hash")
        .parquet(path)
    )


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A table that may not have been written yet."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    filesystem = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return spark.read.schema(schema).parquet(path) if filesystem.exists(folder) else spark.createDataFrame([], schema)
