"""Written intermediate tables: the lineage cut used by loops and numbering."""

from __future__ import annotations

from pyspark.sql import DataFrame

from arborsync.session import new_work_path


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared work folder and read it back.

    A lost executor then costs a re-read, never a replay of the whole loop, and
    later steps see frozen rows with column pruning and file sizes to plan by.
    """
    spark = df.sparkSession
    path = new_work_path(spark, label)
    df.write.mode("error").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
