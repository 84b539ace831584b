"""Running totals and row numbers that hold when one group is most of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arborsync.staging import stage


def running_totals(df: DataFrame, group: Sequence[str], order: Sequence[str], measures: dict[str, Column]) -> DataFrame:
    """Add, per measure, its sum over the rows of the group strictly before the row.

    ``order`` must be unique within a group and ``group`` free of nulls. Rows are
    spread by range over (group, order), which cuts big groups into pieces; each
    piece is totalled on its own and shifted by the totals of the pieces before it.
    """
    named = df.select("*", *[m.cast("bigint").alias(f"_m_{n}") for n, m in measures.items()])
    pieces = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The piece number is a fact of this one shuffle, so it is written down
    # before anything is computed from it.
    ranged = stage(
        named.repartitionByRange(pieces, *group, *order).withColumn("_piece", F.spark_partition_id()),
        "pieces",
    )
    before = Window.partitionBy(*group).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    piece_totals = ranged.groupBy(*group, "_piece").agg(
        *[F.sum(f"_m_{n}").alias(f"_t_{n}") for n in measures]
    )
    shifts = piece_totals.select(
        *group, "_piece",
        *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_s_{n}") for n in measures],
    )
    within = _totals_before(ranged, [*group, "_piece"], order, measures)
    joined = within.join(shifts, [*group, "_piece"])
    shifted = {n: F.col(n) + F.col(f"_s_{n}") for n in measures}
    return joined.select(*df.columns, *[c.alias(n) for n, c in shifted.items()])


def _totals_before(
    df: DataFrame, group: Sequence[str], order: Sequence[str], measures: dict[str, Column]
) -> DataFrame:
    before = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    sums = {n: F.coalesce(F.sum(f"_m_{n}").over(before), F.lit(0)) for n in measures}
    return df.select("*", *[c.alias(n) for n, c in sums.items()]).drop(*[f"_m_{n}" for n in measures])


def number_rows(df: DataFrame, group: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """row_number() from 1 within each group, safe for hot groups."""
    counted = running_totals(df, group, order, {name: F.lit(1)})
    return counted.withColumn(name, F.col(name) + 1)
