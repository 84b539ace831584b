"""Lookup joins: many rows to a table with few rows per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def lookup_join(rows: DataFrame, table: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join ``rows`` to a ``table`` with few rows per key (``how``: left or inner).

    One key may hold a large share of ``rows``. The join is left to adaptive execution,
    which measures the shuffled partitions and reads an oversized one of ``rows`` in
    slices, each with the matching rows of ``table``; session.JOB_CONF switches that on.
    """
    return rows.join(table, list(on), how)
