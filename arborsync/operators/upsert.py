"""Applying upserts and deletes to the document table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = "source_url"


def _one_per_key(rows: DataFrame, version: str, key: str = KEY) -> DataFrame:
    """The greatest row of each key, by ``version`` first where there is such a column."""
    columns = rows.columns
    first = [version] if version in columns else []
    order = first + [c for c in columns if c not in (key, *first)]
    best = rows.groupBy(key).agg(F.max(F.struct(*order)).alias("_best"))
    return best.select(*[F.col(c) if c == key else F.col(f"_best.`{c}`") for c in columns])


def apply_upsert(
    documents: DataFrame, upserts: DataFrame, deletes: DataFrame | None = None, version: str = "sync_id", key: str = KEY
) -> DataFrame:
    """The table after one sync: an upsert replaces its key, a delete removes it unless upserted too.

    A key upserted several times ends as one row: the greatest by ``version`` if ``upserts`` has that
    column, and by the other columns among equals. Only the keys of the change meet the table; a
    small change set is broadcast by the planner and the documents are then not shuffled at all.
    """
    upserts = _one_per_key(upserts, version, key)
    touched = upserts.select(key)
    if deletes is not None:
        touched = touched.union(deletes.select(key))
    kept = documents.join(touched, key, "left_anti")
    return kept.unionByName(upserts.select(*documents.columns))


def latest_versions(documents: DataFrame, version: str = "sync_id") -> DataFrame:
    """One row per key, the newest version and among equals the greatest row: makes a replayed append harmless."""
    return _one_per_key(documents, version)
