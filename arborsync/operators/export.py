"""Change sets as JSON, in bounded parts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborsync.operators.diff import ADDED, DELETED, MODIFIED, RENAMED
from arborsync.operators.numbering import number_rows
from arborsync.schemas import CHANGESET_JSON, FILE_INFO_JSON

PART_CHANGES = 10_000


def export_changesets(changes: DataFrame, part_changes: int = PART_CHANGES) -> DataFrame:
    """``repo_id, part, changeset`` rows, each a JSON object of four sorted lists.

    A repository's change set may exceed one row or one task, so it is cut into
    parts of at most ``part_changes`` changes in path order; the parts together
    are the whole set.
    """
    keyed = changes.select(
        "repo_id", "status", "old_path", "new_path",
        F.coalesce("new_path", "old_path").alias("path"),
    )
    numbered = number_rows(keyed, ["repo_id"], ["path", "status"], "n")
    part = F.floor((F.col("n") - 1) / part_changes).cast("bigint")

    def paths_of(code: str, side: str):
        return F.sort_array(F.collect_list(F.when(F.col("status") == code, F.col(side))))

    pairs = F.sort_array(
        F.collect_list(F.when(F.col("status") == RENAMED, F.array("old_path", "new_path")))
    )
    return (
        numbered.groupBy("repo_id", part.alias("part"))
        .agg(
            paths_of(ADDED, "new_path").alias("added"),
            paths_of(MODIFIED, "new_path").alias("modified"),
            paths_of(DELETED, "old_path").alias("deleted"),
            pairs.alias("renamed"),
        )
        .select("repo_id", "part", F.to_json(F.struct("added", "modified", "deleted", "renamed")).alias("changeset"))
    )


def export_listing(listing: DataFrame) -> DataFrame:
    """``repo_id, file_info``: each row of a listing (``path, name, size, type``) as a JSON object."""
    return listing.select("repo_id", F.to_json(F.struct(*[f.name for f in FILE_INFO_JSON])).alias("file_info"))


def import_listing(exported: DataFrame) -> DataFrame:
    """Listing rows back from JSON; a missing size is 0 and a missing type a file."""
    row = exported.select("repo_id", F.from_json("file_info", FILE_INFO_JSON).alias("f"))
    return row.select(
        "repo_id", "f.path", "f.name", F.coalesce("f.size", F.lit(0).cast("bigint")).alias("size"),
        F.coalesce("f.type", F.lit("file")).alias("type"))


def import_changesets(exported: DataFrame) -> DataFrame:
    """The long form back from JSON parts; missing lists count as empty."""
    lists = exported.select("repo_id", F.from_json("changeset", CHANGESET_JSON).alias("c"))
    none = F.lit(None).cast("string")

    def rows(code: str, items: str, old, new):
        return F.transform(
            F.coalesce(F.col(f"c.{items}"), F.array().cast(CHANGESET_JSON[items].dataType)),
            lambda x: F.struct(
                F.lit(code).alias("status"), old(x).alias("old_path"), new(x).alias("new_path")
            ),
        )

    everything = F.concat(
        rows(ADDED, "added", lambda x: none, lambda x: x),
        rows(MODIFIED, "modified", lambda x: x, lambda x: x),
        rows(DELETED, "deleted", lambda x: x, lambda x: none),
        rows(RENAMED, "renamed", lambda x: x[0], lambda x: x[1]),
    )
    return lists.select("repo_id", F.inline(everything))
