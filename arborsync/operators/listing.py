"""Folder browsing: children of a prefix and pages of a listing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arborsync.functions import paths

PAGE_ROWS = 20
FALLBACK_PAGE_ROWS = 100


def folder_children(tree: DataFrame, prefix: str = "") -> DataFrame:
    """Immediate children of ``prefix``: ``repo_id, id, name, size, type``; a folder's size is that of its files.

    Partial sums make a folder of any size cheap to combine.
    """
    inside = tree.where(paths.in_subdir(F.col("path"), prefix))
    below = paths.relative_path(F.col("path"), prefix)
    head = paths.subdir_prefix(prefix)
    kind = F.when(F.contains(below, F.lit("/")), "folder").otherwise("file")
    children = inside.select("repo_id", F.split_part(below, F.lit("/"), F.lit(1)).alias("name"), kind.alias("type"), "size")
    return (
        children.groupBy("repo_id", "name", "type")
        .agg(F.sum("size").alias("size"))
        .select("repo_id", F.concat(F.lit(head), "name").alias("id"), "name", "size", "type")
    )


def listing_page(
    entries: DataFrame,
    max_keys: int | None = PAGE_ROWS,
    extensions: Sequence[str] = (),
    after: dict[str, str] | None = None,
) -> DataFrame:
    """One page of ``repo_id, id, name, size, type`` rows with ``is_truncated`` and its rank ``n``.

    Folders first, then by lowered name, id and repository. ``after`` is the key of the last
    row of the page before (see page_token); a key, unlike an offset, costs no
    re-reading and holds when files come or go.
    """
    rows = max_keys or FALLBACK_PAGE_ROWS
    is_file = F.col("type") == "file"
    keyed = entries.where(~is_file | paths.has_extension(F.col("name"), extensions)).select(
        "repo_id", "id", "name", "size", "type",
        F.when(F.col("type") == "folder", 0).otherwise(1).alias("_rank"), F.lower("name").alias("_lowered"),
    )
    key = F.struct("_rank", "_lowered", "id", "repo_id")
    if after:
        mark = F.struct(
            F.lit(int(after["rank"])).alias("_rank"), F.lit(after["name"]).alias("_lowered"),
            F.lit(after["id"]).alias("id"), F.lit(after["repo_id"]).alias("repo_id"),
        )
        keyed = keyed.where(key > mark)
    # One row more than asked for tells whether there is a next page; the windows
    # below see that page only.
    page = keyed.orderBy("_rank", "_lowered", "id", "repo_id").limit(rows + 1)
    in_order = Window.orderBy("_rank", "_lowered", "id", "repo_id")
    return (
        page.withColumn("n", F.row_number().over(in_order))
        .withColumn("is_truncated", F.count("*").over(Window.partitionBy()) > rows)
        .where(F.col("n") <= rows)
        .select("n", "repo_id", "id", "name", "size", "type", "is_truncated")
    )


def page_token(page: DataFrame) -> dict[str, str] | None:
    """Key to continue after a page, None on the last one. Reads one row."""
    last = page.where("is_truncated").orderBy(F.desc("n")).select("type", F.lower("name"), "id", "repo_id").first()
    return last and {"rank": str(0 if last[0] == "folder" else 1), "name": last[1], "id": last[2], "repo_id": last[3]}
