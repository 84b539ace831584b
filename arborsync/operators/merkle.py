"""Folders known by their content, and change detection that never enters an unchanged one.

A folder's id is a digest of its entries, and those of folders in it are their ids: two folders hold the same if
their ids are equal, however much lies below. Folders are stored once, whichever snapshots hold them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arborsync.operators.diff import ADDED, DELETED, MODIFIED, pair_renames
from arborsync.operators.skew import lookup_join
from arborsync.operators.snapshot import FOLDER_MODE
from arborsync.schemas import FOLDER_ENTRIES, SNAPSHOT_ROOTS
from arborsync.sources.keyed import append_new, read_segments, rows_with_keys
from arborsync.sources.tables import read_or_empty
from arborsync.staging import stage

TREE, BLOB = "tree", "blob"
_PIECES = 4
_AT = ("repo_id", "commit_sha", "folder")


def _digest(name: Column, mode: Column, child: Column) -> Column:
    told = [F.coalesce(c, F.lit("")) for c in (mode, child, name)]
    return F.sha2(F.concat(*[F.concat(F.octet_length(c).cast("string"), F.lit(":"), c) for c in told]), 256)


def _named(folder_or_path: str) -> tuple[Column, Column]:
    """(folder, last name) of a path without a final slash; the root folder is the empty path."""
    path = F.col(folder_or_path)
    name = F.substring_index(path, "/", -1)
    folder = F.when(F.contains(path, F.lit("/")), F.substring(path, F.lit(1), F.char_length(path) - F.char_length(name) - 1)).otherwise("")
    return folder, name


def _depth(path: Column) -> Column:
    return F.octet_length(path) - F.octet_length(F.replace(path, F.lit("/"), F.lit("")))


def fold_snapshots(tree: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(entries, roots) of the snapshots in ``tree`` (``repo_id, commit_sha, path, mode, blob_sha, size``).

    ``entries``: ``folder_id, name, kind, child_id, mode, size``, each folder once. ``roots``: ``repo_id, commit_sha,
    tree_id, files``. An id is hashed from sums of entry digests, so a folder's entries need not come together:
    sums combine before the shuffle. One round a folder level, over the rows of that level.
    """
    folder, name = _named("path")
    files = stage(
        tree.select(
            "repo_id", "commit_sha", folder.alias("folder"), name.alias("name"), F.lit(BLOB).alias("kind"),
            F.col("blob_sha").alias("child_id"), "mode", F.col("size").cast("bigint").alias("size"), F.lit(1).cast("bigint").alias("files"),
            _depth(F.col("path")).alias("depth")),
        "tree-files")
    deepest = files.agg(F.max("depth")).first()[0]
    pieces = {f"s{i}": F.conv(F.substring("_d", 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(_PIECES)}
    parts, ids, above = [], [], None
    for depth in range(deepest if deepest is not None else -1, -1, -1):
        rows = files.where(F.col("depth") == depth).drop("depth")
        rows = rows if above is None else rows.unionByName(above)
        summed = rows.withColumn("_d", _digest(F.col("name"), F.col("mode"), F.col("child_id"))).withColumns(pieces).groupBy(*_AT).agg(
            *[F.sum(s).alias(s) for s in pieces], F.count("*").alias("_n"), F.sum("files").alias("files"))
        told = F.concat_ws(":", F.col("_n").cast("string"), *[F.col(s).cast("string") for s in pieces])
        found = stage(summed.select(*_AT, F.sha2(told, 256).alias("folder_id"), "files"), "folder-ids")
        parts.append(rows.drop("files"))
        ids.append(found)
        outer, own = _named("folder")
        above = found.where("folder <> ''").select(
            "repo_id", "commit_sha", outer.alias("folder"), own.alias("name"), F.lit(TREE).alias("kind"), F.col("folder_id").alias("child_id"),
            F.lit(FOLDER_MODE).alias("mode"), F.lit(None).cast("bigint").alias("size"), "files")
    if not parts:
        empty = files.select(F.lit("").alias("folder_id"), "name", "kind", "child_id", "mode", "size")
        return empty, files.select("repo_id", "commit_sha", F.lit("").alias("tree_id"), "files")
    everything, all_ids = parts[0], ids[0]
    for rows, found in zip(parts[1:], ids[1:]):
        everything, all_ids = everything.unionByName(rows), all_ids.unionByName(found)
    # Of folders that are the same one is written down.
    single = all_ids.groupBy("folder_id").agg(F.min(F.struct(*_AT)).alias("at")).select("folder_id", "at.*")
    entries = lookup_join(everything, single, _AT, how="inner").select("folder_id", "name", "kind", "child_id", "mode", "size")
    roots = all_ids.where("folder = ''").select("repo_id", "commit_sha", F.col("folder_id").alias("tree_id"), "files")
    return entries, roots


def store_snapshots(tree: DataFrame, path: str, segment: int) -> None:
    """Add snapshots to the folder store: folders that are new first, the roots, which make them known, last.

    A repeated ingest of the same ``segment`` replaces what it wrote.
    """
    entries, roots = fold_snapshots(tree)
    append_new(entries, f"{path}/entries", "folder_id", segment)
    roots.write.mode("overwrite").parquet(f"{path}/roots/segment={segment}")


def read_roots(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, f"{path}/roots", SNAPSHOT_ROOTS).distinct()


def stored_folders(spark: SparkSession, path: str) -> Callable[[DataFrame], DataFrame]:
    """Reads the entries of given folders (``folder_id``) from the store, and as little else as its layout allows."""
    table = read_segments(spark, f"{path}/entries", FOLDER_ENTRIES)
    return lambda wanted: rows_with_keys(table, "folder_id", wanted)


def folder_changes(pairs: DataFrame, folders: DataFrame | Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Paths that differ between two trees, before rename pairing: the rows of ``diff.compare_snapshots``.

    ``pairs``: ``repo_id, old_tree, new_tree``, null where there is no tree; repo_id tells pairs apart. ``folders``: all
    entries, or a function that gives the entries of some folders. Level by level from the roots only folders are
    entered whose ids differ on the two sides; each level is one job, and all its rows are entries of such folders.
    """
    def lookup(wanted: DataFrame) -> DataFrame:
        if callable(folders):
            return folders(wanted)
        return folders.join(wanted, "folder_id", "left_semi")

    frontier = stage(
        pairs.where(~F.col("old_tree").eqNullSafe(F.col("new_tree"))).select("repo_id", F.lit("").alias("prefix"), "old_tree", "new_tree"),
        "folder-pairs")
    changes = None
    entry = F.struct("kind", "child_id", "mode").alias("entry")
    while True:
        wanted = stage(
            frontier.select(F.explode(F.array("old_tree", "new_tree")).alias("folder_id")).where("folder_id IS NOT NULL").distinct(), "entered")
        entries = lookup(wanted).select("folder_id", "name", entry)
        # One folder may hold very many entries: those rows are split where needed.
        sides = [
            lookup_join(entries, frontier.select("repo_id", "prefix", F.col(tree).alias("folder_id")), ["folder_id"], "inner").select(
                "repo_id", "prefix", "name", F.lit(tree).alias("side"), "entry")
            for tree in ("old_tree", "new_tree")
        ]
        side = lambda tree: F.max(F.when(F.col("side") == tree, F.col("entry")))
        met = sides[0].unionByName(sides[1]).groupBy("repo_id", "prefix", "name").agg(side("old_tree").alias("old"), side("new_tree").alias("new"))
        level = stage(met.where(~F.col("old").eqNullSafe(F.col("new"))), "changed-entries")
        file = lambda s: F.when(F.col(f"{s}.kind") == BLOB, F.col(f"{s}.child_id"))
        status = F.when(F.col("old_blob").isNull(), ADDED).when(F.col("new_blob").isNull(), DELETED).otherwise(MODIFIED)
        told = level.select("repo_id", F.concat("prefix", "name").alias("path"), file("old").alias("old_blob"), file("new").alias("new_blob")).where(
            "old_blob IS NOT NULL OR new_blob IS NOT NULL").select("repo_id", "path", status.alias("status"), "old_blob", "new_blob")
        changes = told if changes is None else changes.unionByName(told)
        folder = lambda s: F.when(F.col(f"{s}.kind") == TREE, F.col(f"{s}.child_id"))
        frontier = level.select(
            "repo_id", F.concat("prefix", "name", F.lit("/")).alias("prefix"), folder("old").alias("old_tree"), folder("new").alias("new_tree")
        ).where(~F.col("old_tree").eqNullSafe(F.col("new_tree")))
        if frontier.isEmpty():
            return changes


def merkle_changeset(pairs: DataFrame, folders: DataFrame | Callable[[DataFrame], DataFrame]) -> DataFrame:
    """All changes of each pair with renames paired, as ``diff.changeset`` gives them."""
    return pair_renames(stage(folder_changes(pairs, folders), "changes"))
