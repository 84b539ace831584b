"""Renames with edits: unpaired deleted and added files of similar text.

A text is the set of its runs of three words. A repository's runs are ordered from rare to
common, and each file is known by its first ones in that order: so many that two files over the
threshold must share one of them. No pair is lost, and headers that many files share hardly ever
make a candidate. Candidates are scored on whole texts and matched one to one, best pairs first.
"""

from __future__ import annotations

from hashlib import md5

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arborsync.functions.content import is_binary, is_utf8
from arborsync.operators.content import needed_blobs
from arborsync.operators.diff import ADDED, DELETED, RENAMED
from arborsync.staging import stage

# Fixed value: the share of common text from which on two files count as one renamed.
MIN_SIMILARITY = 0.5
SHINGLE_WORDS = 3
# Groups of pairs that no pair connects are matched in one pass each, if this small and found in so many spreads of their label.
GROUP_PAIRS, SPREADS = 50_000, 3
TAKEN = "repo_id string, old_path string, new_path string, old_blob string, new_blob string, similarity double"
# About so many paths of one blob are in a row; the paths of two blobs meet row by row.
BLOCK_PATHS = 500


def _joined(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """Join by sorting. Stored pairs and paths take a byte a row, and hundreds in memory: by file size the planner would send whole tables through the driver."""
    return left.join(right.hint("merge"), on, how)


def shingles(words: Column) -> Column:
    """Distinct hashes of the runs of three words. ``words`` must be a stored column: it is read per run."""
    starts = F.sequence(F.lit(0), F.greatest(F.size(words) - SHINGLE_WORDS, F.lit(0)))
    runs = F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(SHINGLE_WORDS)]))
    return F.array_distinct(runs)


def blob_grams(blobs: DataFrame) -> DataFrame:
    """``blob_sha, grams, n`` of text blobs."""
    content = F.col("content")
    texts = blobs.where(content.isNotNull() & ~is_binary(content) & is_utf8(content))
    words = texts.select("blob_sha", F.split(content.cast("string"), r"\s+").alias("words"))
    grams = words.select("blob_sha", shingles(F.col("words")).alias("grams"))
    return grams.select("blob_sha", "grams", F.size("grams").alias("n"))


def numbered_files(loose: DataFrame, blobs: DataFrame) -> DataFrame:
    """``file, repo_id, blob_sha, gone, came, grams, n``, written: one row per text blob of each repository.

    ``file`` is a number that stands for repository and blob in all steps on runs, which are many and narrow.
    """
    gone, came = (F.bool_or(F.col("status") == code).alias(name) for code, name in ((DELETED, "gone"), (ADDED, "came")))
    sides = loose.groupBy("repo_id", "blob_sha").agg(gone, came)
    known = _joined(blob_grams(needed_blobs(loose, blobs)), sides, "blob_sha")
    return stage(known.select(F.monotonically_increasing_id().alias("file"), "repo_id", "blob_sha", "gone", "came", "grams", "n"), "grams")


def shared_runs(files: DataFrame) -> DataFrame:
    """``gram, repo_id, file, held_by`` of the runs that more than one file of a repository holds."""
    runs = files.select("repo_id", "file", F.explode("grams").alias("gram"))
    # The number comes first: runs are sorted by it, and repositories are few.
    common = runs.groupBy("gram", "repo_id").agg(F.count("*").alias("held_by")).where(F.col("held_by") > 1)
    return _joined(runs, common, ["gram", "repo_id"])


def _candidates(files: DataFrame, threshold: float) -> DataFrame:
    """``old_file, new_file``: all pairs that can reach ``threshold``, and some that do not.

    Two sets share at least threshold * n runs if they reach the threshold, n being the larger size; so
    they share one of the first n - threshold * n + 1 of each, in any order common to both. Runs that one
    file alone holds are the rarest and make no pair: the others are counted from the end.
    """
    narrow = files.select("file", "gone", "came", "n")
    common_first = Window.partitionBy("file").orderBy(F.desc("held_by"), F.desc("gram"))
    known_by = (
        _joined(shared_runs(files), narrow, "file")
        .withColumn("_place", F.row_number().over(common_first))
        .where(F.col("_place") >= F.ceil(F.lit(threshold) * F.col("n")))
        .select("gram", "repo_id", "file", "gone", "came", "n")
    )
    index = stage(known_by, "rename-index")

    def side(which: str, name: str) -> DataFrame:
        return index.where(which).select("gram", "repo_id", F.col("file").alias(f"{name}_file"), F.col("n").alias(f"{name}_n"))

    met = _joined(side("gone", "old"), side("came", "new"), ["gram", "repo_id"])
    fitting = met.where(F.least("old_n", "new_n") >= F.lit(threshold) * F.greatest("old_n", "new_n"))
    return fitting.select("old_file", "new_file").distinct()


def _scored(pairs: DataFrame, files: DataFrame, threshold: float) -> DataFrame:
    """Pairs that reach the threshold, with their ``similarity``."""
    old = files.select(F.col("file").alias("old_file"), "repo_id", F.col("blob_sha").alias("old_blob"), F.col("grams").alias("old_grams"))
    new = files.select(F.col("file").alias("new_file"), F.col("blob_sha").alias("new_blob"), F.col("grams").alias("new_grams"))
    shared = F.size(F.array_intersect("old_grams", "new_grams"))
    similarity = shared / F.greatest(F.size("old_grams"), F.size("new_grams"))
    scores = _joined(_joined(pairs, old, "old_file"), new, "new_file").select(
        "repo_id", "old_blob", "new_blob", similarity.alias("similarity"))
    return scores.where(F.col("similarity") >= threshold)


def _blocks(loose: DataFrame) -> DataFrame:
    """``repo_id, status, blob_sha, block, paths``: the paths of a blob on one side, in rows of about BLOCK_PATHS."""
    key = ["repo_id", "status", "blob_sha"]
    dealt = F.pmod(F.xxhash64("path"), F.ceil(F.col("_n") / BLOCK_PATHS)).alias("block")
    counted = _joined(loose, loose.groupBy(*key).agg(F.count("*").alias("_n")), key)
    return counted.select(*key, dealt, "path").groupBy(*key, "block").agg(F.collect_list("path").alias("paths"))


def _side(blocks: DataFrame, status: str, name: str) -> DataFrame:
    return blocks.where(F.col("status") == status).select("repo_id", *[
        F.col(c).alias(f"{name}_{c.removesuffix('_sha')}") for c in ("blob_sha", "block", "paths")])


def _with_paths(pairs: DataFrame, blocks: DataFrame) -> DataFrame:
    """Pairs of blocks with their ``old_paths`` and ``new_paths``."""
    held = _joined(pairs.drop("ways"), _side(blocks, DELETED, "old"), ["repo_id", "old_blob", "old_block"])
    return _joined(held, _side(blocks, ADDED, "new"), ["repo_id", "new_blob", "new_block"])


def _ways() -> Column:
    return F.size("old_paths").cast("bigint") * F.size("new_paths")


def _paired_blocks(scores: DataFrame, blocks: DataFrame) -> DataFrame:
    """``repo_id, old_blob, new_blob, old_block, new_block, similarity, ways``: which blocks hold the paths of a pair, in so many ways."""
    held = _joined(scores, _side(blocks, DELETED, "old"), ["repo_id", "old_blob"])
    held = _joined(held, _side(blocks, ADDED, "new"), ["repo_id", "new_blob"])
    return held.select("repo_id", "old_blob", "new_blob", "old_block", "new_block", "similarity", _ways().alias("ways"))


def _grouped(pairs: DataFrame, group_pairs: int) -> DataFrame:
    """``pairs`` with ``group, whole``: pairs that share a file are in one group if it is whole, which large or far-flung ones are not."""
    labelled = pairs.withColumn("group", F.xxhash64("repo_id", "old_blob"))
    for blob in ("new_blob", "old_blob") * SPREADS:
        least = labelled.groupBy("repo_id", blob).agg(F.min("group").alias("_least"))
        spread = _joined(labelled, least, ["repo_id", blob]).select(*pairs.columns, F.col("_least").alias("group"))
        labelled = stage(spread, "pair-groups")
    # Old blobs have one label each by now; a new one with two keeps the groups of both open.
    ends = labelled.groupBy("repo_id", "new_blob").agg((F.min("group") < F.max("group")).alias("_open"))
    sizes = _joined(labelled, ends, ["repo_id", "new_blob"]).groupBy("group").agg(
        ((F.sum("ways") <= group_pairs) & ~F.bool_or("_open")).alias("whole"))
    # Sizes are written first: a join of two plain shuffles is what adaptive execution cuts where one group is most of the rows.
    return stage(_joined(labelled, stage(sizes, "group-sizes"), "group"), "pair-groups")


def _best_first(blocks: pd.DataFrame) -> pd.DataFrame:
    """The pairs of paths of a whole group that are taken, best first."""
    rows = zip(*(blocks[c] for c in ("similarity", "repo_id", "old_blob", "new_blob", "old_paths", "new_paths")))
    order = sorted(
        (-score, md5(f"{old}\x1f{new}".encode()).hexdigest(), old, new, repo, old_blob, new_blob)
        for score, repo, old_blob, new_blob, of_old, of_new in rows for old in of_old for new in of_new)
    gone, came, taken = set(), set(), []
    for score, _, old, new, repo, old_blob, new_blob in order:
        if (repo, old) not in gone and (repo, new) not in came:
            gone.add((repo, old))
            came.add((repo, new))
            taken.append((repo, old, new, old_blob, new_blob, -score))
    return pd.DataFrame(taken, columns=["repo_id", "old_path", "new_path", "old_blob", "new_blob", "similarity"])


def _in_one_pass(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("group").applyInPandas(_best_first, TAKEN)


def _mutual(pairs: DataFrame) -> DataFrame:
    """The pairs of paths, with their blocks, that are the best of both their paths.

    Only the most similar of a blob's partners can hold the best of its paths, which is looked for inside the rows of two blocks: the
    pairs of paths themselves are neither moved nor written.
    """
    for name in ("old", "new"):
        partners = Window.partitionBy("repo_id", f"{name}_blob")
        pairs = pairs.withColumn(f"_{name}_top", F.col("similarity") == F.max("similarity").over(partners))
    near = pairs.where("_old_top or _new_top")

    def best(name: str, other: str, status: str) -> Column:
        """Of each path on one side its best partner in the other block."""
        def partner(path: Column, to: Column) -> Column:
            ends = {name: path, other: to}
            lot = F.md5(F.concat_ws("\x1f", ends["old"], ends["new"]))
            return F.struct(lot.alias("lot"), ends["old"].alias("old_path"), ends["new"].alias("new_path"))

        mine = F.when(F.col(f"_{name}_top"), F.col(f"{name}_paths")).otherwise(F.array().cast("array<string>"))
        return F.transform(mine, lambda path: F.struct(
            F.lit(status).alias("status"), path.alias("path"),
            F.array_min(F.transform(f"{other}_paths", lambda to: partner(path, to))).alias("found")))

    offers = near.select("repo_id", "old_blob", "new_blob", "old_block", "new_block", "similarity", F.explode(
        F.concat(best("old", "new", DELETED), best("new", "old", ADDED))).alias("_offer"))
    place = F.struct(
        (-F.col("similarity")).alias("score"), "_offer.found.lot", "_offer.found.old_path", "_offer.found.new_path",
        "old_blob", "new_blob", "old_block", "new_block")
    chosen = offers.groupBy("repo_id", "_offer.status", "_offer.path").agg(F.min(place).alias("_place"))
    both = chosen.groupBy("repo_id", "_place").agg(F.count("*").alias("_sides")).where(F.col("_sides") == 2)
    return both.select(
        "repo_id", *[f"_place.{c}" for c in ("old_path", "new_path", "old_blob", "new_blob", "old_block", "new_block")],
        (-F.col("_place.score")).alias("similarity"))


def _without(pairs: DataFrame, matched: DataFrame) -> DataFrame:
    """The pairs of blocks with the paths that are left."""
    for name in ("old", "new"):
        key, paths = ["repo_id", f"{name}_blob", f"{name}_block"], f"{name}_paths"
        taken = matched.groupBy(*key).agg(F.collect_list(f"{name}_path").alias("_taken"))
        left = F.when(F.col("_taken").isNull(), F.col(paths)).otherwise(F.array_except(paths, "_taken"))
        pairs = _joined(pairs, taken, key, "left").withColumn(paths, left).drop("_taken").where(F.size(paths) > 0)
    return pairs


def similar_renames(changes: DataFrame, blobs: DataFrame, threshold: float = MIN_SIMILARITY, group_pairs: int = GROUP_PAIRS) -> DataFrame:
    """``repo_id, old_path, new_path, old_blob, new_blob, similarity``, one to one.

    ``changes`` is a paired change set; only its deleted and added rows take part. A pair is taken
    if it is the best of both its files, and so on with the files left. Equal scores go by a hash of
    the two paths, which keeps the rounds few where many files are alike. Groups of up to ``group_pairs``
    connected pairs are walked best first instead, in one pass, which takes the same pairs; so is what rounds
    leave, once it is as small. Copies of a file stay together in blocks, as all their pairs would grow with their square.
    """
    loose = changes.where(F.col("status").isin(DELETED, ADDED)).select(
        "repo_id", "status", F.coalesce("old_path", "new_path").alias("path"),
        F.coalesce("old_blob", "new_blob").alias("blob_sha"),
    )
    loose = stage(loose, "loose")
    files = numbered_files(loose, blobs)
    scores = stage(_scored(_candidates(files, threshold), files, threshold), "scores")
    blocks = stage(_blocks(loose), "path-blocks")
    groups = _grouped(stage(_paired_blocks(scores, blocks), "similar-pairs"), group_pairs)
    found = stage(_in_one_pass(_with_paths(groups.where("whole"), blocks)), "matched")
    left = stage(_with_paths(groups.where("not whole").drop("group", "whole"), blocks), "similar-pairs")
    while (pairs := left.agg(F.sum(_ways())).first()[0] or 0) > group_pairs:
        matched = stage(_mutual(left), "matched")
        found = found.unionByName(matched.select(*found.columns))
        left = stage(_without(left, matched), "similar-pairs")
    return found.unionByName(stage(_in_one_pass(left.withColumn("group", F.lit(0))), "matched")) if pairs else found


def merge_similar(changes: DataFrame, renames: DataFrame) -> DataFrame:
    """The change set with similar pairs shown as renames."""
    ends = renames.select("repo_id", "old_path", "new_path")
    gone = ends.select("repo_id", F.lit(DELETED).alias("status"), "old_path")
    came = ends.select("repo_id", F.lit(ADDED).alias("status"), "new_path")
    rest = _joined(_joined(changes, gone, ["repo_id", "status", "old_path"], "left_anti"), came, ["repo_id", "status", "new_path"], "left_anti")
    return rest.select(*changes.columns).unionByName(
        renames.withColumn("status", F.lit(RENAMED)).select(*changes.columns)
    )
