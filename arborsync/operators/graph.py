"""Commit graph: ancestry and distance for many repositories at once.

History is cut into first-parent chains. A commit's ancestors on any chain are
a prefix of that chain, so the whole ancestor set of a commit is one number per
chain. Both loops below are short: the index takes a number of rounds
logarithmic in the longest chain, the walk one round per change of chain, not
one per commit.

The index is stored. An ingest places its new commits only, behind the chains that
the stored ones end; a walk adds rows to what it has found and never rewrites them.

Rounds are for large repositories. The commits of smaller ones are placed, and their links walked, in one pass over
rows dealt by repository (see repository_pass); both give the same answers.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arborsync.operators.repository_pass import PLACED, REACHED, each_repository, place_commits, walk_links
from arborsync.operators.skew import lookup_join
from arborsync.schemas import CHAIN_INDEX, CHAIN_LINKS, CHAIN_TAILS
from arborsync.sources.keyed import PUSHED_KEYS, SEGMENT, read_segments, rows_with_keys, write_segment
from arborsync.staging import stage

# Merge links are grouped by this many positions of a chain, so that a long
# chain is many join keys instead of one.
BLOCK = 65_536

# A repository with at most so many rows in an ingest (new commits and stored ones they touch) is placed in one pass, and
# one with at most so many links, and so many links times heads, is walked in one.
PASS_ROWS, PASS_STEPS = 50_000, 1_000_000

_PLACE = ("repo_id", "sha", "chain", "pos")
_LINK = ("repo_id", "chain", "pos", "block", "to_chain", "to_pos")


@dataclass(frozen=True)
class CommitIndex:
    """``places`` (``repo_id, sha, chain, pos``), ``links`` (see merge_links) and ``tails`` (``repo_id, chain, pos``: a
    row for each ingest that lengthened a chain). With a ``path`` the tables are stored there."""

    places: DataFrame
    links: DataFrame
    tails: DataFrame


def read_index(spark: SparkSession, path: str) -> CommitIndex:
    """The stored index, empty where nothing was ingested."""
    return CommitIndex(
        read_segments(spark, f"{path}/places", CHAIN_INDEX), read_segments(spark, f"{path}/links", CHAIN_LINKS),
        read_segments(spark, f"{path}/tails", CHAIN_TAILS))


def ingest_commits(commits: DataFrame, path: str, segment: int) -> None:
    """Place the ``commits`` that are not indexed yet. Parents come in the same ingest as their children or before.

    A commit whose parent is not known starts a chain. Reads of the stored index follow the new commits; a
    repeated ingest of the same ``segment`` replaces what it wrote.
    """
    held = read_index(commits.sparkSession, path)
    other = F.col(SEGMENT) != segment
    held = CommitIndex(held.places.where(other), held.links, held.tails.where(other))
    added = extend_index(commits, None if held.places.isEmpty() else held)
    write_segment(added.tails, f"{path}/tails", "chain", segment)
    write_segment(added.links, f"{path}/links", "chain", segment)
    write_segment(added.places, f"{path}/places", "sha", segment)


def _subtree_sizes(firsts: DataFrame) -> DataFrame:
    """``repo_id, sha, size``: commits that reach a commit by first parents alone, itself included.

    ``firsts``: ``repo_id, sha, first_parent``, null where there is none. Doubling: after k rounds a size covers
    2^k steps and the pointer is 2^k steps back; each round adds the sizes found that far ahead.
    """
    state = stage(
        firsts.select("repo_id", "sha", F.col("first_parent").alias("back"), F.lit(1).cast("bigint").alias("size")), "sizes")
    own, sent = F.lit(True).alias("own"), F.lit(False).alias("own")
    while not (active := state.where("back IS NOT NULL")).isEmpty():
        target = state.select("repo_id", F.col("sha").alias("back"), F.col("back").alias("_next"))
        stepped = lookup_join(active, target, ["repo_id", "back"], how="inner")
        rows = stepped.select("repo_id", "sha", F.col("_next").alias("back"), "size", own).unionByName(
            state.where("back IS NULL").select("repo_id", "sha", "back", "size", own)).unionByName(
            active.select("repo_id", F.col("back").alias("sha"), F.lit(None).cast("string").alias("back"), "size", sent))
        state = stage(rows.groupBy("repo_id", "sha").agg(F.max("back").alias("back"), F.sum("size").alias("size")), "sizes")
    return state.select("repo_id", "sha", "size")


def _links(firsts: DataFrame) -> DataFrame:
    """``repo_id, sha, link``: each commit with the first parent it continues, null where it starts a chain.

    Of several commits with the same first parent the one with most commits behind
    it continues the chain: so following first parents changes chain at most
    log2(commits) times, and a main line is not broken by the branches it feeds.
    """
    children = firsts.where("first_parent IS NOT NULL").groupBy("repo_id", "first_parent").agg(F.count("*").alias("n"), F.max("sha").alias("heir"))
    children = stage(children, "children")
    heirs = children.where("n = 1").select("repo_id", F.col("heir").alias("sha"), F.col("first_parent").alias("link"))
    forks = children.where("n > 1").select("repo_id", "first_parent")
    if not forks.isEmpty():
        # Pointers into the stored history end there: only what is new has a weight.
        inside = firsts.join(firsts.select("repo_id", F.col("sha").alias("first_parent"), F.lit(True).alias("_in")), ["repo_id", "first_parent"], "left")
        sizes = _subtree_sizes(inside.select("repo_id", "sha", F.when(F.col("_in"), F.col("first_parent")).alias("first_parent")))
        rivals = firsts.join(forks, ["repo_id", "first_parent"], "left_semi").join(sizes, ["repo_id", "sha"])
        best = rivals.groupBy("repo_id", "first_parent").agg(F.max(F.struct("size", "sha")).alias("best"))
        heirs = heirs.unionByName(best.select("repo_id", F.col("best.sha").alias("sha"), F.col("first_parent").alias("link")))
    return firsts.select("repo_id", "sha").join(heirs, ["repo_id", "sha"], "left")


def _follow(links: DataFrame) -> DataFrame:
    """``repo_id, sha, anchor, steps``: the start of each commit's chain among ``links`` and how far it is.

    Pointer doubling: a round lets every unfinished commit take over the pointers
    of the commit it points at, four jumps deep. Unfinished commits point at
    different commits, so no join key is ever hot.
    """
    state = stage(
        links.select(
            "repo_id", "sha",
            F.coalesce("link", "sha").alias("anchor"),
            F.when(F.col("link").isNull(), 0).otherwise(1).cast("bigint").alias("steps"),
            F.col("link").isNull().alias("done"),
        ),
        "chains",
    )
    while not state.where("NOT done").isEmpty():
        target = state.select(
            "repo_id", F.col("sha").alias("_at"), F.col("anchor").alias("_to"),
            F.col("steps").alias("_more"), F.col("done").alias("_end"),
        )
        moving = state.where("NOT done")
        for _ in range(3):
            # Finished rows look themselves up and ignore the answer: were they to
            # look up their chain's start, that would be one key for a whole chain.
            moving = moving.withColumn("_at", F.when(F.col("done"), F.col("sha")).otherwise(F.col("anchor")))
            moving = moving.join(target, ["repo_id", "_at"]).select(
                "repo_id", "sha",
                F.when(F.col("done"), F.col("anchor")).otherwise(F.col("_to")).alias("anchor"),
                F.when(F.col("done"), F.col("steps")).otherwise(F.col("steps") + F.col("_more")).alias("steps"),
                (F.col("done") | F.col("_end")).alias("done"),
            )
        state = stage(state.where("done").unionByName(moving), "chains")
    return state.select("repo_id", "sha", "anchor", "steps")


def _held_places(wanted: DataFrame, places: DataFrame) -> DataFrame:
    """Stored places of ``wanted`` (``repo_id, sha``, written), reading what holds them."""
    asked = wanted.select("repo_id", "sha")
    if SEGMENT in places.columns:
        return rows_with_keys(places, "sha", asked, also=("repo_id",)).select(*_PLACE)
    return places.select(*_PLACE).join(asked, ["repo_id", "sha"], "left_semi")


def _nulls(*kinds: str) -> list[Column]:
    return [F.lit(None).cast(kind) for kind in kinds]


def extend_index(commits: DataFrame, held: CommitIndex | None = None) -> CommitIndex:
    """The rows that ``commits`` (``repo_id, sha, parents``) add to an index ``held``, those it has already left out."""
    told = stage(commits.select("repo_id", "sha", "parents"), "new-commits")
    rows = told.select("repo_id", "sha", F.col("parents").cast("array<string>").alias("parents"), *_nulls("string", "bigint"))
    earlier = tails = None
    if held is not None:
        ends = told.select("repo_id", F.explode(F.concat(F.array("sha"), F.coalesce("parents", F.array()))).alias("sha"))
        earlier = stage(_held_places(ends, held.places), "held-places")
        of_chains = earlier.select("repo_id", "chain")
        if SEGMENT in held.tails.columns:
            tails = rows_with_keys(held.tails, "chain", of_chains, also=("repo_id",))
        else:
            tails = held.tails.join(of_chains, ["repo_id", "chain"], "left_semi")
        tails = stage(tails.groupBy("repo_id", "chain").agg(F.max("pos").alias("pos")), "held-tails")
        none, no_parents = _nulls("string", "array<string>")
        rows = rows.union(earlier.select("repo_id", "sha", no_parents, "chain", "pos")).union(tails.select("repo_id", none, no_parents, "chain", "pos"))
    large = rows.groupBy("repo_id").agg(F.count("*").alias("n")).where(F.col("n") > PASS_ROWS).select("repo_id")
    large = stage(large, "large-repositories")
    if large.isEmpty():
        return _placed(rows)
    here, rest = _placed(rows.join(large, "repo_id", "left_anti")), []
    for table in (told, earlier, tails):
        rest.append(table and table.join(large, "repo_id", "left_semi"))
    there = _place_in_rounds(*rest)
    return CommitIndex(*(getattr(here, t).unionByName(getattr(there, t)) for t in ("places", "links", "tails")))


def _placed(rows: DataFrame) -> CommitIndex:
    """The index rows of new commits, by one pass over each repository (see place_commits)."""
    placed = stage(each_repository(rows, place_commits, PLACED), "places")
    links = placed.select("repo_id", "chain", "pos", F.explode("links").alias("link")).select("repo_id", "chain", "pos", "link.*")
    return CommitIndex(
        placed.select(*_PLACE), links.withColumn("block", _block(F.col("pos"))).select(*_LINK),
        placed.where("is_tail").select("repo_id", "chain", "pos"))


def _place_in_rounds(told: DataFrame, earlier: DataFrame | None, ends: DataFrame | None) -> CommitIndex:
    """The index rows of new commits, by pointer doubling over all tasks; ``ends`` are those of stored chains."""
    if earlier is not None:
        told = stage(told.join(earlier, ["repo_id", "sha"], "left_anti"), "new-commits")
    parents = told.select("repo_id", "sha", F.get("parents", F.lit(0)).alias("first_parent"))
    known = told.select("repo_id", F.col("sha").alias("first_parent"), F.lit(None).cast("string").alias("chain"), F.lit(None).cast("bigint").alias("pos"))
    if earlier is not None:
        # A stored chain goes on behind its last commit only.
        open_ends = earlier.join(ends, ["repo_id", "chain", "pos"], "left_semi")
        known = known.unionByName(open_ends.select("repo_id", F.col("sha").alias("first_parent"), "chain", "pos"))
    # A parent that was never ingested, or whose chain goes on elsewhere, is none.
    placed = lookup_join(parents.where("first_parent IS NOT NULL"), known, ["repo_id", "first_parent"], "inner")
    rooted = stage(
        told.select("repo_id", "sha").join(placed, ["repo_id", "sha"], "left").select("repo_id", "sha", "first_parent", "chain", "pos"), "first-parents")
    heirs = stage(_links(rooted.select("repo_id", "sha", "first_parent")), "heirs")
    # The heir of a stored commit starts here, and takes over its chain.
    behind = heirs.where("link IS NOT NULL").join(
        rooted.where("chain IS NOT NULL").select("repo_id", "sha", F.col("chain").alias("_chain"), F.col("pos").alias("_pos")), ["repo_id", "sha"])
    starts = stage(behind.select("repo_id", "sha", "_chain", "_pos"), "continued")
    inner = heirs.join(starts.select("repo_id", "sha", F.lit(True).alias("_cut")), ["repo_id", "sha"], "left").select(
        "repo_id", "sha", F.when(F.col("_cut").isNull(), F.col("link")).alias("link"))
    followed = _follow(inner)
    goes_on = lookup_join(followed, starts.withColumnRenamed("sha", "anchor"), ["repo_id", "anchor"], "left")
    places = stage(goes_on.select(
        "repo_id", "sha", F.coalesce("_chain", "anchor").alias("chain"), (F.col("steps") + 1 + F.coalesce("_pos", F.lit(0))).alias("pos")), "places")
    everywhere = places if earlier is None else places.unionByName(earlier.select(*_PLACE))
    tails = places.groupBy("repo_id", "chain").agg(F.max("pos").alias("pos"))
    return CommitIndex(places, merge_links(told, everywhere), tails)


def chain_index(commits: DataFrame) -> DataFrame:
    """``repo_id, sha, chain, pos``: the chain of each commit and its place in it, 1 = oldest."""
    return extend_index(commits).places


def merge_links(commits: DataFrame, index: DataFrame) -> DataFrame:
    """Parent links that lead to another chain: ``repo_id, chain, pos, block, to_chain, to_pos``."""
    links = commits.select("repo_id", "sha", F.explode("parents").alias("parent"))
    child = index.select("repo_id", "sha", "chain", "pos")
    parent = index.select(
        "repo_id", F.col("sha").alias("parent"), F.col("chain").alias("to_chain"), F.col("pos").alias("to_pos")
    )
    placed = links.join(child, ["repo_id", "sha"])
    # A release commit may be the parent of very many branches.
    return (
        lookup_join(placed, parent, ["repo_id", "parent"], how="inner")
        .where(F.col("chain") != F.col("to_chain"))
        .groupBy("repo_id", "chain", "pos", "to_chain")
        .agg(F.max("to_pos").alias("to_pos"))
        .withColumn("block", _block(F.col("pos")))
        .select(*_LINK)
    )


def _block(pos: Column) -> Column:
    return F.floor(pos / BLOCK).cast("bigint")


def _as_index(commits: DataFrame | None, index: DataFrame | CommitIndex | None) -> CommitIndex:
    if isinstance(index, CommitIndex):
        return index
    if index is None:
        return extend_index(commits)
    return CommitIndex(index, stage(merge_links(commits, index), "merge-links"), index.select("repo_id", "chain", "pos"))


def ancestor_reach(heads: DataFrame, commits: DataFrame | None, index: DataFrame | CommitIndex) -> DataFrame:
    """``repo_id, head, chain, reach``: how many commits of each chain are ancestors of ``head`` (or it).

    ``heads`` holds distinct (repo_id, head); unknown commits give no rows. Without a CommitIndex the links are
    made from ``commits``.
    """
    known = _as_index(commits, index)
    asked = stage(heads.select("repo_id", F.col("head").alias("sha")), "heads")
    return _reach_of(stage(_held_places(asked, known.places).withColumnRenamed("sha", "head"), "head-places"), known)


def _reach_of(start: DataFrame, known: CommitIndex) -> DataFrame:
    """ancestor_reach of heads whose places (``repo_id, head, chain, pos``, written) are known.

    Few heads look up links round by round, reading only those of the chains they meet; so do repositories
    that are too large for a pass.
    """
    if start.limit(PUSHED_KEYS + 1).count() <= PUSHED_KEYS:
        return _walk_in_rounds(start, known)
    asked = start.groupBy("repo_id").agg(F.count("*").alias("heads"))
    links = known.links.join(asked.select("repo_id"), "repo_id", "left_semi").select("repo_id", "chain", "pos", "to_chain", "to_pos")
    held = known.links.groupBy("repo_id").agg(F.count("*").alias("links"))
    large = held.where(F.col("links") > PASS_ROWS).join(asked, "repo_id").unionByName(
        held.join(asked, "repo_id").where((F.col("links") <= PASS_ROWS) & (F.col("links") * F.col("heads") > PASS_STEPS)))
    large = stage(large.select("repo_id"), "large-repositories")
    rows = start.select("repo_id", "head", "chain", "pos", *_nulls("string", "bigint")).union(
        links.select("repo_id", *_nulls("string"), "chain", "pos", "to_chain", "to_pos"))
    if large.isEmpty():
        return each_repository(rows, walk_links, REACHED)
    here = each_repository(rows.join(large, "repo_id", "left_anti"), walk_links, REACHED)
    return here.unionByName(_walk_in_rounds(stage(start.join(large, "repo_id", "left_semi"), "head-places"), known))


def _walk_in_rounds(start: DataFrame, known: CommitIndex) -> DataFrame:
    none = F.lit(0).cast("bigint")
    fresh = stage(start.select("repo_id", "head", "chain", F.col("pos").alias("reach"), none.alias("seen")), "reach")
    key = ["repo_id", "head", "chain"]
    found = fresh.select(*key, "reach")
    while not fresh.isEmpty():
        # Every link is met once per head: only positions new to the head are looked at.
        links = known.links
        if SEGMENT in links.columns:
            links = rows_with_keys(links, "chain", fresh.select("chain").distinct())
        blocks = F.sequence(F.floor((F.col("seen") + 1) / BLOCK), F.floor(F.col("reach") / BLOCK))
        met = (
            fresh.withColumn("block", F.explode(blocks))
            .join(links.select(*_LINK), ["repo_id", "chain", "block"])
            .where((F.col("pos") > F.col("seen")) & (F.col("pos") <= F.col("reach")))
            .groupBy("repo_id", "head", F.col("to_chain").alias("chain"))
            .agg(F.max("to_pos").alias("reach"))
        )
        before = found.groupBy(*key).agg(F.max("reach").alias("seen"))
        further = met.join(before, key, "left").withColumn("seen", F.coalesce("seen", none)).where("reach > seen")
        fresh = stage(further.select(*key, "reach", "seen"), "reach")
        found = found.unionByName(fresh.select(*key, "reach"))
    return found.groupBy(*key).agg(F.max("reach").alias("reach"))


def ancestors(heads: DataFrame, commits: DataFrame | None, index: DataFrame | CommitIndex) -> DataFrame:
    """``repo_id, head, sha``: every commit reachable from each head, the head included."""
    reach = ancestor_reach(heads, commits, index)
    places = index.places if isinstance(index, CommitIndex) else index
    met = lookup_join(places.select(*_PLACE), reach, ["repo_id", "chain"], how="inner")
    return met.where(F.col("pos") <= F.col("reach")).select("repo_id", "head", "sha")


def compare_commits(pairs: DataFrame, commits: DataFrame | None, index: DataFrame | CommitIndex | None = None) -> DataFrame:
    """Add ``is_reachable`` and ``distance`` to distinct (repo_id, old_sha, new_sha) pairs.

    Reachable: old is new or an ancestor of it; an unknown commit is not.
    Distance: commits reachable from new and not from old; null if either is unknown.
    """
    # A pair is one number from here on: what is found for it carries no ids.
    pairs = stage(pairs.select("repo_id", "old_sha", "new_sha", F.monotonically_increasing_id().alias("pair")), "commit-pairs")
    known = _as_index(commits, index)
    is_new = F.col("end.is_new")
    ends = pairs.select("repo_id", "pair", F.explode(F.array(
        F.struct(F.col("old_sha").alias("head"), F.lit(False).alias("is_new")), F.struct(F.col("new_sha").alias("head"), F.lit(True).alias("is_new"))
    )).alias("end")).select("repo_id", "pair", "end.head", is_new.alias("is_new")).where("head IS NOT NULL")
    asked = ends.select("repo_id", F.col("head").alias("sha"))
    start = stage(_held_places(asked, known.places).withColumnRenamed("sha", "head"), "head-places")
    none = F.lit(None).cast("bigint")
    reach = _reach_of(start, known).select("repo_id", "head", "chain", "reach", none.alias("pos")).unionByName(
        start.select("repo_id", "head", "chain", none.alias("reach"), "pos"))
    # Per pair and chain: how far both ends reach, and where the old one lies.
    met = lookup_join(reach, ends, ["repo_id", "head"], "inner").groupBy("pair", "chain").agg(
        F.max(F.when(F.col("is_new"), F.col("reach"))).alias("new_reach"), F.max(F.when(~F.col("is_new"), F.col("reach"))).alias("old_reach"),
        F.max(F.when(~F.col("is_new"), F.col("pos"))).alias("old_pos"))
    gap = F.greatest(F.col("new_reach") - F.coalesce("old_reach", F.lit(0)), F.lit(0))
    measured = met.groupBy("pair").agg(
        F.sum(gap).alias("distance"), (F.max("old_pos").isNotNull() & F.max("new_reach").isNotNull()).alias("_known"),
        F.max(F.col("new_reach") >= F.col("old_pos")).alias("_hit"))
    return pairs.join(measured, "pair", "left").select(
        "repo_id", "old_sha", "new_sha", F.coalesce("_hit", F.lit(False)).alias("is_reachable"),
        F.when(F.col("_known"), F.col("distance")).alias("distance"),
    )
