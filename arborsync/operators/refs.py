"""Ref listing and resolution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborsync.functions.keys import branch_or_default

HEADS = "refs/heads/"
REMOTES = "refs/remotes/origin/"
TAGS = "refs/tags/"

# Lookup orders; None stands for the name taken as a full ref or as a commit id.
REMOTE_FIRST = (REMOTES, HEADS)
LOCAL_FIRST = (HEADS, REMOTES)
ANY_NAME = (HEADS, TAGS, None)
BARE = (HEADS, "HEAD")


def list_refs(refs: DataFrame, kinds: list[str] | None = None) -> DataFrame:
    chosen = refs.where(F.col("kind").isin(kinds)) if kinds else refs
    return chosen.select("repo_id", "kind", "name", "sha")


def resolve_refs(
    sources: DataFrame,
    refs: DataFrame,
    order: tuple = REMOTE_FIRST,
    commits: DataFrame | None = None,
    name: str = "head_sha",
) -> DataFrame:
    """Add the commit each source's branch points at, null where nothing matches.

    ``sources`` needs ``config_hash, repo_id, branch``. With ``commits`` given, a
    branch setting that is itself a commit id resolves to it.
    """
    branch = branch_or_default(F.col("branch"))
    candidates = [
        F.struct(
            F.lit(place).alias("priority"),
            (
                branch if prefix is None
                else F.lit(prefix) if prefix == "HEAD"
                else F.concat(F.lit(prefix), branch)
            ).alias("ref_name"),
        )
        for place, prefix in enumerate(order)
    ]
    wanted = sources.select("config_hash", "repo_id", F.explode(F.array(*candidates)).alias("c")).select(
        "config_hash", "repo_id", "c.priority", "c.ref_name"
    )
    named = refs.select("repo_id", F.col("name").alias("ref_name"), "sha")
    if commits is not None:
        named = named.unionByName(commits.select("repo_id", F.col("sha").alias("ref_name"), "sha"))
    best = (
        wanted.join(named, ["repo_id", "ref_name"])
        .groupBy("config_hash")
        .agg(F.min_by("sha", "priority").alias(name))
    )
    return sources.join(best, "config_hash", "left")
