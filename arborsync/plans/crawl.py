"""The crawl: from sources and stored state to documents, deletes, batches and new state."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborsync.functions import keys, paths
from arborsync.functions.content import OK, skip_reason
from arborsync.operators.batching import assign_batches
from arborsync.operators.content import read_outcomes, read_texts
from arborsync.operators.diff import ADDED, DELETED, MODIFIED, RENAMED, changeset, filter_changes
from arborsync.operators.graph import CommitIndex
from arborsync.operators.refs import resolve_refs
from arborsync.operators.skew import lookup_join
from arborsync.operators.snapshot import files_only
from arborsync.plans import state as sync_state
from arborsync.plans.metrics import sync_metrics
from arborsync.plans.sync_plan import FULL, INCREMENTAL, plan_syncs
from arborsync.schemas import ATTEMPTS, DELETES
from arborsync.sources.tables import read_or_empty
from arborsync.staging import stage


@dataclass(frozen=True)
class Repository:
    """The input tables of a crawl.

    ``attempts`` (``config_hash, sync_id, path, outcome``) and ``deletes`` (``config_hash, sync_id,
    path``) are what earlier syncs wrote; from them a full sync tells which documents are gone.
    ``index`` is the stored index of ``commits``; without it they are indexed for each sync.
    """

    sources: DataFrame
    refs: DataFrame
    commits: DataFrame
    tree: DataFrame
    blobs: DataFrame
    sync_state: DataFrame
    failed_paths: DataFrame
    attempts: DataFrame | None = None
    deletes: DataFrame | None = None
    index: CommitIndex | None = None


def with_config(sources: DataFrame) -> DataFrame:
    """Sources with ``config_hash`` and parsed filter columns."""
    settings = [F.col(c) for c in ("repo_url", "branch", "subdir", "extensions")]
    return sources.withColumn("config_hash", keys.config_hash(*settings)).withColumn(
        "extension_list", paths.extension_array(F.col("extensions"))
    )


def plan(repo: Repository) -> DataFrame:
    """One row per source with its mode; staged, since every later step reads it."""
    sources = resolve_refs(with_config(repo.sources), repo.refs)
    stored = sync_state.load_state(sources, repo.sync_state, repo.failed_paths)
    snapshots = repo.tree.select("repo_id", "commit_sha")
    return stage(plan_syncs(sources, stored, repo.commits, repo.index, snapshots), "plan")


def held_documents(attempts: DataFrame, deletes: DataFrame) -> DataFrame:
    """``config_hash, path`` of the documents that earlier syncs left: read, and not deleted since.

    A path deleted and read in one sync was replaced and is still held.
    """
    kept = attempts.where(F.col("outcome") == OK).groupBy("config_hash", "path").agg(F.max("sync_id").alias("_kept"))
    gone = deletes.groupBy("config_hash", "path").agg(F.max("sync_id").alias("_gone"))
    joined = kept.join(gone, ["config_hash", "path"], "left")
    return joined.where(F.col("_gone").isNull() | (F.col("_kept") >= F.col("_gone"))).select("config_hash", "path")


def eligible(tree: DataFrame) -> DataFrame:
    """Tree rows worth reading: files, not below a .git folder, no symbolic links.

    Large files stay in, to be reported as skipped.
    """
    return files_only(tree).where(skip_reason(F.col("path"), F.col("size"), F.col("mode"), None).isNull())


def passes(path: str = "path") -> Column:
    """The path test of joined source columns."""
    return paths.passes_filter(F.col(path), F.col("subdir"), F.col("extension_list"))


def full_paths(tree: DataFrame, sources: DataFrame) -> DataFrame:
    """``config_hash, path, blob_sha, action``: every file at the head that passes the source's filter."""
    filters = sources.select(
        "config_hash", "repo_id", F.col("head_sha").alias("commit_sha"), "subdir", "extension_list"
    )
    joined = lookup_join(tree, filters, ["repo_id", "commit_sha"], how="inner")
    return joined.where(passes()).select("config_hash", "path", "blob_sha", F.lit("add").alias("action"))


def source_changes(tree: DataFrame, sources: DataFrame) -> DataFrame:
    """Change rows per source, seen through its filter.

    Sources that share a repository and both commits share one comparison.
    """
    spans = sources.where("last_sha <> head_sha").withColumn(
        "span", F.concat_ws(":", "repo_id", "last_sha", "head_sha")
    )
    distinct_spans = spans.select("span", "repo_id", "last_sha", "head_sha").distinct()

    def side(sha: str) -> DataFrame:
        at = distinct_spans.select("span", "repo_id", F.col(sha).alias("commit_sha"))
        rows = lookup_join(tree, at, ["repo_id", "commit_sha"], how="inner")
        return rows.select(F.col("span").alias("repo_id"), "path", "blob_sha", "mode")

    changes = changeset(side("last_sha"), side("head_sha")).withColumnRenamed("repo_id", "span")
    filters = spans.select("span", "config_hash", "subdir", "extension_list")
    seen = lookup_join(
        changes, filters, ["span"], how="inner"
    )
    return filter_changes(seen, F.col("subdir"), F.col("extension_list")).select(
        "config_hash", "status", "old_path", "new_path", "new_blob"
    )


def incremental_paths(
    changes: DataFrame, failed: DataFrame, sources: DataFrame, tree: DataFrame
) -> DataFrame:
    """``config_hash, path, blob_sha, action``: changed paths and failed ones that still pass the filter.

    A failed path that is gone keeps a null blob and ends as not found.
    """
    changed = changes.where(F.col("status").isin(ADDED, MODIFIED, RENAMED)).select(
        "config_hash", F.col("new_path").alias("path"), F.col("new_blob").alias("blob_sha"),
        F.when(F.col("status") == MODIFIED, "update").otherwise("add").alias("action"),
        F.lit(1).alias("_rank"),
    )
    wanted = sync_state.retry_queue(
        failed, sources.select("config_hash", "repo_id", "head_sha", "subdir", "extension_list"), passes()
    )
    current = tree.select("repo_id", F.col("commit_sha").alias("head_sha"), "path", "blob_sha")
    retried = wanted.join(current, ["repo_id", "head_sha", "path"], "left").select(
        "config_hash", "path", "blob_sha", F.lit("add").alias("action"), F.lit(0).alias("_rank")
    )
    best = F.max(F.struct("_rank", "blob_sha", "action")).alias("b")
    return (
        changed.unionByName(retried)
        .groupBy("config_hash", "path")
        .agg(best)
        .select("config_hash", "path", "b.blob_sha", "b.action")
    )


def unreadable_documents(attempts: DataFrame, held: DataFrame) -> DataFrame:
    """``config_hash, path`` of held documents whose file was tried again and is no document any more.

    A transient failure says nothing about the file, so its document stays.
    """
    lost = attempts.where((F.col("outcome") != OK) & ~F.col("is_transient")).select("config_hash", "path")
    return held.join(lost, ["config_hash", "path"], "left_semi")


def work_set(repo: Repository, planned: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """(files to read, deletes known before reading, documents held) of all sources.

    Deleted are files that are gone, and all documents of configurations that no source has any more.
    """
    tree = eligible(repo.tree)
    full = planned.where(F.col("mode") == FULL)
    incremental = planned.where(F.col("mode") == INCREMENTAL)
    changes = stage(source_changes(tree, incremental), "source-changes")
    failed = sync_state.failed_of_last_sync(repo.sync_state, repo.failed_paths)
    listed = full_paths(tree, full)
    work = listed.unionByName(incremental_paths(changes, failed, incremental, tree))
    deletes = changes.where(F.col("status").isin(DELETED, RENAMED)).select(
        "config_hash", F.col("old_path").alias("path")
    )
    held = None
    if repo.attempts is not None:
        deleted = repo.deletes if repo.deletes is not None else repo.attempts.where("false")
        held = stage(held_documents(repo.attempts, deleted), "held-documents")
        # Each document meets its own source's mode; a source without a full sync has none here.
        stale = held.join(listed, ["config_hash", "path"], "left_anti")
        deletes = deletes.unionByName(lookup_join(stale, full.select("config_hash"), ["config_hash"], "inner"))
        used = planned.select("config_hash", F.lit(True).alias("_used"))
        deletes = deletes.unionByName(lookup_join(held, used, ["config_hash"]).where("_used IS NULL").select("config_hash", "path"))
    # Read by several joins and jobs below, and narrow.
    return stage(work, "work-set"), deletes, held


def _all_deletes(known: DataFrame, attempts: DataFrame, held: DataFrame | None) -> DataFrame:
    """The delete feed: each path once."""
    return known if held is None else known.unionByName(unreadable_documents(attempts, held)).distinct()


def _describe(files: DataFrame, planned: DataFrame) -> DataFrame:
    """Document columns for files with a text."""
    origin = planned.select("config_hash", "repo_url", keys.branch_or_default(F.col("branch")).alias("branch"))
    title = paths.normalize_path(F.col("path"))
    described = lookup_join(files, origin, ["config_hash"], how="inner")
    return described.select(
        "config_hash", "path", "outcome", "is_transient", "action",
        title.alias("title"),
        F.col("text").alias("content"),
        keys.source_url(F.col("config_hash"), title).alias("source_url"),
        F.concat(F.lit("Git: "), "repo_url", F.lit(" @ "), "branch").alias("description"),
    )


@dataclass(frozen=True)
class CrawlResult:
    """``attempts`` holds a row per file tried; the documents are those with outcome ok."""

    plan: DataFrame
    attempts: DataFrame
    deletes: DataFrame

    @property
    def documents(self) -> DataFrame:
        return self.attempts.where(F.col("outcome") == OK).select(
            "config_hash", "title", "content", "source_url", "description"
        )

    def batches(self) -> DataFrame:
        return assign_batches(self.attempts.select("config_hash", "path", "outcome", "is_transient"))


def crawl(repo: Repository) -> CrawlResult:
    """Run all sources at once: plan, choose files, read them, describe the documents."""
    planned = plan(repo)
    work, deletes, held = work_set(repo, planned)
    attempts = _describe(read_texts(work, repo.blobs), planned)
    return CrawlResult(planned, attempts, _all_deletes(deletes, attempts, held))


def crawl_outcomes(repo: Repository) -> CrawlResult:
    """The same crawl without text: enough for batches, progress, state and metrics."""
    planned = plan(repo)
    work, deletes, held = work_set(repo, planned)
    attempts = stage(read_outcomes(work, repo.blobs), "attempts")
    return CrawlResult(planned, attempts, _all_deletes(deletes, attempts, held))


def run_crawl(repo: Repository, output: str, sync_id: int) -> CrawlResult:
    """Write one sync below ``output``: documents and deletes first, the state last.

    The documents held before come from what earlier syncs wrote there, unless ``repo`` brings them.
    The attempts are written once, content included; batches, metrics and the failed list then read
    only its narrow columns. A rerun of the same ``sync_id`` overwrites its own folders, so a sync
    that died before the state row is simply repeated.
    """
    started = datetime.now(timezone.utc)
    spark = repo.sources.sparkSession
    if repo.attempts is None:
        earlier = F.col("sync_id") < sync_id
        repo = replace(
            repo, attempts=read_or_empty(spark, f"{output}/attempts", ATTEMPTS).where(earlier),
            deletes=read_or_empty(spark, f"{output}/deletes", DELETES).where(earlier),
        )
    planned = plan(repo)
    work, known, held = work_set(repo, planned)
    attempts = _describe(read_texts(work, repo.blobs), planned)
    attempts_path = f"{output}/attempts/sync_id={sync_id}"
    attempts.write.mode("overwrite").parquet(attempts_path)
    written = spark.read.schema(attempts.schema).parquet(attempts_path)
    deletes_path = f"{output}/deletes/sync_id={sync_id}"
    deletes = _all_deletes(known, written, held)
    deletes.write.mode("overwrite").parquet(deletes_path)
    saved = CrawlResult(planned, written, spark.read.schema(deletes.schema).parquet(deletes_path))
    saved.batches().write.mode("overwrite").parquet(f"{output}/batches/sync_id={sync_id}")
    failed = sync_state.next_failed(written, sync_id)
    failed.drop("sync_id").write.mode("overwrite").parquet(f"{output}/failed_paths/sync_id={sync_id}")
    counted = sync_metrics(saved.plan, written, saved.deletes, started, datetime.now(timezone.utc))
    counted.write.mode("overwrite").parquet(f"{output}/metrics/sync_id={sync_id}")
    state = sync_state.next_state(planned, sync_id)
    state.drop("sync_id").write.mode("overwrite").parquet(f"{output}/sync_state/sync_id={sync_id}")
    return saved
