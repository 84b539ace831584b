"""Streaming jobs run to their end; the final state is compared."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arborsync.catalog import Catalog
from arborsync.catalog.fragments import SNAPSHOTS
from arborsync.catalog.fragments import changes as changes_sql
from arborsync.operators import merkle
from arborsync.session import new_work_path
from arborsync.sources import virtual
from arborsync.sources.tables import read_table
from arborsync.staging import stage
from arborsync.streaming import changefeed, events, keyed

CATALOG = Catalog()

EVENT_FILES = 3


@CATALOG.query(
    f"""with {changes_sql('source')}
select repo_id, cast(1 as bigint) as sync_id, 'A' as status, null as old_path, path as new_path from o
union all select repo_id, 2, status, old_path, new_path from changes
union all select repo_id, 3, case status when 'A' then 'D' when 'D' then 'A' else status end, new_path, old_path from changes"""
)
def stream_changefeed(spark: SparkSession, folder: str) -> DataFrame:
    """Three snapshots per source, the old one, the new one and the old one again, announced out of order and repeatedly."""
    return _feed(spark, folder)


@CATALOG.query(f"with {SNAPSHOTS} select source as repo_id, path from old_tree")
def stream_current(spark: SparkSession, folder: str) -> DataFrame:
    """The files that exist once the whole feed is applied: those of the last snapshot."""
    return changefeed.current_paths(_feed(spark, folder))


def _feed(spark: SparkSession, folder: str) -> DataFrame:
    """Snapshots 1 and 3 come first, then 2, then 1 and 2 once more; 2 is stored after the stream was set up."""
    work = new_work_path(spark, "changefeed")
    tree = stage(virtual.tree(spark, folder, repo="source").drop("doc_id"), "tree")
    is_new = F.col("commit_sha") == virtual.commit_sha(F.col("repo_id"), virtual.NEW)
    merkle.store_snapshots(tree.where(~is_new), f"{work}/store", 1)
    repos = read_table(spark, folder, "documents").select(F.col("source").alias("repo_id")).distinct()
    sizes = tree.groupBy("repo_id", "commit_sha").agg(F.count("*").alias("files"))
    versions = {1: virtual.OLD, 2: virtual.NEW, 3: virtual.OLD}

    def announce(*sync_ids: int) -> None:
        told = [
            repos.select(
                "repo_id", F.lit(number).cast("bigint").alias("sync_id"),
                virtual.commit_sha(F.col("repo_id"), versions[number]).alias("commit_sha"),
            ).join(sizes, ["repo_id", "commit_sha"], "left").select(
                "repo_id", "sync_id", "commit_sha", F.coalesce("files", F.lit(0).cast("bigint")).alias("files"))
            for number in sync_ids
        ]
        reduce(DataFrame.unionByName, told).coalesce(1).write.mode("append").parquet(f"{work}/announced")

    announce(1, 3)
    stream = changefeed.read_announcements(spark, f"{work}/announced", files_per_batch=1)
    changefeed.start_changefeed(stream, f"{work}/store", f"{work}/out", f"{work}/checkpoint").awaitTermination()
    merkle.store_snapshots(tree.where(is_new), f"{work}/store", 2)
    announce(2)
    announce(2, 1)
    changefeed.start_changefeed(stream, f"{work}/store", f"{work}/out", f"{work}/checkpoint").awaitTermination()
    return changefeed.read_feed(spark, f"{work}/out")


def _event_stream(spark: SparkSession, folder: str, work: str) -> DataFrame:
    """The events table replayed from files in time order."""
    rows = read_table(spark, folder, "events")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    low, high = rows.agg(F.min(at), F.max(at)).first()
    part = F.floor((at - F.lit(low)) * EVENT_FILES / F.lit((high or 0) - (low or 0) + 1))
    # One write after the other: a stream takes files by their age.
    for number in range(EVENT_FILES):
        rows.where(part == number).write.mode("append").parquet(f"{work}/events")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{work}/events")
    return stream.select(
        F.concat(F.lit("user/"), F.col("user_id").cast("string")).alias("path"),
        "ts", F.col("event_id").alias("seq"), "event_type", "props",
        (F.col("event_type") == "error").alias("failed"),
    )


@CATALOG.query(
    """select 'user/' || cast(user_id as varchar) as path, ts, event_id as seq, event_type, props
from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as k from events) where k = 1"""
)
def stream_latest(spark: SparkSession, folder: str) -> DataFrame:
    """Newest event per path."""
    work = new_work_path(spark, "latest")
    state = events.latest_per_path(_event_stream(spark, folder, work), ["event_type", "props"])
    events.start_updates(state, f"{work}/out", f"{work}/checkpoint").awaitTermination()
    return events.read_latest(spark, f"{work}/out", state.schema)


@CATALOG.query(
    """select 'user/' || cast(user_id as varchar) as path, ts as failed_at, event_id as seq
from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as k from events)
where k = 1 and event_type = 'error'"""
)
def stream_retry(spark: SparkSession, folder: str) -> DataFrame:
    """Paths whose last event is a failed read, after all micro-batches."""
    work = new_work_path(spark, "retry")
    state = events.last_outcomes(_event_stream(spark, folder, work))
    events.start_updates(state, f"{work}/out", f"{work}/checkpoint").awaitTermination()
    return events.read_retry_queue(spark, f"{work}/out", state.schema)


def _shuffled_events(spark: SparkSession, folder: str, work: str) -> DataFrame:
    """The events table replayed out of order, every fifth event twice, in files by event_id % 4."""
    rows = read_table(spark, folder, "events")
    again = rows.where("event_id % 5 = 2")
    for part in (3, 0, 2, 1):
        own = F.col("event_id") % 4 == part
        rows.where(own).unionByName(again.where(F.col("event_id") % 4 == (part + 1) % 4)).coalesce(1).write.mode("append").parquet(f"{work}/events")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{work}/events")
    return stream.select(
        F.concat(F.lit("user/"), F.col("user_id").cast("string")).alias("path"),
        F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("seq"), "event_type", "props")


@CATALOG.query(
    """select 'user/' || cast(user_id as varchar) as path, ts, event_id as seq, event_type, props
from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as k from events) where k = 1"""
)
def stream_latest_state(spark: SparkSession, folder: str) -> DataFrame:
    """Newest event per path as keyed state, events arriving late and repeated."""
    work = new_work_path(spark, "latest-state")
    newest = keyed.newest_versions(_shuffled_events(spark, folder, work))
    keyed.write_rows(newest, f"{work}/out", f"{work}/checkpoint").awaitTermination()
    found = keyed.newest_rows(spark.read.schema(newest.schema).parquet(f"{work}/out"))
    return found.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@CATALOG.query(
    """with e as (
  select user_id, ts, event_id, event_type = 'error' as failed,
    lead(ts) over w as following, count(*) filter (event_type <> 'error') over w as successes
  from events window w as (partition by user_id order by ts, event_id)),
counted as (select *, row_number() over (partition by user_id, successes order by ts, event_id)
    - case when successes > 0 then 1 else 0 end as attempt from e),
timed as (select *, ts + to_microseconds(least(3600000000 * power(2, attempt - 1), 604800000000)::bigint) as due from counted where failed)
select 'user/' || cast(user_id as varchar) as path, attempt::integer as attempt, ts as failed_at, event_id as seq, due as due_at from timed
where (following is null or ceil(epoch_us(due) / 1000) <= ceil(epoch_us(following) / 1000))
  and (following is not null or ceil(epoch_us(due) / 1000) <= floor((select max(epoch_us(ts)) from events) / 1000) - 3600000)"""
)
def stream_backoff(spark: SparkSession, folder: str) -> DataFrame:
    """Failed reads that fell due again before anything newer came, by timers with back-off."""
    work = new_work_path(spark, "backoff")
    events_in_order = _event_stream(spark, folder, work).withColumn("ts", F.col("ts").cast("timestamp"))
    due = keyed.due_retries(events_in_order)
    keyed.write_rows(due, f"{work}/out", f"{work}/checkpoint").awaitTermination()
    found = spark.read.schema(due.schema).parquet(f"{work}/out")
    return found.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("failed_at", "due_at")})
