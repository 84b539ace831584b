"""The crawl of all sources and its bookkeeping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arborsync.catalog import Catalog
from arborsync.catalog.fragments import CRAWL
from arborsync.operators import batching
from arborsync.plans import crawl, metrics
from arborsync.plans import state as sync_state
from arborsync.sources import virtual
from arborsync.sources.tables import read_table

CATALOG = Catalog()

SYNC_ID = 2


@CATALOG.query(
    f"""with {CRAWL}
select a.config_hash, a.path as title, a.content, 'git:' || a.config_hash || ':' || a.path as source_url,
  'Git: ' || s.repo_url || ' @ ' || s.branch as description
from attempts a join sources s on a.config_hash = s.config_hash where a.outcome = 'ok'"""
)
def crawl_documents(spark: SparkSession, folder: str) -> DataFrame:
    """All sources planned, filtered, read and described; whole texts."""
    return crawl.crawl(virtual.crawl_repository(spark, folder)).documents


@CATALOG.query(
    f"with {CRAWL} select config_hash, repo_id, mode, coalesce(n_failed, 0) as n_failed from plan"
)
def crawl_plan(spark: SparkSession, folder: str) -> DataFrame:
    planned = crawl.plan(virtual.crawl_repository(spark, folder))
    return planned.select("config_hash", "repo_id", "mode", "n_failed")


@CATALOG.query(f"with {CRAWL} select config_hash, path, outcome, batch_no, attempted from batch_rows")
def batches(spark: SparkSession, folder: str) -> DataFrame:
    result = crawl.crawl_outcomes(virtual.crawl_repository(spark, folder))
    return result.batches().drop("is_transient")


@CATALOG.query(
    f"""with {CRAWL},
per_batch as (
  select config_hash, batch_no, count(*) filter (outcome = 'ok') as documents,
    count(*) filter (is_transient) as failed, max(attempted) as completed
  from batch_rows group by 1, 2),
totals as (select config_hash, max(completed) as total, max(batch_no) as last_batch from per_batch group by 1)
select s.config_hash, coalesce(b.batch_no, 0) as batch_no, coalesce(b.documents, 0) as documents,
  coalesce(b.failed, 0) as failed, coalesce(b.completed, 0) as completed, coalesce(t.total, 0) as total,
  case when b.batch_no < t.last_batch then 'processing' else 'completed' end as status
from sources s left join totals t on s.config_hash = t.config_hash
left join per_batch b on s.config_hash = b.config_hash"""
)
def batch_progress(spark: SparkSession, folder: str) -> DataFrame:
    result = crawl.crawl_outcomes(virtual.crawl_repository(spark, folder))
    return batching.batch_progress(result.batches(), result.plan)


@CATALOG.query(
    """with numbered as (
  select 'src-' || source as config_hash, doc_id % 9 in (0, 3, 4, 5) as is_bad, doc_id % 9 = 5 as is_transient,
    source || '/' || cast(doc_id as varchar) as path from documents),
placed as (
  select *, cast(floor(coalesce(sum(case when is_bad then 0 else 1 end) over (partition by config_hash order by path
    rows between unbounded preceding and 1 preceding), 0) / 7) as bigint) as batch_no,
    row_number() over (partition by config_hash order by path) as attempted from numbered)
select config_hash, path, batch_no, attempted from placed"""
)
def batches_by_range(spark: SparkSession, folder: str) -> DataFrame:
    """Batches of 7 over all documents."""
    kind = F.col("doc_id") % 9
    outcome = F.when(kind == 5, "read_error").when(kind.isin(0, 3, 4), "binary").otherwise("ok")
    outcomes = read_table(spark, folder, "documents").select(
        F.concat(F.lit("src-"), "source").alias("config_hash"),
        F.concat("source", F.lit("/"), F.col("doc_id").cast("string")).alias("path"),
        outcome.alias("outcome"),
    )
    return batching.assign_batches(outcomes, batch_files=7).drop("outcome")


@CATALOG.query(
    f"""with {CRAWL},
counted as (
  select config_hash, count(*) filter (outcome = 'ok' and action = 'add') as files_added,
    count(*) filter (outcome = 'ok' and action = 'update') as files_updated,
    count(*) filter (outcome <> 'ok' and not is_transient) as files_skipped,
    count(*) filter (is_transient) as errors
  from attempts group by 1),
gone as (select config_hash, count(*) as files_deleted from delete_feed group by 1)
select p.config_hash, p.mode as sync_type, (select min(ts) from events) as started_at, (select max(ts) from events) as finished_at,
  (select date_diff('microsecond', min(ts), max(ts)) / 1e6 from events) as duration_seconds, coalesce(files_added, 0) as files_added,
  coalesce(files_updated, 0) as files_updated, coalesce(files_deleted, 0) as files_deleted,
  coalesce(files_skipped, 0) as files_skipped, coalesce(errors, 0) as errors
from plan p left join counted c on p.config_hash = c.config_hash left join gone g on p.config_hash = g.config_hash"""
)
def sync_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of the crawl; its times are those of the first and last event."""
    result = crawl.crawl_outcomes(virtual.crawl_repository(spark, folder))
    times = read_table(spark, folder, "events").agg(F.min("ts"), F.max("ts")).first()
    return metrics.sync_metrics(result.plan, result.attempts, result.deletes, *times)


@CATALOG.query(f"with {CRAWL} select * from delete_feed")
def delete_feed(spark: SparkSession, folder: str) -> DataFrame:
    result = crawl.crawl_outcomes(virtual.crawl_repository(spark, folder))
    return result.deletes


@CATALOG.query(
    f"""with {CRAWL}
select config_hash, cast({SYNC_ID} as bigint) as sync_id, 'head' as kind, head_sha as value from plan where mode <> 'noop'
union all
select config_hash, {SYNC_ID}, 'failed', path from attempts where is_transient"""
)
def sync_state_after(spark: SparkSession, folder: str) -> DataFrame:
    """The state a crawl leaves: new heads and the replaced failed list."""
    result = crawl.crawl_outcomes(virtual.crawl_repository(spark, folder))
    heads = sync_state.next_state(result.plan, SYNC_ID)
    failed = sync_state.next_failed(result.attempts, SYNC_ID)
    return heads.select("config_hash", "sync_id", F.lit("head").alias("kind"), F.col("head_sha").alias("value")).unionByName(
        failed.select("config_hash", "sync_id", F.lit("failed").alias("kind"), F.col("path").alias("value"))
    )


@CATALOG.query(
    f"""with {CRAWL}
select f.config_hash, f.path from failed_before f
where starts_with(f.path, f.prefix) and regexp_matches(lower(f.path), f.ext_regex)"""
)
def retry_queue(spark: SparkSession, folder: str) -> DataFrame:
    repo = virtual.crawl_repository(spark, folder)
    failed = sync_state.failed_of_last_sync(repo.sync_state, repo.failed_paths)
    queue = sync_state.retry_queue(failed, crawl.with_config(repo.sources), crawl.passes())
    return queue.select("config_hash", "path")


@CATALOG.query(
    """with saved as (select cast(o_custkey as varchar) as config_hash, o_orderkey as sync_id,
  sha1('order:' || cast(o_orderkey as varchar)) as head_sha, o_orderstatus from orders),
latest as (select config_hash, max(sync_id) as last_sync_id, arg_max(head_sha, sync_id) as last_sha from saved group by 1),
failed as (
  select s.config_hash, count(*) as n from saved s join latest l on s.config_hash = l.config_hash
    and s.sync_id = l.last_sync_id join lineitem i on i.l_orderkey = s.sync_id group by 1)
select cast(c.c_custkey as varchar) || x.suffix as config_hash, l.last_sha, coalesce(f.n, 0) as n_failed
from customer c cross join (values (''), ('-new')) x(suffix)
left join latest l on l.config_hash = cast(c.c_custkey as varchar) || x.suffix
left join failed f on f.config_hash = cast(c.c_custkey as varchar) || x.suffix"""
)
def sync_state_load(spark: SparkSession, folder: str) -> DataFrame:
    """Newest state per configuration from a log of all syncs; a new configuration has none."""
    customer = F.col("c_custkey").cast("string")
    names = F.explode(F.array(customer, F.concat(customer, F.lit("-new"))))
    sources = read_table(spark, folder, "customer").select(names.alias("config_hash"))
    orders = read_table(spark, folder, "orders").select(
        F.col("o_custkey").cast("string").alias("config_hash"), F.col("o_orderkey").alias("sync_id")
    )
    saved = orders.withColumn("head_sha", virtual.order_sha(F.col("sync_id")))
    lines = read_table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("sync_id"), F.col("l_partkey").cast("string").alias("path")
    )
    failed = lines.join(orders, "sync_id").withColumn("reason", F.lit("read_error"))
    return sync_state.load_state(sources, saved, failed)


@CATALOG.query(
    """select event_id, case when event_id % 3 = 0 then 0 when event_id % 3 = 1 then 2 else 0 end as n_paths,
  case when event_id % 3 = 1 then 'u' || cast(user_id as varchar) || '|' || event_type else '' end as paths
from events"""
)
def failed_list_load(spark: SparkSession, folder: str) -> DataFrame:
    """Stored failed lists read back; an object, broken JSON or nothing counts as an empty list."""
    kind = F.col("event_id") % 3
    stored = (
        F.when(kind == 0, F.concat("props", F.lit("[")))
        .when(kind == 1, F.to_json(F.array(F.concat(F.lit("u"), F.col("user_id").cast("string")), F.col("event_type"))))
    )
    paths = sync_state.parse_failed_list(stored)
    return read_table(spark, folder, "events").select(
        "event_id", F.size(paths).alias("n_paths"), F.array_join(paths, "|").alias("paths")
    )
