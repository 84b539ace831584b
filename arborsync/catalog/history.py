"""Refs, commit graph, file history and sync planning over many repositories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arborsync.catalog import Catalog
from arborsync.functions import keys
from arborsync.operators import graph, history, refs, snapshot
from arborsync.plans.sync_plan import plan_syncs
from arborsync.sources import virtual
from arborsync.sources.tables import read_table

CATALOG = Catalog()

CHAIN = """chain as (
  select cast(o_custkey as varchar) as repo_id, o_custkey, o_orderkey, o_orderdate,
    sha1('order:' || cast(o_orderkey as varchar)) as sha,
    sha1('order:' || cast(lag(o_orderkey, 1) over w as varchar)) as before,
    sha1('order:' || cast(lag(o_orderkey, 2) over w as varchar)) as before_that,
    row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as age
  from orders window w as (partition by o_custkey order by o_orderdate, o_orderkey))"""

STRAIGHT_LINKS = """links as (
  select repo_id, sha, before as parent from chain where before is not null
  union select repo_id, sha, before_that from chain where before_that is not null and o_orderkey % 7 = 0)"""

FORKED_LINKS = """links as (
  select repo_id, sha, before as parent from chain where before is not null
    and not (o_orderkey % 5 = 1 and before_that is not null and o_orderkey % 7 <> 0)
  union select repo_id, sha, before_that from chain where before_that is not null
    and (o_orderkey % 5 = 1 or o_orderkey % 7 = 0))"""

ANCESTORS = """anc as (
  select repo_id, sha as head, sha from chain where age in (1, 3) 
  union
  select a.repo_id, a.head, l.parent from anc a join links l on a.repo_id = l.repo_id and a.sha = l.sha)"""

REFS = """refs as (
  select repo_id, 'refs/remotes/origin/main' as name, 'remote' as kind, sha from chain where age = 1 and o_custkey % 3 <> 0
  union all select repo_id, 'refs/heads/main', 'branch', sha from chain where age = 2
  union all select repo_id, 'refs/tags/v1', 'tag', sha from chain where age = 3
  union all select repo_id, 'HEAD', 'head', sha from chain where age = 4 and o_custkey % 2 = 0)"""


def _sources(spark: SparkSession, folder: str, commits: DataFrame) -> DataFrame:
    """One source per customer; branch by key % 5: unset, main, v1, a commit id, a name that is not there."""
    key = F.col("repo_id").cast("bigint") % 5
    third = commits.where("age = 3").select("repo_id", F.col("sha").alias("third"))
    branch = F.when(key == 1, "main").when(key == 2, "v1").when(key == 3, F.col("third")).when(key == 4, "nosuch")
    repos = commits.where("age = 1").select("repo_id").join(third, "repo_id", "left")
    return repos.select("repo_id", F.col("repo_id").alias("config_hash"), branch.alias("branch"))


@CATALOG.query(
    f"""with {CHAIN}, {REFS},
named as (
  select s.repo_id, coalesce(case s.o_custkey % 5 when 1 then 'main' when 2 then 'v1' when 3 then t.sha
    when 4 then 'nosuch' end, 'main') as branch
  from chain s left join chain t on s.repo_id = t.repo_id and t.age = 3 where s.age = 1)
select n.repo_id, coalesce(r.sha, h.sha) as remote_first, coalesce(h.sha, r.sha) as local_first,
  coalesce(h.sha, t.sha, c.sha) as any_name, coalesce(h.sha, hd.sha) as bare
from named n left join refs r on r.repo_id = n.repo_id and r.name = 'refs/remotes/origin/' || n.branch
left join refs h on h.repo_id = n.repo_id and h.name = 'refs/heads/' || n.branch
left join refs t on t.repo_id = n.repo_id and t.name = 'refs/tags/' || n.branch
left join chain c on c.repo_id = n.repo_id and c.sha = n.branch
left join refs hd on hd.repo_id = n.repo_id and hd.name = 'HEAD'"""
)
def resolve_refs(spark: SparkSession, folder: str) -> DataFrame:
    """Each source's branch under four lookup orders."""
    commits = virtual.commits(spark, folder)
    known = virtual.customer_refs(commits)
    found = _sources(spark, folder, commits)
    found = refs.resolve_refs(found, known, refs.REMOTE_FIRST, name="remote_first")
    found = refs.resolve_refs(found, known, refs.LOCAL_FIRST, name="local_first")
    found = refs.resolve_refs(found, known, refs.ANY_NAME, commits=commits, name="any_name")
    found = refs.resolve_refs(found, known, refs.BARE, name="bare")
    return found.select("repo_id", "remote_first", "local_first", "any_name", "bare")


@CATALOG.query(f"with {CHAIN}, {REFS} select repo_id, kind, name, sha from refs")
def list_refs(spark: SparkSession, folder: str) -> DataFrame:
    return refs.list_refs(virtual.customer_refs(virtual.commits(spark, folder)))


LAST_TOUCH = """touched as (
  select l_partkey, l_suppkey, o_orderkey, o_orderdate, sha1('order:' || cast(o_orderkey as varchar)) as sha,
    o_orderpriority as author, 'order ' || cast(o_orderkey as varchar) as message from lineitem join orders on l_orderkey = o_orderkey),
last as (
  select l_partkey, o_orderdate, sha, author, message from (
    select *, row_number() over (partition by l_partkey order by o_orderdate desc, sha desc) as k from touched)
  where k = 1)"""


@CATALOG.query(
    f"""with {LAST_TOUCH}
select 'corpus' as repo_id, 'parts/' || cast(l_partkey as varchar) || '.md' as path,
  sha as last_commit_sha, o_orderdate as last_commit_time, author as last_commit_author, message as last_commit_message from last"""
)
def last_commit_per_file(spark: SparkSession, folder: str) -> DataFrame:
    return history.last_commit_per_file(virtual.touches(spark, folder), virtual.touch_commits(spark, folder))


@CATALOG.query(
    f"""with {LAST_TOUCH}
select 'corpus' as repo_id, 'parts/' || cast(l_partkey as varchar) || '.md' as path,
  sha as last_commit_sha, o_orderdate as last_commit_time, author as last_commit_author, message as last_commit_message from last"""
)
def last_commit_from_state(spark: SparkSession, folder: str) -> DataFrame:
    """The same, kept up over five ingests of commits by month."""
    return virtual.last_commits(spark, folder)


@CATALOG.query(
    f"""with {LAST_TOUCH},
ranked as (select *, row_number() over (partition by l_partkey order by o_orderdate desc, sha desc) as n
  from (select distinct l_partkey, o_orderkey, o_orderdate, sha, author from touched))
select 'parts/' || cast(l_partkey as varchar) || '.md' as path, cast(n as integer) as n, sha, o_orderdate as ts, author,
  'order ' || cast(o_orderkey as varchar) as message
from ranked where n <= 10"""
)
def file_history(spark: SparkSession, folder: str) -> DataFrame:
    newest = history.file_history(virtual.touches(spark, folder), virtual.touch_commits(spark, folder))
    return newest.select("path", "n", "sha", "ts", "author", "message")


@CATALOG.query(
    f"""with {LAST_TOUCH}
select 'corpus' as repo_id, 'parts/' || cast(p_partkey as varchar) || '.md' as path, p_size as size,
  sha as last_commit_sha, o_orderdate as last_commit_time, author as last_commit_author, message as last_commit_message,
  'corpus::main::parts/' || cast(p_partkey as varchar) || '.md' as document_id from part left join last on p_partkey = l_partkey"""
)
def snapshot_with_history(spark: SparkSession, folder: str) -> DataFrame:
    files = read_table(spark, folder, "part").select(
        F.lit(virtual.CORPUS).alias("repo_id"),
        F.concat(F.lit("parts/"), F.col("p_partkey").cast("string"), F.lit(".md")).alias("path"),
        F.col("p_size").alias("size"),
    )
    newest = history.last_commit_per_file(virtual.touches(spark, folder), virtual.touch_commits(spark, folder))
    listed = snapshot.with_history(files, newest)
    return listed.withColumn("document_id", keys.item_id(F.col("repo_id"), F.lit("main"), F.col("path")))


@CATALOG.query(
    """with touched as (
  select 'supplier-' || cast(l_suppkey as varchar) as repo_id, l_suppkey, 'parts/' || cast(l_partkey as varchar) as path,
    o_orderdate, sha1('order:' || cast(o_orderkey as varchar)) as sha from lineitem join orders on l_orderkey = o_orderkey),
last as (select repo_id, l_suppkey, path, max(o_orderdate) as ts from touched group by 1, 2, 3),
marks as (select l_suppkey, avg(epoch(l_shipdate)) as mark from lineitem where l_suppkey % 3 <> 0 group by 1)
select l.repo_id, l.path, l.ts as last_commit_time from last l left join marks m on l.l_suppkey = m.l_suppkey
where m.mark is null or epoch(l.ts) > floor(m.mark)"""
)
def changed_since(spark: SparkSession, folder: str) -> DataFrame:
    """Files of each supplier's repository whose last commit is newer than its mark."""
    lines = read_table(spark, folder, "lineitem")
    name = virtual.supplier_repo(F.col("l_suppkey")).alias("repo_id")
    touched = lines.select(
        name, F.concat(F.lit("parts/"), F.col("l_partkey").cast("string")).alias("path"),
        virtual.order_sha(F.col("l_orderkey")).alias("sha"),
    )
    commits = virtual.supplier_commits(spark, folder)
    shipped = F.floor(F.avg(F.unix_timestamp(F.col("l_shipdate").cast("timestamp"))))
    marks = (
        lines.where("l_suppkey % 3 <> 0").groupBy(name)
        .agg(F.timestamp_seconds(shipped).cast("timestamp_ntz").alias("stored_time"))
    )
    newest = history.last_commit_per_file(touched, commits)
    return history.changed_since(newest, marks).select("repo_id", "path", "last_commit_time")


@CATALOG.query(
    f"""with recursive {CHAIN}, {FORKED_LINKS}, {ANCESTORS},
pairs as (
  select n.repo_id, o.sha as old_sha, n.sha as new_sha from chain n join chain o on n.repo_id = o.repo_id
  where n.age = 1 and o.age = 3)
select p.*, exists (select 1 from anc a where a.repo_id = p.repo_id and a.head = p.new_sha and a.sha = p.old_sha) as is_reachable,
  (select count(*) from anc a where a.repo_id = p.repo_id and a.head = p.new_sha
     and not exists (select 1 from anc b where b.repo_id = p.repo_id and b.head = p.old_sha and b.sha = a.sha)) as distance
from pairs p"""
)
def commit_distance(spark: SparkSession, folder: str) -> DataFrame:
    """Commits between the third-newest and the newest commit of every repository, forks and merges included."""
    commits = virtual.commits(spark, folder, forked=True)
    old = commits.where("age = 3").select("repo_id", F.col("sha").alias("old_sha"))
    new = commits.where("age = 1").select("repo_id", F.col("sha").alias("new_sha"))
    return graph.compare_commits(old.join(new, "repo_id"), None, virtual.commit_index(spark, folder, forked=True))


@CATALOG.query(
    f"""with recursive {CHAIN}, {FORKED_LINKS}, {ANCESTORS}
select c.repo_id, c.sha, a.sha is not null as is_reachable
from chain c join chain h on c.repo_id = h.repo_id and h.age = 1
left join anc a on a.repo_id = c.repo_id and a.head = h.sha and a.sha = c.sha"""
)
def reachable(spark: SparkSession, folder: str) -> DataFrame:
    """Every commit of every repository: is it an ancestor of the newest one?"""
    commits = virtual.commits(spark, folder, forked=True)
    heads = commits.where("age = 1").select("repo_id", F.col("sha").alias("head"))
    index = virtual.commit_index(spark, folder, forked=True)
    known = graph.ancestors(heads, None, index).select("repo_id", "sha", F.lit(True).alias("hit"))
    return commits.select("repo_id", "sha").join(known, ["repo_id", "sha"], "left").select(
        "repo_id", "sha", F.coalesce("hit", F.lit(False)).alias("is_reachable")
    )


@CATALOG.query(
    f"""with recursive {CHAIN}, {STRAIGHT_LINKS}, {ANCESTORS},
heads as (select repo_id, o_custkey, sha as head_sha from chain where age = 1),
state as (
  select h.repo_id, h.o_custkey, h.head_sha, case when h.o_custkey % 8 = 1 then 2 else 0 end as n_failed,
    case h.o_custkey % 4 when 1 then h.head_sha when 2 then t.sha when 3 then sha1('gone:' || h.repo_id) end as last_sha
  from heads h left join chain t on h.repo_id = t.repo_id and t.age = 3),
measured as (
  select s.*,
    exists (select 1 from anc a where a.repo_id = s.repo_id and a.head = s.head_sha and a.sha = s.last_sha) as hit,
    (select count(*) from anc a where a.repo_id = s.repo_id and a.head = s.head_sha
       and not exists (select 1 from anc b where b.repo_id = s.repo_id and b.head = s.last_sha and b.sha = a.sha)) as apart
  from state s),
told as (
  select *, case when last_sha is null then 'first_sync' when last_sha = head_sha and n_failed = 0 then 'unchanged'
    when last_sha = head_sha then 'retry_only' when not hit then 'history_rewritten'
    else 'changes' end as reason
  from measured)
select 'cfg-' || repo_id as config_hash, last_sha, head_sha, n_failed, reason,
  case when reason = 'unchanged' then 'noop' when reason in ('changes', 'retry_only') then 'incremental' else 'full' end as mode,
  case when last_sha = head_sha then 0 when hit then apart end as distance
from told"""
)
def sync_plan(spark: SparkSession, folder: str) -> DataFrame:
    """Full, incremental or nothing, for every customer's repository."""
    commits = virtual.commits(spark, folder)
    sources, state = virtual.chain_states(spark, folder, commits)
    planned = plan_syncs(sources, state, commits, virtual.commit_index(spark, folder))
    return planned.select("config_hash", "last_sha", "head_sha", "n_failed", "reason", "mode", "distance")
