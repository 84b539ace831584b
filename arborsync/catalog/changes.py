"""Change sets and what follows from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arborsync.catalog import Catalog
from arborsync.catalog.fragments import CRAWL, SNAPSHOTS, changes as changes_sql
from arborsync.functions import paths
from arborsync.operators import actions, diff, export, merkle, renames, snapshot, upsert
from arborsync.operators.refs import resolve_refs
from arborsync.plans import crawl
from arborsync.session import new_work_path
from arborsync.sources import ranged, virtual
from arborsync.staging import stage

CATALOG = Catalog()

SHOWN = ("repo_id", "status", "old_path", "new_path")
FILTER_SUBDIR, FILTER_EXTENSIONS = "moved", ".md,.json,gz"
PART = 20
UPSERT_RANGE = 2000


def _changes(spark: SparkSession, folder: str, repo: str | None = None) -> DataFrame:
    return diff.changeset(*virtual.snapshot_pair(spark, folder, repo))


@CATALOG.query(f"with {changes_sql()} select * from changes")
def changeset(spark: SparkSession, folder: str) -> DataFrame:
    """What changed between two snapshots, with renames."""
    return _changes(spark, folder).select(*SHOWN)


@CATALOG.query(f"with {changes_sql('source')} select * from changes")
def changeset_by_folders(spark: SparkSession, folder: str) -> DataFrame:
    """What changed in every source, found from the top folders down: folders that are the same are not entered."""
    entries, roots = virtual.folder_store(spark, folder)

    def tops(version: str, name: str) -> DataFrame:
        at = roots.where(F.col("commit_sha") == virtual.commit_sha(F.col("repo_id"), version))
        return at.select("repo_id", F.col("tree_id").alias(name))

    pairs = tops(virtual.OLD, "old_tree").join(tops(virtual.NEW, "new_tree"), "repo_id", "full_outer")
    return merkle.merkle_changeset(pairs, entries).select(*SHOWN)


@CATALOG.query(
    f"""with {changes_sql('source')}
select repo_id, count(*) filter (status = 'A') as added, count(*) filter (status = 'M') as modified,
  count(*) filter (status = 'D') as deleted, count(*) filter (status = 'R') as renamed
from changes group by repo_id"""
)
def changeset_summary(spark: SparkSession, folder: str) -> DataFrame:
    return diff.change_counts(_changes(spark, folder, "source"))


FILTERED_SQL = f"""with {changes_sql()},
sided as (select *,
  coalesce(starts_with(old_path, 'moved/') and regexp_matches(lower(old_path), '[.](md|json|gz)$'), false) as old_ok,
  coalesce(starts_with(new_path, 'moved/') and regexp_matches(lower(new_path), '[.](md|json|gz)$'), false) as new_ok
  from changes)"""


@CATALOG.query(f"{FILTERED_SQL} select repo_id, status, old_path, new_path from sided where old_ok or new_ok")
def changeset_filtered(spark: SparkSession, folder: str) -> DataFrame:
    """A rename stays when either side passes the filter."""
    wanted = paths.parse_extensions(FILTER_EXTENSIONS)
    return diff.filter_changes_raw(_changes(spark, folder), FILTER_SUBDIR, wanted).select(*SHOWN)


@CATALOG.query(
    f"""{FILTERED_SQL},
seen as (select repo_id, case when status <> 'R' or (old_ok and new_ok) then status
                when new_ok then 'A' else 'D' end as status, old_path, new_path
         from sided where old_ok or new_ok)
select repo_id, status, case when status <> 'A' then old_path end as old_path,
  case when status <> 'D' then new_path end as new_path from seen"""
)
def changeset_seen(spark: SparkSession, folder: str) -> DataFrame:
    """A rename across the filter's edge counts as an addition or a deletion."""
    wanted = paths.parse_extensions(FILTER_EXTENSIONS)
    return diff.filter_changes(_changes(spark, folder), FILTER_SUBDIR, wanted).select(*SHOWN)


@CATALOG.query(
    f"""with {changes_sql()}
select distinct repo_id, path from (
  select repo_id, old_path as path from changes union all select repo_id, new_path from changes)
where path is not null"""
)
def affected_paths(spark: SparkSession, folder: str) -> DataFrame:
    return diff.affected_paths(_changes(spark, folder))


@CATALOG.query(
    f"""with {changes_sql('section')}
select s.repo_id, count(c.repo_id) as n_changes, count(c.repo_id) = 0 as is_unchanged
from (select distinct section as repo_id from files) s left join changes c on s.repo_id = c.repo_id group by 1"""
)
def unchanged_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Change count of every section as a repository of its own; some have none."""
    sections = virtual.files(spark, folder).select(F.col("section").alias("repo_id")).distinct()
    counted = diff.with_change_flag(sections, _changes(spark, folder, "section"))
    return counted.withColumn("is_unchanged", F.col("n_changes") == 0)


EXPORT_SQL = f"""with {changes_sql('source')},
placed as (select *, cast(floor((row_number() over (partition by repo_id
    order by coalesce(new_path, old_path), status) - 1) / {PART}) as bigint) as part from changes)
select repo_id, part, cast(to_json(struct_pack(
  added := coalesce(list(new_path order by new_path) filter (status = 'A'), []),
  modified := coalesce(list(new_path order by new_path) filter (status = 'M'), []),
  deleted := coalesce(list(old_path order by old_path) filter (status = 'D'), []),
  renamed := coalesce(list([old_path, new_path] order by old_path, new_path) filter (status = 'R'), [])
  )) as varchar) as changeset
from placed group by repo_id, part"""


@CATALOG.query(EXPORT_SQL)
def changeset_export(spark: SparkSession, folder: str) -> DataFrame:
    return export.export_changesets(_changes(spark, folder, "source"), PART)


@CATALOG.query(f"with {changes_sql('source')} select * from changes")
def changeset_import(spark: SparkSession, folder: str) -> DataFrame:
    """The exported JSON read back: the same change set again."""
    exported = export.export_changesets(_changes(spark, folder, "source"), PART)
    return export.import_changesets(exported)


def _actions_sql(added: str, modified: str, rename: list[tuple[str, str]]) -> str:
    moves = " union all ".join(
        f"select repo_id, '{action}' as action, {side} as path from changes where status = 'R'"
        for action, side in rename
    )
    return f"""with {changes_sql()}
select repo_id, '{added}' as action, new_path as path from changes where status = 'A'
union all select repo_id, '{modified}', new_path from changes where status = 'M'
union all select repo_id, 'delete', old_path from changes where status = 'D'
union all {moves}"""


@CATALOG.query(_actions_sql("add", "update", [("delete", "old_path"), ("add", "new_path")]))
def sync_actions(spark: SparkSession, folder: str) -> DataFrame:
    return actions.sync_actions(_changes(spark, folder))


@CATALOG.query(_actions_sql("add", "update", [("update", "new_path")]))
def sync_actions_keep_renames(spark: SparkSession, folder: str) -> DataFrame:
    return actions.sync_actions(_changes(spark, folder), rename_as_delete_add=False)


@CATALOG.query(_actions_sql("upsert", "upsert", [("delete", "old_path"), ("upsert", "new_path")]))
def upserts_and_deletes(spark: SparkSession, folder: str) -> DataFrame:
    return actions.upserts_and_deletes(_changes(spark, folder))


@CATALOG.query(
    f"""with {changes_sql()}
select 'corpus' as repo_id, path from old_tree
where path not in (select old_path from changes where status in ('D', 'R'))"""
)
def active_files(spark: SparkSession, folder: str) -> DataFrame:
    old, new = virtual.snapshot_pair(spark, folder)
    return actions.active_files(old.select("repo_id", "path"), diff.changeset(old, new))


@CATALOG.query(
    f"""with {SNAPSHOTS}
select 'corpus' as repo_id, path from old_tree where path not in (select path from new_tree)"""
)
def orphans(spark: SparkSession, folder: str) -> DataFrame:
    old, new = virtual.snapshot_pair(spark, folder)
    return actions.orphans(old.select("repo_id", "path"), new)


@CATALOG.query(
    f"""with {changes_sql()}
select 'corpus' as repo_id, l.path, case c.status when 'A' then 'added' when 'M' then 'modified'
  when 'D' then 'deleted' when 'R' then 'renamed' else 'unchanged' end as status
from (select path from new_tree union all select old_path from changes where status = 'D') l
left join changes c on l.path = coalesce(c.new_path, c.old_path)"""
)
def annotated_listing(spark: SparkSession, folder: str) -> DataFrame:
    """The new snapshot and the deleted files, each with its status."""
    old, new = virtual.snapshot_pair(spark, folder)
    changed = stage(diff.changeset(old, new), "changeset")
    gone = changed.where(F.col("status") == diff.DELETED).select("repo_id", F.col("old_path").alias("path"))
    return actions.annotate_listing(new.select("repo_id", "path").unionByName(gone), changed)


@CATALOG.query(
    f"""with {CRAWL},
every_change as (
  select s.config_hash, c.new_path as path, case when c.status = 'M' then 'update' else 'add' end as action
  from repo_changes c join sources s on c.repo_id = s.repo_id
  where c.new_path is not null and starts_with(c.new_path, s.prefix)
    and regexp_matches(lower(c.new_path), s.ext_regex))
select * from every_change
union all
select f.config_hash, f.path, 'add' from failed_before f
where starts_with(f.path, f.prefix) and regexp_matches(lower(f.path), f.ext_regex)
  and not exists (select 1 from every_change e where e.config_hash = f.config_hash and e.path = f.path)"""
)
def incremental_paths(spark: SparkSession, folder: str) -> DataFrame:
    """The work set of an incremental sync of every source, from the old commit to the new."""
    repo = virtual.crawl_repository(spark, folder)
    sources = resolve_refs(crawl.with_config(repo.sources), repo.refs).withColumn(
        "last_sha", virtual.commit_sha(F.col("repo_id"), virtual.OLD)
    )
    tree = crawl.eligible(repo.tree)
    changed = crawl.source_changes(tree, sources)
    return crawl.incremental_paths(changed, repo.failed_paths, sources, tree).select(
        "config_hash", "path", "action"
    )


UPSERTED = f"""with {SNAPSHOTS}
select 'git:corpus:' || path as source_url, text as content,
  cast(case when doc_id % 10 in (0, 2, 3) then 2 + doc_id % 2 else 1 end as bigint) as sync_id from new_tree"""


def _document_changes(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents of the old snapshot, upserts, deletes); every upsert comes twice or three times, with older versions that must lose."""
    old, new = virtual.snapshot_pair(spark, folder)
    steps = stage(actions.upserts_and_deletes(diff.changeset(old, new)), "steps")
    url = F.concat(F.lit("git:corpus:"), "path").alias("source_url")

    def documents(version: str, sync_id: Column) -> DataFrame:
        return virtual.texts(spark, folder, version).select(
            url, F.col("text").alias("content"), sync_id.cast("bigint").alias("sync_id"))

    keys = steps.select("action", url)
    fresh = documents(virtual.NEW, F.lit(2) + F.col("doc_id") % 2).join(
        keys.where(F.col("action") == actions.UPSERT).select("source_url"), "source_url", "left_semi"
    )
    stale = fresh.select("source_url", F.concat(F.lit("stale "), "content").alias("content"), F.lit(0).cast("bigint").alias("sync_id"))
    repeated = fresh.unionByName(fresh).unionByName(stale)
    return documents(virtual.OLD, F.lit(1)), repeated, keys.where(F.col("action") == actions.DELETE).select("source_url")


@CATALOG.query(UPSERTED)
def apply_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of the old snapshot with the change set applied: those of the new one."""
    return upsert.apply_upsert(*_document_changes(spark, folder))


@CATALOG.query(UPSERTED)
def apply_upsert_stored(spark: SparkSession, folder: str) -> DataFrame:
    """The same on a stored table: a first version of the old documents, and one that rewrites the ranges that change."""
    held, upserts, deletes = _document_changes(spark, folder)
    path = new_work_path(spark, "documents")
    ranged.upsert_ranged(path, held, None, 1, range_rows=UPSERT_RANGE)
    ranged.upsert_ranged(path, upserts, deletes, 2, range_rows=UPSERT_RANGE)
    return ranged.read_ranged(spark, path, held.schema)


@CATALOG.query(
    f"""with {changes_sql('source')}
select repo_id, path, status from (
  select source as repo_id, path, 'listed' as status from new_tree
  union all select repo_id, old_path, 'gone' from changes where status in ('D', 'R'))"""
)
def listing_with_tombstones(spark: SparkSession, folder: str) -> DataFrame:
    """Full listing of each source plus its delete feed."""
    old, new = virtual.snapshot_pair(spark, folder, "source")
    deleted = actions.upserts_and_deletes(diff.changeset(old, new)).where(F.col("action") == actions.DELETE)
    listed = snapshot.list_files(new).select("repo_id", "path", F.lit("listed").alias("status"))
    return listed.unionByName(deleted.select("repo_id", "path", F.lit("gone").alias("status")))


# Similar pairs by brute force over all deleted and added files; on the test tables the pairs that are
# best for both their files are all there are.
SIMILAR = f"""{changes_sql()},
gone as (select c.old_path as path, t.blob, string_split_regex(t.text, '\\s+') as words
  from changes c join old_tree t on c.old_path = t.path where c.status = 'D'),
came as (select c.new_path as path, t.blob, string_split_regex(t.text, '\\s+') as words
  from changes c join new_tree t on c.new_path = t.path where c.status = 'A'),
gone_runs as (select distinct path, list_slice(words, i, i + 2) as run
  from (select path, words, unnest(range(1, greatest(len(words) - 2, 1) + 1)) as i from gone)),
came_runs as (select distinct path, list_slice(words, i, i + 2) as run
  from (select path, words, unnest(range(1, greatest(len(words) - 2, 1) + 1)) as i from came)),
shared as (select g.path as old_path, c.path as new_path, count(*) as n
  from gone_runs g join came_runs c on g.run = c.run group by 1, 2),
scored as (
  select old_path, new_path, n / greatest((select count(*) from gone_runs where path = old_path),
    (select count(*) from came_runs where path = new_path)) as similarity from shared),
placed as (
  select *, row_number() over (partition by old_path order by similarity desc, md5(old_path || chr(31) || new_path)) as a,
    row_number() over (partition by new_path order by similarity desc, md5(old_path || chr(31) || new_path)) as b
  from scored where similarity >= 0.5),
similar_pairs as (
  select 'corpus' as repo_id, p.old_path, p.new_path, g.blob as old_blob, c.blob as new_blob, p.similarity
  from placed p join gone g on p.old_path = g.path join came c on p.new_path = c.path where a = 1 and b = 1)"""


@CATALOG.query(f"with {SIMILAR} select * from similar_pairs")
def renames_similar(spark: SparkSession, folder: str) -> DataFrame:
    """Deleted and added files of similar text, paired one to one."""
    changed = stage(_changes(spark, folder), "changeset")
    return renames.similar_renames(changed, virtual.text_blobs(spark, folder))


@CATALOG.query(
    f"""with {SIMILAR}
select repo_id, status, old_path, new_path from changes
where not (status = 'D' and old_path in (select old_path from similar_pairs))
  and not (status = 'A' and new_path in (select new_path from similar_pairs))
union all select repo_id, 'R', old_path, new_path from similar_pairs"""
)
def changeset_similar(spark: SparkSession, folder: str) -> DataFrame:
    """The change set with similar pairs shown as renames."""
    changed = stage(_changes(spark, folder), "changeset")
    similar = renames.similar_renames(changed, virtual.text_blobs(spark, folder))
    return renames.merge_similar(changed, similar).select(*SHOWN)
