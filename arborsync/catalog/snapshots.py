"""Snapshot scans, path filters and folder browsing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arborsync.catalog import Catalog
from arborsync.catalog.fragments import CRAWL_SOURCES, FILES, PLANTED, SNAPSHOTS
from arborsync.functions import mime, paths
from arborsync.operators import export, intervals, listing, snapshot
from arborsync.operators.refs import resolve_refs
from arborsync.plans import crawl
from arborsync.sources import virtual

CATALOG = Catalog()

EXTENSIONS = ".md, TXT,gz"
EXCLUDES = ("*.json", "fr", "doc_1?.*", "doc_[2-4]*.py", ".*", "moved/*", "src[!0-9]*")
LISTING_SQL = "'corpus' as repo_id, path, string_split(path, '/')[-1] as name, size, 'file' as type"


def _new(spark: SparkSession, folder: str) -> DataFrame:
    return virtual.snapshot_pair(spark, folder)[1]


def _listing_sql(condition: str) -> str:
    return f"with {SNAPSHOTS} select {LISTING_SQL} from new_tree where {condition}"


@CATALOG.query(_listing_sql("true"))
def snapshot_list(spark: SparkSession, folder: str) -> DataFrame:
    return snapshot.list_files(_new(spark, folder))


@CATALOG.query(
    f"""with {SNAPSHOTS}
select source as repo_id, cast(position as bigint) as position, path, blob as blob_sha, size
from (select *, unnest([1, 3]) as position from old_tree union all by name select *, 2 as position from new_tree)"""
)
def snapshot_from_intervals(spark: SparkSession, folder: str) -> DataFrame:
    """Every stored snapshot of every source, rebuilt from the intervals in which its files held."""
    store, positions = virtual.interval_store(spark, folder)
    return intervals.files_at(spark, store, positions).select("repo_id", "position", "path", "blob_sha", "size")


@CATALOG.query(
    f"""with {SNAPSHOTS}
select section as repo_id, '{{"path":"' || path || '","name":"' || string_split(path, '/')[-1] || '","size":' || size || ',"type":"file"}}' as file_info,
  path, size from new_tree"""
)
def listing_export(spark: SparkSession, folder: str) -> DataFrame:
    """Listing rows as JSON objects, and path and size read back from them."""
    exported = export.export_listing(snapshot.list_files(virtual.snapshot_pair(spark, folder, repo="section")[1]))
    back = export.import_listing(exported).select("repo_id", "path", "size")
    return exported.withColumn("path", F.get_json_object("file_info", "$.path")).join(back, ["repo_id", "path"])


@CATALOG.query(_listing_sql("path like 'src4/en/%'"))
def snapshot_subtree(spark: SparkSession, folder: str) -> DataFrame:
    return snapshot.subtree(_new(spark, folder), "src4/en")


@CATALOG.query(
    f"""with {SNAPSHOTS}
select source as repo_id, path, string_split(path, '/')[-1] as name, size, 'file' as type
from (select *, row_number() over (partition by source order by path) as k from new_tree) where k <= 25"""
)
def snapshot_capped(spark: SparkSession, folder: str) -> DataFrame:
    """The first files of each source's repository."""
    return snapshot.list_files(virtual.snapshot_pair(spark, folder, repo="source")[1], max_files=25)


@CATALOG.query(
    f"""with {SNAPSHOTS}
select 'corpus' as repo_id, o.path, string_split(o.path, '/')[-1] as name, n.size, n.path is not null as found
from old_tree o left join new_tree n on o.path = n.path"""
)
def file_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Every path of the old snapshot, looked up in the new one."""
    old, new = virtual.snapshot_pair(spark, folder)
    return snapshot.lookup_files(old.select("repo_id", "path"), new)


@CATALOG.query(
    f"""with {PLANTED}, {CRAWL_SOURCES}
select s.config_hash, e.path from judged e join sources s on e.source = s.repo_id
where e.version = 'new' and not e.is_link
  and starts_with(e.path, s.prefix) and regexp_matches(lower(e.path), s.ext_regex)"""
)
def full_paths(spark: SparkSession, folder: str) -> DataFrame:
    """The work set of a full sync of every source."""
    repo = virtual.crawl_repository(spark, folder)
    sources = resolve_refs(crawl.with_config(repo.sources), repo.refs)
    return crawl.full_paths(crawl.eligible(repo.tree), sources).select("config_hash", "path")


@CATALOG.query(_listing_sql("regexp_matches(lower(path), '[.](md|txt|gz)$')"))
def filter_extensions(spark: SparkSession, folder: str) -> DataFrame:
    return snapshot.list_files(_new(spark, folder), extensions=paths.parse_extensions(EXTENSIONS))


@CATALOG.query(_listing_sql("starts_with(path, 'src5/')"))
def filter_subdir(spark: SparkSession, folder: str) -> DataFrame:
    return snapshot.list_files(_new(spark, folder), subdir=" /src5/ ")


@CATALOG.query(_listing_sql("starts_with(path, 'src2/') and regexp_matches(lower(path), '[.](py|json)$')"))
def filter_combined(spark: SparkSession, folder: str) -> DataFrame:
    return snapshot.list_files(
        _new(spark, folder), subdir="src2", extensions=paths.parse_extensions("py,JSON")
    )


@CATALOG.query(
    _listing_sql(
        """not (path like '%.json' or regexp_matches(path, '(^|/)fr(/|$)')
  or regexp_matches(path, '(^|/)doc_1.[.]') or regexp_matches(path, '(^|/)doc_[2-4][^/]*[.]py')
  or regexp_matches(path, '(^|/)[.]') or starts_with(path, 'moved/'))"""
    )
)
def filter_exclude(spark: SparkSession, folder: str) -> DataFrame:
    return snapshot.list_files(_new(spark, folder), exclude=EXCLUDES)


@CATALOG.query(_listing_sql("size <= 4096"))
def filter_size(spark: SparkSession, folder: str) -> DataFrame:
    return snapshot.list_files(_new(spark, folder), max_bytes=4096)


@CATALOG.query(
    f"""with {PLANTED}
select case doc_id % 13 when 5 then '.git/' || path when 6 then 'sub\\.git\\' || path else path end as path,
  case when doc_id % 13 in (5, 6) then 'git_directory' when is_link then 'symlink'
       when size > 10000 then 'too_large' end as skip_reason
from judged where version = 'new'"""
)
def skip_reasons(spark: SparkSession, folder: str) -> DataFrame:
    new = virtual.snapshot_pair(spark, folder, planted=True)[1]
    thirteens = F.col("doc_id") % 13
    path = (
        F.when(thirteens == 5, F.concat(F.lit(".git/"), "path"))
        .when(thirteens == 6, F.concat(F.lit("sub\\.git\\"), "path"))
        .otherwise(F.col("path"))
    )
    return snapshot.with_skip_reason(new.withColumn("path", path), 10_000).select("path", "skip_reason")


@CATALOG.query(
    f"""with {FILES}
select path,
  case when starts_with(path, 'src3/en/') then substr(path, 9) else path end as below_fixed,
  case when doc_id % 2 = 0 then substr(path, length(source) + 2) else path end as below_own
from files"""
)
def relative_paths(spark: SparkSession, folder: str) -> DataFrame:
    own = F.when(F.col("doc_id") % 2 == 0, F.col("source")).otherwise("elsewhere")
    return virtual.files(spark, folder).select(
        "path",
        paths.relative_path(F.col("path"), "/src3/en/").alias("below_fixed"),
        paths.relative_path(F.col("path"), own).alias("below_own"),
    )


MIME_SQL = """case doc_id % 6 when 0 then 'text/markdown' when 1 then 'text/plain' when 2 then 'text/x-python'
  when 3 then 'application/json' when 4 then 'application/x-tar' else 'text/plain' end"""


@CATALOG.query(f"with {SNAPSHOTS} select path, {MIME_SQL} as mime_type from new_tree where doc_id % 6 <> 4")
def text_files(spark: SparkSession, folder: str) -> DataFrame:
    typed = mime.with_mime_type(_new(spark, folder).select("path"))
    return typed.where(mime.is_text_type(F.col("mime_type")))


@CATALOG.query(
    f"""with {SNAPSHOTS}
select mime_type, not mime_type = 'application/x-tar' as is_text, count(*) as n_files, cast(sum(size) as bigint) as bytes
from (select {MIME_SQL} as mime_type, size from new_tree) group by 1, 2"""
)
def mime_profile(spark: SparkSession, folder: str) -> DataFrame:
    typed = mime.with_mime_type(_new(spark, folder).select("path", "size"))
    return typed.groupBy("mime_type", mime.is_text_type(F.col("mime_type")).alias("is_text")).agg(
        F.count("*").alias("n_files"), F.sum("size").alias("bytes")
    )


@CATALOG.query(
    f"""with {SNAPSHOTS}
select path, mime_type, case mime_type when 'text/markdown' then '.md' when 'text/plain' then '.txt'
  when 'text/x-python' then '.py' when 'application/json' then '.json' else '.tar' end as extension
from (select path, {MIME_SQL} as mime_type from new_tree)"""
)
def mime_reverse(spark: SparkSession, folder: str) -> DataFrame:
    """The extension each file would be saved under, told from its MIME type alone."""
    typed = mime.with_mime_type(_new(spark, folder).select("path"))
    return typed.join(mime.preferred_extensions(spark), "mime_type", "left")


@CATALOG.query(
    f"""with {FILES},
ugly as (select doc_id, case doc_id % 8
    when 0 then replace(path, '/', '\\') when 1 then './' || path when 2 then '/././' || path
    when 3 then '///' || path when 4 then './/' || path when 5 then 'a/../' || path
    when 6 then '/./notes..' || path else path end as raw, path from files)
select doc_id, raw,
  case doc_id % 8 when 4 then '/' || path when 5 then raw when 6 then 'notes..' || path else path end as normalized,
  doc_id % 8 = 5 as is_traversal
from ugly"""
)
def normalize_paths(spark: SparkSession, folder: str) -> DataFrame:
    docs = virtual.files(spark, folder)
    path, kind = F.col("path"), F.col("doc_id") % 8

    def led(prefix: str):
        return F.concat(F.lit(prefix), path)

    raw = (
        F.when(kind == 0, F.replace(path, F.lit("/"), F.lit("\\")))
        .when(kind == 1, led("./"))
        .when(kind == 2, led("/././"))
        .when(kind == 3, led("///"))
        .when(kind == 4, led(".//"))
        .when(kind == 5, led("a/../"))
        .when(kind == 6, led("/./notes.."))
        .otherwise(path)
    )
    shown = docs.select("doc_id", raw.alias("raw")).withColumn("normalized", paths.normalize_path(F.col("raw")))
    return shown.withColumn("is_traversal", paths.has_traversal(F.col("normalized")))


@CATALOG.query(
    f"""with {SNAPSHOTS},
kids as (select section as repo_id, case when starts_with(path, 'moved/') then substr(path, 7) end as below, size from new_tree)
select repo_id, 'moved/' || string_split(below, '/')[1] as id, string_split(below, '/')[1] as name,
  cast(sum(size) as bigint) as size, case when contains(below, '/') then 'folder' else 'file' end as type
from kids where below is not null group by 1, 2, 3, 5"""
)
def folder_children(spark: SparkSession, folder: str) -> DataFrame:
    """Children of one folder in the repositories of all sections; those of one source share folder names."""
    return listing.folder_children(virtual.snapshot_pair(spark, folder, repo="section")[1], "/moved")


@CATALOG.query(
    f"""with {SNAPSHOTS},
folders as (select section as repo_id, string_split(path, '/')[1] as name, sum(size) as size from new_tree group by 1, 2),
files2 as (select section as repo_id, path as id, string_split(path, '/')[-1] as name, size from new_tree),
entries as (
  select repo_id, name as id, name, cast(size as bigint) as size, 'folder' as type from folders
  union all select repo_id, id, name, size, 'file' from files2 where regexp_matches(lower(name), '[.](md|py)$')),
ranked as (select row_number() over (order by case when type = 'folder' then 0 else 1 end, lower(name), id, repo_id) as n,
  count(*) over () as total, * from entries)
select cast(n as integer) as n, repo_id, id, name, size, type, total > 60 as is_truncated from ranked where n <= 60"""
)
def listing_page(spark: SparkSession, folder: str) -> DataFrame:
    """First page over the top folders and all files of several repositories, extension test on files only."""
    new = virtual.snapshot_pair(spark, folder, repo="section")[1]
    top = listing.folder_children(new).where("type = 'folder'")
    files = snapshot.list_files(new).select("repo_id", F.col("path").alias("id"), "name", "size", "type")
    return listing.listing_page(top.unionByName(files), 60, paths.parse_extensions("md,py"))


@CATALOG.query(
    f"""with {SNAPSHOTS},
entries as (select path as id, string_split(path, '/')[-1] as name, size from new_tree),
ranked as (select row_number() over (order by lower(name), id) as n, count(*) over () as total, * from entries)
select cast(n - 20 as integer) as n, 'corpus' as repo_id, id, name, size, 'file' as type, total > 40 as is_truncated
from ranked where n > 20 and n <= 40"""
)
def listing_next_page(spark: SparkSession, folder: str) -> DataFrame:
    """The second page, continued by the key of the last row of the first."""
    files = snapshot.list_files(_new(spark, folder)).select("repo_id", F.col("path").alias("id"), "name", "size", "type")
    token = listing.page_token(listing.listing_page(files))
    return listing.listing_page(files, after=token)


@CATALOG.query(
    f"with {SNAPSHOTS} select 'corpus' as repo_id, path, blob as blob_sha, size from new_tree"
)
def tree_flatten(spark: SparkSession, folder: str) -> DataFrame:
    """Paths of the new snapshot, rebuilt from nested folder entries."""
    entries, roots = virtual.tree_entries(spark, folder)
    return snapshot.flatten_trees(entries, roots)
