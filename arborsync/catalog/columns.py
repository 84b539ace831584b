"""Key, address and masking jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arborsync.catalog import Catalog
from arborsync.catalog.fragments import FILES
from arborsync.functions import keys, masking, paths, urls
from arborsync.operators import masking as hiding
from arborsync.sources import virtual
from arborsync.sources.tables import read_table

CATALOG = Catalog()

SOURCES = """sources as (
  select page_id, url as repo_url, case page_id % 3 when 0 then null when 1 then 'main' else 'dev' end as branch,
    case page_id % 4 when 0 then '' when 1 then 'docs' when 2 then 'docs/' else '/' end as subdir,
    case page_id % 5 when 0 then '' when 1 then '.md' when 2 then 'MD,.txt' when 3 then ' .txt , md ' else '.md,,' end as extensions,
    case page_id % 5 when 0 then '' when 1 then '.md' when 2 then '.md|.txt' when 3 then '.txt|.md' else '.md' end as parsed,
    case page_id % 5 when 0 then '' when 1 then '.md' when 2 then '.txt,md' when 3 then '.txt,md' else '.md' end as canonical,
    case page_id % 5 when 0 then '' when 1 then '.md' when 2 then '.md,.txt' when 3 then '.md,.txt' else '.md' end as dotted
  from pages)"""


def _settings() -> list:
    return [F.col(c) for c in ("repo_url", "branch", "subdir", "extensions")]


@CATALOG.query(f"with {SOURCES} select page_id, parsed from sources")
def source_extensions(spark: SparkSession, folder: str) -> DataFrame:
    parsed = F.array_join(paths.extension_array(F.col("extensions")), "|")
    return virtual.page_sources(spark, folder).select("page_id", parsed.alias("parsed"))


@CATALOG.query(
    f"""with {SOURCES}
select page_id, canonical, sha256(repo_url || ':' || coalesce(branch, 'main') || ':' || subdir || ':' || canonical)[1:16] as config_hash,
  sha256(repo_url || ':' || coalesce(branch, 'main') || ':' || trim(subdir, '/') || ':' || dotted)[1:16] as source_key
from sources"""
)
def config_hashes(spark: SparkSession, folder: str) -> DataFrame:
    return virtual.page_sources(spark, folder).select(
        "page_id",
        keys.canonical_extensions(F.col("extensions")).alias("canonical"),
        keys.config_hash(*_settings()).alias("config_hash"),
        keys.source_key(*_settings()).alias("source_key"),
    )


@CATALOG.query(
    f"""with {SOURCES},
hashed as (select page_id,
  sha256(repo_url || ':' || coalesce(branch, 'main') || ':' || subdir || ':' || canonical)[1:16] as config_hash,
  sha256(repo_url || ':' || coalesce(branch, 'main') || ':' || trim(subdir, '/') || ':' || lower(trim(extensions)))[1:16] as browse,
  sha256(repo_url || ':' || coalesce(branch, ''))[1:16] as legacy from sources)
select page_id, 'git_browse:' || browse as storage_key, 'git_sha:' || config_hash as sha_key,
  'git_failed:' || config_hash as failed_key, 'git_sync:' || legacy as legacy_key from hashed"""
)
def storage_keys(spark: SparkSession, folder: str) -> DataFrame:
    config = keys.config_hash(*_settings())
    return virtual.page_sources(spark, folder).select(
        "page_id",
        keys.storage_key(*_settings()).alias("storage_key"),
        keys.sha_state_key(config).alias("sha_key"),
        keys.failed_state_key(config).alias("failed_key"),
        keys.legacy_state_key(F.col("repo_url"), F.col("branch")).alias("legacy_key"),
    )


@CATALOG.query(
    """with hashed as (select page_id, sha256(url)[1:16] as h from pages),
made as (select page_id, h, case page_id % 8 when 0 then 'git_browse:' || h when 1 then 'git_sha:' || h
  when 2 then 'git_browse:' || h || ':x' when 3 then 'git_browse:' || h[1:15] when 4 then 'git_browse:zz' || h[3:16]
  when 5 then 'git_browse:0x' || h[3:16] when 6 then h else 'git_browse:' || upper(h) end as storage_key from hashed)
select page_id, storage_key, case when page_id % 8 = 6 then '' else string_split(storage_key, ':')[1] end as prefix,
  case page_id % 8 when 2 then h || ':x' when 3 then h[1:15] when 4 then 'zz' || h[3:16] when 5 then '0x' || h[3:16]
    when 7 then upper(h) else h end as hash,
  page_id % 8 in (0, 5, 7) as is_valid
from made"""
)
def storage_key_audit(spark: SparkSession, folder: str) -> DataFrame:
    page = F.col("page_id") % 8
    digest = F.substring(F.sha2("url", 256), 1, 16)
    tail = F.substring(digest, 3, 14)

    def browse(*parts):
        return F.concat(F.lit("git_browse:"), *parts)

    key = (
        F.when(page == 0, browse(digest))
        .when(page == 1, F.concat(F.lit("git_sha:"), digest))
        .when(page == 2, browse(digest, F.lit(":x")))
        .when(page == 3, browse(F.substring(digest, 1, 15)))
        .when(page == 4, browse(F.lit("zz"), tail))
        .when(page == 5, browse(F.lit("0x"), tail))
        .when(page == 6, digest)
        .otherwise(browse(F.upper(digest)))
    )
    made = read_table(spark, folder, "pages").select("page_id", key.alias("storage_key"))
    return made.select(
        "page_id", "storage_key",
        keys.storage_key_prefix(F.col("storage_key")).alias("prefix"),
        keys.storage_key_hash(F.col("storage_key")).alias("hash"),
        keys.is_storage_key(F.col("storage_key")).alias("is_valid"),
    )


@CATALOG.query(
    f"""with {FILES}
select doc_id, sha256(source)[1:16] || '::main::' || path as item_id,
  sha256('https://git.example.com/' || source || ':main:' || path) as file_id from files"""
)
def document_ids(spark: SparkSession, folder: str) -> DataFrame:
    address = F.concat(F.lit("https://git.example.com/"), "source")
    ref, path = F.lit("main"), F.col("path")
    return virtual.files(spark, folder).select(
        "doc_id",
        keys.item_id(keys.short_hash(F.col("source")), ref, path).alias("item_id"),
        keys.stable_file_id(address, ref, path).alias("file_id"),
    )


URLS = r"""urls as (
  select page_id, case when page_id % 12 = 10 then 'git@' || host when page_id % 6 = 0 then url
    when page_id % 6 = 1 then ' git@' || host || ':' || rest || '.git' when page_id % 6 = 2 then 'ssh://git@' || host || '/' || rest
    when page_id % 6 = 3 then '/srv/git/' || rest when page_id % 6 = 4 then 'git://' || host || '/' || rest
    else 'https://token:secret-' || cast(page_id as varchar) || '@' || host || '/' || rest || '.git' end as url,
    host, rest, trim(url) as page_url
  from (select page_id, url, regexp_extract(url, '^https?://([^/]+)', 1) as host,
          regexp_extract(url, '^https?://[^/]+/([^?#]*)', 1) as rest from pages))"""

BAD_URL_SQL = "'" + urls.BAD_URL + "'"


@CATALOG.query(
    f"""with {URLS},
told as (select page_id, url, case
  when regexp_matches(trim(url), '^https?://[a-zA-Z0-9.-]+(:[0-9]+)?/[a-zA-Z0-9._/-]+$')
    or regexp_matches(trim(url), '^git@[a-zA-Z0-9.-]+:[a-zA-Z0-9._/-]+$')
    or regexp_matches(trim(url), '^ssh://([a-zA-Z0-9._-]+@)?[a-zA-Z0-9.-]+(:[0-9]+)?/[a-zA-Z0-9._/-]+$')
    or regexp_matches(trim(url), '^(file://)?/[a-zA-Z0-9._/-]+$') then ''
  when starts_with(trim(url), 'git://') then '{urls.GIT_PROTOCOL}'
  when contains(url, '@') and not contains(url, '://') and not contains(string_split(url, '@')[2], ':') then '{urls.BAD_SSH}'
  else {BAD_URL_SQL} end as error from urls)
select page_id, url, error = '' as is_valid, error from told"""
)
def url_audit(spark: SparkSession, folder: str) -> DataFrame:
    error = urls.url_error(F.col("url"))
    return virtual.page_urls(spark, folder).select(
        "page_id", "url", (error == "").alias("is_valid"), error.alias("error")
    )


@CATALOG.query(
    f"""with {URLS},
typed as (select page_id, url, case when page_id % 12 = 10 then 'ssh' else case page_id % 6 when 0 then 'https' when 1 then 'ssh'
  when 2 then 'ssh' when 3 then 'local' when 4 then 'unknown' else 'https' end end as url_type from urls)
select page_id, url_type, case when url_type <> 'unknown' then url_type <> 'local' end as requires_clone, url as location from typed"""
)
def url_types(spark: SparkSession, folder: str) -> DataFrame:
    url = F.col("url")
    return virtual.page_urls(spark, folder).select(
        "page_id",
        urls.url_type(url).alias("url_type"),
        urls.requires_clone(url).alias("requires_clone"),
        urls.clone_location(url).alias("location"),
    )


@CATALOG.query(
    f"""with {URLS},
cut as (select page_id, case when ends_with(trim(url), '.git') then left(trim(url), length(trim(url)) - 4) else trim(url) end as u from urls)
select page_id, case when contains(u, '/') then string_split(u, '/')[-1] else string_split(u, ':')[-1] end as repo_name from cut"""
)
def repo_names(spark: SparkSession, folder: str) -> DataFrame:
    return virtual.page_urls(spark, folder).select("page_id", urls.repo_name(F.col("url")).alias("repo_name"))


@CATALOG.query(
    f"""with {URLS}
select page_id, case page_id % 6 when 2 then 'ssh://***:***@' || host || '/' || rest
  when 5 then 'https://***:***@' || host || '/' || rest || '.git' else url end as masked from urls"""
)
def mask_urls(spark: SparkSession, folder: str) -> DataFrame:
    return virtual.page_urls(spark, folder).select("page_id", masking.mask_url(F.col("url")).alias("masked"))


@CATALOG.query(
    """select doc_id, replace(replace(replace(text, 'the', '***'), 'other', '***'), source, '***') as masked,
  replace(replace(replace(text, 'other', '***'), 'the', '***'), '', '***') as longest_first
from documents"""
)
def mask_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Whole texts with secret values hidden: in given order with a per-row one, and longest first."""
    text = F.col("text")
    return read_table(spark, folder, "documents").select(
        "doc_id",
        masking.mask_secrets(text, ["the", "other", F.col("source"), ""]).alias("masked"),
        masking.mask_secrets(text, ["the", "", "other"], longest_first=True).alias("longest_first"),
    )


@CATALOG.query(
    """with words as (select distinct unnest(regexp_extract_all(text, '[A-Za-z]+')) as w from benchmark),
secrets as (select list(w order by length(w) desc, w) as held from words)
select doc_id, list_reduce(list_prepend(text, held), lambda t, s: replace(t, s, '***')) as masked from documents, secrets"""
)
def mask_secret_table(spark: SparkSession, folder: str) -> DataFrame:
    """Whole texts with a table of secret values hidden, longest first: here every word of the benchmark."""
    words = read_table(spark, folder, "benchmark").select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]+"), 0)).alias("secret"))
    docs = read_table(spark, folder, "documents").select("doc_id", F.col("text").alias("masked"))
    return hiding.mask_secret_table(docs, "masked", words)


@CATALOG.query(
    """with tokens as (select c_custkey, case c_custkey % 4 when 0 then c_name when 1 then c_mktsegment
  when 2 then null else c_name[1:8] end as token from customer)
select c_custkey, case when length(token) > 8 then token[1:4] || '****' || right(token, 4) else '***' end as masked from tokens"""
)
def mask_tokens(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("c_custkey") % 4
    token = (
        F.when(kind == 0, F.col("c_name"))
        .when(kind == 1, F.col("c_mktsegment"))
        .when(kind == 3, F.substring("c_name", 1, 8))
    )
    return read_table(spark, folder, "customer").select("c_custkey", masking.mask_token(token).alias("masked"))


@CATALOG.query(
    """select c_custkey, '***' as Access_Token, c_mktsegment as segment, '***' as db_password,
  case when c_nationkey = 0 then '0' else '***' end as nation_secret, '***' as map_api_key, c_mktsegment as map_region,
  case when c_nationkey = 0 then '0' else '***' end as number_token, cast(c_custkey as varchar) as number_plain,
  '***' as list_secret, '["' || c_mktsegment || '"]' as list_plain, '***' as outer_secret,
  '{"password":"***","region":"' || c_mktsegment || '"}' as outer_plain
from customer"""
)
def mask_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Columns, a nested struct and maps of text, numbers, lists and maps, masked by key name."""
    config = read_table(spark, folder, "customer").select(
        "c_custkey",
        F.col("c_name").alias("Access_Token"),
        F.struct(
            F.col("c_mktsegment").alias("segment"),
            F.struct(F.col("c_name").alias("db_password"), F.col("c_nationkey").alias("nation_secret")).alias("login"),
        ).alias("auth"),
        F.create_map(F.lit("API_KEY"), "c_name", F.lit("region"), "c_mktsegment").alias("extra"),
        F.create_map(F.lit("token"), F.col("c_nationkey").cast("bigint"), F.lit("plain"), F.col("c_custkey").cast("bigint")).alias("numbers"),
        F.create_map(F.lit("my_secret"), F.array("c_name"), F.lit("plain"), F.array("c_mktsegment")).alias("lists"),
        F.create_map(
            F.lit("Secret"), F.create_map(F.lit("x"), "c_name", F.lit("region"), "c_name"),
            F.lit("plain"), F.create_map(F.lit("password"), "c_name", F.lit("region"), "c_mktsegment"),
        ).alias("maps"),
    )
    return masking.mask_columns(config).select(
        "c_custkey", "Access_Token", "auth.segment", "auth.login.db_password", "auth.login.nation_secret",
        F.col("extra")["API_KEY"].alias("map_api_key"), F.col("extra")["region"].alias("map_region"),
        F.col("numbers")["token"].alias("number_token"), F.col("numbers")["plain"].alias("number_plain"),
        F.col("lists")["my_secret"].alias("list_secret"), F.col("lists")["plain"].alias("list_plain"),
        F.col("maps")["Secret"].alias("outer_secret"), F.col("maps")["plain"].alias("outer_plain"),
    )


@CATALOG.query(
    f"""with {URLS}
select page_id, case page_id % 6
  when 5 then 'unable to access https://***:***@' || host || '/' || rest || '.git: denied'
  when 2 then 'unable to access ssh://***:***@' || host || '/' || rest || ': denied'
  else 'unable to access ' || replace(url, 'secret-' || cast(page_id as varchar), '***') || ': denied' end as line,
  case page_id % 6
  when 5 then 'see http://x/ then https://***:***@' || host || '/' || rest || '.git'
  when 2 then 'see http://x/ then ssh://***:***@' || host || '/' || rest
  else 'see http://x/ then ' || url end as every_url
from urls"""
)
def mask_log_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Log lines with a row's own secret and the login of its address hidden."""
    secret = F.concat(F.lit("secret-"), F.col("page_id").cast("string"))
    line = F.concat(F.lit("unable to access "), "url", F.lit(": denied"))
    two = F.concat(F.lit("see http://x/ then "), "url")
    return virtual.page_urls(spark, folder).select(
        "page_id",
        masking.mask_log_line(line, [secret]).alias("line"),
        masking.mask_every_url(two).alias("every_url"),
    )
