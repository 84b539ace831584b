"""A versioned repository derived from the test tables, for queries, tests and the bench.

Rules (they are also written out in the oracle SQL):
files      documents, path = source/lang/doc_<id><ext>, ext by doc_id % 6
snapshots  old: slot <> 0; new: slot <> 1, with slot 2 edited and slot 3 moved below
           moved/; slot = doc_id % 10, in the planted repository doc_id / 20 % 10, as
           a document's source follows doc_id % 20
planted    content by doc_id % 9: 0 PNG head, 1 early NUL, 2 late NUL, 3 bad byte,
           4 blob missing, 5 read error, 6 text starting MZ, else plain
           symbolic link where doc_id % 11 = 4
commits    orders, one repository per customer; touches from lineitem
sources    one per distinct document source (crawl), or one per page (key jobs)
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arborsync.functions.paths import passes_filter
from arborsync.operators import graph, history, intervals
from arborsync.operators.content import read_outcomes
from arborsync.operators.merkle import read_roots, store_snapshots
from arborsync.operators.refs import HEADS, REMOTES, TAGS
from arborsync.plans.crawl import Repository, with_config
from arborsync.schemas import BLOBS, FOLDER_ENTRIES
from arborsync.session import new_work_path
from arborsync.sources.keyed import append_new, read_segments
from arborsync.sources.tables import read_table
from arborsync.staging import stage

# Fixed values of the derived repository.
EXTENSIONS = (".md", ".TXT", ".py", ".json", ".tar.gz", "")
CORPUS = "corpus"
OLD, NEW = "old", "new"
FILE_MODE, LINK_MODE = "100644", "120000"


_written: dict[tuple[str, str, str], DataFrame] = {}
_paths: dict[tuple[str, str, str], str] = {}


def stored(spark: SparkSession, folder: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A table that a real engine would find stored: derived and written once per application and folder."""
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _written:
        _written[key] = stage(build(), name)
    return _written[key]


def stored_path(spark: SparkSession, folder: str, name: str, write: Callable[[str], None]) -> str:
    """Like ``stored`` for a table with a layout of its own, which ``write`` writes below a path."""
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _paths:
        path = new_work_path(spark, name)
        write(path)
        _paths[key] = path
    return _paths[key]


def _pick(key: Column, values: tuple) -> Column:
    """values[key % n]; None stands for null."""
    chosen = F.lit(values[-1])
    for place, value in reversed(list(enumerate(values[:-1]))):
        chosen = F.when(key % len(values) == place, F.lit(value)).otherwise(chosen)
    return chosen


def files(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, source, section, path, text``; a section is a source and a language."""
    doc = F.col("doc_id")
    name = F.concat(F.lit("doc_"), doc.cast("string"), _pick(doc, EXTENSIONS))
    return read_table(spark, folder, "documents").select(
        "doc_id", "source", F.concat_ws("-", "source", "lang").alias("section"),
        F.concat_ws("/", "source", "lang", name).alias("path"), "text",
    )


def commit_sha(repo: Column, version: str) -> Column:
    return F.sha1(F.concat(repo, F.lit(f":{version}")))


def _slot(planted: bool) -> Column:
    return F.floor(F.col("doc_id") / 20) % 10 if planted else F.col("doc_id") % 10


def _versions(docs: DataFrame, version: str, planted: bool) -> DataFrame:
    """The files of one snapshot, with their path and text in it."""
    tens = _slot(planted)
    if version == OLD:
        return docs.where(tens != 0)
    path = F.when(tens == 3, F.concat(F.lit("moved/"), "path")).otherwise(F.col("path"))
    text = F.when(tens == 2, F.concat("text", F.lit(" v2"))).otherwise(F.col("text"))
    return docs.where(tens != 1).withColumn("path", path).withColumn("text", text)


def texts(spark: SparkSession, folder: str, version: str, planted: bool = False) -> DataFrame:
    """``doc_id, source, section, path, text`` of one snapshot."""
    return _versions(files(spark, folder), version, planted)


def _tree_rows(docs: DataFrame, version: str, repo: Column, planted: bool) -> DataFrame:
    doc = F.col("doc_id")
    content = planted_content(F.col("text"), doc) if planted else F.encode("text", "UTF-8")
    link = F.when(doc % 11 == 4, LINK_MODE).otherwise(FILE_MODE) if planted else F.lit(FILE_MODE)
    rows = _versions(docs, version, planted).select("doc_id", "path", repo.alias("repo_id"), content.alias("content"))
    return rows.select(
        "repo_id",
        commit_sha(F.col("repo_id"), version).alias("commit_sha"),
        "path",
        link.alias("mode"),
        (_planted_sha() if planted else F.sha2("content", 256)).alias("blob_sha"),
        F.coalesce(F.octet_length("content"), F.lit(0)).cast("bigint").alias("size"),
        "doc_id",
    )


def snapshot_pair(
    spark: SparkSession, folder: str, repo: str | None = None, planted: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(old, new) tree rows: one repository, or one per value of the column ``repo``."""
    name = F.col(repo) if repo else F.lit(CORPUS)
    docs = files(spark, folder)
    return _tree_rows(docs, OLD, name, planted), _tree_rows(docs, NEW, name, planted)


def tree(spark: SparkSession, folder: str, repo: str | None = None, planted: bool = False) -> DataFrame:
    """Tree rows of both snapshots."""
    old, new = snapshot_pair(spark, folder, repo, planted)
    return old.unionByName(new)


def folder_store(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(entries, roots) of both snapshots of every source, stored in two ingests."""
    path = stored_path(spark, folder, "folders", lambda path: _store_folders(spark, folder, path))
    return read_segments(spark, f"{path}/entries", FOLDER_ENTRIES), read_roots(spark, path)


def _store_folders(spark: SparkSession, folder: str, path: str) -> None:
    for segment, snapshot in enumerate(snapshot_pair(spark, folder, "source")):
        store_snapshots(snapshot.drop("doc_id"), path, segment)


def interval_store(spark: SparkSession, folder: str) -> tuple[str, DataFrame]:
    """(store, positions) of every source's snapshots: the old one at 1, the new one at 2, the old one again at 3."""
    repos = stored(spark, folder, "repositories", lambda: read_table(spark, folder, "documents").select(F.col("source").alias("repo_id")).distinct())
    at = lambda position: repos.withColumn("position", F.lit(position).cast("bigint"))

    def write(path: str) -> None:
        old, new = snapshot_pair(spark, folder, "source")
        for position, rows in enumerate((old, new, old), 1):
            intervals.ingest_snapshots(rows, at(position), path, position)

    path = stored_path(spark, folder, "intervals", write)
    return path, stored(spark, folder, "positions", lambda: at(1).unionByName(at(2)).unionByName(at(3)))


def text_blobs(spark: SparkSession, folder: str) -> DataFrame:
    """``blob_sha, content, read_error, segment`` of the plain texts in both snapshots, the new one's stored in a later ingest."""
    def write(path: str) -> None:
        docs = files(spark, folder)
        for segment, version in enumerate((OLD, NEW)):
            rows = _versions(docs, version, False).select(F.encode("text", "UTF-8").alias("content"))
            told = rows.select(F.sha2("content", 256).alias("blob_sha"), "content", F.lit(None).cast("string").alias("read_error"))
            append_new(told, path, "blob_sha", segment, once=True)

    return read_segments(spark, stored_path(spark, folder, "text-blobs", write), BLOBS)


# --- planted content ---------------------------------------------------------


def planted_content(text: Column, doc: Column) -> Column:
    """Bytes of a file; null where the blob is missing or cannot be read."""
    raw = F.encode(text, "UTF-8")
    size = F.octet_length(text)
    nul = F.lit(bytearray(b"\x00"))
    kind = doc % 9
    padding = F.encode(F.repeat(F.lit(" "), F.greatest(F.lit(0), F.lit(8192) - size)), "UTF-8")
    return (
        F.when(kind == 0, F.concat(F.lit(bytearray(b"\x89PNG\r\n\x1a\n")), raw))
        .when(kind == 1, F.concat(F.encode(F.substring(text, 1, 10), "UTF-8"), nul, F.encode(F.substring(text, F.lit(11), size), "UTF-8")))
        .when(kind == 2, F.concat(raw, padding, nul, F.lit(bytearray(b"tail"))))
        .when(kind == 3, F.concat(raw, F.lit(bytearray(b"\xff"))))
        .when(kind.isin(4, 5), F.lit(None).cast("binary"))
        .when(kind == 6, F.concat(F.lit(bytearray(b"MZ")), raw))
        .otherwise(raw)
    )


def _planted_sha() -> Column:
    """Blob id from a row's ``content`` and ``doc_id``; what cannot be read has an id of its own."""
    unread = F.sha2(F.concat(F.lit("unread:"), F.col("doc_id").cast("string")), 256)
    return F.coalesce(F.sha2("content", 256), unread)


def planted_blobs(spark: SparkSession, folder: str) -> DataFrame:
    """``blob_sha, content, read_error, segment``, one row per blob; missing ones have none. The edited texts of the
    new snapshot came in a later ingest."""
    def write(path: str) -> None:
        docs = files(spark, folder)
        doc = F.col("doc_id")
        edited = _versions(docs, NEW, True).where(_slot(True) == 2)
        for segment, held in enumerate((docs, edited)):
            rows = held.where(doc % 9 != 4).select("doc_id", planted_content(F.col("text"), doc).alias("content"))
            told = rows.select(_planted_sha().alias("blob_sha"), "content", F.when(doc % 9 == 5, "Input/output error").alias("read_error"))
            append_new(told, path, "blob_sha", segment, once=True)

    return read_segments(spark, stored_path(spark, folder, "planted-blobs", write), BLOBS)


# --- sources -----------------------------------------------------------------


def page_sources(spark: SparkSession, folder: str) -> DataFrame:
    """One source row per page: settings in all the spellings users type."""
    page = F.col("page_id")
    return read_table(spark, folder, "pages").select(
        "page_id",
        F.col("page_id").cast("string").alias("repo_id"),
        F.col("url").alias("repo_url"),
        _pick(page, (None, "main", "dev")).alias("branch"),
        _pick(page, ("", "docs", "docs/", "/")).alias("subdir"),
        _pick(page, ("", ".md", "MD,.txt", " .txt , md ", ".md,,")).alias("extensions"),
    )


def page_urls(spark: SparkSession, folder: str) -> DataFrame:
    """``page_id, url``: page addresses rewritten to every kind of repository address by page_id % 6.

    0 as it is, 1 git@, 2 ssh://, 3 local path, 4 git://, 5 with login; page_id % 12 = 10
    is an ssh address without its path.
    """
    page = F.col("page_id")
    host = F.regexp_extract("url", "^https?://([^/]+)", 1)
    rest = F.regexp_extract("url", "^https?://[^/]+/([^?#]*)", 1)
    variant = (
        F.when(page % 12 == 10, F.concat(F.lit("git@"), host))
        .when(page % 6 == 0, F.col("url"))
        .when(page % 6 == 1, F.concat(F.lit(" git@"), host, F.lit(":"), rest, F.lit(".git")))
        .when(page % 6 == 2, F.concat(F.lit("ssh://git@"), host, F.lit("/"), rest))
        .when(page % 6 == 3, F.concat(F.lit("/srv/git/"), rest))
        .when(page % 6 == 4, F.concat(F.lit("git://"), host, F.lit("/"), rest))
        .otherwise(F.concat(
            F.lit("https://token:secret-"), page.cast("string"), F.lit("@"), host, F.lit("/"), rest, F.lit(".git")
        ))
    )
    return read_table(spark, folder, "pages").select("page_id", variant.alias("url"))


def crawl_sources(spark: SparkSession, folder: str) -> DataFrame:
    """One source per distinct document source, with its number ``n``."""
    names = read_table(spark, folder, "documents").select(F.col("source").alias("repo_id")).distinct()
    n = F.regexp_extract("repo_id", r"([0-9]+)\z", 1).cast("int")
    repo = F.col("repo_id")
    subdir = (
        F.when(n % 5 == 0, F.lit(""))
        .when(n % 5 == 1, F.concat(repo, F.lit("/en")))
        .when(n % 5 == 2, F.lit("/"))
        .when(n % 5 == 3, F.lit("moved/"))
        .otherwise(F.concat(F.lit("/"), repo, F.lit("/")))
    )
    return names.select(
        "repo_id",
        F.concat(F.lit("https://git.example.com/corpus/"), repo, F.lit(".git")).alias("repo_url"),
        _pick(n, (None, "main", "dev")).alias("branch"),
        subdir.alias("subdir"),
        _pick(n, ("", ".md,txt,.PY", " .json , md ")).alias("extensions"),
        n.alias("n"),
    )


def crawl_repository(spark: SparkSession, folder: str) -> Repository:
    """All tables of a crawl. Stored state by n % 4: none, in step, one commit behind, unknown commit."""
    sources = stored(spark, folder, "sources", lambda: crawl_sources(spark, folder))
    stored_tree = stored(spark, folder, "tree", lambda: tree(spark, folder, repo="source", planted=True).drop("doc_id"))
    repo = F.col("repo_id")
    branch = F.when(F.col("n") % 3 == 2, "dev").otherwise("main")
    refs = sources.select(
        "repo_id",
        F.concat(F.when(F.col("n") % 2 == 0, F.lit(REMOTES)).otherwise(HEADS), branch).alias("name"),
        F.lit("branch").alias("kind"),
        commit_sha(repo, NEW).alias("sha"),
    )
    no_parent = F.array().cast("array<string>")
    first = sources.select("repo_id", commit_sha(repo, OLD).alias("sha"), no_parent.alias("parents"))
    second = sources.select(
        "repo_id", commit_sha(repo, NEW).alias("sha"), F.array(commit_sha(repo, OLD)).alias("parents")
    )
    configured = with_config(sources)
    last = (
        F.when(F.col("n") % 4 == 1, commit_sha(repo, NEW))
        .when(F.col("n") % 4 == 2, commit_sha(repo, OLD))
        .when(F.col("n") % 4 == 3, F.sha1(F.lit("elsewhere")))
    )
    sync_id = F.lit(1).cast("bigint")
    state = configured.select("config_hash", sync_id.alias("sync_id"), last.alias("head_sha")).where(
        "head_sha IS NOT NULL"
    )
    # Failed before: files that still cannot be read and files that now can.
    failing = configured.where((F.col("n") % 8 == 1) | (F.col("n") % 4 == 2)).select("config_hash", "repo_id")
    old_files = _versions(files(spark, folder), OLD, True).where((F.col("doc_id") % 9).isin(5, 7))
    failed = old_files.join(failing, F.col("source") == F.col("repo_id")).select(
        "config_hash", sync_id.alias("sync_id"), "path", F.lit("read_error").alias("reason")
    )
    # Written by earlier syncs: sync 0 read the old snapshot, sync 1 deleted some of its files again;
    # a file outside any snapshot was read, deleted and read once more. Some files that are binary or not
    # UTF-8 now were read as text then (doc_id % 13 = 5), and settings used before left a document too.
    stated = configured.where(F.col("n") % 4 != 0)
    old_tree = stored_tree.where((F.col("commit_sha") == commit_sha(F.col("repo_id"), OLD)) & (F.col("mode") != LINK_MODE))
    listed = old_tree.join(stated.select("repo_id", "config_hash", "subdir", "extension_list"), "repo_id").where(
        passes_filter(F.col("path"), F.col("subdir"), F.col("extension_list"))
    )
    doc = F.regexp_extract("path", "doc_([0-9]+)", 1).cast("bigint")
    read = read_outcomes(listed, planted_blobs(spark, folder)).select("config_hash", "path", "outcome", doc.alias("doc"))
    extra = stated.select("config_hash", F.concat(F.lit("never/listed_"), F.col("n").cast("string"), F.lit(".md")).alias("path"))
    zero = F.lit(0).cast("bigint")
    as_text = (F.col("doc") % 13 == 5) & F.col("outcome").isin("binary", "non_utf8")
    earlier = F.when(as_text, "ok").otherwise(F.col("outcome")).alias("outcome")
    abandoned = stated.select(
        F.concat(F.lit("old-"), "config_hash").alias("config_hash"), zero.alias("sync_id"),
        F.concat(F.lit("docs/left_"), F.col("n").cast("string"), F.lit(".md")).alias("path"), F.lit("ok").alias("outcome"))
    attempts = read.select("config_hash", zero.alias("sync_id"), "path", earlier).unionByName(abandoned).unionByName(
        extra.select("config_hash", F.explode(F.array(zero, zero + 2)).alias("sync_id"), "path", F.lit("ok").alias("outcome"))
    )
    deletes = read.where("doc % 7 = 3").select("config_hash", sync_id.alias("sync_id"), "path").unionByName(
        extra.select("config_hash", sync_id.alias("sync_id"), "path")
    )
    return Repository(
        attempts=stored(spark, folder, "attempts", lambda: attempts),
        deletes=stored(spark, folder, "deletes", lambda: deletes),
        sources=sources,
        refs=refs,
        commits=first.unionByName(second),
        tree=stored_tree,
        blobs=planted_blobs(spark, folder),
        sync_state=state,
        failed_paths=failed,
    )


def tree_entries(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(entries, roots): the new snapshot as nested folders, a folder's id being a hash of its path."""
    _, new = snapshot_pair(spark, folder)
    steps = new.withColumn("parts", F.split("path", "/")).select(
        "blob_sha", "size", "parts", F.posexplode("parts").alias("level", "name")
    )
    is_file = F.col("level") == F.size("parts") - 1

    def folder_id(levels: Column) -> Column:
        return F.sha1(F.array_join(F.slice("parts", F.lit(1), levels), "/"))

    entries = steps.select(
        folder_id(F.col("level")).alias("parent_id"),
        "name",
        F.when(is_file, "blob").otherwise("tree").alias("kind"),
        F.when(is_file, F.col("blob_sha")).otherwise(folder_id(F.col("level") + 1)).alias("child_id"),
        F.when(is_file, F.col("size")).alias("size"),
    ).distinct()
    roots = entries.where(F.col("parent_id") == F.sha1(F.lit(""))).select(
        F.lit(CORPUS).alias("repo_id"), F.col("parent_id").alias("tree_id")
    ).distinct()
    return entries, roots


# --- commits and touches -------------------------------------------------------


def order_sha(key: Column) -> Column:
    return F.sha1(F.concat(F.lit("order:"), key.cast("string")))


def order_message(key: Column) -> Column:
    """Two lines; every third message starts with white space and blank lines."""
    head = F.when(key % 3 == 0, F.lit("\n \t\n ")).otherwise(F.lit(""))
    return F.concat(head, F.lit("order "), key.cast("string"), F.lit("\nstatus "), "o_orderstatus")


def _order_chain(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with the one and two orders before them of the same customer."""
    history = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return read_table(spark, folder, "orders").select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_orderpriority", "o_orderstatus",
        F.lag("o_orderkey", 1).over(history).alias("before"),
        F.lag("o_orderkey", 2).over(history).alias("before_that"),
        F.row_number().over(Window.partitionBy("o_custkey").orderBy(
            F.col("o_orderdate").desc(), F.col("o_orderkey").desc()
        )).cast("bigint").alias("age"),
    )


def commits(spark: SparkSession, folder: str, forked: bool = False) -> DataFrame:
    """Commits of all customers' repositories, ``age`` 1 for the newest.

    Straight history: the order before is the parent, the one before that a second
    parent where o_orderkey % 7 = 0. ``forked`` makes o_orderkey % 5 = 1 start from
    two orders before instead, which leaves side branches that a later % 7 merge
    may or may not pick up.
    """
    key = F.col("o_orderkey")
    before, before_that = order_sha(F.col("before")), order_sha(F.col("before_that"))
    merge = (key % 7 == 0) & F.col("before_that").isNotNull()
    side = (key % 5 == 1) & F.col("before_that").isNotNull() & F.lit(forked)
    parents = (
        F.when(F.col("before").isNull(), F.array().cast("array<string>"))
        .when(side & merge, F.array(before_that, before))
        .when(side, F.array(before_that))
        .when(merge, F.array(before, before_that))
        .otherwise(F.array(before))
    )
    rows = _order_chain(spark, folder).select(
        F.col("o_custkey").cast("string").alias("repo_id"),
        order_sha(key).alias("sha"),
        parents.alias("parents"),
        F.col("o_orderdate").alias("ts"),
        F.col("o_orderpriority").alias("author"),
        order_message(key).alias("message"),
        "age",
    )
    return stored(spark, folder, "forked-commits" if forked else "commits", lambda: rows)


def commit_index(spark: SparkSession, folder: str, forked: bool = False) -> graph.CommitIndex:
    """The stored index of ``commits``: the newest three of each repository came in a later ingest than the rest."""
    def write(path: str) -> None:
        rows = commits(spark, folder, forked)
        for segment, part in enumerate((rows.where("age > 3"), rows.where("age <= 3"))):
            graph.ingest_commits(part, path, segment)

    return graph.read_index(spark, stored_path(spark, folder, "forked-index" if forked else "commit-index", write))


def touches(spark: SparkSession, folder: str) -> DataFrame:
    """(repo_id, path, sha): one repository in which commit l_orderkey touches file l_partkey."""
    return _touches(read_table(spark, folder, "lineitem"))


def _touches(lines: DataFrame) -> DataFrame:
    return lines.select(
        F.lit(CORPUS).alias("repo_id"),
        F.concat(F.lit("parts/"), F.col("l_partkey").cast("string"), F.lit(".md")).alias("path"),
        order_sha(F.col("l_orderkey")).alias("sha"),
    )


def touch_commits(spark: SparkSession, folder: str) -> DataFrame:
    """The commits of touches(): every order, in the one repository."""
    key = F.col("o_orderkey")
    return read_table(spark, folder, "orders").select(
        F.lit(CORPUS).alias("repo_id"), order_sha(key).alias("sha"), F.col("o_orderdate").alias("ts"),
        F.col("o_orderpriority").alias("author"),
        order_message(key).alias("message"),
    )


def supplier_repo(key: Column) -> Column:
    return F.concat(F.lit("supplier-"), key.cast("string"))


def supplier_commits(spark: SparkSession, folder: str) -> DataFrame:
    """The commits of each supplier's repository: the orders with one of its lines. Joined and stored by their short keys."""
    def build() -> DataFrame:
        lines = read_table(spark, folder, "lineitem").select("l_suppkey", F.col("l_orderkey").alias("o_orderkey")).distinct()
        orders = read_table(spark, folder, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority", "o_orderstatus")
        return lines.join(orders, "o_orderkey")

    key = F.col("o_orderkey")
    return stored(spark, folder, "supplier-commits", build).select(
        supplier_repo(F.col("l_suppkey")).alias("repo_id"), order_sha(key).alias("sha"), F.col("o_orderdate").alias("ts"),
        F.col("o_orderpriority").alias("author"), order_message(key).alias("message"),
    )


def last_commits(spark: SparkSession, folder: str, wanted: DataFrame | None = None) -> DataFrame:
    """The newest commit of each touched file, from a state that took in the commits in five parts, by month."""
    commits_of = touch_commits(spark, folder)
    schema = history.last_commits_schema(commits_of)

    def write(path: str) -> None:
        # An ingest brings the touches of its own commits, not those of all others too.
        month = read_table(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"), (F.month("o_orderdate") % 5).alias("part"))
        lines = read_table(spark, folder, "lineitem").select("l_orderkey", "l_partkey")
        of_part = stage(lines.join(month, "l_orderkey"), "touches-by-month")
        for segment in range(5):
            touched = _touches(of_part.where(F.col("part") == segment))
            history.ingest_touches(touched, commits_of.where(F.month("ts") % 5 == segment), path, segment)

    return history.stored_last_commits(spark, stored_path(spark, folder, "last-commits", write), schema, wanted)


def chain_states(spark: SparkSession, folder: str, graph: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sources, state) of the customers' repositories.

    State by o_custkey % 4: none, in step, third-newest commit, unknown commit;
    n_failed is 2 where o_custkey % 8 = 1.
    """
    heads = graph.where("age = 1").select("repo_id", F.col("sha").alias("head_sha"))
    sources = heads.withColumn("config_hash", F.concat(F.lit("cfg-"), "repo_id"))
    customer = F.col("repo_id").cast("bigint")
    third = graph.where("age = 3").select("repo_id", F.col("sha").alias("third_sha"))
    last = (
        F.when(customer % 4 == 1, F.col("head_sha"))
        .when(customer % 4 == 2, F.col("third_sha"))
        .when(customer % 4 == 3, F.sha1(F.concat(F.lit("gone:"), "repo_id")))
    )
    state = sources.join(third, "repo_id", "left").select(
        "config_hash", last.alias("last_sha"),
        F.when(customer % 8 == 1, 2).otherwise(0).cast("bigint").alias("n_failed"),
    )
    return sources, state


def customer_refs(graph: DataFrame) -> DataFrame:
    """Refs of the customers' repositories.

    A remote main at the newest commit unless the customer key is a multiple of 3,
    a local main at the second newest, a tag at the third newest, and for even keys a
    HEAD at the fourth newest.
    """
    customer = F.col("repo_id").cast("bigint")

    def ref(age: int, prefix: str, name: str, kind: str) -> DataFrame:
        return graph.where(F.col("age") == age).select(
            "repo_id", F.lit(prefix + name).alias("name"), F.lit(kind).alias("kind"), "sha"
        )

    remote = ref(1, REMOTES, "main", "remote").where(customer % 3 != 0)
    detached = ref(4, "", "HEAD", "head").where(customer % 2 == 0)
    return remote.unionByName(ref(2, HEADS, "main", "branch")).unionByName(ref(3, TAGS, "v1", "tag")).unionByName(detached)
