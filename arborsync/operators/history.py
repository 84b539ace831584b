"""File history from commit touches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from arborsync.functions.strings import strip
from arborsync.operators.skew import lookup_join
from arborsync.sources.keyed import read_segments, rows_with_keys, write_segment
from arborsync.staging import stage

HISTORY_DEPTH = 10


def first_line(message: Column) -> Column:
    """The first line of a message, white space around the whole message apart."""
    return F.substring_index(strip(message), "\n", 1)


def touches_with_commit(touches: DataFrame, commits: DataFrame) -> DataFrame:
    """(repo_id, path, sha) touches with time, author and first message line of their commit."""
    told = commits.select(
        "repo_id", "sha", "ts", "author",
        first_line(F.col("message")).alias("message"),
    )
    # Ids differ in their first bytes, which sorts compare first; repositories do not.
    return lookup_join(touches.select("repo_id", "path", "sha"), told, ["sha", "repo_id"], "inner").select(
        "repo_id", "sha", "path", "ts", "author", "message")


_CODE_BITS = 56


def _micros(ts: Column, kind: str) -> Column:
    """Microseconds since 1970; of a time without zone by its own calendar, whatever the session's zone."""
    if kind != "timestamp_ntz":
        return F.unix_micros(ts.cast("timestamp"))
    days = F.date_diff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    within = (F.hour(ts) * 3600 + F.minute(ts) * 60).cast("bigint") * 1_000_000 + (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("bigint")
    return days * 86_400_000_000 + within


def coded_commits(commits: DataFrame) -> DataFrame:
    """``repo_id, sha, ts, author, message, code``: within a repository codes are in the order of (ts, sha).

    A code is one number of fixed width, so that a maximum of codes is hashed and combined before a shuffle:
    the time, the first bytes of the id, and a place among the few commits that agree in both.
    """
    told = commits.select("repo_id", "sha", "ts", "author", first_line(F.col("message")).alias("message"))
    digits = _CODE_BITS // 4
    head = F.conv(F.rpad(F.substring(F.hex(F.encode("sha", "UTF-8")), 1, digits), digits, "0"), 16, 10)
    time = _micros(F.col("ts"), dict(told.dtypes)["ts"]).cast("decimal(38,0)")
    rough = time * F.lit(10**17).cast("decimal(18,0)") + head.cast("decimal(17,0)")
    rough = told.withColumn("_rough", rough)
    # Hardly any agree in both, so only those few are sorted; the rest get their code where they lie.
    likeness = F.xxhash64("_rough", "repo_id").alias("_like")
    ties = rough.groupBy(likeness).agg(F.count("*").alias("_ties")).where("_ties > 1").select("_like")
    ties = stage(ties, "tied-commits")
    rough = rough.withColumn("_like", likeness)
    one = F.lit(1)
    if ties.isEmpty():
        placed = rough.withColumn("_n", one)
    else:
        alike = Window.partitionBy("_rough", "repo_id").orderBy("sha")
        tied = rough.join(ties, "_like", "left_semi").withColumn("_n", F.row_number().over(alike))
        placed = rough.join(ties, "_like", "left_anti").withColumn("_n", one).unionByName(tied)
    code = (F.col("_rough") * 1000 + F.col("_n")).cast("decimal(38,0)")
    return placed.select(*told.columns, code.alias("code"))


def _packed(sha: Column) -> Column:
    """A commit id as bytes, half as many for hexadecimal ones; different ids stay different."""
    raw = F.unhex(sha)
    is_hex = F.lower(F.hex(raw)) == sha
    return F.when(is_hex, F.concat(F.lit(bytearray(b"\x01")), raw)).otherwise(F.concat(F.lit(bytearray(b"\x00")), F.encode(sha, "UTF-8")))


def last_commit_per_file(touches: DataFrame, commits: DataFrame) -> DataFrame:
    """Newest commit touching each (repo_id, path), with time, author and first message line; equal times are told apart by commit id.

    Commits are few next to touches, so they get their codes first: the aggregate over
    the touches is then a maximum of numbers, hashed and combined before the
    shuffle, however many commits touch one file.
    """
    coded = coded_commits(commits)
    sha = _packed(F.col("sha")).alias("_sha")
    placed = lookup_join(touches.select("repo_id", "path", sha), coded.select("repo_id", sha, "code"), ["_sha", "repo_id"], "inner")
    newest = placed.groupBy("repo_id", "path").agg(F.max("code").alias("code"))
    told = lookup_join(newest, coded, ["code", "repo_id"], "inner")
    return told.select(
        "repo_id", "path", F.col("sha").alias("last_commit_sha"), F.col("ts").alias("last_commit_time"),
        F.col("author").alias("last_commit_author"), F.col("message").alias("last_commit_message"),
    )


def last_commits_schema(commits: DataFrame) -> StructType:
    """The columns of ``last_commit_per_file``."""
    told = commits.select(
        "repo_id", F.lit("").alias("path"), F.col("sha").alias("last_commit_sha"), F.col("ts").alias("last_commit_time"),
        F.col("author").alias("last_commit_author"), F.col("message").alias("last_commit_message"))
    return StructType([StructField(f.name, f.dataType, True) for f in told.schema])


def ingest_touches(touches: DataFrame, commits: DataFrame, path: str, segment: int) -> None:
    """Add the touches of new ``commits`` to the stored state: the newest of them for each file, as one segment.

    Earlier segments are not read. Each has Bloom filters of the paths that it changed, so a look at
    few files skips the blocks of commits that touched none. A repeated ingest replaces its segment.
    """
    write_segment(last_commit_per_file(touches, commits), path, "path", segment)


def stored_last_commits(spark: SparkSession, path: str, schema: StructType, wanted: DataFrame | None = None) -> DataFrame:
    """``last_commit_per_file`` over all ingested commits, of the files ``wanted`` (``repo_id, path``, all without it)."""
    state = read_segments(spark, path, schema)
    if wanted is not None:
        state = rows_with_keys(state, "path", wanted.select("path").distinct()).join(wanted, ["repo_id", "path"], "left_semi")
    best = F.max(F.struct("last_commit_time", "last_commit_sha", "last_commit_author", "last_commit_message")).alias("last")
    newest = state.groupBy("repo_id", "path").agg(best)
    return newest.select("repo_id", "path", "last.last_commit_sha", "last.last_commit_time", "last.last_commit_author", "last.last_commit_message")


def file_history(touches: DataFrame, commits: DataFrame, depth: int = HISTORY_DEPTH) -> DataFrame:
    """The newest ``depth`` commits of each file, ``n`` = 1 for the newest.

    A dense_rank filter like this keeps only the rows of ``depth`` commits per file and task before the shuffle, and
    touches told twice share a rank, so they need no shuffle of their own. Files are sorted by a hash first,
    which takes no comparison of strings; the hash decides nothing else.
    """
    newest_first = Window.partitionBy("_file", "repo_id", "path").orderBy(F.col("ts").desc(), F.col("sha").desc())
    seen = touches_with_commit(touches, commits).withColumn("_file", F.xxhash64("repo_id", "path"))
    newest = seen.withColumn("n", F.dense_rank().over(newest_first)).where(F.col("n") <= depth)
    once = newest.withColumn("_before", F.lag("n").over(newest_first))
    return once.where(F.col("_before").isNull() | (F.col("_before") != F.col("n"))).drop("_file", "_before")


def changed_since(last_commits: DataFrame, stored: DataFrame) -> DataFrame:
    """Files whose last commit is newer than the time stored for their repository.

    A repository without a stored time gives all its files.
    """
    marks = stored.select("repo_id", "stored_time")
    joined = lookup_join(last_commits, marks, ["repo_id"], "left")
    return joined.where(F.col("stored_time").isNull() | (F.col("last_commit_time") > F.col("stored_time")))
