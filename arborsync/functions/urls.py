"""Repository address checks and projections."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from arborsync.functions.strings import any_of, strip

# Accepted address shapes and the messages for the others.
URL_SHAPES = (
    r"\Ahttps?://[a-zA-Z0-9.-]+(?::\p{Nd}+)?/[a-zA-Z0-9._/-]+(?:\.git)?\z",
    r"\Agit@[a-zA-Z0-9.-]+:[a-zA-Z0-9._/-]+(?:\.git)?\z",
    r"\Assh://(?:[a-zA-Z0-9._-]+@)?[a-zA-Z0-9.-]+(?::\p{Nd}+)?/[a-zA-Z0-9._/-]+(?:\.git)?\z",
    r"\A(?:file://)?/[a-zA-Z0-9._/-]+\z",
)
URL_REQUIRED = "Repository URL is required"
GIT_PROTOCOL = "git:// protocol is not supported. Use https:// or git@host:user/repo.git"
BAD_SSH = "Invalid SSH URL format. Use git@host:user/repo.git"
BAD_URL = (
    "Invalid repository URL format. Supported formats:\n"
    "- HTTPS: https://github.com/user/repo.git\n"
    "- SSH: git@github.com:user/repo.git\n"
    "- SSH URL: ssh://git@github.com/user/repo.git\n"
    "- Local: /path/to/repo or file:///path/to/repo"
)
UNKNOWN = "unknown"


def _is_missing(url: Column) -> Column:
    return F.coalesce(url, F.lit("")) == ""


def url_error(url: Column) -> Column:
    """Empty for an accepted address, else the message for its owner."""
    bare = strip(url)
    accepted = any_of([F.rlike(bare, F.lit(shape)) for shape in URL_SHAPES])
    host_only = (
        F.contains(bare, F.lit("@"))
        & ~F.contains(bare, F.lit("://"))
        & ~F.contains(F.split_part(bare, F.lit("@"), F.lit(2)), F.lit(":"))
    )
    return (
        F.when(_is_missing(url), URL_REQUIRED)
        .when(accepted, "")
        .when(F.startswith(bare, F.lit("git://")), GIT_PROTOCOL)
        .when(host_only, BAD_SSH)
        .otherwise(BAD_URL)
    )


def _starts_with_any(text: Column, *prefixes: str) -> Column:
    return any_of([F.startswith(text, F.lit(p)) for p in prefixes])


def url_type(url: Column) -> Column:
    bare = strip(url)
    return (
        F.when(_is_missing(url), UNKNOWN)
        .when(_starts_with_any(bare, "https://", "http://"), "https")
        .when(_starts_with_any(bare, "git@", "ssh://"), "ssh")
        .when(_starts_with_any(bare, "/", "file://"), "local")
        .otherwise(UNKNOWN)
    )


def requires_clone(url: Column) -> Column:
    """False for local paths, null where the address is of no known type."""
    kind = url_type(url)
    return F.when(kind != UNKNOWN, kind != "local")


def clone_location(url: Column) -> Column:
    """The address to read from; a local one without its scheme."""
    return F.when(url_type(url) == "local", F.replace(url, F.lit("file://"), F.lit(""))).otherwise(url)


def repo_name(url: Column) -> Column:
    bare = F.regexp_replace(strip(url), r"\.git\z", "")
    last = F.when(F.contains(bare, F.lit("/")), F.substring_index(bare, "/", -1)).otherwise(
        F.substring_index(bare, ":", -1)
    )
    return F.when(_is_missing(url), UNKNOWN).otherwise(last)
