"""Path predicates and projections.

Filter settings come either as plain Python values (one source, so literals
that Parquet can prune by) or as columns (many sources joined in).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from arborsync.functions.strings import any_of, strip, strip_slashes

PARENT_STEP = ".."


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def normalize_path(path: Column) -> Column:
    """POSIX form: back slashes turned, leading slashes then leading ``./`` steps cut, once each."""
    posix = F.replace(path, F.lit("\\"), F.lit("/"))
    return F.regexp_replace(F.regexp_replace(posix, r"\A/+", ""), r"\A(?:\./)+", "")


def has_traversal(normalized: Column) -> Column:
    """True where ``..`` is a whole component; ``notes..md`` is fine."""
    return F.array_contains(F.split(normalized, "/"), PARENT_STEP)


# --- sub-directories -------------------------------------------------------


def subdir_prefix(subdir: str | Column) -> str | Column:
    """``docs/`` for `` /docs/ ``; empty when the setting selects everything."""
    if isinstance(subdir, Column):
        bare = strip_slashes(strip(F.coalesce(subdir, F.lit(""))))
        return F.when(bare == "", F.lit("")).otherwise(F.concat(bare, F.lit("/")))
    bare = (subdir or "").strip().strip("/")
    return f"{bare}/" if bare else ""


def in_subdir(path: Column, subdir: str | Column) -> Column:
    prefix = subdir_prefix(subdir)
    bare_path = F.ltrim(path, F.lit("/"))
    if isinstance(prefix, Column):
        return F.startswith(bare_path, prefix)
    if not prefix:
        return F.lit(True)
    # The first conjunct is implied by the second, but only it can reach the scan.
    prunable = F.startswith(path, F.lit(prefix)) | F.startswith(path, F.lit("/"))
    return prunable & F.startswith(bare_path, F.lit(prefix))


def relative_path(path: Column, subdir: str | Column) -> Column:
    """Path below ``subdir``; a path outside it comes back untouched."""
    prefix = subdir_prefix(subdir)
    prefix = prefix if isinstance(prefix, Column) else F.lit(prefix)
    bare_path = F.ltrim(path, F.lit("/"))
    inside = (prefix != "") & F.startswith(bare_path, prefix)
    return F.when(inside, F.substring(bare_path, F.length(prefix) + 1, F.length(bare_path))).otherwise(
        path
    )


# --- extensions ------------------------------------------------------------


def parse_extensions(setting: str | None) -> list[str]:
    """Extensions of one settings string: lowered, dotted, order and repeats kept."""
    names = (part.strip().lower() for part in (setting or "").split(","))
    return [name if name.startswith(".") else f".{name}" for name in names if name]


def extension_array(setting: Column) -> Column:
    """parse_extensions over a column of settings strings."""
    parts = F.transform(F.split(F.coalesce(setting, F.lit("")), ","), lambda p: F.lower(strip(p)))
    return F.transform(
        F.array_remove(parts, ""), lambda p: F.when(F.startswith(p, F.lit(".")), p).otherwise(F.concat(F.lit("."), p))
    )


def has_extension(path: Column, extensions: Sequence[str] | Column) -> Column:
    """Case-blind suffix test; an empty list lets everything through."""
    lowered = F.lower(path)
    if isinstance(extensions, Column):
        return (F.size(extensions) == 0) | F.exists(extensions, lambda e: F.endswith(lowered, e))
    if not extensions:
        return F.lit(True)
    dotted = [e if e.startswith(".") else f".{e}" for e in extensions]
    return any_of([F.endswith(lowered, F.lit(e.lower())) for e in dotted])


def passes_filter(
    path: Column, subdir: str | Column, extensions: Sequence[str] | Column
) -> Column:
    return in_subdir(path, subdir) & has_extension(path, extensions)


# --- exclude globs ---------------------------------------------------------

_REGEX_SPECIAL = set(r"\.^$|()[]{}*+?")


def glob_regex(pattern: str) -> str:
    """Regex body of a shell glob whose ``*`` also crosses ``/`` (no anchors)."""
    pieces: list[str] = []
    rest = pattern
    while rest:
        char, rest = rest[0], rest[1:]
        if char == "*":
            pieces.append(".*")
        elif char == "?":
            pieces.append(".")
        elif char == "[" and (end := rest.find("]", 2 if rest[:1] == "!" else 1)) > 0:
            members, rest = rest[:end], rest[end + 1 :]
            negated = members.startswith("!")
            members = members[1:] if negated else members
            safe = "".join(f"\\{c}" if c in "\\[]^&~" else c for c in members)
            pieces.append(f"[{'^' if negated else ''}{safe}]")
        else:
            pieces.append(f"\\{char}" if char in _REGEX_SPECIAL else char)
    return "".join(pieces)


def parse_patterns(setting: str | None) -> list[str]:
    return [part.strip() for part in (setting or "").split(",") if part.strip()]


def exclude_regex(pattern: str) -> str:
    """One regex for a pattern met as the whole path, as its head, tail or middle part.

    A single component that matches is such a part, so it needs no test of its own.
    """
    return rf"(?s)\A(?:.*/)?{glob_regex(pattern)}(?:/.*)?\z"


def is_excluded(path: Column, patterns: Sequence[str]) -> Column:
    return any_of([F.rlike(path, F.lit(exclude_regex(p))) for p in patterns])
