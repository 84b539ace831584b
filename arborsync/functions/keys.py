"""Hash keys, document ids and state keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from arborsync.functions.paths import extension_array, subdir_prefix
from arborsync.functions.strings import or_default, strip, strip_slashes

# Key prefixes and formats.
HASH_CHARS = 16
DEFAULT_BRANCH = "main"
BROWSE_PREFIX = "git_browse"
SHA_PREFIX = "git_sha"
FAILED_PREFIX = "git_failed"
LEGACY_PREFIX = "git_sync"
# What a base-16 number may look like: sign, 0x and single underscores included.
HEX_NUMBER = r"\A\s*[+-]?(?:0[xX]_?)?[0-9a-fA-F]+(?:_[0-9a-fA-F]+)*\s*\z"


def _text(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def _joined(*parts: Column) -> Column:
    return F.concat_ws(":", *[_text(p) for p in parts])


def short_hash(text: Column) -> Column:
    return F.substring(F.sha2(text, 256), 1, HASH_CHARS)


def branch_or_default(branch: Column) -> Column:
    return or_default(branch, DEFAULT_BRANCH)


def canonical_extensions(setting: Column) -> Column:
    """Lowered, stripped, sorted; neither dots added nor repeats removed."""
    parts = F.transform(F.split(_text(setting), ","), lambda p: strip(F.lower(p)))
    return F.array_join(F.array_sort(F.array_remove(parts, "")), ",")


def config_hash(url: Column, branch: Column, subdir: Column, extensions: Column) -> Column:
    """Key of one source configuration, over the settings as written."""
    return short_hash(
        _joined(url, branch_or_default(branch), subdir, canonical_extensions(extensions))
    )


def source_key(url: Column, branch: Column, subdir: Column, extensions: Column) -> Column:
    """config_hash over normalised settings, so ``md``/``.md`` and ``docs``/``docs/`` agree."""
    return short_hash(
        _joined(
            strip(url),
            or_default(strip(_text(branch)), DEFAULT_BRANCH),
            strip_slashes(subdir_prefix(subdir)),
            F.array_join(F.array_sort(F.array_distinct(extension_array(extensions))), ","),
        )
    )


def storage_key(url: Column, branch: Column, subdir: Column, extensions: Column) -> Column:
    return F.concat(
        F.lit(f"{BROWSE_PREFIX}:"),
        short_hash(
            _joined(
                strip(_text(url)),
                strip(branch_or_default(branch)),
                strip_slashes(strip(_text(subdir))),
                F.lower(strip(_text(extensions))),
            )
        ),
    )


def storage_key_prefix(key: Column) -> Column:
    return F.when(F.contains(key, F.lit(":")), F.substring_index(key, ":", 1)).otherwise("")


def storage_key_hash(key: Column) -> Column:
    """All after the first colon, or the whole key without one."""
    return F.substring(key, F.locate(":", key) + 1, F.length(key))


def is_storage_key(key: Column) -> Column:
    digits = storage_key_hash(key)
    return F.coalesce(
        F.startswith(key, F.lit(f"{BROWSE_PREFIX}:"))
        & ~F.contains(digits, F.lit(":"))
        & (F.length(digits) == HASH_CHARS)
        & F.rlike(digits, F.lit(HEX_NUMBER)),
        F.lit(False),
    )


def source_url(key: Column, normalized_path: Column) -> Column:
    return F.concat(F.lit("git:"), key, F.lit(":"), normalized_path)


def sha_state_key(key: Column) -> Column:
    return F.concat(F.lit(f"{SHA_PREFIX}:"), key)


def failed_state_key(key: Column) -> Column:
    return F.concat(F.lit(f"{FAILED_PREFIX}:"), key)


def legacy_state_key(url: Column, branch: Column) -> Column:
    return F.concat(F.lit(f"{LEGACY_PREFIX}:"), short_hash(_joined(url, branch)))


def item_id(repo_hash: Column, ref: Column, path: Column) -> Column:
    """Document id that holds across commits."""
    return F.concat_ws("::", repo_hash, ref, path)


def stable_file_id(url: Column, ref: Column, path: Column) -> Column:
    return F.sha2(_joined(url, ref, path), 256)
