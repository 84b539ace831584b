"""Hiding of secrets in text, addresses and columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, MapType, StringType, StructType

from arborsync.functions.strings import any_of

# The mask, its form in an address, and what makes a key name sensitive.
MASK = "***"
URL_MASK = "***:***@"
TOKEN_GAP = "****"
SENSITIVE_WORDS = (
    "access_token",
    "ssh_private_key",
    "password",
    "token",
    "secret",
    "api_key",
    "private_key",
)


def mask_secrets(text: Column, secrets: Sequence[str | Column], longest_first: bool = False) -> Column:
    """Replace each secret value in turn; columns allow per-row secrets.

    Given order is kept, which can leave pieces when one secret holds another;
    ``longest_first`` avoids that for literal secrets, which then come before columns.
    operators.masking hides a whole table of secrets.
    """
    values = list(secrets)
    if longest_first:
        literals = [v for v in values if not isinstance(v, Column)]
        values = sorted(literals, key=len, reverse=True) + [v for v in values if isinstance(v, Column)]
    for value in values:
        if isinstance(value, Column):
            usable = F.coalesce(value, F.lit("")) != ""
            text = F.when(usable, F.replace(text, value, F.lit(MASK))).otherwise(text)
        elif value:
            text = F.replace(text, F.lit(value), F.lit(MASK))
    return text


def mask_url(text: Column) -> Column:
    """Hide user and password behind the first ``://`` of a text."""
    scheme_end = F.locate("://", text) + 2
    rest = F.substring(text, scheme_end + 1, F.length(text))
    authority = F.substring_index(rest, "/", 1)
    host = F.substring_index(authority, "@", -1)
    masked = F.concat(
        F.substring(text, F.lit(1), scheme_end),
        F.lit(URL_MASK),
        F.substring(rest, F.length(authority) - F.length(host) + 1, F.length(rest)),
    )
    has_login = (F.locate("://", text) > 0) & F.contains(authority, F.lit("@"))
    return F.when(has_login, masked).otherwise(text)


def mask_every_url(text: Column) -> Column:
    """mask_url for all addresses of a text; white space ends an address."""
    return F.regexp_replace(text, r"://[^/\s]*@", f"://{URL_MASK}".replace("$", r"\$"))


def mask_token(token: Column) -> Column:
    """First and last four characters; nothing of a token that short or missing."""
    shown = F.concat(F.substring(token, 1, 4), F.lit(TOKEN_GAP), F.substring(token, -4, 4))
    return F.when(F.length(token) > 8, shown).otherwise(MASK)


def mask_log_line(line: Column, secrets: Sequence[str | Column] = ()) -> Column:
    return mask_url(mask_secrets(line, secrets))


def is_sensitive_name(name: str) -> bool:
    return any(word in name.lower() for word in SENSITIVE_WORDS)


def is_sensitive_key(key: Column) -> Column:
    return any_of([F.contains(F.lower(key), F.lit(word)) for word in SENSITIVE_WORDS])


def _is_set(value: Column, kind: DataType) -> Column:
    """Whether a value is there to hide: not null, not empty, not zero, not false."""
    if isinstance(kind, StructType):
        return value.isNotNull()
    if kind.typeName() in ("array", "map"):
        return F.coalesce(F.size(value) > 0, F.lit(False))
    if kind.typeName() == "boolean":
        return F.coalesce(value, F.lit(False))
    empty = F.lit("") if kind.typeName() in ("string", "binary") else F.lit(0)
    return F.coalesce(value != empty.cast(kind), F.lit(False))


def _masked(name: str, value: Column, kind: DataType) -> Column:
    if is_sensitive_name(name):
        return _hidden(value, kind)
    if isinstance(kind, StructType):
        fields = [_masked(f.name, value[f.name], f.dataType).alias(f.name) for f in kind]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(kind, MapType) and isinstance(kind.keyType, StringType):
        held = kind.valueType
        return F.transform_values(
            value, lambda k, v: F.when(is_sensitive_key(k), _hidden(v, held)).otherwise(_inside_map(v, held)))
    return value


def _as_text(value: Column, kind: DataType) -> Column:
    """A value of any type as a string; nested ones as JSON."""
    if isinstance(kind, StringType):
        return value
    return F.to_json(value) if kind.typeName() in ("struct", "array", "map") else value.cast("string")


def _hidden(value: Column, kind: DataType) -> Column:
    """The mask for a value that is set, else the value as text."""
    return F.when(_is_set(value, kind), MASK).otherwise(_as_text(value, kind))


def _inside_map(value: Column, kind: DataType) -> Column:
    """A value under a harmless key, as text: a map holds one type, and its masked entries are strings."""
    return _as_text(_masked("", value, kind), kind)


def mask_columns(df: DataFrame) -> DataFrame:
    """Mask every sensitive column, struct field and map entry, following the schema.

    A key is tested before what it holds, so nothing under a sensitive key is shown, whatever its
    type. What is masked becomes a string; so do all values of a map with string keys, nested ones
    as JSON, since a map holds one type.
    """
    return df.select([_masked(f.name, F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema])
