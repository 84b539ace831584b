"""String helpers shared by the other column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters the host language treats as white space. Spark's
# trim() takes only the space character.
WHITE_SPACE = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def strip(text: Column) -> Column:
    """Remove leading and trailing white space of any kind."""
    head_cut = F.regexp_replace(text, rf"\A{WHITE_SPACE}+", "")
    return F.regexp_replace(head_cut, rf"{WHITE_SPACE}+\z", "")


def strip_slashes(text: Column) -> Column:
    return F.trim(text, F.lit("/"))


def or_default(text: Column, default: str) -> Column:
    """``default`` for null and for the empty string."""
    return F.when(F.coalesce(text, F.lit("")) == "", F.lit(default)).otherwise(text)


def any_of(conditions: list[Column]) -> Column:
    result = F.lit(False)
    for condition in conditions:
        result = result | condition
    return result
