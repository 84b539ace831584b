"""MIME typing of paths by a small lookup table."""

from __future__ import annotations

import mimetypes

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Types that come before the standard table, the default type,
# and the application types that count as text.
FIRST_TYPES = {
    ".md": "text/markdown",
    ".markdown": "text/markdown",
    ".rst": "text/x-rst",
    ".yaml": "text/yaml",
    ".yml": "text/yaml",
    ".toml": "text/toml",
    ".json": "application/json",
    ".jsonl": "application/x-ndjson",
    ".tsx": "text/typescript-jsx",
    ".jsx": "text/javascript-jsx",
    ".vue": "text/x-vue",
    ".svelte": "text/x-svelte",
    ".astro": "text/x-astro",
    ".mdx": "text/mdx",
}
DEFAULT_TYPE = "text/plain"
TEXT_APPLICATION_TYPES = (
    "application/json",
    "application/xml",
    "application/javascript",
    "application/x-javascript",
    "application/typescript",
    "application/x-sh",
    "application/x-ndjson",
)

# The standard table without the files of the host machine, so that driver and
# executors of any machine agree.
_STANDARD = mimetypes.MimeTypes(filenames=())
STANDARD_TYPES = dict(_STANDARD.types_map[True])
COMPOUND_SUFFIXES = dict(_STANDARD.suffix_map)
ENCODING_SUFFIXES = tuple(_STANDARD.encodings_map)


def type_rows() -> list[tuple[str, str, str, int]]:
    """(lookup, extension, type, ordinal) rows; the ordinal keeps table order."""
    first = [("first", e, t) for e, t in FIRST_TYPES.items()]
    standard = [("standard", e, t) for e, t in STANDARD_TYPES.items()]
    return [(*row, i) for i, row in enumerate(first + standard)]


def _values_table(spark: SparkSession, rows: list[tuple], columns: str) -> DataFrame:
    """A table of literals; its size is known to the planner, so joins to it broadcast by themselves."""
    body = ", ".join(
        "(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in row) + ")" for row in rows
    )
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({columns})")


def type_table(spark: SparkSession) -> DataFrame:
    return _values_table(spark, type_rows(), "lookup, ext, mime_type, ordinal")


def last_suffix(path: Column) -> Column:
    """Lowered text after the last dot of the whole path, with the dot; empty without a dot."""
    return F.when(
        F.contains(path, F.lit(".")), F.concat(F.lit("."), F.lower(F.substring_index(path, ".", -1)))
    ).otherwise("")


def _split_suffix(path: Column) -> Column:
    """Suffix of the last component; dots that open a name do not start one."""
    return F.regexp_extract(path, r"(?s)\A(?:.*/)?\.*[^/.][^/]*?(\.[^/.]*)\z", 1)


def standard_suffix(path: Column) -> Column:
    """The suffix the standard table is asked for: ``.tgz`` reads as ``.tar.gz``, encodings are peeled."""
    expanded = path
    suffix = F.lower(_split_suffix(path))
    for short, long in COMPOUND_SUFFIXES.items():
        expanded = F.when(
            suffix == short,
            F.concat(F.substring(path, F.lit(1), F.length(path) - len(short)), F.lit(long)),
        ).otherwise(expanded)
    outer = _split_suffix(expanded)
    stem = F.substring(expanded, F.lit(1), F.length(expanded) - F.length(outer))
    return F.lower(F.when(outer.isin(*ENCODING_SUFFIXES), _split_suffix(stem)).otherwise(outer))


def with_mime_type(files: DataFrame, path: str = "path", name: str = "mime_type") -> DataFrame:
    """Add the MIME type of ``path``: first table, then the standard one, then the default."""
    types = type_table(files.sparkSession)
    first = types.where("lookup = 'first'").select(
        F.col("ext").alias("_first_ext"), F.col("mime_type").alias("_first_type")
    )
    standard = types.where("lookup = 'standard'").select(
        F.col("ext").alias("_std_ext"), F.col("mime_type").alias("_std_type")
    )
    keyed = files.withColumn("_first_ext", last_suffix(F.col(path))).withColumn(
        "_std_ext", standard_suffix(F.col(path))
    )
    return (
        keyed.join(first, "_first_ext", "left")
        .join(standard, "_std_ext", "left")
        .withColumn(name, F.coalesce("_first_type", "_std_type", F.lit(DEFAULT_TYPE)))
        .drop("_first_ext", "_std_ext", "_first_type", "_std_type")
    )


def is_text_type(mime_type: Column) -> Column:
    return F.startswith(mime_type, F.lit("text/")) | mime_type.isin(*TEXT_APPLICATION_TYPES)


def preferred_extensions(spark: SparkSession) -> DataFrame:
    """One extension per MIME type: the first table's entry wins, then table order."""
    return type_table(spark).groupBy("mime_type").agg(F.min_by("ext", "ordinal").alias("extension"))
