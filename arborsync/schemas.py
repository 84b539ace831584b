"""Schemas of the tables the engine reads and writes."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _table(*fields: tuple) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields])


STRING = StringType()
LONG = LongType()

SOURCES = _table(
    ("repo_id", STRING), ("repo_url", STRING), ("branch", STRING),
    ("subdir", STRING), ("extensions", STRING),
)
REFS = _table(("repo_id", STRING), ("name", STRING), ("kind", STRING), ("sha", STRING))
COMMITS = _table(
    ("repo_id", STRING), ("sha", STRING), ("parents", ArrayType(STRING)),
    ("ts", TimestampType()), ("author", STRING), ("message", STRING),
)
TREE_ENTRIES = _table(
    ("repo_id", STRING), ("commit_sha", STRING), ("path", STRING),
    ("mode", STRING), ("blob_sha", STRING), ("size", LONG),
)
# Folders by their content: each entry of each folder, and the top folder of each snapshot.
FOLDER_ENTRIES = _table(
    ("folder_id", STRING), ("name", STRING), ("kind", STRING), ("child_id", STRING), ("mode", STRING), ("size", LONG),
)
SNAPSHOT_ROOTS = _table(("repo_id", STRING), ("commit_sha", STRING), ("tree_id", STRING), ("files", LONG))
# Files by the positions from and up to which they hold; segment and bucket are folders.
OPENED_ROWS = _table(
    ("repo_id", STRING), ("path", STRING), ("mode", STRING), ("blob_sha", STRING), ("size", LONG), ("valid_from", LONG),
    ("segment", LONG), ("bucket", IntegerType()),
)
CLOSED_ROWS = _table(
    ("repo_id", STRING), ("path", STRING), ("valid_from", LONG), ("valid_to", LONG), ("segment", LONG), ("bucket", IntegerType()),
)
# The commit graph as chains: places, links that change chain, and how long chains were after each ingest.
CHAIN_INDEX = _table(("repo_id", STRING), ("sha", STRING), ("chain", STRING), ("pos", LONG))
CHAIN_LINKS = _table(
    ("repo_id", STRING), ("chain", STRING), ("pos", LONG), ("block", LONG), ("to_chain", STRING), ("to_pos", LONG),
)
CHAIN_TAILS = _table(("repo_id", STRING), ("chain", STRING), ("pos", LONG))
BLOBS = _table(("blob_sha", STRING), ("content", BinaryType()), ("read_error", STRING))
DOCUMENTS_OUT = _table(
    ("config_hash", STRING), ("sync_id", LONG), ("title", STRING), ("content", STRING),
    ("source_url", STRING), ("description", STRING),
)
SYNC_STATE = _table(("config_hash", STRING), ("sync_id", LONG), ("head_sha", STRING))
# What later syncs read of the attempts and deletes of earlier ones.
ATTEMPTS = _table(("config_hash", STRING), ("sync_id", LONG), ("path", STRING), ("outcome", STRING))
DELETES = _table(("config_hash", STRING), ("sync_id", LONG), ("path", STRING))
FAILED_PATHS = _table(
    ("config_hash", STRING), ("sync_id", LONG), ("path", STRING), ("reason", STRING),
)

# An exported row of a listing.
FILE_INFO_JSON = _table(("path", STRING), ("name", STRING), ("size", LONG), ("type", STRING))

# The exported change set: four lists, a rename being an [old, new] pair.
CHANGESET_JSON = StructType(
    [
        StructField("added", ArrayType(STRING)),
        StructField("modified", ArrayType(STRING)),
        StructField("deleted", ArrayType(STRING)),
        StructField("renamed", ArrayType(ArrayType(STRING))),
    ]
)
