"""A shared folder as a data source of its own: ``spark.read.format("directory")``, and as a stream of a manifest.

``path, mode, size, content, read_error`` of every file below the option ``path``, dot-files included. The batch reader
has a partition for each entry of the top folder (or of the folder that a filter on ``path`` leaves); files are read
by the tasks that walk to them. With the option ``manifest``, a text file of one path a line, the files are
those it names, cut by byte ranges; read as a stream, each micro-batch takes the lines added since the last.
"""

from __future__ import annotations

import os
import stat
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    EqualTo,
    Filter,
    InputPartition,
    StringStartsWith,
)
from pyspark.sql.types import StructType

from arborsync.functions.content import SYMLINK_MODE
from arborsync.sources.directory import CONTENT_COLUMNS, SKIPPED_FOLDER, UNREADABLE_MODE

MANIFEST_BYTES = 1 << 20
PUSHDOWN_CONF = "spark.sql.python.filterPushdown.enabled"


@dataclass
class Below(InputPartition):
    """A file, or all files below a folder."""

    path: str


@dataclass
class Lines(InputPartition):
    """Lines of the manifest that begin in a range of bytes."""

    begin: int
    end: int


def _file(root: str, path: str) -> tuple:
    """The row of one file; a failed read is a row. Links are not followed."""
    try:
        status = os.lstat(os.path.join(root, path))
        if stat.S_ISLNK(status.st_mode):
            return path, SYMLINK_MODE, status.st_size, None, None
        with open(os.path.join(root, path), "rb") as handle:
            content = handle.read()
        return path, "100755" if status.st_mode & 0o100 else "100644", status.st_size, content, None
    except OSError as problem:
        return path, "100644", 0, None, str(problem)


def _walk(root: str, path: str, prefix: str) -> Iterator[tuple]:
    """Rows of the files at or below ``path`` whose path starts with ``prefix``; other folders are not entered."""
    place = os.path.join(root, path)
    if os.path.islink(place) or not os.path.isdir(place):
        if path.startswith(prefix) and (os.path.islink(place) or not os.path.exists(place) or os.path.isfile(place)):
            yield _file(root, path)
        return
    inside = f"{path}/" if path else ""
    if not (inside.startswith(prefix) or prefix.startswith(inside)):
        return
    try:
        names = sorted(os.listdir(place))
    except OSError as problem:
        # The folder stands for its files, so that they are not taken for deleted.
        yield path or ".", UNREADABLE_MODE, 0, None, str(problem)
        return
    for name in names:
        if name != SKIPPED_FOLDER:
            yield from _walk(root, inside + name, prefix)


def _lines(manifest: str, begin: int, end: int) -> Iterator[str]:
    """Paths of the lines that begin at ``begin`` or behind it and before ``end``; a line without its end is not there yet."""
    with open(manifest, "rb") as handle:
        handle.seek(max(begin - 1, 0))
        if begin:
            handle.readline()  # the rest of a line that began before
        while handle.tell() < end:
            line = handle.readline()
            if not line.endswith(b"\n"):
                return
            if line.strip():
                yield line[:-1].decode()


class FolderReader(DataSourceReader):
    def __init__(self, root: str, manifest: str | None) -> None:
        self.root, self.manifest, self.prefix, self.only = root, manifest, "", None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for one in filters:
            if isinstance(one, StringStartsWith) and one.attribute == ("path",) and one.value.startswith(self.prefix):
                self.prefix = one.value
            elif isinstance(one, EqualTo) and one.attribute == ("path",) and self.only is None:
                self.only = one.value
            # Spark tests all filters again: what is pushed only spares reading.
            yield one

    def partitions(self) -> list[InputPartition]:
        if self.only is not None:
            return [Below(self.only)]
        if self.manifest:
            size = os.path.getsize(self.manifest)
            return [Lines(at, min(at + MANIFEST_BYTES, size)) for at in range(0, size, MANIFEST_BYTES)]
        top = self.prefix.rpartition("/")[0]
        place = os.path.join(self.root, top)
        if not os.path.isdir(place) or not os.access(place, os.R_OK):
            return [Below(top)]
        names = [n for n in sorted(os.listdir(place)) if n != SKIPPED_FOLDER]
        return [Below(f"{top}/{n}" if top else n) for n in names] or [Below(top)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        if isinstance(partition, Below):
            if self.only is None:
                yield from _walk(self.root, partition.path, self.prefix)
            elif self.manifest is None or self.only in _lines(self.manifest, 0, os.path.getsize(self.manifest)):
                place = os.path.join(self.root, self.only)
                if os.path.islink(place) or os.path.isfile(place):
                    yield _file(self.root, self.only)
            return
        for path in _lines(self.manifest, partition.begin, partition.end):
            if path.startswith(self.prefix):
                yield _file(self.root, path)


class ManifestStream(DataSourceStreamReader):
    """Positions are bytes of the manifest, always at the end of a line."""

    def __init__(self, root: str, manifest: str) -> None:
        self.root, self.manifest = root, manifest

    def initialOffset(self) -> dict:
        return {"bytes": 0}

    def latestOffset(self) -> dict:
        if not os.path.exists(self.manifest):
            return {"bytes": 0}
        size = os.path.getsize(self.manifest)
        with open(self.manifest, "rb") as handle:
            while size:
                begin = max(size - 4096, 0)
                handle.seek(begin)
                at = handle.read(size - begin).rfind(b"\n")
                if at >= 0:
                    return {"bytes": begin + at + 1}
                size = begin
        return {"bytes": 0}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [Lines(at, min(at + MANIFEST_BYTES, end["bytes"])) for at in range(start["bytes"], end["bytes"], MANIFEST_BYTES)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for path in _lines(self.manifest, partition.begin, partition.end):
            yield _file(self.root, path)


class DirectorySource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "directory"

    def schema(self) -> str:
        return CONTENT_COLUMNS

    def reader(self, schema: StructType) -> DataSourceReader:
        return FolderReader(self.options["path"], self.options.get("manifest"))

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return ManifestStream(self.options["path"], self.options["manifest"])


def register(spark: SparkSession) -> None:
    """Make ``spark.read.format("directory")`` known to the session and let filters reach it."""
    spark.conf.set(PUSHDOWN_CONF, "true")
    spark.dataSource.register(DirectorySource)


def load_directory(spark: SparkSession, root: str, manifest: str | None = None) -> DataFrame:
    """The files of a folder. Load it once for each use: Spark keeps the filters that reached a loaded source
    with the source, so two uses of one loaded table in a query would share them."""
    register(spark)
    reader = spark.read.format("directory")
    return (reader.option("manifest", manifest) if manifest else reader).load(root)
