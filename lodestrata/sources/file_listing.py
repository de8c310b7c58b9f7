"""File listing as a data source, with one task per folder below the root, as a batch and as a stream.

Spark's own file sources keep the whole listing in the driver before any task runs. Here the driver knows the prefixes only,
and the files are rows from the start. Both readers go through `pyarrow.fs`, which reaches local paths, HDFS and the object
stores by their address; a store that only Spark's connectors can open is left to `listing.list_files`.
"""

from __future__ import annotations

import time
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from ..session import ship

FORMAT = "prefix_listing"
SCHEMA = "path string, length bigint, modificationTime timestamp"
ARROW_SCHEMA = pa.schema(
    [("path", pa.string()), ("length", pa.int64()), ("modificationTime", pa.timestamp("us", tz="UTC"))]
)
# Files of one batch of rows.
BATCH = 4096
# How far a stream looks back behind its offset: clocks of stores and machines differ, and files appear after their time.
OVERLAP_SECONDS = 60
# A stream that begins has seen nothing.
BEGINNING = -(1 << 62)


@dataclass
class Prefix(InputPartition):
    """Files in `folder`, relative to the root, modified in (after, until], in microseconds."""

    folder: str
    deep: bool
    after: int = BEGINNING
    until: int = 1 << 62


def _opened(root: str) -> tuple[fs.FileSystem, str, str]:
    """The file system of `root`, its path there, and what turns such a path into an address again."""
    scheme, colon, rest = root.partition(":/")
    if not colon or scheme == "file":
        path = ("/" + rest.lstrip("/") if colon else root).rstrip("/") or "/"
        return fs.LocalFileSystem(), path, "file:" if colon else ""
    # The object store connectors of Hadoop have schemes of their own.
    known = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    store, path = fs.FileSystem.from_uri(f"{known}:/{rest.rstrip('/')}")
    return store, path.rstrip("/"), root.rstrip("/").removesuffix(path.rstrip("/"))


def _visible(info: fs.FileInfo) -> bool:
    """As Spark's file sources see it: names with a leading dot or underscore are work in progress."""
    name = info.base_name
    return not name.startswith(".") and (not name.startswith("_") or "=" in name)


class _Options:
    def __init__(self, options: Mapping[str, str]):
        self.root, self.suffix = options["path"], options.get("suffix", "")
        named = options.get("prefixes", "")
        self.named = [p.strip("/") for p in named.split("\n") if p.strip("/")]
        self.overlap = int(float(options.get("overlapSeconds", OVERLAP_SECONDS)) * 1e6)

    def prefixes(self, after: int = BEGINNING, until: int = 1 << 62) -> list[Prefix]:
        """The named folders, or else all that lie directly in the root, and the root's own files."""
        if self.named:
            return [Prefix(folder, True, after, until) for folder in self.named]
        store, path, _ = _opened(self.root)
        folders = (i for i in store.get_file_info(fs.FileSelector(path)) if i.type == fs.FileType.Directory)
        below = sorted(i.base_name for i in folders if _visible(i))
        return [Prefix("", False, after, until), *(Prefix(folder, True, after, until) for folder in below)]

    def files(self, prefix: Prefix) -> Iterator[pa.RecordBatch]:
        """What the prefix holds, folder by folder; a folder that went in the meantime holds nothing."""
        store, path, address = _opened(self.root)
        waiting, rows = [f"{path}/{prefix.folder}" if prefix.folder else path], []
        while waiting:
            for info in store.get_file_info(fs.FileSelector(waiting.pop(), allow_not_found=True)):
                if not _visible(info):
                    continue
                if info.type == fs.FileType.Directory:
                    waiting += [info.path] * prefix.deep
                elif info.type == fs.FileType.File and info.base_name.endswith(self.suffix):
                    changed = info.mtime_ns // 1000 if info.mtime_ns is not None else prefix.until
                    if prefix.after < changed <= prefix.until:
                        rows.append((address + info.path, info.size, changed))
            while len(rows) >= BATCH:
                yield _batch(rows[:BATCH])
                del rows[:BATCH]
        if rows:
            yield _batch(rows)


def _batch(rows: Sequence[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), ARROW_SCHEMA.types, strict=True)],
        schema=ARROW_SCHEMA,
    )


class _Reader(DataSourceReader):
    def __init__(self, options: _Options):
        self.options = options

    def partitions(self) -> list[Prefix]:
        return self.options.prefixes()

    def read(self, partition: Prefix) -> Iterator[pa.RecordBatch]:
        return self.options.files(partition)


class _StreamReader(DataSourceStreamReader):
    """The offset is a time: all files modified until then are seen.

    A batch looks back behind its start by the overlap, so a file may come twice, and whoever reads the stream compares it
    with what is loaded. A file that arrives with an older time than that is left to the batch listing.
    """

    def __init__(self, options: _Options):
        self.options = options

    def initialOffset(self) -> dict:
        return {"until": BEGINNING}

    def latestOffset(self) -> dict:
        return {"until": time.time_ns() // 1000}

    def partitions(self, start: dict, end: dict) -> list[Prefix]:
        return self.options.prefixes(start["until"] - self.options.overlap, end["until"])

    def read(self, partition: Prefix) -> Iterator[pa.RecordBatch]:
        return self.options.files(partition)


class PrefixListing(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _Reader:
        return _Reader(_Options(self.options))

    def streamReader(self, schema) -> _StreamReader:
        return _StreamReader(_Options(self.options))


def _options(suffix: str, prefixes: Sequence[str], **more) -> dict:
    return {"suffix": suffix, "prefixes": "\n".join(prefixes), **more}


def _registered(spark: SparkSession) -> None:
    ship(spark)
    spark.dataSource.register(PrefixListing)


def scan_files(spark: SparkSession, root: str, suffix: str = "", prefixes: Sequence[str] = ()) -> DataFrame:
    """Every file below `root` whose name ends with the suffix (case matters), one task per prefix.

    `prefixes` names the folders below the root; without them the driver looks at the root's own entries, no deeper.
    """
    _registered(spark)
    return spark.read.format(FORMAT).options(**_options(suffix, prefixes)).load(root)


def stream_files(
    spark: SparkSession, root: str, suffix: str = ".csv", prefixes: Sequence[str] = (), overlap_seconds: float = OVERLAP_SECONDS
) -> DataFrame:
    """The same as a stream of what was modified since the offset that the stream's checkpoint holds."""
    _registered(spark)
    options = _options(suffix, prefixes, overlapSeconds=str(overlap_seconds))
    return spark.readStream.format(FORMAT).options(**options).load(root)
