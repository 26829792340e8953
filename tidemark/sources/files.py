"""Every file of a folder tree, hidden and empty ones too, as a Spark data source.

Spark's own file sources leave out names that begin with ``_`` or ``.`` and give no row for empty files. This one lists the tree
itself: the driver goes as far as a bounded number of entries, and what lies deeper is listed by the tasks that read it.

``part="small"`` gives ``source, size, content`` of files up to ``large`` bytes, ``part="large"`` gives ``source, size`` of the others.
``only`` (a JSON list of sources) reads these files without listing anything; names that are gone give no row.
"""

from __future__ import annotations

import json
import posixpath
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from fnmatch import fnmatchcase

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

NAME = "tidemark_files"

#: Entries that the driver lists, and files and bytes that a task reads.
LISTED, TASK_FILES, TASK_BYTES = 100_000, 2_000, 32 << 20
#: Bytes of contents handed over at once.
BATCH_BYTES = 8 << 20


def open_root(root: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder given as Hadoop spells it; ``ValueError`` for a scheme that pyarrow doesn't know."""
    scheme, _, rest = root.partition(":")
    if scheme == "file" or "/" in scheme or not rest:
        path = rest if scheme == "file" else root
        return pafs.LocalFileSystem(), "/" + path.lstrip("/")
    return pafs.FileSystem.from_uri(root.rstrip("/"))


@dataclass
class Share(InputPartition):
    """Files (path below the root, size) and folders, still to be listed, of one task."""

    files: list[tuple[str, int]]
    folders: list[str]


class TreeReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.root = options["path"].rstrip("/")
        self.pattern = options.get("pattern", "*.json")
        self.large = int(options.get("large", 64 << 20))
        self.small = options.get("part", "small") == "small"
        self.only = json.loads(options["only"]) if "only" in options else None

    def _children(self, fs: pafs.FileSystem, base: str, folder: str) -> Iterator[tuple[str, int | None]]:
        """Files with their sizes and folders, in order of their names."""
        place = f"{base.rstrip('/')}/{folder}".rstrip("/") or "/"
        for info in sorted(fs.get_file_info(pafs.FileSelector(place, allow_not_found=False)), key=lambda i: i.path):
            name = posixpath.join(folder, info.base_name)
            if info.type == pafs.FileType.Directory:
                yield name, None
            elif info.type == pafs.FileType.File and fnmatchcase(info.base_name, self.pattern):
                yield name, info.size or 0

    def partitions(self) -> list[Share]:
        fs, base = open_root(self.root)
        if self.only is not None:
            found = zip(self.only, fs.get_file_info([f"{base.rstrip('/')}/{name}" for name in self.only]))
            files, folders = [(name, info.size or 0) for name, info in found if info.type == pafs.FileType.File], deque()
        else:
            files, folders, seen = [], deque([""]), 0
            while folders and seen < LISTED:
                for name, size in self._children(fs, base, folders.popleft()):
                    seen += 1
                    files.append((name, size)) if size is not None else folders.append(name)
        shares, held, size = [], [], 0
        for file in files:
            if (file[1] <= self.large) != self.small:
                continue
            if held and (len(held) == TASK_FILES or (self.small and size + file[1] > TASK_BYTES)):
                shares.append(Share(held, []))
                held, size = [], 0
            held.append(file)
            size += file[1]
        if held:
            shares.append(Share(held, []))
        # A task may do without any work, a scan not without any task.
        return shares + [Share([], [f]) for f in folders] or [Share([], [])]

    def _files(self, share: Share, fs: pafs.FileSystem, base: str) -> Iterator[tuple[str, int]]:
        yield from share.files
        waiting = list(share.folders)
        while waiting:
            for name, size in self._children(fs, base, waiting.pop()):
                if size is None:
                    waiting.append(name)
                elif (size <= self.large) == self.small:
                    yield name, size

    def read(self, share: Share) -> Iterator[pa.RecordBatch]:
        fs, base = open_root(self.root)
        rows, held = [], 0
        for name, size in self._files(share, fs, base):
            row = {"source": name, "size": size}
            if self.small:
                with fs.open_input_stream(f"{base.rstrip('/')}/{name}", compression=None) as stream:
                    row["content"] = stream.read()
                held += len(row["content"])
            rows.append(row)
            if held >= BATCH_BYTES or len(rows) == TASK_FILES:
                yield pa.RecordBatch.from_pylist(rows, schema=_arrow(self.small))
                rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_arrow(self.small))


def _arrow(small: bool) -> pa.Schema:
    return pa.schema([("source", pa.string()), ("size", pa.int64()), *([("content", pa.binary())] if small else [])])


class TreeFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return "source string, size bigint" + (", content binary" if self.options.get("part", "small") == "small" else "")

    def reader(self, schema) -> TreeReader:
        return TreeReader(self.options)


def readable(root: str) -> bool:
    """Whether this source can open ``root``, given as Hadoop spells it."""
    try:
        open_root(root)
    except (ValueError, pa.ArrowException, OSError):
        return False
    return True


def tree(spark: SparkSession, root: str, part: str = "small", only: list[str] | None = None, **options):
    """The files below ``root``."""
    spark.dataSource.register(TreeFiles)
    reader = spark.read.format(NAME).option("part", part).options(**options)
    if only is not None:
        reader = reader.option("only", json.dumps(only))
    return reader.load(root)
