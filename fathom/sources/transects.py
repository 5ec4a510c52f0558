"""A Spark data source of MAT files that reads no more of them than the columns asked for.

``register(spark)``, then ``spark.read.format("mat5").option("variables", "GPS").load(folder)``. Each task opens its
own files by their URI (local, or any store that Arrow's file systems know) and goes past
the variables it doesn't need: neither are their bytes read nor inflated. A condition on
``perfil`` leaves out whole files before any is opened.
Where a path can only be opened by Spark itself, ``mat5.read_transects`` takes the same
variables out of contents that Spark has read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from fathom.sources import mat5

#: Bytes of files and number of files that a task reads, about.
TASK_BYTES, TASK_FILES = 128 << 20, 2_000


def _stem(path: str) -> str:
    return path.rsplit("/", 1)[-1].rsplit(".", 1)[0]


def _system(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


@dataclass
class Files(InputPartition):
    root: str
    paths: tuple[str, ...]


class TransectReader(DataSourceReader):
    def __init__(self, root: str, columns: list[tuple[str, str]]):
        self.root, self.columns, self.only = root, columns, None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Take conditions on the file's name; the others stay Spark's."""
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute == ("perfil",):
                names = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.only = names if self.only is None else self.only & names
            else:
                yield f

    def partitions(self) -> list[Files]:
        system, path = _system(self.root)
        info = system.get_file_info(path)
        found = system.get_file_info(fs.FileSelector(path, recursive=True)) if info.type == fs.FileType.Directory else [info]
        found = [f for f in found if f.type == fs.FileType.File and f.path.lower().endswith(".mat")]
        found = sorted((f for f in found if self.only is None or _stem(f.path) in self.only), key=lambda f: f.path)
        parts, own, size = [], [], 0
        for f in found:
            own.append(f.path)
            size += f.size
            if size >= TASK_BYTES or len(own) >= TASK_FILES:
                parts.append(Files(self.root, tuple(own)))
                own, size = [], 0
        return [*parts, Files(self.root, tuple(own))] if own or not parts else parts

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        system, _ = _system(partition.root)
        for path in partition.paths:
            try:
                with system.open_input_file(path) as file:
                    yield mat5._rows(_stem(path), file, self.columns)
            except OSError as problem:  # a file that can't be opened is a row that says so
                arrays = {"perfil": [_stem(path)], "error": [str(problem)[:200]]}
                columns = [pa.array(arrays.get(c, [None]), mat5.KINDS_OF[k]) for c, k in self.columns]
                yield pa.RecordBatch.from_arrays(columns, names=[c for c, _ in self.columns])


class TransectSource(DataSource):
    """Rows of ensembles; option ``variables``: names of the file's variables, comma-separated (all if left out)."""

    @classmethod
    def name(cls) -> str:
        return "mat5"

    def _columns(self) -> list[tuple[str, str]]:
        given = self.options.get("variables")
        return mat5.schema_of({v.strip() for v in given.split(",")} if given else None)

    def schema(self) -> str:
        return ", ".join(f"{c} {k}" for c, k in self._columns())

    def reader(self, schema) -> TransectReader:
        return TransectReader(self.options["path"], self._columns())


def register(spark: SparkSession) -> None:
    """Make the format known to a session, and let it take conditions (a setting that Spark asks for)."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(TransectSource)
