"""Data source of whole text files, listed and written in tasks.

``spark.read.format("whole_files")`` gives ``(path, value)`` for the files of
folders that all nodes see under one path.  The driver resolves folders alone;
each folder is dealt over ``splits`` tasks, which list it and read the files
whose name falls to them, so no file is named on the driver and a folder of any
number of files is no single task's.  Unlike Spark's own readers it keeps files
of no bytes.  Names that start with ``_`` or ``.`` are left out, ``.gz`` files
are unpacked, bytes that are not UTF-8 become U+FFFD.  A file that disappears
between listing and reading fails its task, which is then run again.

Writing takes ``(path, value)`` rows, the path relative to the target folder.
Each task attempt writes into a folder of its own under ``_staging-<job>``; the
commit moves the files of the attempts that count to their names, replacing
older files, and an abort or a failed commit leaves no staged file.  A name
that leaves the target, starts with ``_`` or ``.``, or comes twice in a task
fails the job (``write_shared`` brings equal names into one task).
"""

from __future__ import annotations

import fnmatch
import glob
import gzip
import os
import shutil
import sys
import uuid
import zlib
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

# Tasks need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "whole_files"


def folders_of(pattern: str) -> tuple[list[str], str]:
    """(folders, pattern of the file names) that a folder, file or glob names."""
    pattern = pattern.rstrip("/") or "/"
    if os.path.isdir(pattern):
        return [pattern], "*"
    parent, names = os.path.split(pattern)
    if os.path.isfile(pattern):
        return [parent], glob.escape(names)
    matches = sorted(f for f in glob.glob(parent) if os.path.isdir(f))
    if not matches:
        raise FileNotFoundError(f"no folder {parent!r}")
    return matches, names


class FolderPart(InputPartition):
    """The files of ``folder`` whose name hashes to ``part`` of ``splits``."""

    def __init__(self, folder: str, part: int, splits: int):
        super().__init__((folder, part, splits))
        self.folder, self.part, self.splits = folder, part, splits


class WholeFilesReader(DataSourceReader):
    def __init__(self, pattern: str, splits: int):
        self.folders, self.names = folders_of(pattern)
        self.splits = splits

    def partitions(self) -> list[InputPartition]:
        return [FolderPart(f, k, self.splits) for f in self.folders for k in range(self.splits)]

    def read(self, partition: FolderPart) -> Iterator[tuple[str, str]]:
        with os.scandir(partition.folder) as entries:
            names = [e.name for e in entries if not e.name.startswith(("_", ".")) and fnmatch.fnmatchcase(e.name, self.names)
                     and zlib.crc32(os.fsencode(e.name)) % partition.splits == partition.part and e.is_file()]
        for name in sorted(names):
            path = os.path.join(partition.folder, name)
            with (gzip.open if name.endswith(".gz") else open)(path, "rb") as f:
                yield path, f.read().decode("utf-8", "replace")


class WrittenFolder(WriterCommitMessage):
    """The folder of a task attempt."""

    def __init__(self, folder: str):
        self.folder = folder


class WholeFilesWriter(DataSourceWriter):
    def __init__(self, root: str):
        self.root = root
        self.staging = os.path.join(root, f"_staging-{uuid.uuid4().hex}")

    def write(self, iterator) -> WrittenFolder:
        own = os.path.join(self.staging, uuid.uuid4().hex)
        os.makedirs(own)
        for path, value in iterator:
            steps = (path or "").split("/")
            if any(not step or step[0] in "_." for step in steps):
                raise ValueError(f"not a file name under the target folder: {path!r}")
            target = os.path.join(own, *steps)
            os.makedirs(os.path.dirname(target), exist_ok=True)
            with open(target, "xb") as f:  # a name that comes twice fails
                f.write((value or "").encode("utf-8"))
        return WrittenFolder(own)

    def commit(self, messages) -> None:
        try:
            for message in messages:
                for folder, _, names in os.walk(message.folder):
                    target = os.path.normpath(os.path.join(self.root, os.path.relpath(folder, message.folder)))
                    os.makedirs(target, exist_ok=True)
                    for name in names:
                        os.replace(os.path.join(folder, name), os.path.join(target, name))
        finally:
            shutil.rmtree(self.staging, ignore_errors=True)

    def abort(self, messages) -> None:
        shutil.rmtree(self.staging, ignore_errors=True)


class WholeFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "path string, value string"

    def reader(self, schema) -> WholeFilesReader:
        return WholeFilesReader(self.options["path"], int(self.options.get("splits", 1)))


    def writer(self, schema, overwrite: bool) -> WholeFilesWriter:
        if overwrite:
            raise ValueError("whole files are appended to a folder; those of the same names are replaced")
        return WholeFilesWriter(self.options["path"])


def write_shared(files: DataFrame, root: str) -> None:
    """Write ``files (path, value)`` under ``root``, a folder all nodes share."""
    files.sparkSession.dataSource.register(WholeFiles)
    (files.select("path", "value").repartition("path").write.format(FORMAT).mode("append").save(os.path.abspath(root)))


def read_shared(spark: SparkSession, pattern: str, splits: int) -> DataFrame:
    """``(path, value)`` of the files of ``pattern``; FileNotFoundError if there is
    no such folder."""
    pattern = os.path.abspath(pattern)
    folders_of(pattern)
    spark.dataSource.register(WholeFiles)
    return spark.read.format(FORMAT).option("splits", splits).load(pattern)
