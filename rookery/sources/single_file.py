"""A sink for extracts that must be one text file: written aside by one task, put in its place in one step when the job succeeds."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType


def _opened(path: str):
    """File system and path; a path without a scheme is a local or mounted one."""
    import pyarrow.fs as pafs

    return pafs.FileSystem.from_uri(path if "://" in path else "file://" + os.path.abspath(path.removeprefix("file:")))


@dataclass
class _Part(WriterCommitMessage):
    path: str
    rows: int


class _Writer(DataSourceWriter):
    def __init__(self, path: str):
        self.path = path
        self.stamp = uuid.uuid4().hex

    def _aside(self) -> tuple[str, str]:
        folder, _, name = self.path.rpartition("/")
        return folder, f".{name}.{self.stamp}."

    def write(self, iterator: Iterator[Row]) -> _Part:
        """Lines of one task; a task without rows writes nothing."""
        folder, name = self._aside()
        path, rows, out = f"{folder}/{name}{uuid.uuid4().hex}", 0, None
        for row in iterator:
            if out is None:
                fs, at = _opened(path)
                fs.create_dir(at.rpartition("/")[0], recursive=True)
                out = fs.open_output_stream(at)
            out.write(((row[0] or "") + "\n").encode())
            rows += 1
        if out is not None:
            out.close()
        return _Part(path, rows)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        """The one file that was written takes its place; an extract without rows is an empty file."""
        parts = [m for m in messages if m is not None and m.rows]
        if len(parts) > 1:
            self.abort(messages)
            raise ValueError(f"{self.path}: rows came from {len(parts)} tasks, one file needs one")
        fs, to = _opened(self.path)
        if parts:
            fs.move(_opened(parts[0].path)[1], to)
        else:
            fs.create_dir(to.rpartition("/")[0], recursive=True)
            fs.open_output_stream(to).close()
        self._swept()

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        """What was written aside goes, also what a failed task left; the old file stays."""
        self._swept()

    def _swept(self) -> None:
        import pyarrow.fs as pafs

        folder, name = self._aside()
        fs, at = _opened(folder)
        if fs.get_file_info(at).type == pafs.FileType.Directory:
            for f in fs.get_file_info(pafs.FileSelector(at)):
                if f.base_name.startswith(name):
                    fs.delete_file(f.path)


class SingleFile(DataSource):
    """``df.write.format("single_file").mode("overwrite").save(path)`` for a table with one string column."""

    @classmethod
    def name(cls) -> str:
        return "single_file"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        if not overwrite:
            raise ValueError("a single file is replaced as a whole: use mode overwrite")
        return _Writer(self.options["path"])


def write_file(lines: DataFrame, path: str, order: list | None = None) -> None:
    """Writes ``lines(value)`` as one file, in order if one is given: sorted by many tasks, written by one."""
    spark: SparkSession = lines.sparkSession
    spark.dataSource.register(SingleFile)
    rows = lines.orderBy(*order) if order else lines
    rows.select(F.col("value").cast("string")).coalesce(1).write.format("single_file").mode("overwrite").save(path)
