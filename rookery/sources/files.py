"""Files of the driver's kind: small ones that are replaced as a whole, and the folder that all nodes share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_local: dict[str, str] = {}


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path in ``spark.checkpoint.dir``; where that is unset a temporary folder, which is right for local mode only."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        root = _local.setdefault(app, "") or "file://" + tempfile.mkdtemp(prefix="rookery-")
        _local[app] = root
    return f"{root.rstrip('/')}/rookery-{name}-{uuid.uuid4().hex}"


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return jvm, target, target.getFileSystem(conf), jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf)


def _rename(spark: SparkSession, source: str, to: str, replace: bool) -> None:
    """One step for readers: they find the old file or the new one.  Without ``replace`` a file that is there stays and an error is raised."""
    jvm, target, _, context = _hadoop(spark, to)
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(kind, 1)
    how[0] = kind.OVERWRITE if replace else kind.NONE
    context.rename(jvm.org.apache.hadoop.fs.Path(source), target, how)


def write_file(spark: SparkSession, path: str, text: str, replace: bool = True) -> None:
    """A small text written beside its place and renamed to it; a crash leaves the old file."""
    _, _, fs, _ = _hadoop(spark, path)
    aside = f"{path.rpartition('/')[0]}/.{path.rpartition('/')[2]}.{uuid.uuid4().hex}"
    out = fs.create(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(aside), True)
    out.write(text.encode())
    out.close()
    _rename(spark, aside, path, replace)


def move_file(spark: SparkSession, source: str, to: str) -> None:
    """A finished file takes the place of another in one step."""
    _rename(spark, source, to, replace=True)


def read_file(spark: SparkSession, path: str) -> str | None:
    """A small text; null if there is no such file."""
    jvm, target, fs, _ = _hadoop(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of a folder's entries, in order; none if there is no such folder."""
    _, target, fs, _ = _hadoop(spark, folder)
    return sorted(x.getPath().getName() for x in fs.listStatus(target)) if fs.exists(target) else []


def remove(spark: SparkSession, path: str) -> None:
    """A file, or a folder with all that it has."""
    _, target, fs, _ = _hadoop(spark, path)
    fs.delete(target, True)
