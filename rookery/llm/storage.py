"""The folder that the driver and all executors share, and tables written there to cut lineage."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_made: list[tuple[SparkSession, str]] = []
_local_root: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; where it is unset, a temporary folder, which is right for local mode only."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        if app not in _local_root:
            _local_root[app] = "file://" + tempfile.mkdtemp(prefix="rookery-shared-")
        root = _local_root[app]
    return root.rstrip("/")


def _drop(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def _drop_all() -> None:
    for spark, path in _made:
        try:
            _drop(spark, path)
        except Exception:  # the JVM may have gone first; the folder then stays, named as below
            return


atexit.register(_drop_all)


def bound_batches(spark: SparkSession, most: str = "4m") -> None:
    """Limits the Arrow batches that tasks pass to Python, unless the session has a limit of its own.

    The default of 64 MB a batch is held several times over, in the JVM and in Python.  The setting is read when a plan runs,
    which may be long after the call, so it stays as it is set here.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name) == "67108864b":
        spark.conf.set(name, most)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; it goes when the driver's Python ends."""
    path = f"{shared_root(spark)}/rookery-{name}-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


def cut(df: DataFrame, name: str) -> DataFrame:
    """Writes a table to the shared folder and reads it back, so that a lost executor costs no earlier stage again."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back._rookery_path = path
    return back


def forget(df: DataFrame) -> None:
    """Deletes the files of a ``cut`` table that nothing will read again."""
    path = getattr(df, "_rookery_path", None)
    if path:
        _drop(df.sparkSession, path)
        _made[:] = [x for x in _made if x[1] != path]


def open_folder(uri: str):
    """File system and path of a folder for use in tasks; the folder may be of any kind that Arrow can open."""
    import pyarrow.fs as pafs

    return pafs.FileSystem.from_uri(uri if "://" in uri else "file://" + os.path.abspath(uri.removeprefix("file:")))


def local_path(path: str) -> str:
    """The path under which every worker can memory-map a shared file; needs a mounted folder (``file:`` or a bare path)."""
    if path.startswith("file:"):
        return "/" + path[5:].lstrip("/")
    if "://" in path:
        raise ValueError(f"{path}: memory-mapping needs a shared folder that is mounted on every node (file://...)")
    return os.path.abspath(path)
