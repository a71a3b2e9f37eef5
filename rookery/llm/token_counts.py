"""Token counts per document from flat, unindexed token files, by scanning for the separator id.

``write_flat`` makes such files: unsigned 16-bit little-endian ids, each document followed by the end-of-document id, and
nothing else.  ``separator_scan`` reads any of them in blocks of equal size.  Each block is searched with one vectorised
comparison; what crosses a block's border is stitched by a prefix scan over the blocks of a file (the last separator
before a block, and the number of separators before it).  The scan's rows hold two numbers for each block of 4 MB; the
separators' places stay where they were found and are joined with the scan's result by file and block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import words as W
from .storage import bound_batches, cut, open_folder
from .tokens import CHUNK_BYTES, row_tokens

END = 49407  # <|endoftext|> of the vocabulary
BLOCK_BYTES = 4 << 20


def _write(uri: str, path: str, end: int):
    schema = pa.schema([("file", pa.string()), ("ordinal", pa.int64()), ("doc_id", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name = f"tokens-{task.partitionId():06d}-{task.taskAttemptId()}.bin"  # a repeated attempt writes a file of its own
        fs, root = open_folder(uri)
        attempt = f"{root}/_{name}"
        done = 0
        fs.create_dir(root, recursive=True)
        with fs.open_output_stream(attempt) as out:
            for batch in batches:
                for c in W.chunks(batch.column("text"), limit=CHUNK_BYTES):
                    ids, at = row_tokens(path, c, ordinary=True)
                    if ids.max(initial=0) > 0xFFFF or (ids == end).any():
                        raise ValueError("ids must fit 16 bits and differ from the end id")
                    n = np.diff(at) + 1
                    data = np.full(int(n.sum()), end, dtype="<u2")
                    data[W.ragged_arange(np.cumsum(n) - n, n - 1)] = ids
                    out.write(data.tobytes())
                    doc = batch.column("doc_id").slice(c.row0, c.row1 - c.row0)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(n)), pa.array(np.arange(done, done + len(n))), doc],
                        schema=schema,
                    )
                    done += len(n)
        fs.move(attempt, f"{root}/{name}")  # whole or not at all; nothing has this name

    return run, "file string, ordinal long, doc_id long"


def write_flat(docs: DataFrame, tokenizer: str, uri: str, end: int = END) -> DataFrame:
    """Writes one flat file per partition under ``uri`` when the result is computed: which document is the how-manieth of a file.

    Null texts count as empty: the end id alone.  The separator's string in a text is ordinary text, so its id stands for ends
    only.  Null and repeated ids are written like others; other columns are dropped.  An empty table writes no ids.  Files that
    the result does not name are those of attempts that failed or came second: give the result, written, to the scan.
    """
    bound_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(*_write(uri, tokenizer, end))


def _blocks(spark: SparkSession, uri: str, block_bytes: int) -> DataFrame:
    fs, root = open_folder(uri)
    files = [
        (f.base_name, f.size) for f in fs.get_file_info(pafs.FileSelector(root)) if f.is_file and not f.base_name.startswith(("_", "."))
    ] if fs.get_file_info(root).type == pafs.FileType.Directory else []
    table = spark.createDataFrame(files, "file string, size long")
    starts = F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(block_bytes).cast("long"))
    return table.filter("size > 0").select("file", "size", F.posexplode(starts).alias("block", "begin"))


def _search(uri: str, end: int, block_bytes: int):
    schema = pa.schema(
        [("file", pa.string()), ("block", pa.int32()), ("last", pa.int64()), ("n", pa.int64()), ("ends", pa.list_(pa.int64()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_folder(uri)
        for batch in batches:
            for x in batch.to_pylist():
                with fs.open_input_file(f"{root}/{x['file']}") as file:
                    ids = np.frombuffer(file.read_at(min(block_bytes, x["size"] - x["begin"]), x["begin"]), dtype="<u2")
                found = np.flatnonzero(ids == end) + x["begin"] // 2
                last = int(found[-1]) if len(found) else None
                yield pa.RecordBatch.from_pydict(
                    {"file": [x["file"]], "block": [x["block"]], "last": [last], "n": [len(found)], "ends": [found]},
                    schema=schema,
                )

    return run, "file string, block int, last long, n long, ends array<long>"


def separator_scan(
    spark: SparkSession, uri: str, end: int = END, block_bytes: int = BLOCK_BYTES, manifest: DataFrame | None = None
) -> DataFrame:
    """``file, ordinal, start, n_tokens`` of each document in the flat files of a folder (the separator not counted).

    With a ``manifest(file)`` only the files that it names count.
    Ids after a file's last separator are a document without an end and are returned too, if there are any.
    """
    if block_bytes % 2:
        raise ValueError("blocks must hold whole ids")
    table = _blocks(spark, uri, block_bytes)
    if manifest is not None:
        table = table.join(manifest.select("file").distinct(), "file", "left_semi")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = cut(table.repartition(n, "file", "block").mapInArrow(*_search(uri, end, block_bytes)), "separators")
    so_far = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before, seen = F.last("last", ignorenulls=True).over(so_far), F.sum("n").over(so_far)
    carried = found.select(
        "file",
        "block",
        F.coalesce(before, F.lit(-1).cast("long")).alias("before"),
        F.coalesce(seen, F.lit(0).cast("long")).alias("seen"),
    )
    stitched = found.select("file", "block", "ends").join(carried, ["file", "block"])
    each = stitched.select("file", "seen", "ends", "before", F.posexplode("ends").alias("i", "stop"))
    previous = F.when(F.col("i") == 0, F.col("before")).otherwise(F.get("ends", F.col("i") - 1))
    closed = each.select(
        "file",
        (F.col("seen") + F.col("i")).alias("ordinal"),
        (previous + 1).alias("start"),
        (F.col("stop") - previous - 1).alias("n_tokens"),
    )
    totals = found.groupBy("file").agg((F.coalesce(F.max("last"), F.lit(-1).cast("long")) + 1).alias("start"), F.sum("n").alias("ordinal"))
    sizes = table.filter("block = 0").select("file", (F.col("size") / 2).cast("long").alias("ids"))
    tail = totals.join(sizes, "file").select(
        "file",
        "ordinal",
        "start",
        (F.col("ids") - F.col("start")).alias("n_tokens"),
    ).filter("n_tokens > 0")
    return closed.unionByName(tail)
