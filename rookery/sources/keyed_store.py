"""A store of keyed records that rounds add to without rewriting it.

Keys are dealt to a fixed number of buckets by a hash.  A batch writes its own rows, by bucket, as a delta; a bucket whose
deltas have outgrown its base is folded into a new base, and no other bucket is touched.  A manifest names the files of every
bucket and the last batch of every stream.  It is written last, under the next number and in one step: readers see all of a
batch or nothing of it, a batch that comes again finds its number taken and changes nothing, and of two writers that
start from the same manifest the second one fails.  Files that no manifest names are what a broken batch has left.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from ..operators import merge
from . import files


@dataclass
class Manifest:
    """What a version of the store consists of; its size goes with the number of buckets, not of records."""

    number: int = 0
    buckets: int = 64
    schema: str = ""
    #: folder of a bucket's base, its deltas in order, and their rows
    base: dict[int, str] = field(default_factory=dict)
    deltas: dict[int, list[str]] = field(default_factory=dict)
    rows: dict[int, list[int]] = field(default_factory=dict)
    #: last batch of each stream
    batches: dict[str, int] = field(default_factory=dict)


class KeyedStore:
    """Records ``key, ord, ...`` in ``path``; ``fold`` of ``operators.merge`` says what later records of a key add."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType | None = None, buckets: int = 64, least: int = 1000):
        """``schema`` and ``buckets`` count for a new store only.  A base is renewed when its deltas have over ``least`` rows and as many as it."""
        self.spark, self.path, self.least = spark, path.rstrip("/"), least
        found = self.manifest()
        if found is None:
            if schema is None:
                raise ValueError(f"{path}: a new store needs a schema")
            self._commit(Manifest(0, buckets, schema.json()))

    def manifest(self) -> Manifest | None:
        """The latest manifest."""
        names = [x for x in files.names_in(self.spark, f"{self.path}/manifests") if x.endswith(".json") and not x.startswith(".")]
        if not names:
            return None
        x = json.loads(files.read_file(self.spark, f"{self.path}/manifests/{names[-1]}"))
        for part in ("base", "deltas", "rows"):
            x[part] = {int(k): v for k, v in x[part].items()}
        return Manifest(**x)

    def _commit(self, m: Manifest) -> None:
        files.write_file(self.spark, f"{self.path}/manifests/{m.number:012d}.json", json.dumps(asdict(m)), replace=False)

    def _schema(self, m: Manifest) -> StructType:
        return StructType.fromJson(json.loads(m.schema)).add("side", LongType()).add("source", StringType())

    def _rows(self, m: Manifest, buckets: list[int]) -> DataFrame:
        paths = [p for b in buckets for p in ([m.base[b]] if b in m.base else []) + m.deltas.get(b, [])]
        schema = self._schema(m)
        return self.spark.read.schema(schema).parquet(*(f"{self.path}/{p}" for p in paths)) if paths else self.spark.createDataFrame([], schema)

    def _write(self, rows: DataFrame, m: Manifest, name: str) -> tuple[str, dict[int, int]]:
        """Writes rows by bucket; the folder, and the rows of each bucket that got any."""
        folder = f"{name}-{m.number + 1:012d}-{uuid.uuid4().hex[:8]}"
        dealt = rows.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(m.buckets)).cast("int"))
        # a bucket's rows go to several files if they are many: dealt by bucket and key, cut by size
        dealt.repartition("bucket", F.pmod(F.xxhash64("key", "ord"), F.lit(8))).write.partitionBy("bucket").parquet(f"{self.path}/{folder}")
        back = self.spark.read.schema("bucket int").parquet(f"{self.path}/{folder}") if files.names_in(self.spark, f"{self.path}/{folder}") else None
        sizes = {r.bucket: r.n for r in back.groupBy("bucket").agg(F.count("*").alias("n")).collect() if r.bucket is not None} if back else {}
        return folder, sizes  # a row for each bucket

    def add(self, batch: DataFrame, source: str, stream: str | None = None, number: int | None = None) -> bool:
        """Adds a batch under the rule of ``source``; false if ``stream`` has brought this batch before."""
        m = self.manifest()
        if stream is not None and number is not None and m.batches.get(stream, -1) >= number:
            return False
        if source not in merge.RULES:
            raise ValueError(f"no rule for {source}")
        names = [c for c in self._schema(m).names if c not in ("side", "source")]
        rows = batch.select(*names, F.lit(m.number + 1).cast("bigint").alias("side"), F.lit(source).alias("source"))
        folder, sizes = self._write(rows, m, "delta")
        for b, n in sizes.items():
            m.deltas.setdefault(b, []).append(f"{folder}/bucket={b}")
            m.rows.setdefault(b, [0, 0])[1] += n
        self._compact(m)
        if stream is not None and number is not None:
            m.batches[stream] = number
        m.number += 1
        self._commit(m)
        return True

    def _compact(self, m: Manifest) -> None:
        """New bases for the buckets whose deltas have outgrown them."""
        grown = sorted(b for b, (base, delta) in m.rows.items() if delta > max(base, self.least))
        if not grown:
            return
        folded = merge.fold(self._rows(m, grown)).withColumns({"side": F.lit(0).cast("bigint"), "source": F.lit(None).cast("string")})
        folder, sizes = self._write(folded, m, "base")
        for b in grown:
            m.base[b], m.deltas[b], m.rows[b] = f"{folder}/bucket={b}", [], [sizes[b], 0]

    def read(self) -> DataFrame:
        """The records as they are now, one for each key."""
        m = self.manifest()
        names = sorted({*m.base, *m.deltas})
        return merge.fold(self._rows(m, names)).select(*(c for c in self._schema(m).names if c not in ("side", "source")))

    def clean(self, keep: int = 2) -> None:
        """Deletes all but the last ``keep`` manifests, and files that none of these names; for times without writers and long readers."""
        names = [x for x in files.names_in(self.spark, f"{self.path}/manifests") if x.endswith(".json") and not x.startswith(".")]
        named = set()
        for name in names[-keep:]:
            x = json.loads(files.read_file(self.spark, f"{self.path}/manifests/{name}"))
            named |= {p.split("/")[0] for p in [*x["base"].values(), *(d for ds in x["deltas"].values() for d in ds)]}
        for name in names[:-keep]:
            files.remove(self.spark, f"{self.path}/manifests/{name}")
        for name in files.names_in(self.spark, self.path):
            if name.startswith(("base-", "delta-")) and name not in named:
                files.remove(self.spark, f"{self.path}/{name}")
