"""WARC archives of pages: written with segmented and chunked records, read back by segment reassembly.

Writing: a page is one HTTP response record.  A block longer than ``segment`` bytes is split: the first record has
segment number 1, the others are continuation records that name the first one's id.  Of pages with equal payloads (of
``least`` bytes or more) those with the smallest page id are responses, the others are revisit records without a payload.
Each record is a gzip member; files are closed at about ``file_bytes``, so that a reader's task holds one small file.  Which
files count is said by a manifest that Spark commits with the tasks, so files of failed attempts are never read.  Record ids
are unique: equal rows are records of their own.

Reading: files are parsed into records.  Continuation records are grouped by origin, ordered by number, joined, and their
length compared with the total that the last one states; chunked framing is decoded; digests are verified.  Groups that are
complete within a file are joined where they are read, as a map-side sum would be; the parts of the others travel to
their origin.  A group holds one block.  Revisits take the size of the payload they refer to.  Joins on a digest are salted, as
a third of all pages may be empty or equal.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import bound_batches, cut, open_folder, scratch

_CHUNK = 16 << 10
#: Parts that the rows of one digest are dealt to.
SALTS = 32
_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
_DATE = "2024-01-01T00:00:00Z"  # a fixed capture date keeps archives of equal input equal
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _base32(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def _record(kind: str, block: bytes, fields: dict[str, str | None]) -> bytes:
    lines = [b"WARC/1.1", f"WARC-Type: {kind}".encode(), f"WARC-Date: {_DATE}".encode()]
    lines += [f"{k}: {v}".encode() for k, v in fields.items() if v is not None]
    lines.append(b"Content-Length: %d" % len(block))
    small = len(block) < 1 << 14  # a small window takes less time to set up
    packer = zlib.compressobj(2, zlib.DEFLATED, 16 + (13 if small else 15), 6 if small else 8)
    return packer.compress(b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def chunked(payload: bytes, size: int = _CHUNK) -> bytes:
    """HTTP/1.1 chunked framing of a payload."""
    parts = [b"%x\r\n%s\r\n" % (len(p), p) for p in (payload[i : i + size] for i in range(0, len(payload), size))]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(framed: bytes) -> bytes | None:
    """The payload of chunked framing (extensions and trailers are skipped); None if the framing is broken."""
    parts, at = [], 0
    while True:
        end = framed.find(b"\r\n", at)
        try:
            size = int(framed[at:end].split(b";")[0], 16) if end >= 0 else -1
        except ValueError:
            return None
        if size == 0:
            return b"".join(parts)
        at = end + 2 + size
        if size < 0 or framed[at : at + 2] != b"\r\n":
            return None
        parts.append(framed[end + 2 : at])
        at += 2


def payload_of(block: bytes) -> bytes | None:
    """The payload of an HTTP response block."""
    head, gap, body = block.partition(b"\r\n\r\n")
    if not gap:
        return None
    return unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body


def _one_line(value: str | None) -> str | None:
    return None if value is None else value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _any_line(value: str | None) -> str | None:
    return None if value is None else value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def _records_of(
    page: int | None,
    url: str | None,
    html: str | None,
    sha1: str,
    refers: int | None,
    revisit: bool,
    segment: int,
    place: str,
) -> Iterator[bytes]:
    """place: tells records of equal rows apart."""
    digest = "sha1:" + _base32(sha1)
    ident = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page} {digest} {place}')}>"
    common = {"WARC-Target-URI": _one_line(url), "WARC-Payload-Digest": digest, "Rookery-Page": None if page is None else str(page)}
    if revisit:
        yield _record("revisit", b"", {"WARC-Record-ID": ident, **common, "WARC-Profile": _PROFILE, "Rookery-Refers-To-Page": str(refers)})
        return
    block = _HEAD + chunked((html or "").encode())
    if len(block) <= segment:
        yield _record("response", block, {"WARC-Record-ID": ident, **common, "Content-Type": "application/http; msgtype=response"})
        return
    count = -(-len(block) // segment)
    for i in range(count):
        part = block[i * segment : (i + 1) * segment]
        if i == 0:
            yield _record("response", part, {"WARC-Record-ID": ident, **common, "WARC-Segment-Number": "1"})
        else:
            last = {"WARC-Segment-Total-Length": str(len(block))} if i == count - 1 else {}
            own = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{ident} {i}')}>"
            yield _record(
                "continuation",
                part,
                {"WARC-Record-ID": own, "WARC-Segment-Origin-ID": ident, "WARC-Segment-Number": str(i + 1), **last},
            )


def _write(uri: str, segment: int, file_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        fs, root = open_folder(uri)
        attempt, number, out, size, records, row = TaskContext.get().taskAttemptId(), 0, None, 0, 0, 0

        def closed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict(
                {"file": [f"{uri}/pages-{attempt:08d}-{number:06d}.warc.gz"], "records": [records], "bytes": [size]}
            )

        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "html", "sha1", "refers", "revisit")]
            for i in range(batch.num_rows):
                row += 1
                for data in _records_of(*(c[i].as_py() for c in columns), segment, f"{attempt} {row}"):
                    if out is not None and size + len(data) > file_bytes:
                        yield closed()
                        out = None
                    if out is None:
                        fs.create_dir(root, recursive=True)
                        number, size, records = number + 1, 0, 0
                        out = fs.open_output_stream(f"{root}/pages-{attempt:08d}-{number:06d}.warc.gz", compression=None)
                    out.write(data)
                    size, records = size + len(data), records + 1
        if out is not None:
            yield closed()

    return run, "file string, records long, bytes long"


def write_archives(pages: DataFrame, uri: str, least: int = 0, segment: int = 64 << 10, file_bytes: int = 8 << 20) -> DataFrame:
    """Writes ``pages(page_id, url, html)`` to ``uri`` when the result is computed: a row for each file.

    A null html is an empty payload; a null url or page id leaves its header out.  Rows that tie on the smallest page id of
    a payload are all responses.  A payload that only rows without a page id share has responses only.  Other columns are
    not archived.  An empty table writes no files.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    rows = rows.withColumns(
        {"sha1": F.sha1(F.coalesce("html", F.lit("")).cast("binary")), "size": F.coalesce(F.octet_length("html"), F.lit(0))}
    )
    first = rows.filter(F.col("size") >= least).groupBy("sha1").agg(
        F.min("page_id").alias("refers"),
        F.count("*").alias("copies"),
    ).filter("copies > 1").drop("copies")
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    known = rows.join(_salted(first), ["sha1", "salt"], "left")
    known = known.withColumn(
        "revisit",
        F.coalesce((F.col("size") >= least) & ~F.col("page_id").eqNullSafe(F.col("refers")) & F.col("refers").isNotNull(), F.lit(False)),
    )
    return known.select(
        "page_id",
        "url",
        F.when(~F.col("revisit"), F.col("html")).alias("html"),
        "sha1",
        "refers",
        "revisit",
    ).mapInArrow(*_write(uri, segment, file_bytes))


def _salted(small: DataFrame) -> DataFrame:
    return small.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


_MAGIC = b"\x1f\x8b\x08"


def _members(data: bytes) -> Iterator[bytes | None]:
    """The gzip members of a file; null for a stretch that is no whole member, after which the next one is sought by its first bytes."""
    at, step, sound = 0, 16 << 10, True
    while at < len(data):
        begin, reader, parts = at, zlib.decompressobj(31), []
        try:
            while not reader.eof and at < len(data):
                parts.append(reader.decompress(data[at : at + step]))
                at += step
            whole = reader.eof
        except zlib.error:
            whole = False
        if whole:
            at, sound = min(at, len(data)) - len(reader.unused_data), True
            yield b"".join(parts) + reader.flush()
            continue
        if sound:
            yield None
        at, sound = data.find(_MAGIC, begin + 1), False
        if at < 0:
            return


def _split_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and blocks of the records in one gzip member; an error if it is not made of whole records."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        fields = {k.strip().lower(): v.strip() for k, v in (x.split(":", 1) for x in lines[1:])}
        size = int(fields["content-length"])
        if size < 0 or end + 4 + size > len(data):
            raise ValueError("a record is shorter than it says")
        yield fields, data[end + 4 : end + 4 + size]
        at = end + 8 + size


_FIELDS = "record_id string, record_type string, page_id long, url string, stated string, refers_to long, number int, origin string, total long, payload_bytes long, payload_digest string, whole boolean, block binary"


def _arrow_schema() -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in _FIELDS.split(", "))])


def _measured(block: bytes, stated: str | None, keep: bool, total: int | None = None) -> dict:
    payload = payload_of(block) if total is None or total == len(block) else None
    if payload is None:
        return {"payload_bytes": None, "payload_digest": None, "whole": False, "block": None}
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    return {"payload_bytes": len(payload), "payload_digest": digest, "whole": stated in (None, digest), "block": payload if keep else None}


def _joined(parts: list[dict], keep: bool) -> dict:
    """The record that some parts of one origin, in order, make."""
    head = parts[0]
    if [p["number"] for p in parts] == list(range(1, len(parts) + 1)):
        got = _measured(b"".join(p["block"] for p in parts), head["stated"], keep, parts[-1]["total"] or -1)
    else:
        got = {"payload_bytes": None, "payload_digest": None, "whole": False, "block": None}
    return dict.fromkeys(_arrow_schema().names) | {
        k: head[k] for k in ("record_type", "page_id", "url", "stated")
    } | {"record_id": head["origin"]} | got


class _Rows:
    """Rows that leave as batches of some MB."""

    def __init__(self) -> None:
        self.rows: list[dict] = []
        self.held, self.schema = 0, _arrow_schema()

    def add(self, row: dict) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.held += len(row["block"] or b"") + 200
        if self.held > 4 << 20:
            yield from self.out()

    def out(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            yield pa.RecordBatch.from_pylist(self.rows, schema=self.schema)
            self.rows, self.held = [], 0


def _read(keep: bool):
    def number(x: str | None) -> int | None:
        return None if x is None else int(x)

    def content(path: str) -> bytes:
        folder, name = path.rsplit("/", 1)
        fs, root = open_folder(folder)
        with fs.open_input_file(f"{root}/{name}") as file:
            return file.read()

    damaged = dict.fromkeys(_arrow_schema().names) | {"record_type": "damaged", "whole": False}

    def records(path: str) -> Iterator[dict]:
        """Rows of all records; one of type ``damaged`` for each stretch or member that cannot be read, what follows it is read on."""
        for member in _members(content(path)):
            try:
                if member is None:
                    yield damaged
                else:
                    yield from records_of(member)
            except (ValueError, KeyError):
                yield damaged

    def records_of(member: bytes) -> Iterator[dict]:
        for f, block in _split_records(member):
            stated = (f.get("warc-payload-digest") or "").removeprefix("sha1:") or None
            row = {
                "record_id": f["warc-record-id"],
                "record_type": f["warc-type"],
                "page_id": number(f.get("rookery-page")),
                "url": _any_line(f.get("warc-target-uri")),
                "stated": stated,
            }
            row |= {
                "refers_to": number(f.get("rookery-refers-to-page")),
                "number": number(f.get("warc-segment-number")),
                "total": number(f.get("warc-segment-total-length")),
            }
            row["origin"] = f.get("warc-segment-origin-id", row["record_id"])
            if row["number"] is not None:
                yield row | {"payload_bytes": None, "payload_digest": None, "whole": None, "block": block}
            elif f["warc-type"] == "revisit":
                yield row | {"payload_bytes": None, "payload_digest": stated, "whole": True, "block": None}
            else:
                yield row | _measured(block, stated, keep)

    def complete(parts: list[dict]) -> bool:
        return [p["number"] for p in parts] == list(range(1, len(parts) + 1)) and parts[-1]["total"] == sum(len(p["block"]) for p in parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _Rows()
        for batch in batches:
            for path in batch.column("file").to_pylist():
                groups: dict[str, list[dict]] = {}  # of one file
                for row in records(path):
                    if row["number"] is None:
                        yield from rows.add(row)
                    else:
                        groups.setdefault(row["origin"], []).append(row)
                for parts in groups.values():
                    parts.sort(key=lambda p: p["number"])
                    for row in [_joined(parts, keep)] if complete(parts) else parts:
                        yield from rows.add(row)
        yield from rows.out()

    return run, _FIELDS


def _assemble(keep: bool):
    """The parts of each origin joined; rows come sorted by origin and number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = _Rows(), []
        for batch in batches:
            for row in batch.to_pylist():
                if held and held[0]["origin"] != row["origin"]:
                    yield from rows.add(_joined(held, keep))
                    held = []
                held.append(row)
        if held:
            yield from rows.add(_joined(held, keep))
        yield from rows.out()

    return run, _FIELDS


def read_archives(spark: SparkSession, files: DataFrame, keep_payload: bool = True) -> DataFrame:
    """One row per response or revisit in the archives that ``files(file)`` names; no files give no rows.

    ``record_id, record_type, page_id, url, refers_to, payload_bytes, payload_digest, whole`` and, if wanted, ``payload``.
    ``whole`` is false where a segment is missing or there twice, the total length differs, the framing is broken or the
    digest is not the stated one; size and digest are then null if no payload could be decoded.  A stretch or member of a
    file that cannot be read is a row of type ``damaged``, not whole and otherwise null; what follows it is read on.  A revisit's size comes from
    the response that it refers to, and is null if that is not there.
    """
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    records = cut(files.select("file").repartition(n, "file").mapInArrow(*_read(keep_payload)), "records")
    parts = records.filter("number is not null").repartition(n, "origin").sortWithinPartitions("origin", "number")
    joined = cut(parts.mapInArrow(*_assemble(keep_payload)), "joined")
    whole = records.filter("number is null").unionByName(joined)
    kept = ("record_id", "record_type", "page_id", "url", "refers_to", "payload_bytes", "payload_digest", "whole", "block")
    revisit = whole.filter("record_type = 'revisit'").select(*kept)
    wanted = revisit.groupBy("refers_to", "payload_digest").agg(F.count("*").alias("times")).drop("times")
    size = whole.filter("record_type = 'response' and whole").groupBy(
        F.col("page_id").alias("refers_to"),
        "payload_digest",
    ).agg(F.max("payload_bytes").alias("there"))
    found = _salted(wanted.join(size, ["refers_to", "payload_digest"]))
    revisit = revisit.withColumn("salt", F.pmod(F.xxhash64("record_id"), F.lit(SALTS)).cast("int"))
    revisit = revisit.join(found, ["refers_to", "payload_digest", "salt"], "left").withColumn("payload_bytes", F.col("there")).select(*kept)
    out = whole.filter("record_type <> 'revisit'").select(*kept).unionByName(revisit)
    return out.select(*kept[:-1], *([F.col("block").alias("payload")] if keep_payload else []))


def round_trip(pages: DataFrame, least: int = 0, segment: int = 64 << 10, keep_payload: bool = True) -> DataFrame:
    """Writes pages to archives in the shared folder and reads them back; see the two functions above."""
    bound_batches(pages.sparkSession)
    folder = scratch(pages.sparkSession, "warc")
    manifest = cut(write_archives(pages, folder, least, segment), "manifest")
    return read_archives(pages.sparkSession, manifest, keep_payload)
