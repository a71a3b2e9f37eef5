"""Damaged archives, repeated task attempts, limits of keys: what is left is read, nothing counts twice."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from rookery.llm import kneser_ney, storage, token_counts, warc
from tests.llm.test_llm import DOCS, vocabulary


def archive(spark, folder, n=4):
    pages = spark.createDataFrame([(i, f"http://a/{i}", f"page {i} " * 50) for i in range(n)], "page_id long, url string, html string")
    files = warc.write_archives(pages.coalesce(1), str(folder), 0, 1 << 20).collect()
    with open(files[0].file.removeprefix("file:"), "rb") as f:
        return f.read()


def back(spark, folder, data):
    path = folder / "x.warc.gz"
    path.write_bytes(data)
    rows = warc.read_archives(spark, spark.createDataFrame([(str(path),)], "file string")).collect()
    return sorted((r.page_id for r in rows if r.record_type == "response" and r.whole), key=str), [r for r in rows if r.record_type == "damaged"]


def members(data):
    return [gzip.compress(m, mtime=0) for m in warc._members(data)]


def test_damaged_members_cost_no_others(spark, tmp_path):
    data = archive(spark, tmp_path / "a")
    parts = members(data)
    assert back(spark, tmp_path, b"".join(parts)) == ([0, 1, 2, 3], [])
    pages = len(parts) - 4  # members before the pages, if any
    first = pages + 1
    cut, flipped = parts[first][: len(parts[first]) // 2], bytearray(parts[first])
    flipped[len(flipped) // 2] ^= 0xFF
    foreign = gzip.compress(b"no record at all"), gzip.compress(b"WARC/1.0\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\n"), gzip.compress(b"WARC/1.0\r\nContent-Length: 99\r\n\r\nabc")
    for bad in (cut, bytes(flipped), *foreign, b"plain text \x1f\x8b\x08 and more"):
        kept, damaged = back(spark, tmp_path, b"".join([*parts[:first], bad, *parts[first + 1 :]]))
        assert len(kept) == 3 and len(damaged) == 1 and not damaged[0].whole and damaged[0].page_id is None
    kept, damaged = back(spark, tmp_path, b"".join(parts)[:-7])
    assert len(kept) == 3 and len(damaged) == 1
    assert back(spark, tmp_path, b"") == ([], [])


def test_files_of_other_attempts_do_not_count(spark, tmp_path):
    docs = spark.createDataFrame([(i, "some words here " * i, "en", "s", 1) for i in range(6)], DOCS)
    folder = str(tmp_path / "flat")
    frame = token_counts.write_flat(docs.coalesce(1), vocabulary(), folder)
    frame.collect()  # an attempt whose rows are lost
    written = storage.cut(frame, "order")
    assert len(os.listdir(folder)) == 2
    counts = token_counts.separator_scan(spark, folder, manifest=written)
    assert counts.count() == 6 and counts.join(written, ["file", "ordinal"], "left_anti").count() == 0
    assert token_counts.separator_scan(spark, folder).count() == 12


def test_more_words_than_keys_can_hold_are_refused(spark, monkeypatch):
    size = kneser_ney.MOST_WORDS + 3
    assert size * size - 1 < 1 << 63 <= (size + 1) * (size + 1) - 1
    docs = spark.createDataFrame([(1, "a b c d e", "en", "s", 1)], DOCS)
    monkeypatch.setattr(kneser_ney, "MOST_WORDS", 4)
    with pytest.raises(ValueError, match="distinct words"):
        kneser_ney.train(docs, F.lit(True), order=3)


def test_many_buckets_give_the_same_scores(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"a b c a b d {'x' * (i % 3)} w{i % 7} a b c", "en", "s", 1) for i in range(40)], DOCS)
    want = {r.doc_id: r.score for r in kneser_ney.score(docs, kneser_ney.train(docs, F.col("doc_id") % 4 > 0, order=3)).collect()}
    monkeypatch.setattr(kneser_ney, "BUCKET_BYTES", 3)
    model = kneser_ney.train(docs, F.col("doc_id") % 4 > 0, order=3)
    assert model.buckets > 200
    got = {r.doc_id: r.score for r in kneser_ney.score(docs, model).collect()}
    assert got == pytest.approx(want, abs=1e-9)
