"""The corpus pipeline: quality, near duplicates, repeated passages, benchmark passages, packing.

Every stage takes empty tables and gives an empty one; columns other than those of documents are dropped by the first.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rookery.llm import decontamination, minhash, packing, quality_classifier, storage, substring

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: The classifier's random features and the star components are no SQL.
ORACLE_SQL = None


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learnt on the documents given, scores 0.3 or more.

    Rows are told apart by id and text, repeated rows share their fate; null texts are scored as empty ones.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    out = quality_classifier.rejected(docs, labels, least=0.3)
    keyed = _documents(docs).withColumns({"k": F.col("doc_id").cast("long"), "p": F.xxhash64("text")})
    gone = out.select(F.col("doc_id").alias("k"), F.col("print").alias("p"))
    same = keyed["k"].eqNullSafe(gone["k"]) & (keyed["p"] == gone["p"])
    return _documents(keyed.join(gone, same, "left_anti"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest id) of each group that links of similarity 0.8 on five-word shingles make.

    Rows that repeat an id are one if their texts are the same and documents of their own if not; rows without an id stay.
    """
    keyed = _documents(docs).filter("doc_id is not null").withColumns({"k": F.col("doc_id").cast("long"), "p": F.xxhash64("text")})
    first = keyed.groupBy("k").agg(F.min("p").alias("least"), F.max("p").alias("most"))
    several = first.filter("least <> most").select("k", "least")
    if several.limit(1).count():
        # a further text of an id is compared under a hash of both, and named by its id again afterwards
        keyed = keyed.join(several, "k", "left").withColumn(
            "s",
            F.when(F.col("p") == F.coalesce("least", "p"), F.col("k")).otherwise(F.xxhash64("k", "p")),
        ).drop("least")
        found = minhash.near_duplicates(
            keyed.select(F.col("s").alias("doc_id"), "text"),
            k=5,
            percent=80,
        ).select(F.col("doc_id").alias("s"), "component_id").distinct()
        kept = keyed.select("k", "p", "s").join(found, "s").groupBy("component_id").agg(F.min(F.struct("k", "p")).alias("x")).select("x.k", "x.p")
    else:
        found = minhash.near_duplicates(docs, k=5, percent=80).filter("kept and doc_id is not null").select(F.col("doc_id").alias("k"))
        kept = found.distinct().join(first.select("k", F.col("least").alias("p")), "k")
    rest = [c for c in COLUMNS if c not in ("doc_id", "text")]
    named = keyed.join(kept, ["k", "p"], "left_semi").groupBy("k", "p").agg(
        F.min(F.struct("doc_id", "text", *rest)).alias("x")
    ).select("x.*")
    return named.select(*COLUMNS).unionByName(_documents(docs).filter("doc_id is null"))


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the words that repeated windows of 35 words cover; ``n_chars`` is counted anew, null texts become empty."""
    left = substring.remove_repeats(_documents(docs), k=35, keep_text=True)
    return _documents(left.withColumn("n_chars", F.char_length("text").cast("long")))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found; null and empty texts stay."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    keyed = _documents(docs).withColumn("p", F.xxhash64("text"))  # whether an item is found depends on the text alone
    bad = decontamination.contaminated(
        keyed.select(F.col("p").alias("doc_id"), "text"),
        items,
        rate=0.1,
    ).select(F.col("doc_id").alias("p")).distinct()
    return _documents(keyed.join(bad, "p", "left_anti"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, placed in sequences of at most 2048 tokens; an empty text is its end id alone."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=2048, end=0, keep_ids=False)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("substrings", substrings),
    ("benchmark", benchmark),
    ("pack", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to the documents; each result is written to the shared folder and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        before, docs = docs, storage.cut(stage(spark, docs, sf_dir), name)
        storage.forget(before)
    return STAGES[-1][1](spark, docs, sf_dir)
