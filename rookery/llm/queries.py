"""The registered queries of the operators in this subpackage, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chat,
    decontamination,
    divergence,
    kneser_ney,
    minhash,
    packing,
    periodic_runs,
    quality_classifier,
    quality_rules,
    storage,
    substring,
    token_counts,
    vector_search,
    warc,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc_reassembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written to WARC archives in segments of 2 KiB, so that most pages have several, and read back."""
    back = warc.round_trip(_table(spark, sf_dir, "pages"), least=0, segment=2 << 10, keep_payload=False)
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left after removing every window of 35 words that starts anywhere else too."""
    return substring.remove_repeats(_table(spark, sf_dir, "documents"), k=35, keep_text=False)


def _vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of all documents' pieces in sequences of at most 2048 tokens."""
    return packing.pack(_table(spark, sf_dir, "documents"), _vocabulary(), capacity=2048, end=0, keep_ids=False)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of each text and the verdict by thresholds from the sketches of its language and source."""
    judged = quality_rules.quality_rules(_table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all texts by a model of the labels outside the held-out fold."""
    scored = quality_classifier.scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item within one edit in ten characters, and where."""
    return decontamination.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), rate=0.1)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens per document, read from flat files of all documents by a scan for the separator."""
    folder = storage.scratch(spark, "flat")
    written = storage.cut(token_counts.write_flat(_table(spark, sf_dir, "documents"), _vocabulary(), folder), "order")
    counts = token_counts.separator_scan(spark, folder, manifest=written)
    return counts.join(written, ["file", "ordinal"], "left").select("doc_id", "file", "ordinal", "start", "n_tokens")


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of 3-word shingles have a Jaccard similarity of 0.85 or more."""
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), k=3, percent=85)


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roles and canonical turns of all conversations' transcripts, by a model of those outside the held-out fold."""
    plain = storage.cut(chat.transcripts(_table(spark, sf_dir, "conversations")), "transcripts")
    held = F.coalesce(F.crc32(F.col("conv_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    parsed = chat.parse(plain.drop("turns"), chat.train(plain.filter(~held)))
    roles = F.array_join("parsed.role", ",")
    return parsed.select(
        "conv_id",
        "alone",
        "part",
        held.alias("held_out"),
        "n_lines",
        F.size("parsed").cast("long").alias("n_turns"),
        roles.alias("roles"),
        "rendered",
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of all texts under a Kneser-Ney trigram model of those whose id's crc32 modulo 7 is not 2."""
    docs = _table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    model = kneser_ney.train(docs, ~held, order=3)
    scored = kneser_ney.score(docs, model)
    return scored.select(
        "doc_id",
        held.alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        "perplexity",
    )


def op11_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of each vector whose id is divisible by 50, by one-bit codes and exact reranking."""
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    return vector_search.nearest(vectors, F.col("vec_id") % 50 == 0, k=5)


def _with_planted_period(docs: DataFrame) -> DataFrame:
    """``doc_id, text``; a text whose id's crc32 is divisible by 10 goes on periodically from some word, as the contract says."""
    h = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary"))
    g = F.floor(h / 10)
    w = F.array_remove(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", -1), "")

    def periodic(x: Column) -> Column:
        a = (g % F.size(x)).cast("int")
        p = (1 + F.floor((F.size(x) - a) / (3 + g % 8))).cast("int")
        at = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p)
        return F.when(F.size(x) > 0, F.array_join(F.transform(F.sequence(F.lit(0), F.size(x) - 1), lambda i: F.get(x, at(i))), " "))

    return docs.select("doc_id", F.when(h % 10 == 0, quality_rules.let(w, periodic)).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of four and more periods in all texts, the strongest of each text, and digests of runs and collapsed texts."""
    found = periodic_runs.periodic_runs(_with_planted_period(_table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda x: F.concat_ws(",", x["start"], x["length"], x["period"]))
    said = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    best = found.withColumn("x", periodic_runs.strongest(F.col("runs")))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "x.start",
        "x.length",
        "x.period",
        F.expr("1000 * x.length div x.period").alias("exponent_milli"),
        F.sha2(said, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the term shares of sources lie apart, by pairs within a language, and the terms that set a source off most."""
    return divergence.audit(_table(spark, sf_dir, "documents"), least_docs=10, top=10)


_WORDS = r"[^\x20\x09-\x0D]+"

SQL_WARC = """
with p as (select page_id, coalesce(html, '') h, sha1(coalesce(html, '')) x from pages),
f as (select x, min(page_id) first from p group by x),
d as (select p.*, first, (select string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(x, 1 + 5 * g, 5))::bigint >> (15 - 5 * b)) & 31)::int + 1, 1), '' order by g, b)
    from range(8) t(g), range(4) u(b)) digest from p join f using (x))
select page_id, octet_length(encode(h))::bigint payload_bytes, digest payload_digest, case when page_id = first then 'response' else 'revisit' end record_type,
    case when page_id <> first then first end refers_to from d"""

SQL_SUBSTRING = rf"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '{_WORDS}') w from documents),
v as (select doc_id, i, sha256(array_to_string(w[i:i + 34], ' ')) g from (select doc_id, w, unnest(range(1, len(w) - 33)) i from d)),
r as (select doc_id, i from (select doc_id, i, count(*) over (partition by g) c from v) where c > 1),
t as (select doc_id, w[i] word, i from (select doc_id, w, unnest(range(1, len(w) + 1)) i from d)),
m as (select t.doc_id, t.i, t.word, max(r.i) over (partition by t.doc_id order by t.i rows between 34 preceding and current row) is not null gone
    from t left join r on r.doc_id = t.doc_id and r.i = t.i),
k as (select doc_id, count(*) filter (gone) n_removed, string_agg(word, ' ' order by i) filter (not gone) kept from m group by 1)
select d.doc_id, len(w)::bigint n_words, coalesce(n_removed, 0)::bigint n_removed, sha256(coalesce(kept, '')) kept_sha256 from d left join k using (doc_id)"""

SQL_NEAR = rf"""
with recursive d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORDS}') w from documents),
s as (select distinct doc_id, g from (select doc_id, unnest(case when len(w) between 1 and 2 then [array_to_string(w, ' ')] else list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) end) g from d)),
n as (select doc_id, count(*) n from s group by 1),
p as (select a.doc_id a, b.doc_id b, count(*) k from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
l as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * k >= 85 * (x.n + y.n - k)),
e as (select a u, b v from l union select b, a from l),
r as (select u, u v from e union select r.u, e.v from r join e on e.u = r.v),
c as (select u, min(v) c from r group by 1)
select d.doc_id, coalesce(n.n, 0)::bigint n_shingles, coalesce(c.c, d.doc_id) component_id, coalesce(c.c, d.doc_id) = d.doc_id kept
from d left join n on n.doc_id = d.doc_id left join c on c.u = d.doc_id"""

SQL_NEAREST = """
with v as (select vec_id, min(embedding::double[]) e from embeddings where vec_id is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0 group by 1),
p as (select q.vec_id query_id, v.vec_id, list_cosine_similarity(q.e, v.e) score from v q join v on q.vec_id <> v.vec_id and len(q.e) = len(v.e) where q.vec_id % 50 = 0)
select query_id, rank::int rank, vec_id, score from (select *, row_number() over (partition by query_id order by score desc, vec_id) rank from p) where rank <= 5"""

SQL_DIVERGENCE = r"""
with d as (select row_number() over () r, coalesce(lang, '') lang, coalesce(source, '') source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{80}-\x{10FFFF}]+') w from documents),
c as (select lang, source, term, count(*) n, count(distinct r) docs from (select r, lang, source, unnest(w) term from d) group by all),
k as (select lang, term, sum(n)::hugeint n from c group by all having sum(docs) >= 10),
v as (select lang, count(*)::hugeint v, sum(n)::hugeint n from k group by 1),
g as (select distinct lang, source from d),
s as (select lang, source, sum(c.n)::hugeint n from c join k using (lang, term) group by all),
p as (select g.lang, g.source, k.term, coalesce(c.n, 0) n, 1 + (1000000000::hugeint * (coalesce(c.n, 0) + 2)) // (coalesce(s.n, 0) + 2 * v.v) p, 1 + (1000000000::hugeint * (k.n + 2)) // (v.n + 2 * v.v) q
    from g join k on k.lang = g.lang join v on v.lang = g.lang left join s on s.lang = g.lang and s.source = g.source
    left join c on c.lang = g.lang and c.source = g.source and c.term = k.term),
m as (select a.lang, a.source, b.source item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) x from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
o as (select a.lang, a.source, 'pair' part, b.source item, coalesce(x, 0)::bigint as value from g a join g b on a.lang = b.lang and a.source <> b.source
    left join m on m.lang = a.lang and m.source = a.source and m.item = b.source
    union all select lang, source, 'term', term, (((p - q) * (p - q)) // (p + q))::bigint from p where n > 0 and p > q)
select lang, source, part, item, value, rank::int rank from (select *, row_number() over (partition by lang, source, part order by value desc, item) rank from o) where part = 'pair' or rank <= 10"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc_reassembly": op1_warc_reassembly,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_quality_rules": op4_quality_rules,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_decontamination": op6_decontamination,
    "op7_token_counts": op7_token_counts,
    "op8_minhash_near_dedup": op8_minhash_near_dedup,
    "op9_chat_formatting": op9_chat_formatting,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_nearest_vectors": op11_nearest_vectors,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_source_divergence": op13_source_divergence,
    "pipeline": pipeline,
}

SQL: dict[str, str] = {
    "op1_warc_reassembly": SQL_WARC,
    "op2_substring_dedup": SQL_SUBSTRING,
    "op4_quality_rules": quality_rules.sql(),
    "op8_minhash_near_dedup": SQL_NEAR,
    "op11_nearest_vectors": SQL_NEAREST,
    "op13_source_divergence": SQL_DIVERGENCE,
}
