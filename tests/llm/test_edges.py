"""Edges of the corpus operators: repeated rows, hot keys, clashing names, odd values, strings made to collide."""

import math
import random
from collections import Counter, defaultdict
from zlib import crc32

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from rookery.llm import chat, decontamination, kneser_ney, minhash, packing, quality_classifier, quality_rules, storage, substring, token_counts, warc
from rookery.llm import words as W
from rookery.llm.queries import QUERIES, SQL
from tests.llm.test_llm import DOCS, vocabulary
from tests.oracle import plain


def documents(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], DOCS)


def from_sql(folder, name):
    db = duckdb.connect()
    db.sql(f"create view documents as from read_parquet('{folder}/documents.parquet/*.parquet')")
    return db.sql(SQL[name]).df()


def opposite(n):
    """A Thue-Morse string of two letters and its complement: no polynomial hash of an odd base tells them apart."""
    a = "a"
    while len(a) < n:
        a += a.translate(str.maketrans("ab", "ba"))
    return a, a.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("n", [32, 1024])
def test_opposite_strings_are_told_apart(spark, tmp_path, n):
    a, b = opposite(n)
    rest = " ".join(f"w{i}" for i in range(34))
    both = [" ".join(x) for x in opposite(2048)]  # the same with words for letters
    docs = documents(spark, [f"{a} {rest}", f"{b} {rest}", a, b, *both])
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    for name in ("op2_substring_dedup", "op8_minhash_near_dedup"):
        assert plain(QUERIES[name](spark, str(tmp_path)).toPandas()) == plain(from_sql(tmp_path, name)), name
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary())
    got = {r.doc_id: r.ids_crc32 for r in QUERIES["op3_best_fit_packing"](spark, str(tmp_path)).filter("piece = 0").collect()}
    for i, text in ((2, a), (3, b)):
        assert got[i] == crc32(np.array(([*t.encode(text, add_special_tokens=False).ids, 0])[:2048], dtype="<u4").tobytes())
    model = kneser_ney.train(docs, F.col("doc_id") == 2, order=3)
    known = {r.doc_id: r.n_known for r in kneser_ney.score(docs, model).collect()}
    assert known[2] == 2 and known[3] == 1


def test_windows_of_one_hash_are_compared_by_their_words(monkeypatch):
    codes = np.array([1, 2, 3, 9, 1, 2, 3, 8, 1, 2, 4])
    at = np.arange(len(codes) - 2)
    got = substring._repeated(np.zeros(len(at), dtype=np.uint64), codes, at, 3)
    assert np.flatnonzero(got).tolist() == [0, 4]


def test_word_cache_tells_words_of_one_hash_apart(monkeypatch):
    import pyarrow as pa

    from rookery.llm import tokens

    texts = ["alpha beta gamma delta " * 3, "beta epsilon zeta ~ eta<|x|>", "theta iota alpha kappa"]
    want = [tokens.WordTokens(vocabulary()).tokenizer.encode(x, add_special_tokens=False).ids for x in texts]
    plain_hash = W.byte_hash
    monkeypatch.setattr(W, "byte_hash", lambda *x: plain_hash(*x) % np.uint64(3))
    cache = tokens.WordTokens(vocabulary())
    for _ in range(2):
        for x, ids in zip(texts, want):
            for c in W.chunks(pa.array([x])):
                assert cache.encode(c)[0].tolist() == ids


REPEATED = 10_000


def test_a_row_that_is_there_ten_thousand_times(spark, tmp_path):
    one = " ".join(f"r{i}" for i in range(60))
    rows = spark.range(REPEATED).select(
        F.lit(7).cast("long").alias("doc_id"),
        F.lit(one).alias("text"),
        F.lit("en").alias("lang"),
        F.lit("s").alias("source"),
        F.lit(1).cast("long").alias("n_chars"),
    )
    docs = rows.unionByName(documents(spark, ["another text " * 30, None, "x"]))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(7, 1, 0), (0, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, one[10:90])], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.range(REPEATED).select(
        F.lit(3).cast("long").alias("page_id"),
        F.lit("u").alias("url"),
        F.lit("same page " * 300).alias("html"),
    ).write.parquet(str(tmp_path / "pages.parquet"))
    spark.range(REPEATED).select(F.lit(50).cast("long").alias("vec_id"), F.array(F.lit(1.0), F.lit(2.0)).alias("embedding")).write.parquet(
        str(tmp_path / "embeddings.parquet")
    )
    spark.range(REPEATED).select(
        F.lit(1).cast("long").alias("conv_id"),
        (F.col("id") % 5000).alias("turn"),
        F.lit("user").alias("role"),
        F.lit("hi").alias("text"),
    ).write.parquet(str(tmp_path / "conversations.parquet"))
    found = {
        name: q(spark, str(tmp_path)).filter("doc_id = 7") for name, q in QUERIES.items() if not name.startswith(("op1_", "op9_", "op11_", "op13_", "pipeline"))
    }
    assert all(r.n_removed == 60 and r.n_words == 60 for r in found["op2_substring_dedup"].distinct().collect())
    packed = found["op3_best_fit_packing"].select("sequence_id", "offset", "length", "ids_crc32")
    assert packed.distinct().count() == REPEATED and packed.select("ids_crc32").distinct().count() == 1
    assert found["op4_quality_rules"].distinct().count() == 1 and found["op5_quality_classifier"].distinct().count() == 1
    assert found["op7_token_counts"].select("n_tokens").distinct().count() == 1
    assert [(r.component_id, r.kept) for r in found["op8_minhash_near_dedup"].distinct().collect()] == [(7, True)]
    assert found["op10_lm_scoring"].distinct().count() == 1
    assert found["op6_decontamination"].select("item_id", "edits").collect() == [(1, 0)]
    for name in (
        "op2_substring_dedup",
        "op3_best_fit_packing",
        "op4_quality_rules",
        "op7_token_counts",
        "op8_minhash_near_dedup",
        "op10_lm_scoring",
        "op12_periodic_runs",
    ):
        assert found[name].count() == REPEATED, name
    pages = QUERIES["op1_warc_reassembly"](spark, str(tmp_path))
    assert [
        tuple(r) for r in pages.groupBy("page_id", "payload_bytes", "record_type", "refers_to").count().collect()
    ] == [(3, 3000, "response", None, REPEATED)]
    assert QUERIES["op11_nearest_vectors"](spark, str(tmp_path)).count() == 0  # one id has no neighbour
    assert QUERIES["op13_source_divergence"](spark, str(tmp_path)).count() == 0  # a source alone in its language differs from nothing
    talk = QUERIES["op9_chat_formatting"](spark, str(tmp_path))
    assert talk.agg(F.sum("n_turns")).first()[0] == 5000


def test_extra_columns_with_the_names_of_results(spark):
    docs = documents(spark, ["a b c d e f g " * 8, "other words here", None, ""])
    names = [
        "doc",
        "print",
        "spans",
        "kept",
        "rest",
        "at",
        "own",
        "shard",
        "number",
        "rank",
        "sequence_id",
        "offset",
        "ids",
        "n_words",
        "n_removed",
        "score",
        "n_tokens",
        "held_out",
        "row",
        "length_",
        "before",
        "last",
        "shingles",
        "digest",
        "bucket",
        "salt",
        "most",
        "weird name",
    ]
    extra = docs.withColumns({n: F.concat(F.lit("extra "), F.lit(n)) for n in names})
    got = substring.remove_repeats(extra, k=5, keep_text=True)
    want = substring.remove_repeats(docs, k=5, keep_text=True)
    assert plain(got.select(want.columns).toPandas()) == plain(want.toPandas())
    assert got.select("spans").distinct().first().spans == "extra spans" and got.schema["n_words"].dataType.simpleString() == "bigint"
    pieces = packing.tokenised_pieces(docs, vocabulary(), keep_ids=False)
    packed = packing.best_fit(
        pieces.withColumns({n: F.lit(n) for n in ("shard", "rank", "number", "own", "before", "sequence_id", "offset")})
    )
    assert plain(packed.select("doc_id", "piece", "length").toPandas()) == plain(pieces.select("doc_id", "piece", "length").toPandas())
    assert packed.filter("shard = 'shard' and rank = 'rank'").count() == pieces.count() and packed.schema["offset"].dataType.simpleString() == "bigint"
    model = kneser_ney.train(extra, F.lit(True))
    scored = kneser_ney.score(extra, model)
    assert scored.schema["score"].dataType.simpleString() == "double" and scored.filter("spans = 'extra spans'").count() == 4
    for f in (
        lambda d: quality_rules.quality_rules(d),
        lambda d: minhash.near_duplicates(d),
        lambda d: decontamination.contaminated(d, d.select(F.col("doc_id").alias("item_id"), "text")),
        lambda d: packing.pack(d, vocabulary(), keep_ids=False).drop("sequence_id", "offset"),
    ):
        assert plain(f(extra).toPandas()) == plain(f(docs).toPandas())
    labels = spark.createDataFrame([(0, 1), (1, 0)], "doc_id long, quality int")
    assert plain(quality_classifier.scores(extra, labels).toPandas()) == plain(quality_classifier.scores(docs, labels).toPandas())


def test_crowded_buckets_equal_brute_force(spark, monkeypatch):
    """Documents that share a passage meet in the same buckets, in many components."""
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rng = random.Random(11)
    common = [f"c{i}" for i in range(12)]
    texts = []
    for _ in range(60):
        own = [f"t{rng.randrange(10**6)}" for _ in range(30)]
        for _ in range(rng.choice([1, 1, 1, 3])):
            copy = list(own)
            for _ in range(rng.randrange(3)):
                copy[rng.randrange(len(copy))] = f"t{rng.randrange(10**6)}"
            texts.append(" ".join(common + copy))
    rng.shuffle(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, k=3, percent=60, bands=24, rows=1).collect()}
    sets = [{tuple(w[i : i + 3]) for i in range(len(w) - 2)} for w in (x.split() for x in texts)]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if 100 * n >= 60 * (len(sets[i]) + len(sets[j]) - n):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    assert got == {i: find(i) for i in range(len(sets))}


def test_repeated_and_missing_ids_in_near_duplicates(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(20)) for x in "abc")
    rows = [(1, a), (2, a), (3, b), (3, b), (4, None), (5, ""), (6, " \n"), (None, a), (None, c), (7, "one"), (8, "ONE"), (9, c), (9, b)]
    got = Counter(
        tuple(r) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k=3, percent=85).collect()
    )
    for key, n in {
        (1, 18, 1, True): 1,
        (2, 18, 1, False): 1,
        (3, 18, 3, True): 2,
        (4, 0, 4, True): 1,
        (5, 0, 5, True): 1,
        (6, 0, 6, True): 1,
        (None, 18, None, True): 2,
        (7, 1, 7, True): 1,
        (8, 1, 7, False): 1,
    }.items():
        assert got[key] == n, key
    assert {k[2] for k in got if k[0] == 9} in ({3}, {9})  # one of its texts stands for the id


def edits(item, text):
    """Fewest edits of the item to a part of the text."""
    row = [0] * (len(text) + 1)
    for n, ch in enumerate(item):
        new = [n + 1]
        for j, t in enumerate(text):
            new.append(min(row[j] + (ch != t), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


@pytest.mark.parametrize("rate", [0.1, 0.3])
def test_short_items_equal_brute_force(spark, monkeypatch, rate):
    rng = random.Random(7)
    items = [
        "q",
        "ab",
        "abc",
        "hello",
        "é",
        " spaced  out ",
        *("".join(rng.choice("abcd ") for _ in range(n)).strip() or "z" for n in range(4, 90, 3)),
    ]
    docs = ["", "a", "xx q yy", "HELLO there", "spaced out", "é é", "c" * 300]
    for item in items:
        s = list(item)
        for _ in range(rng.randrange(2 + int(len(s) * rate))):
            k = rng.randrange(len(s)) if s else 0
            s[k : k + 1] = rng.choice([[], ["b"], ["c", "x"]])
        docs.append("zz " + "".join(s) + " zz")
    d = spark.createDataFrame([*enumerate(docs), (99, None)], "doc_id long, text string")
    b = spark.createDataFrame([*enumerate(items), (77, None), (78, " \n")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.edits for r in decontamination.contaminated(d, b, rate=rate).collect()}
    want = {}
    for i, text in enumerate(docs):
        x = decontamination.normalised(text)[0].tolist()
        for j, item in enumerate(items):
            y = decontamination.normalised(item.strip())[0].tolist()
            n = edits(y, x)
            if n <= math.floor(len(y) * rate + 1e-9):
                want[i, j] = n
    assert got == want
    monkeypatch.setattr(decontamination, "BLOCK_CHARS", 300)  # several passes
    again = {(r.doc_id, r.item_id): r.edits for r in decontamination.contaminated(d, b, rate=rate).collect()}
    assert again == want


def test_texts_and_items_of_one_letter(spark):
    docs = spark.createDataFrame([(1, "a" * 200_000 + "b"), (2, "ab" * 50_000)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a" * 400), (2, "a" * 399 + "c" * 60), (3, "ba" * 300)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.edits for r in decontamination.contaminated(docs, items).collect()}
    assert got == {(1, 1): 0, (2, 3): 0}


def test_flat_files_hold_the_tokenizers_ids(spark):
    from tokenizers import Tokenizer

    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").unionByName(
        spark.createDataFrame([(-1, None), (-2, ""), (-3, "~ <|endoftext|> a~b É")], "doc_id long, text string")
    ).collect()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    folder = storage.scratch(spark, "flat")
    written = storage.cut(token_counts.write_flat(docs, vocabulary(), folder), "order")
    found = token_counts.separator_scan(spark, folder, block_bytes=4096).join(written, ["file", "ordinal"]).collect()
    t = Tokenizer.from_file(vocabulary())
    t.encode_special_tokens = True
    root = folder.removeprefix("file://")
    files = {name: np.fromfile(f"{root}/{name}", dtype="<u2") for name in {r.file for r in found}}
    got = {r.doc_id: files[r.file][r.start : r.start + r.n_tokens].tolist() for r in found}
    assert got == {r.doc_id: t.encode(r.text or "", add_special_tokens=False).ids for r in rows}
    assert storage.cut(token_counts.write_flat(docs.limit(0), vocabulary(), storage.scratch(spark, "flat")), "order").count() == 0


def test_base_columns_of_language_model_scores(spark, tmp_path):
    rng = random.Random(3)
    texts = [
        " ".join(rng.choice(["A", "a", "b", "C,", "é", f"u{i}"]) for _ in range(rng.randrange(30))) for i in range(60)
    ] + [None, "", " \n"]
    docs = documents(spark, texts).unionByName(spark.createDataFrame([(None, "a b", "en", "s", 3)], DOCS))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    low = lambda t: [x.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for x in (t or "").split()]
    rows = [(r.doc_id, low(r.text)) for r in docs.collect()]
    held = {i: i is not None and crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    counts = Counter(w for i, t in rows if not held[i] for w in [*t, "</s>"])
    total = sum(counts.values())
    got = {r.doc_id: r for r in QUERIES["op10_lm_scoring"](spark, str(tmp_path)).collect()}
    assert any(held.values())
    for i, t in rows:
        tokens = [*t, "</s>"]
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(tokens), sum(w in counts for w in tokens), total)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (total * 1.0 + len(counts) + 1)) for w in tokens))


def test_held_out_folds(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in QUERIES["op5_quality_classifier"](spark, "/root/testdata/sf0.001").collect()}
    assert set(got) == {r.doc_id for r in docs.select("doc_id").collect()}
    assert all(r.held_out == (crc32(str(i).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.3) for i, r in got.items())
    spoilt = labels.withColumn("quality", F.when(quality_classifier.fold(5) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r.doc_id: r.score for r in quality_classifier.scores(docs, spoilt).collect()}
    assert all(again[i] == pytest.approx(r.score) for i, r in got.items())  # labels of the held-out fold change nothing


def test_segments_are_reassembled(spark):
    rng = random.Random(2)
    pages = [(i, f"http://h/{i}", "".join(rng.choice("<p>é \n") for _ in range(rng.choice([0, 10, 3000, 9000])))) for i in range(60)]
    table = spark.createDataFrame(pages, "page_id long, url string, html string")
    folder = storage.scratch(spark, "warc")
    for size in (8 << 20, 4096):  # small files: parts of a page lie in several
        files = storage.cut(warc.write_archives(table, f"{folder}-{size}", segment=2048, file_bytes=size), "manifest")
        assert files.agg(F.sum("records")).first()[0] > 120
        back = {r.page_id: r for r in warc.read_archives(spark, files).collect()}
        for i, url, text in pages:
            r = back[i]
            assert r.whole and r.url == url and r.payload_bytes == len(text.encode())
            assert r.record_type == "revisit" or bytes(r.payload) == text.encode()
    lost = warc.read_archives(spark, files.limit(files.count() // 2))
    assert lost.filter("not whole").count() > 0 and lost.filter("not whole and payload is not null").count() == 0
    assert warc.read_archives(spark, files.limit(0)).count() == 0


def test_nulls_and_ties_have_their_stated_results(spark, tmp_path):
    rows = [
        (None, "no id " * 20, None, None, 1),
        (1, None, "en", None, None),
        (2, "", None, "s", 0),
        (3, " \t\n ", "en", "s", 4),
        (4, "one", "en", "s", 3),
        (4, "one", "en", "s", 3),
    ]
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(4, None), (None, 1)], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame(
        [(None, "no id no id no id"), (5, None)],
        "item_id long, text string",
    ).write.parquet(str(tmp_path / "benchmark.parquet"))

    def rows_of(name, *columns):
        return sorted(map(tuple, QUERIES[name](spark, str(tmp_path)).select(*columns).collect()), key=str)

    assert rows_of("op2_substring_dedup", "doc_id", "n_words", "n_removed") == [
        (1, 0, 0),
        (2, 0, 0),
        (3, 0, 0),
        (4, 1, 0),
        (4, 1, 0),
        (None, 40, 40),
    ]
    assert rows_of("op3_best_fit_packing", "doc_id", "piece", "start") == [
        (1, 0, 0),
        (2, 0, 0),
        (3, 0, 0),
        (4, 0, 0),
        (4, 0, 0),
        (None, 0, 0),
    ]
    assert rows_of("op4_quality_rules", "doc_id", "n_words", "base_failed", "kept") == [
        (1, 0, True, False),
        (2, 0, True, False),
        (3, 0, True, False),
        (4, 1, True, False),
        (4, 1, True, False),
        (None, 40, True, False),
    ]
    assert rows_of("op5_quality_classifier", "doc_id", "score") == [(1, 0.5), (2, 0.5), (3, 0.5), (4, 0.5), (4, 0.5), (None, 0.5)]
    assert rows_of("op6_decontamination", "doc_id", "item_id", "edits") == [(None, None, 0)]
    assert [r[0] for r in rows_of("op7_token_counts", "doc_id", "n_tokens")] == [1, 2, 3, 4, 4, None]
    assert [r[:2] for r in rows_of("op10_lm_scoring", "doc_id", "n_tokens")] == [(1, 1), (2, 1), (3, 1), (4, 2), (4, 2), (None, 41)]
    talks = [(None, 1, "user", "x"), (1, None, None, None), (1, 0, "odd", "hi"), (1, 0, "odd", "hi"), (1, 0, "user", "hi")]
    table = spark.createDataFrame(talks, "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.alone is None): [(t.turn, t.role, t.text) for t in r.turns] for r in chat.transcripts(table).collect()}
    assert got == {(1, True): [(0, "user", "hi")], (1, False): [(None, "user", "")], (None, False): [(1, "user", "x")]}


def test_pipeline_equals_a_plain_version(spark, tmp_path, monkeypatch):
    """All stages but the classifier, whose decisions are given."""
    import corpus_pipeline
    from tokenizers import Tokenizer

    rng = random.Random(9)
    fresh = lambda n: [f"v{rng.randrange(10**7)}" for _ in range(n)]
    passage, item = fresh(60), fresh(30)
    texts = [fresh(rng.choice([5, 60, 300, 2500])) for _ in range(30)]
    texts += [
        list(texts[1]),
        [*texts[2][:-1], "changed"],
        fresh(20) + passage + fresh(20),
        passage + fresh(45),
        fresh(9) + item + fresh(9),
        [],
        fresh(40),
    ]
    bad = {6, len(texts) - 1}
    docs = documents(spark, [" ".join(t) for t in texts])
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, 1)], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, " ".join(item))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    monkeypatch.setattr(
        quality_classifier,
        "rejected",
        lambda d, labels, least: d.filter(F.col("doc_id").isin(*bad)).select("doc_id", F.xxhash64("text").alias("print")),
    )
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    left = {i: t for i, t in enumerate(texts) if i not in bad}
    sets = {i: {tuple(t[j : j + 5]) for j in range(len(t) - 4)} or ({tuple(t)} if t else set()) for i, t in left.items()}
    for i in sorted(left):
        if any(j in left and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) for j in range(i)):
            del left[i]
    windows = Counter(tuple(t[j : j + 35]) for t in left.values() for j in range(len(t) - 34))
    for i, t in left.items():
        gone = {k for j in range(len(t) - 34) if windows[tuple(t[j : j + 35])] > 1 for k in range(j, j + 35)}
        left[i] = [w for k, w in enumerate(t) if k not in gone]
    left = {i: t for i, t in left.items() if " ".join(item) not in " ".join(t)}
    t = Tokenizer.from_file(vocabulary())
    want = {}
    for i, words in left.items():
        ids = [*t.encode(" ".join(words), add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), 2048):
            part = ids[k : k + 2048]
            want[i, k // 2048] = (k, len(part), crc32(np.array(part, dtype="<u4").tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got} == want
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for parts in places.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))] and sum(n for _, n in parts) <= 2048
