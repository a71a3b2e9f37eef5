import base64
import hashlib
import itertools
import math
import random
from collections import Counter, defaultdict
from zlib import crc32

import duckdb
import numpy as np
import pytest

from pyspark.sql import functions as F

from rookery.llm import chat, components, decontamination, kneser_ney, minhash, packing, quality_classifier, quality_rules, storage, substring, token_counts, warc
from rookery.llm.queries import QUERIES, SQL
from tests.oracle import plain, same

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def vocabulary():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    same(spark, SF, QUERIES[name], SQL[name])


def odd_documents(spark):
    passage = " ".join(f"w{i}" for i in range(40))
    texts = [
        None,
        "",
        " \n\t ",
        "one",
        "a b c",
        passage,
        "start " + passage,
        passage,
        "é " * 30,
        "same " * 400,
        "x" * 300_000,
        "~ <|endoftext|> a~b",
        passage.upper(),
    ]
    rows = [(i, t, None if i % 3 == 0 else "en", None if i % 4 == 0 else "s", None) for i, t in enumerate(texts)]
    rows += [(None, "no id " * 20, None, None, 1), (5, passage, "en", "s", 3)]
    return spark.createDataFrame(rows, DOCS)


def queried(spark, tmp_path, docs, name, **tables):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    for k, t in tables.items():
        t.write.parquet(str(tmp_path / f"{k}.parquet"))
    return QUERIES[name](spark, str(tmp_path))


@pytest.mark.parametrize("name", ["op2_substring_dedup", "op4_quality_rules"])
def test_odd_documents_equal_sql(spark, tmp_path, name):
    docs = odd_documents(spark).filter("doc_id is not null").dropDuplicates(["doc_id"])
    got = queried(spark, tmp_path, docs, name).toPandas()
    db = duckdb.connect()
    db.sql(f"create view documents as from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert plain(got) == plain(db.sql(SQL[name]).df())


@pytest.mark.parametrize("empty", [False, True])
def test_every_operator_takes_odd_and_empty_tables(spark, tmp_path, empty):
    docs = odd_documents(spark).withColumns({"print": F.lit(1), "spans": F.lit("x"), "score": F.lit(2)})
    labels = spark.createDataFrame([(3, None, 1), (4, 1, None), (5, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(None, None), (1, ""), (2, "w1 w2 w3 w4 w5 w6"), (2, "w1 w2 w3 w4 w5 w6")], "item_id long, text string")
    pages = spark.createDataFrame(
        [(1, None, None), (None, "u\r\nv", "p"), (2, "u", "p"), (2, "u", "p"), (3, "%0A", "")],
        "page_id long, url string, html string",
    )
    talks = spark.createDataFrame(
        [(1, 0, "user", "hi"), (1, None, None, None), (None, 1, "odd", "x\n\ny"), (1, 0, "user", "hi")],
        "conv_id long, turn long, role string, text string",
    )
    vectors = spark.createDataFrame(
        [(0, [1.0, 2.0], 1), (1, [2.0, None], 1), (None, [1.0], 1), (2, [0.5, 0.1], None), (2, None, 1)],
        "vec_id long, embedding array<float>, label int",
    )
    if empty:
        docs, labels, bench, pages, talks, vectors = (t.limit(0) for t in (docs, labels, bench, pages, talks, vectors))
    n = docs.count()
    folder = tmp_path / "t"
    folder.mkdir()
    for name, t in {
        "documents": docs,
        "labels": labels,
        "benchmark": bench,
        "pages": pages,
        "conversations": talks,
        "embeddings": vectors,
    }.items():
        t.write.parquet(str(folder / f"{name}.parquet"))
    rows = {name: q(spark, str(folder)).count() for name, q in QUERIES.items()}
    for name in (
        "op2_substring_dedup",
        "op4_quality_rules",
        "op5_quality_classifier",
        "op7_token_counts",
        "op8_minhash_near_dedup",
        "op10_lm_scoring",
        "op12_periodic_runs",
    ):
        assert rows[name] == n, name
    assert rows["op1_warc_reassembly"] == pages.count()


def test_archives_round_trip_and_damage(spark):
    big = "ü<p>" * 60_000
    pages = spark.createDataFrame(
        [(1, "http://a/\n", big), (2, "http://b/", big), (3, None, "x"), (4, "c", None), (5, "d", "")],
        "page_id long, url string, html string",
    )
    back = {r.page_id: r for r in warc.round_trip(pages, segment=50_000).collect()}
    assert back[1].payload == big.encode() and back[1].record_type == "response" and back[1].url == "http://a/\n"
    assert (back[2].record_type, back[2].refers_to, back[2].payload_bytes) == ("revisit", 1, len(big.encode()))
    assert back[5].refers_to == 4 and back[4].payload_digest == base64.b32encode(hashlib.sha1(b"").digest()).decode()
    assert all(r.whole for r in back.values())
    assert all(r.record_type == "response" for r in warc.round_trip(pages, least=10**9).collect())
    block = warc._HEAD + warc.chunked(b"abc" * 9)
    assert warc.payload_of(block) == b"abc" * 9 and warc.unchunked(b"5\r\nab") is None and warc.unchunked(b"zz") is None
    import pyarrow as pa

    row = dict.fromkeys(warc._arrow_schema().names) | {
        "number": 2,
        "record_type": "response",
        "page_id": 1,
        "total": 99,
        "block": block,
        "origin": "o",
    }
    for rows in ([row], [row | {"number": 1}, row], [row | {"number": 1, "total": None}, row | {"number": 1}, row]):
        batch = pa.RecordBatch.from_pylist(rows, schema=warc._arrow_schema())
        got = [r for b in warc._assemble(True)[0](iter([batch])) for r in b.to_pylist()]
        assert len(got) == 1 and got[0]["whole"] is False and got[0]["block"] is None


def test_packing_is_gapless_and_tight(spark):
    rng = random.Random(3)
    texts = [
        " ".join(rng.choice("alpha beta gamma d e".split()) for _ in range(rng.choice([0, 3, 200, 700, 900, 2500]))) for _ in range(300)
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = packing.pack(docs, vocabulary(), capacity=2048).collect()
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary())
    by_doc = defaultdict(dict)
    by_sequence = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id][r.piece] = r
        by_sequence[r.sequence_id].append((r.offset, r.length))
        assert r.ids_crc32 == crc32(r.ids)
    for i, x in enumerate(texts):
        ids = np.array(t.encode(x, add_special_tokens=False).ids + [0], dtype="<u4").tobytes()
        assert b"".join(bytes(by_doc[i][k].ids) for k in sorted(by_doc[i])) == ids
    for parts in by_sequence.values():
        assert [o for o, _ in sorted(parts)] == list(
            np.cumsum([0] + [n for _, n in sorted(parts)])[:-1]
        ) and sum(n for _, n in parts) <= 2048
    assert len(by_sequence) <= 1.03 * sum(r.length for r in rows) / 2048 + 1


def test_separator_scan_meets_block_borders(spark):
    docs = spark.createDataFrame([(i, "word " * (i % 7 * 5)) for i in range(60)], "doc_id long, text string").repartition(2)
    folder = storage.scratch(spark, "flat")
    written = storage.cut(token_counts.write_flat(docs, vocabulary(), folder), "order")
    for block in (2, 14, 1 << 20):
        got = token_counts.separator_scan(spark, folder, block_bytes=block).join(written, ["file", "ordinal"]).collect()
        assert {r.doc_id: r.n_tokens for r in got} == {i: i % 7 * 5 for i in range(60)}


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 200)] + [(500, 501), (501, 501)], "u long, v long")
    got = {r.node: r.component for r in components.components(edges).collect()}
    assert all(got[i] == 1 for i in range(1, 201)) and got[501] == 500


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(8)
    base = [[f"t{rng.randrange(900)}" for _ in range(rng.randint(3, 120))] for _ in range(40)]
    texts = []
    for b in base:
        for _ in range(rng.randint(1, 5)):
            c = list(b)
            for _ in range(rng.randrange(4)):
                c[rng.randrange(len(c))] = f"t{rng.randrange(900)}"
            texts.append(" ".join(c))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, k=5, percent=80).collect()}
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)} for w in (x.split() for x in texts)]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if 100 * n >= 80 * (len(sets[i]) + len(sets[j]) - n):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    assert got == {i: find(i) for i in range(len(sets))}


def test_crowded_minimisers_give_the_same_spans(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    a = substring.remove_repeats(docs, k=20, keep_text=False).toPandas()
    assert plain(a) == plain(substring.remove_repeats(docs, k=20, hot=1, keep_text=False).toPandas())


def test_decontamination_equals_brute_force(spark):
    rng = random.Random(5)
    letters = "etaoin shr"
    items, docs = [], []
    for i in range(25):
        item = "".join(rng.choice(letters) for _ in range(rng.randint(60, 160))).strip(" ")
        items.append((i, item))
        s = list(item)
        for _ in range(rng.randrange(len(s) // 7)):
            k = rng.randrange(len(s))
            s[k : k + 1] = rng.choice([[], [rng.choice(letters)], [s[k], "x"]])
        docs.append((i, "Some words é " + "".join(s).upper() + "  and  more."))
    docs.append((99, items[0][1][:50]))
    docs.append((100, items[0][1][50:]))  # a passage cut between two documents is in neither
    got = {
        (r.doc_id, r.item_id): r.edits for r in decontamination.contaminated(
            spark.createDataFrame(docs, "doc_id long, text string").coalesce(1),
            spark.createDataFrame(items, "item_id long, text string"),
        ).collect()
    }
    want = {}
    for d, text in docs:
        x = decontamination.normalised(text)[0].tolist()
        for i, item in items:
            y = decontamination.normalised(item)[0].tolist()
            row = [0] * (len(x) + 1)
            for n, ch in enumerate(y):
                new = [n + 1]
                for j, t in enumerate(x):
                    new.append(min(row[j] + (ch != t), row[j + 1] + 1, new[j] + 1))
                row = new
            if min(row) <= len(y) // 10:
                want[d, i] = min(row)
    assert got == want


def test_classifier_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_classifier.scores(docs, labels).filter("held_out").join(labels, "doc_id").collect()
    right = sum((r.score >= 0.3) == (r.quality == 1) for r in rows)
    assert len(rows) > 50 and right >= 0.9 * len(rows) and all(0 <= r.score <= 1 for r in rows)
    rising = quality_classifier.isotonic(np.array([0, 3, 1, 9.0]), np.array([1, 4, 4, 9.0]))
    assert list(rising) == sorted(rising) and rising[1] == rising[2] == pytest.approx(4.02 / 8.04)


def quality_documents(spark):
    rng = random.Random(6)
    rows = []
    for source, symbols in (("plain", 0), ("code", 6)):
        for i in range(300):
            words = [f"w{rng.randrange(10**6)}" for _ in range(80)]
            for k in range(symbols and rng.randrange(symbols, 3 * symbols)):
                words[k] += "$"
            rows.append((len(rows), " ".join(words), "en", source, None))
    rows.append((1000, " ".join(f"a{j}$$$" for j in range(80)), "en", "plain", None))
    rows.append((1001, " ".join(f"b{j:06d}" + "$" * (j < 12) for j in range(80)), "en", "code", None))
    return spark.createDataFrame(rows, DOCS)


def test_quality_rules_take_each_sources_own_limits(spark):
    docs = quality_documents(spark)
    counts = quality_rules.base_counts(docs).cache()
    found = {r.source: r for r in quality_rules.thresholds(counts).collect()}
    assert 2 * found["plain"].symbols < found["code"].symbols
    kept = {r.doc_id: r.kept for r in quality_rules.verdicts(counts).collect()}
    assert not kept[1000] and kept[1001] and sum(kept.values()) > 580
    assert kept == {r.doc_id: r.kept for r in quality_rules.verdicts(counts, broadcast_groups=0).collect()}


def test_quality_limits_differ_between_groups(spark):
    counts = quality_rules.base_counts(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).cache()
    rows = quality_rules.thresholds(counts).collect()
    for metric in quality_rules.RANKS:
        assert len({r[metric] for r in rows}) > 10, metric


def test_roles_are_recovered(spark):
    plain_ = chat.transcripts(spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")).cache()
    model = chat.train(plain_.filter("conv_id % 5 <> 0"))
    rows = chat.parse(plain_, model).filter("conv_id % 5 = 0").collect()
    right = sum([t.role for t in r.turns] == [t.role for t in r.parsed] for r in rows)
    assert right >= 0.9 * len(rows)
    assert chat.turns_of(model, None) == chat.turns_of(model, "\n \n") == ([], False)
    assert chat.render([("user", "<|end|>")]) == "<|user|>\n< |end|>\n<|end|>\n"


def a_model(spark):
    rows = [(c, i, "user" if i % 2 else "assistant", f"word{i}\n\nmore words of {i} " * (1 + i % 3)) for c in range(20) for i in range(8)]
    return chat.train(chat.transcripts(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))


def test_viterbi_equals_all_paths(spark):
    model, rng = a_model(spark), np.random.default_rng(4)
    for n in (1, 2, 5):
        seen = np.stack([rng.integers(0, k, n) for k in (4, 2, 4)], axis=1)
        score = model.scores(seen)

        def total(path, before):
            first = model.start if before is None else model.step[before]
            return first[path[0]] + sum(score[i, s] for i, s in enumerate(path)) + sum(model.step[a, b] for a, b in zip(path, path[1:]))

        for before in (None, 3):
            paths = list(itertools.product(range(6), repeat=n))
            assert total(model.states(seen, before).tolist(), before) == pytest.approx(max(total(p, before) for p in paths))
            for last in range(6):
                best = max(total(p, before) for p in paths if p[-1] == last)
                assert total(model.states(seen, before, last).tolist(), before) == pytest.approx(best)
                assert model.matrix(seen)[6 if before is None else before, last] == pytest.approx(best)


def test_parts_of_a_long_conversation_are_decoded_as_one(spark, monkeypatch):
    monkeypatch.setattr(chat, "PART", 16)
    words = ["yes", "Q: what", "no\n\nsecond paragraph", "x " * 90, "", "### Human"]
    rows = [(c, i, chat.ROLES[(i * 7 + c) % 3], words[(i * 5 + c * i) % 6]) for c in range(4) for i in range(200)]
    rows += [(9, 1, "user", f"same turn {i}") for i in range(50)] + [(None, 1, "user", "alone"), (9, None, "user", "no place")]
    plain_ = chat.transcripts(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).cache()
    assert plain_.agg(F.max(F.size("turns"))).first()[0] <= 16 and plain_.filter("alone is null").count() == 4 * 13 + 4
    model = chat.train(plain_)
    found = defaultdict(list)
    for r in chat.parse(plain_, model).orderBy("conv_id", "alone", "part").collect():
        found[r.conv_id, r.alone].append(r)
    whole = defaultdict(list)
    for r in plain_.orderBy("conv_id", "alone", "part").collect():
        whole[r.conv_id, r.alone].append(r.transcript)
    assert set(found) == set(whole)
    for key, parts in whole.items():
        text = "\n\n".join(parts)
        turns, _ = chat.turns_of(model, text)
        assert "".join(r.rendered for r in found[key]) == chat.render(turns)


def test_white_lines_within_a_turn_stay(spark):
    turns, _ = chat.turns_of(a_model(spark), "User: first\n\nsecond\n \n\nthird\n\nAssistant: ok")
    assert turns == [("user", "first\n\nsecond\n \n\nthird"), ("assistant", "ok")]


def test_training_takes_transcripts_with_empty_turns(spark):
    texts = ["hello", None, "", "two\n\nlines", "User:", " \n", "end"]
    rows = [(c, i, chat.ROLES[(c + i) % 3], t) for c in range(40) for i, t in enumerate(texts)]
    plain_ = chat.transcripts(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    counts = plain_.select("part", "turns", "transcript").mapInArrow(chat._label, "name string, i int, j int, n long").groupBy("name").agg(F.sum("n").alias("n"))
    found = {r.name: r.n for r in counts.collect()}
    n_lines = sum(len(chat.observed(r.transcript)[0]) for r in plain_.collect())
    assert found["start"] == 40 and found["emit0"] == n_lines and found["step"] == n_lines - 40


def test_kneser_ney_equals_a_plain_version(spark):
    rng = random.Random(1)
    texts = [
        " ".join(f"v{min(int(rng.expovariate(0.2)), 40)}" for _ in range(rng.randrange(40))) for _ in range(80)
    ] + ["unseen v1 words", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = kneser_ney.train(docs, F.col("doc_id") < 80)
    got = {r.doc_id: r for r in kneser_ney.score(docs, model).collect()}
    train = [["<s>", *(t or "").split(), "</s>"] for t in texts[:80]]
    pairs = Counter(p for t in train for p in zip(t, t[1:]))
    words = {w for _, w in pairs} | {"</s>"}
    follows = Counter(w for _, w in pairs)

    def d(counts):
        n = Counter(min(c, 5) for c in counts)
        return kneser_ney.discounts(n[1], n[2], n[3], n[4])

    d2, d1 = (0, *d(pairs.values())), (0, *d(follows.values()))
    context = defaultdict(list)
    for (a, _), c in pairs.items():
        context[a].append(c)
    size = len(words) + 1  # known words, the end among them, and one unknown
    spread = sum(d1[min(c, 3)] for c in follows.values()) / len(pairs) / size
    for i, text in enumerate(texts):
        total = 0.0
        tokens = ["<s>", *(text or "").split(), "</s>"]
        for a, b in zip(tokens, tokens[1:]):
            low = max(follows[b] - d1[min(follows[b], 3)], 0) / len(pairs) + spread
            all_ = sum(context[a])
            total += math.log10(
                (pairs[a, b] - d2[min(pairs[a, b], 3)]) / all_ + sum(d2[min(c, 3)] for c in context[a]) / all_ * low if all_ else low
            )
        assert got[i].score == pytest.approx(total, abs=1e-6)


def test_kneser_ney_trigrams_equal_a_plain_version(spark):
    rng = random.Random(2)
    texts = [" ".join(f"v{min(int(rng.expovariate(0.4)), 30)}" for _ in range(rng.randrange(60))) for _ in range(79)] + [
        " ".join(f"x y z{i}" for i in range(300)),
        "a b c " * 400,
        "x y z7 unseen v1 words v2 v1 v0",
        None,
        "a b c a",
        "c",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = kneser_ney.train(docs, F.col("doc_id") < 81, order=3)
    got = {r.doc_id: r for r in kneser_ney.score(docs, model).collect()}
    train = [["<s>", *(t or "").split(), "</s>"] for t in texts[:81]]
    triples = Counter(p for t in train for p in zip(t, t[1:], t[2:]))
    pairs = Counter((b, c) for _, b, c in triples) + Counter((t[0], t[1]) for t in train)  # continuations; own counts at the beginning
    follows = Counter(w for _, w in pairs)

    def d(counts):
        n = Counter(min(c, 5) for c in counts)
        return 0, *kneser_ney.discounts(n[1], n[2], n[3], n[4])

    d3, d2, d1 = d(triples.values()), d(pairs.values()), d(follows.values())
    context = defaultdict(list)
    for gram, c in [*triples.items(), *pairs.items()]:
        context[gram[:-1]].append(c)
    spread = sum(d1[min(c, 3)] for c in follows.values()) / len(pairs) / (len(follows) + 1)

    def above(c, each, cuts, low):
        return (c - cuts[min(c, 3)] + sum(cuts[min(x, 3)] for x in each) * low) / sum(each) if each else low

    assert max(triples.values()) > 255 and model.trigrams == len(triples)
    for i, text in enumerate(texts):
        tokens = ["<s>", *(text or "").split(), "</s>"]
        total = 0.0
        for k in range(1, len(tokens)):
            w = tokens[k]
            p = (follows[w] - d1[min(follows[w], 3)]) / len(pairs) + spread
            p = above(pairs[tokens[k - 1], w], context[tokens[k - 1],], d2, p)
            if k > 1:
                p = above(triples[tokens[k - 2], tokens[k - 1], w], context[tokens[k - 2], tokens[k - 1]], d3, p)
            total += math.log10(p)
        assert got[i].score == pytest.approx(total, abs=1e-6)


def test_pipeline_tells_rows_without_or_with_repeated_ids_apart(spark, tmp_path):
    import corpus_pipeline

    def text(a):
        return " ".join(f"{a}{i}" for i in range(40))

    spark.createDataFrame([(1, text("item"))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [
        (None, "so " + text("item") + " on"),
        (None, text("a")),
        (7, "so " + text("item") + " on"),
        (7, text("b")),
        (8, text("c")),
        (9, None),
    ]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS)
    left = corpus_pipeline.benchmark(spark, docs, str(tmp_path)).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in left) == [(0, text("a")), (7, text("b")), (8, text("c")), (9, "")]
    rows = [
        (3, text("a")),
        (3, text("b")),
        (3, text("c")),
        (3, text("c")),
        (4, text("b")),
        (2, text("c")),
        (5, text("d")),
        (6, text("d")),
        (None, text("d")),
    ]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS)
    left = corpus_pipeline.near_duplicates(spark, docs, str(tmp_path)).collect()
    assert sorted((r.doc_id or 0, r.text) for r in left) == [(0, text("d")), (2, text("c")), (3, text("a")), (3, text("b")), (5, text("d"))]


def test_pipeline_takes_effect(spark):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    good = corpus_pipeline.quality(spark, docs, "/root/testdata/sf0.01").cache()
    kept = {r.doc_id for r in good.select("doc_id").collect()}
    bad, clean = [i for i, q in labels.items() if q == 0], [i for i, q in labels.items() if q == 1]
    assert sum(i in kept for i in bad) <= 0.1 * len(bad) and sum(i in kept for i in clean) >= 0.95 * len(clean)
    one = corpus_pipeline.near_duplicates(spark, good, "/root/testdata/sf0.01")
    assert one.count() == one.select("text").distinct().count() <= good.count()
    left = corpus_pipeline.benchmark(spark, docs, "/root/testdata/sf0.01")
    items = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").collect()]
    assert left.count() == docs.count() - 26 and not any(x in r.text for r in left.collect() for x in items)
