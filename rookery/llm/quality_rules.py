"""Quality rules with adaptive thresholds, in DataFrame functions only.

Per text the base counts are computed by array functions inside one projection (nothing is exploded or shuffled) and
written once.  Texts that fail the base rules are out; of the others each metric, a share in parts of a million, goes into
one quantile sketch (KLL) for each language and source, and these sketches are merged to one for each language and to one for
all.  Nothing but ranks is a parameter: a metric's limit is ``high + reach * (high - middle)``, where ``high`` and
``middle`` are quantiles of the group's sketch at the ranks of ``RANKS``.  Where both are zero, as where most texts have no
symbol at all, the bulk has no spread, and the limit is a quarter of the median of the values that are not zero, which a
sketch of their own knows; for the metrics of ``RARE`` it is no more than that wherever the middle is zero.  This median is
weighed with the language's by the number of such values.  A group of ``n`` texts weighs its own limit by ``n`` and its
language's by ``WEIGHT``; a language does the same with the limit for all.
Texts are then joined with the limits of their language and source, and kept if no metric is above its limit by more than
one standard error of its count (the square root of the count): one symbol proves nothing.

A sketch holds a few thousand values however many texts it has seen.  Its quantiles are exact up to ``SIZE`` texts, beyond
which ranks are off by about 2 / SIZE.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import cut

#: Size of a sketch.
SIZE = 4096
#: Percent ranks of the middle and the high quantile, and the reach above, by metric.
RANKS = {"symbols": (50, 90, 1), "repeats": (50, 95, 2), "lines": (50, 98, 1), "upper": (50, 95, 2)}
#: Metrics that sound texts hardly have: the high quantile may be among the unsound ones.
RARE = {"symbols"}
#: Of the median of what is not zero, where the middle is zero.
PART = 4
#: Standard errors by which a text's count may be above the limit.
ERRORS = 1
#: A group's own limit counts as much as its language's when it has so many texts.
WEIGHT = 100
#: Up to so many groups their limits are broadcast (some MB); beyond, texts are dealt to them by salted keys.
BROADCAST_GROUPS = 50_000
SALTS = 64
_SPACE = r"[\x20\x09-\x0D]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, also where the body's lambdas use it for each element."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(w: Column) -> Column:
    """Words in windows of three that the array holds twice or more (first ones included)."""

    def of(windows: Column) -> Column:
        def again(x: Column, i: Column) -> Column:
            same_before = (i > 0) & (F.get(windows, i - 1)["h"] == x["h"])
            return same_before | (F.get(windows, i + 1)["h"] == x["h"])

        def added(total: Column, start: Column) -> Column:
            """Each window adds the words that the window before it in the text has not covered."""
            return F.struct(start.alias("last"), (total["n"] + F.least(F.lit(3), start - total["last"])).alias("n"))

        at = F.array_sort(F.transform(F.filter(windows, again), lambda x: x["i"]))
        zero = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n"))
        return let(at, lambda starts: F.aggregate(starts, zero, added)["n"])

    starts = F.sequence(F.lit(0), F.size(w) - 3)
    windows = F.transform(starts, lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")))
    return F.when(F.size(w) < 3, F.lit(0).cast("long")).otherwise(let(F.array_sort(windows), of))


def base_counts(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, source``, the counts of each whole text and ``base_failed``; a null text has no words.

    Null languages and sources count as empty ones.  Windows are compared by a 64-bit hash of their words.  Other columns
    are dropped.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def left(pattern: str) -> Column:
        return F.char_length(F.regexp_replace(text, pattern, "")).cast("long")

    def of_words(w: Column) -> Column:
        size, chars = F.size(w).cast("long"), F.char_length(F.array_join(w, "")).cast("long")
        return F.struct(size.alias("n_words"), chars.alias("word_chars"), _repeat_words(w).alias("n_repeat_words"))

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("lang", F.lit("")).alias("lang"),
        F.coalesce("source", F.lit("")).alias("source"),
        let(F.array_remove(F.split(text, _SPACE + "+", -1), ""), of_words).alias("c"),
        left(r"[^#*$%&|<>]+").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        F.size(lines).cast("long").alias("n_lines"),
        left(r"[^\p{Lu}]+").alias("n_upper"),
    )
    rows = rows.select("doc_id", "lang", "source", "c.*", "n_symbols", "n_dup_lines", "n_lines", "n_upper")
    return rows.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def _metrics(errors: int = 0) -> dict[str, Column]:
    """Parts of a million, of counts less so many standard errors."""

    def share(part: str, whole: str) -> Column:
        return F.expr(f"1000000L * greatest({part} - {errors} * cast(floor(sqrt({part})) as bigint), 0L) div greatest({whole}, 1L)")

    return {
        "symbols": share("n_symbols", "word_chars"),
        "repeats": share("n_repeat_words", "n_words"),
        "lines": share("n_dup_lines", "n_lines"),
        "upper": share("n_upper", "word_chars"),
    }


def sketches(counts: DataFrame) -> DataFrame:
    """``lang, source, n`` and a sketch for each metric of the texts that pass the base rules, by map-side sums."""
    passed = counts.filter(~F.col("base_failed")).select("lang", "source", *(x.alias(m) for m, x in _metrics().items()))
    every = [F.kll_sketch_agg_bigint(m, SIZE).alias(m) for m in RANKS]
    above = [F.kll_sketch_agg_bigint(F.when(F.col(m) > 0, F.col(m)), SIZE).alias(f"{m}_above") for m in RANKS]
    some = [F.count_if(F.col(m) > 0).alias(f"{m}_n") for m in RANKS]
    return passed.groupBy("lang", "source").agg(F.count("*").alias("n"), *every, *above, *some)


def merged(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """The sketches of rows that share ``keys``, merged."""
    names = [*RANKS, *(f"{m}_above" for m in RANKS)]
    counts = [F.sum(c).alias(c) for c in ("n", *(f"{m}_n" for m in RANKS))]
    return sketch.groupBy(*keys).agg(*counts, *(F.kll_merge_agg_bigint(m, SIZE).alias(m) for m in names))


def levels(sketch: DataFrame, prefix: str) -> DataFrame:
    """``sketch`` with numbers in place of the sketches; names get the prefix.

    For each metric the limit by its spread, whether middle and high quantile are zero (``_m``, ``_h``), and number and median
    of the values above zero (``_n``, ``_a``).
    """

    def of(metric: str, middle: int, high: int, reach: int) -> dict[str, Column]:
        at = lambda rank, of=metric: F.kll_sketch_get_quantile_bigint(of, F.lit(rank / 100))
        some = F.col(f"{metric}_n")
        spread = ((1 + reach) * at(high) - reach * at(middle)).cast("double")
        above = F.when(some > 0, at(50, f"{metric}_above")).otherwise(0).cast("double")
        return {"": spread, "_m": at(middle) == 0, "_h": at(high) == 0, "_n": some, "_a": above}

    rest = {"n", *RANKS, *(f"{m}_above" for m in RANKS), *(f"{m}_n" for m in RANKS)}
    keys = [c for c in sketch.columns if c not in rest]
    numbers = [x.alias(f"{prefix}{m}{part}") for m, r in RANKS.items() for part, x in of(m, *r).items()]
    return sketch.filter("n > 0").select(*keys, F.col("n").alias(prefix + "n"), *numbers)


def _weighed(n: Column, own: Column, wider: Column) -> Column:
    return (n * own + WEIGHT * wider) / (n + WEIGHT)


def _limit(x: Callable[[str], Column], metric: str, above: Column) -> Column:
    """A level's own limit, given the median of the values above zero."""
    gap, spread = above / PART, x("")
    by_gap = x("_m") & (x("_h") | (F.lit(metric in RARE) & (gap < spread)))
    return F.when(by_gap, gap).otherwise(spread)


def thresholds(counts: DataFrame) -> DataFrame:
    """``lang, source, n`` and the limit of each metric, for every group that has a text that passes the base rules."""
    sketch = cut(sketches(counts), "sketches")
    everything = levels(merged(sketch, []), "").first()  # one row of numbers
    joined = levels(sketch, "own_").join(levels(merged(sketch, ["lang"]), "lang_"), "lang")

    def chosen(metric: str) -> Column:
        of_all = lambda part: F.lit(everything[metric + part] if everything else None)
        of_lang, own = (lambda part, p=p: F.col(f"{p}_{metric}{part}") for p in ("lang", "own"))
        # where no text at all has any of a metric, half of a million stands for the median
        all_above = F.lit(everything[f"{metric}_a"] if everything and everything[f"{metric}_n"] else 5e5)
        lang_above = _weighed(of_lang("_n"), of_lang("_a"), all_above)
        own_above = _weighed(own("_n"), own("_a"), lang_above)
        wider = _weighed(F.col("lang_n"), _limit(of_lang, metric, lang_above), _limit(of_all, metric, all_above))
        return _weighed(F.col("own_n"), _limit(own, metric, own_above), wider).alias(metric)

    return joined.select("lang", "source", F.col("own_n").alias("n"), *(chosen(m) for m in RANKS))


def verdicts(counts: DataFrame, broadcast_groups: int = BROADCAST_GROUPS) -> DataFrame:
    """``counts`` with ``kept``; ``counts`` is read more than once and should be a written table."""
    table = cut(thresholds(counts), "limits").select("lang", "source", F.struct(*RANKS).alias("most"))
    if table.count() <= broadcast_groups:
        joined = counts.join(F.broadcast(table), ["lang", "source"], "left")
    else:
        dealt = table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salt = F.pmod(F.xxhash64("doc_id", "n_words", "word_chars"), F.lit(SALTS)).cast("int")
        joined = counts.withColumn("salt", salt).join(dealt, ["lang", "source", "salt"], "left")
    inside = [value <= F.col(f"most.{m}") for m, value in _metrics(ERRORS).items()]
    kept = ~F.col("base_failed") & F.coalesce(inside[0] & inside[1] & inside[2] & inside[3], F.lit(False))
    return joined.select(*counts.columns, kept.alias("kept"))


def quality_rules(docs: DataFrame) -> DataFrame:
    """Counts and verdict for each row of ``docs(doc_id, text, lang, source)``; repeated rows are judged each.

    Null and empty texts have no words and fail the base rules.  An empty table gives an empty result.
    """
    return verdicts(cut(base_counts(docs), "counts"))


def sql() -> str:
    """The same in DuckDB's SQL, with exact quantiles."""
    share = lambda part, whole, e=0: f"(1000000 * greatest({part} - {e} * floor(sqrt({part}))::bigint, 0) // greatest({whole}, 1))"
    parts = {"symbols": ("n_symbols", "word_chars"), "repeats": ("n_repeat_words", "n_words"), "lines": ("n_dup_lines", "n_lines"), "upper": ("n_upper", "word_chars")}
    metrics = {m: share(*x) for m, x in parts.items()}

    def numbers(m: str, middle: int, high: int, reach: int) -> str:
        at = lambda rank: f"list_sort(list({metrics[m]}))[(count(*) * {rank} + 99) // 100]"
        some = f"count(*) filter ({metrics[m]} > 0)"
        above = f"coalesce(list_sort(list({metrics[m]}) filter ({metrics[m]} > 0))[({some} + 1) // 2], 0)::double"
        spread = f"({1 + reach} * {at(high)} - {reach} * {at(middle)})::double"
        return f"{spread} {m}, {at(middle)} = 0 {m}_m, {at(high)} = 0 {m}_h, {some}::double {m}_n, {above} {m}_a"

    def level(name: str, keys: str) -> str:
        values = ", ".join(numbers(m, *r) for m, r in RANKS.items())
        return f"{name} as (select {keys + ', ' if keys else ''}count(*)::double n, {values} from counts where not base_failed {'group by ' + keys if keys else ''})"

    weighed = lambda n, own, wider: f"(({n} * {own} + {WEIGHT} * {wider}) / ({n} + {WEIGHT}))"

    def own_limit(t: str, m: str, above: str) -> str:
        rare = f" or {above} / {PART} < {t}.{m}" if m in RARE else ""
        return f"case when {t}.{m}_m and ({t}.{m}_h{rare}) then {above} / {PART} else {t}.{m} end"

    def mixed(m: str) -> str:
        of_all = f"case when a.{m}_n > 0 then a.{m}_a else 5e5::double end"
        of_lang = weighed(f"l.{m}_n", f"l.{m}_a", of_all)
        own = weighed(f"s.{m}_n", f"s.{m}_a", of_lang)
        return weighed("s.n", f"({own_limit('s', m, own)})", weighed("l.n", f"({own_limit('l', m, of_lang)})", f"({own_limit('a', m, of_all)})"))

    inside = " and ".join(f"{share(*x, ERRORS)} <= {mixed(m)}" for m, x in parts.items())
    return f"""
    with docs as (select doc_id, coalesce(lang, '') lang, coalesce(source, '') source, coalesce(text, '') as text from documents),
    split as (select *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') w,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) lines from docs),
    windows as (select doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] g from (select doc_id, w, unnest(range(1, len(w) - 1)) i from split)),
    again as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, g) c from windows) where c > 1),
    repeats as (select doc_id, count(distinct i + d)::bigint n from again, (select unnest([0, 1, 2]) d) group by 1),
    plain as (select s.doc_id, lang, source, len(w)::bigint n_words, length(array_to_string(w, ''))::bigint word_chars, coalesce(n, 0)::bigint n_repeat_words,
        length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::bigint n_symbols, (len(lines) - len(list_distinct(lines)))::bigint n_dup_lines,
        len(lines)::bigint n_lines, length(regexp_replace(text, '[^\\p{{Lu}}]+', '', 'g'))::bigint n_upper from split s left join repeats r on r.doc_id = s.doc_id),
    counts as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words base_failed from plain),
    {level("s", "lang, source")}, {level("l", "lang")}, {level("a", "")}
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and coalesce({inside}, false) kept
    from counts c left join s on s.lang = c.lang and s.source = c.source left join l on l.lang = c.lang cross join a"""
