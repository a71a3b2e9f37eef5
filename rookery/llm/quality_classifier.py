"""Quality classifier: random Fourier features of document statistics, ridge regression, isotonic calibration.

1.  Statistics of every whole text are computed once (numpy on chunks of texts) and written: a small row per text.
2.  Mean and spread of each statistic over all texts scale them.  Cosines of fixed random projections approximate a
    Gaussian kernel over the scaled statistics.
3.  Each task sums its labelled rows' normal equations; the sums meet in two rounds of grouped additions, so what reaches
    the driver is one matrix, whatever the number of rows or partitions.
4.  Ridge scores of labelled rows that the equations did not see are counted between their own quantiles (a mergeable
    sketch); pooling adjacent violators over these bins gives a rising step function, and scores between the bins' means are
    interpolated.

All labelled rows of the training folds are used.  Labels, language, source and id are never inputs of a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .storage import bound_batches, cut

STATS = (
    "log_words",
    "word_length",
    "upper",
    "digit",
    "symbol",
    "bang",
    "punctuation",
    "distinct",
    "same_next",
    "repeat_3",
    "line_words",
    "dup_lines",
    "capital_words",
    "foreign",
)
FEATURES = 192
#: Quantiles of the raw scores between which the calibration counts.
SCORE_BINS = 1000
_CLASS = np.zeros(256, dtype=np.uint8)
_CLASS[[ord(x) for x in "#*$%&|<>@^~_=+\\/{}[]"]] = 1
_CLASS[ord("!")] = 2
_CLASS[[ord(x) for x in ".,;:?'\"()-"]] = 3
_CLASS[0x30:0x3A] = 4
_CLASS[0x41:0x5B] = 5


def _per_row(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of ``values[at[i]:at[i + 1]]``."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[at[1:]] - total[at[:-1]]


def _distinct(keys: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """Distinct keys of each row."""
    both = np.unique(W.mix(keys ^ W.mix(row.astype(np.uint64) + np.uint64(1))), return_index=True)[1]
    return np.bincount(row[both], minlength=n)


def statistics(c: W.Chunk) -> np.ndarray:
    """A row of ``STATS`` for each text of a chunk; texts without words give zeros."""
    n = c.row1 - c.row0
    kind = _CLASS[c.buf]
    size = np.maximum(np.diff(c.at) - _per_row(W.IS_SPACE[c.buf], c.at), 1).astype(np.float64)
    share = [_per_row(kind == k, c.at) / size for k in (5, 4, 1, 2, 3)]
    # two bytes from C3 80 to C3 9E are capital letters of Latin-1
    second = np.zeros(len(c.buf), dtype=bool)
    second[1:] = (c.buf[:-1] == 0xC3) & (c.buf[1:] < 0x9F)
    capital = (kind == 5) | second
    share[0] = _per_row(capital, c.at) / size
    words = np.maximum(c.n_words, 1).astype(np.float64)
    row, h = c.row_of_word(), c.hashes()
    same = np.zeros(len(h), dtype=bool)
    if len(h):
        same[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    ok = c.window_rows(3)
    grams, of = W.window_hash(h, 3)[ok], row[: len(ok)][ok]
    windows = np.maximum(np.bincount(of, minlength=n), 1)
    repeat = 1 - (_distinct(grams, of, n) + (np.bincount(of, minlength=n) == 0)) / windows if len(of) else np.zeros(n)
    breaks = c.buf == 0x0A
    edge = np.unique(np.concatenate([c.at, np.flatnonzero(breaks) + 1]))
    starts = edge[:-1][np.diff(edge) > 0] if len(edge) > 1 else np.zeros(0, dtype=np.int64)
    ends = np.append(starts[1:], len(c.buf))
    line_row = np.searchsorted(c.at, starts, side="right") - 1
    lines = np.maximum(np.bincount(line_row, minlength=n), 1)
    line_key = W.byte_hash(c.buf, starts, ends - breaks[ends - 1]) if len(starts) else np.zeros(0, dtype=np.uint64)
    dup = (lines - _distinct(line_key, line_row, n)) / lines if len(starts) else np.zeros(n)
    caps = np.concatenate([[0], np.cumsum(capital, dtype=np.int64)])
    shouted = 2 * (caps[c.ends] - caps[c.starts]) >= c.ends - c.starts if len(h) else np.zeros(0, dtype=bool)
    out = np.stack(
        [
            np.log1p(c.n_words),
            size / words,
            *share,
            _distinct(h, row, n) / words if len(h) else np.zeros(n),
            _per_row(same, c.first) / words,
            repeat,
            words / lines,
            dup,
            _per_row(shouted, c.first) / words,
            _per_row(c.buf >= 0x80, c.at) / size,
        ],
        axis=1,
    )
    out[:, 10] = np.log1p(out[:, 10])
    out[c.n_words == 0] = 0
    return out


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for c in W.chunks(batch.column("text")):
            x = statistics(c)
            ids = batch.column("doc_id").slice(c.row0, c.row1 - c.row0)
            stats = pa.ListArray.from_arrays(
                pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)),
                pa.array(x.astype(np.float32).ravel()),
            )
            yield pa.RecordBatch.from_arrays(
                [ids, batch.column("print").slice(c.row0, len(ids)), stats],
                names=["doc_id", "print", "stats"],
            )


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id, print, stats`` of each row of ``docs(doc_id, text)``; ``print`` is a hash of the text."""
    bound_batches(docs.sparkSession)
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("print"), "text")
    return keyed.mapInArrow(_measure, "doc_id long, print long, stats array<float>")


@dataclass
class Classifier:
    """Everything that a score needs: some hundred numbers."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    places: np.ndarray  # rising raw scores, and the probability at each
    calibration: np.ndarray

    @staticmethod
    def _projection() -> tuple[np.ndarray, np.ndarray]:
        rng = np.random.default_rng(20240301)
        return rng.normal(size=(len(STATS), FEATURES)) * 0.35, rng.uniform(0, 2 * np.pi, FEATURES)

    def features(self, stats: np.ndarray) -> np.ndarray:
        along, shift = self._projection()
        z = np.clip((stats - self.mean) / self.spread, -6, 6)
        return np.hstack([np.cos(z @ along + shift) * np.sqrt(2 / FEATURES), np.ones((len(z), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def probability(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(stats), self.places, self.calibration)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.asarray(batch.column("stats").flatten(), dtype=np.float64).reshape(-1, len(STATS))


def _equations(model: Classifier):
    d = FEATURES + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d + 1))
        seen = False
        for batch in batches:
            z = model.features(_matrix(batch))
            y = np.asarray(batch.column("label"), dtype=np.float64)
            total[:, :d] += z.T @ z
            total[:, d] += z.T @ y
            seen |= len(y) > 0
        if seen:
            yield pa.RecordBatch.from_pydict({"i": pa.array(range(d), pa.int32()), "row": pa.array(list(total), pa.list_(pa.float64()))})

    return run, "i int, row array<double>"


def _raw(model: Classifier):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"raw": pa.array(model.raw(_matrix(batch))), "label": batch.column("label")})

    return run, "raw double, label int"


def _binned(edges: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = np.searchsorted(edges, np.asarray(batch.column("raw")))
            yield pa.RecordBatch.from_pydict({"bin": pa.array(place), "raw": batch.column("raw"), "label": batch.column("label")})

    return run, "bin long, raw double, label int"


def isotonic(positive: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Rising shares of positives of bins that all have rows: adjacent violators are pooled."""
    pools: list[list[float]] = []  # positives, rows, bins
    for p, n in zip(positive.tolist(), count.tolist(), strict=True):
        pools.append([p, n, 1])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            p1, n1, b1 = pools.pop()
            pools[-1][0] += p1
            pools[-1][1] += n1
            pools[-1][2] += b1
    out = np.concatenate([np.full(b, (p + 0.02) / (n + 0.04)) for p, n, b in pools])
    return np.maximum.accumulate(np.clip(out, 0, 1))


def fit(stats: DataFrame, labelled: DataFrame, calibrate: Column, ridge: float = 1e-3) -> Classifier:
    """``labelled(stats, label)`` has training rows only; those for which ``calibrate`` holds are kept for the calibration.

    Without labelled rows every score is one half; labels of one kind give the smoothed share of that kind.
    """
    x = [F.col("stats")[i].cast("double") for i in range(len(STATS))]
    row = stats.agg(*(f(c).alias(f"{name}{i}") for i, c in enumerate(x) for name, f in (("m", F.avg), ("s", F.stddev_pop)))).first()
    mean = np.array([row[f"m{i}"] or 0.0 for i in range(len(STATS))])
    spread = np.maximum(np.array([row[f"s{i}"] or 0.0 for i in range(len(STATS))]), 1e-3)
    d = FEATURES + 1
    model = Classifier(mean, spread, np.zeros(d), np.zeros(1), np.full(1, 0.5))
    parts = labelled.filter(~calibrate).select("stats", "label").mapInArrow(*_equations(model))
    parts = parts.select(
        F.pmod(F.spark_partition_id(), F.lit(16)).alias("some"),
        "i",
        F.posexplode("row").alias("j", "x"),
    ).groupBy("some", "i", "j").agg(F.sum("x").alias("x"))
    sums = parts.groupBy("i", "j").agg(F.sum("x").alias("x")).groupBy("i").agg(F.collect_list(F.struct("j", "x")).alias("xs")).collect()  # FEATURES + 1 rows
    if not sums:
        return model
    total = np.zeros((d, d + 1))
    for r in sums:
        for c in r.xs:
            total[r.i, c.j] = c.x
    model.weights = np.linalg.solve(total[:, :d] + ridge * max(total[d - 1, d - 1], 1.0) / d * np.eye(d), total[:, d])
    apart = cut(labelled.filter(calibrate).select("stats", "label").mapInArrow(*_raw(model)), "raw")
    ranks = [i / SCORE_BINS for i in range(1, SCORE_BINS)]
    edges = np.unique(np.array(apart.agg(F.percentile_approx("raw", ranks, 10 * SCORE_BINS)).first()[0] or [], dtype=np.float64))
    means = F.avg("raw").alias("raw")
    found = sorted(apart.mapInArrow(*_binned(edges)).groupBy("bin").agg(F.count("*").alias("n"), F.sum("label").alias("positive"), means).collect())  # at most SCORE_BINS rows
    if found:
        model.places = np.array([r.raw for r in found])
        model.calibration = isotonic(np.array([r.positive for r in found]), np.array([r.n for r in found]))
    else:  # too few labels to keep some apart
        model.places, model.calibration = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    return model


def _predict(model: Classifier):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("print"), pa.array(model.probability(_matrix(batch)))],
                names=["doc_id", "print", "score"],
            )

    return run, "doc_id long, print long, score double"


def fold(of: int) -> Column:
    """crc32 of the id as text modulo ``of``; null ids have none."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % of


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, print, held_out, score`` of each row of ``docs``, learnt from ``labels(doc_id, quality)``.

    Labels of ids whose crc32 modulo 5 is 0 are never read; remainder 4 calibrates, the others fit.  Null labels are left
    out; an id with several labels counts with each.  A null id is not held out and has no label.  Null and empty texts
    have statistics of zero and are scored like others; repeated rows are scored each.  Other columns are dropped.  An
    empty table gives an empty table.
    """
    stats = cut(measured(docs), "stats")
    known = labels.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("quality").cast("int").alias("label"),
    ).filter("label is not null and doc_id is not null").filter(fold(5) != 0)
    labelled = cut(stats.join(known, "doc_id").select("doc_id", "stats", "label"), "labelled")
    model = fit(stats, labelled, fold(5) == 4)
    scored = stats.select("doc_id", "print", "stats").mapInArrow(*_predict(model))
    return scored.select("doc_id", "print", F.coalesce(fold(5) == 0, F.lit(False)).alias("held_out"), "score")


def rejected(docs: DataFrame, labels: DataFrame, least: float = 0.3) -> DataFrame:
    """Distinct ``doc_id, print`` of the rows that score below ``least``."""
    return scores(docs, labels).filter(F.col("score") < least).select("doc_id", "print").distinct()
