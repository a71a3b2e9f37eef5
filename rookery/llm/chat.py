"""Transcript parsing: roles recovered by a hidden Markov model over lines, then canonical rendering of turns.

A transcript is plain text.  Each line is observed as three features: the kind of speaker marker it begins with, whether
it follows a blank line, and a class of its length.  Hidden states are a role and whether the line opens a turn.  Start,
transition and emission probabilities are smoothed shares of counts over labelled transcripts, summed by Spark (some
dozen numbers).  Viterbi finds the likeliest states of a transcript; lines of a turn are joined and rendered.

A long conversation is cut into parts of about ``PART`` turns, so that a task never holds more than some parts, and is still
decoded as one: a part's lines are a matrix of the best scores from each state before it to each state at its end; a pass
forward over these matrices and a pass back give the states at all borders, between which each part is decoded by itself.  What
is rendered for a conversation's parts, one after another, is what would be rendered for all of it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .storage import cut

#: Turns of a part.
PART = 1024
ROLES = ("system", "user", "assistant")
#: Fixed marker words by role, and the styles that ``transcripts`` writes.
_WORDS = {"system": "system|instructions?|context", "user": "user|human|customer|question|q", "assistant": "assistant|ai|bot|answer|a"}
STYLES = (
    {"system": "System: ", "user": "User: ", "assistant": "Assistant: "},
    {"system": "### Instructions\n", "user": "### Human\n", "assistant": "### Assistant\n"},
    {"system": "[system] ", "user": "[user] ", "assistant": "[assistant] "},
    {"system": "CONTEXT: ", "user": "Q: ", "assistant": "A: "},
    {"system": "<system> ", "user": "<human> ", "assistant": "<bot> "},
)
_MARK = re.compile(
    "|".join(rf"(?P<{role}>(?:#+\s*(?:{w})\s*:?\s*\Z|[\[<](?:{w})[\]>]\s*|(?:{w})\s*:\s+|(?:{w})\s*:\s*\Z))" for role, w in _WORDS.items()),
    re.IGNORECASE,
)
_STATES = [(role, opens) for role in ROLES for opens in (True, False)]
_FEATURES = (4, 2, 4)  # kinds of marker (none last), after a blank line or not, classes of length


def _mark(line: str) -> tuple[int, str]:
    """Kind of marker and the rest of a line."""
    m = _MARK.match(line)
    return (len(ROLES), line) if m is None else (ROLES.index(m.lastgroup), line[m.end() :])


def observed(text: str) -> tuple[list[str], list[list[str]], np.ndarray]:
    """The lines of a transcript that have more than white space, the white lines before each, and the lines' features."""
    lines, gaps, found, gap = [], [], [], []
    for line in text.split("\n"):
        if not line.strip():
            gap.append(line)
            continue
        kind, _ = _mark(line)
        found.append((kind, int(bool(gap) or not lines), min(len(line) // 60, 3)))
        lines.append(line)
        gaps.append(gap)
        gap = []
    return lines, gaps, np.array(found, dtype=np.int64).reshape(-1, 3)


@dataclass
class Model:
    """Logarithms of start, transition and emission probabilities."""

    start: np.ndarray
    step: np.ndarray
    emit: list[np.ndarray]

    def scores(self, seen: np.ndarray) -> np.ndarray:
        """Log probability of each line's features in each state."""
        return sum(e[:, seen[:, i]] for i, e in enumerate(self.emit)).T

    def states(self, seen: np.ndarray, before: int | None = None, last: int | None = None) -> np.ndarray:
        """Viterbi path, after the state ``before`` and up to the state ``last`` if these are known; ties go to the earlier state."""
        score = self.scores(seen)
        best, back = (self.start if before is None else self.step[before]) + score[0], np.zeros(score.shape, dtype=np.int64)
        for t in range(1, len(score)):
            each = best[:, None] + self.step
            back[t] = each.argmax(axis=0)
            best = each.max(axis=0) + score[t]
        path = np.empty(len(score), dtype=np.int64)
        path[-1] = int(best.argmax()) if last is None else last
        for t in range(len(score) - 1, 0, -1):
            path[t - 1] = back[t, path[t]]
        return path

    def matrix(self, seen: np.ndarray) -> np.ndarray:
        """Best scores of some lines: from each state before them (in the last row: from the beginning) to each at their end."""
        score = self.scores(seen)
        best = np.vstack([self.step, self.start]) + score[0]
        for t in range(1, len(score)):
            best = (best[:, :, None] + self.step).max(axis=1) + score[t]
        return best


def transcripts(conversations: DataFrame) -> DataFrame:
    """Plain transcripts of ``conversations(conv_id, turn, role, text)``, as they are met in the wild, with their turns.

    ``conv_id, alone, part, parts, turns array<struct<turn,role,text,marked>>, transcript``: a row for each part of a
    conversation, numbered from 0.  The style of markers depends on the conversation's id; about one turn in seven has no
    marker.  Equal rows count once; turns with the same number are in the order of role and text; a null role is a user's;
    null texts are empty.  A row without a conversation or a turn number has no place in an order and is a transcript of its
    own, told apart by ``alone``.  Other columns are dropped.  An empty table gives an empty table.
    """
    named = F.when(F.col("role").isin(*ROLES), F.col("role")).otherwise(F.lit("user"))
    rows = conversations.select("conv_id", "turn", named.alias("role"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    rows = rows.withColumn("alone", F.when(F.col("conv_id").isNull() | F.col("turn").isNull(), F.xxhash64("turn", "role", "text")))
    # parts are ranges of turn numbers, and of ranks where a number is there many times
    rows = rows.withColumn("range", F.floor(F.col("turn") / PART))
    rank = F.row_number().over(Window.partitionBy("conv_id", "alone", "range").orderBy("turn", "role", "text"))
    rows = rows.withColumn("piece", F.floor((rank - 1) / PART))
    style = F.pmod(F.xxhash64("conv_id"), F.lit(len(STYLES)))
    marker = F.coalesce(*(F.when((style == i) & (F.col("role") == r), F.lit(s[r])) for i, s in enumerate(STYLES) for r in ROLES))
    shown = F.when(F.pmod(F.xxhash64("conv_id", "turn", F.lit("mark")), F.lit(7)) == 3, F.lit("")).otherwise(marker)
    turn = F.struct("turn", "role", "text", F.concat(shown, "text").alias("line"), (shown != "").alias("marked"))
    grouped = rows.groupBy("conv_id", "alone", "range", "piece").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    own = Window.partitionBy("conv_id", "alone")
    numbers = grouped.select("conv_id", "alone", "range", "piece")
    number = (F.row_number().over(own.orderBy("range", "piece")) - 1).cast("long").alias("part")
    several = numbers.filter("alone is null").select("conv_id", "range", "piece", number, F.count("*").over(own).alias("parts"))
    placed = grouped.join(several, ["conv_id", "range", "piece"], "left")
    turns = F.transform("turns", lambda t: F.struct(t["turn"], t["role"], t["text"], t["marked"])).alias("turns")
    first, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    return placed.select(
        "conv_id",
        "alone",
        F.coalesce("part", first).alias("part"),
        F.coalesce("parts", one).alias("parts"),
        turns,
        F.array_join(F.col("turns.line"), "\n\n").alias("transcript"),
    )


def _label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of starts, steps and features in labelled transcripts, by task."""
    n = len(_STATES)
    start, step, emit = np.zeros(n), np.zeros((n, n)), [np.zeros((n, k)) for k in _FEATURES]
    for batch in batches:
        for part, turns, text in zip(*(batch.column(x).to_pylist() for x in ("part", "turns", "transcript")), strict=True):
            lines, _, seen = observed(text)
            wanted = []  # each line's state, by walking along the turns' own lines
            for t in turns:
                own = sum(bool(x.strip()) for x in t["text"].split("\n"))
                wanted.append((ROLES.index(t["role"]), own, t.get("marked", True)))
            states, i = [], 0
            for role, own, marked in wanted:
                bare = i < len(lines) and marked and _mark(lines[i])[0] < len(ROLES) and not _mark(lines[i])[1].strip()
                count = own + bool(bare)
                states += [2 * role + (k > 0) for k in range(count)]
                i += count
            if len(states) != len(lines) or not states:
                continue  # no lines, or turns that are not those of the transcript
            if not part:
                start[states[0]] += 1
            np.add.at(step, (states[:-1], states[1:]), 1)
            for k, e in enumerate(emit):
                np.add.at(e, (states, seen[:, k]), 1)
    names = [("start", start.reshape(1, -1)), ("step", step), *((f"emit{k}", e) for k, e in enumerate(emit))]
    rows = [(name, int(i), int(j), int(x[i, j])) for name, x in names for i, j in np.argwhere(x)]
    yield pa.RecordBatch.from_pydict(
        {
            "name": pa.array([r[0] for r in rows], pa.string()),
            "i": pa.array([r[1] for r in rows], pa.int32()),
            "j": pa.array([r[2] for r in rows], pa.int32()),
            "n": pa.array([r[3] for r in rows], pa.int64()),
        }
    )


def train(labelled: DataFrame) -> Model:
    """Model of ``labelled(part, turns, transcript)``; every count is smoothed by a half, so no transcripts give an even model.

    Steps from one part of a conversation to the next are not counted.
    """
    n = len(_STATES)
    tables = {"start": np.full((1, n), 0.5), "step": np.full((n, n), 0.5)} | {
        f"emit{k}": np.full((n, m), 0.5) for k, m in enumerate(_FEATURES)
    }
    counts = labelled.select("part", "turns", "transcript").mapInArrow(_label, "name string, i int, j int, n long")
    for r in counts.groupBy("name", "i", "j").agg(F.sum("n").alias("n")).collect():  # one row for each parameter
        tables[r["name"]][r.i, r.j] += r.n
    logs = {k: np.log(x / x.sum(axis=1, keepdims=True)) for k, x in tables.items()}
    return Model(logs["start"][0], logs["step"], [logs[f"emit{k}"] for k in range(len(_FEATURES))])


def turns_of(model: Model, text: str | None, before: int | None = None, last: int | None = None) -> tuple[list[tuple[str, str]], bool]:
    """Roles and texts of a transcript's turns, none for a text without words, and whether the first goes on a turn before it.

    White lines within a turn stay; those around a turn go.
    """
    lines, gaps, seen = observed(text or "")
    out: list[tuple[str, list[str]]] = []
    if not lines:
        return [], False
    states = model.states(seen, before, last).tolist()
    role_before = None if before is None else _STATES[before][0]
    goes_on = not _STATES[states[0]][1] and role_before == _STATES[states[0]][0]
    for line, gap, state in zip(lines, gaps, states, strict=True):
        role, opens = _STATES[state]
        if opens or role_before != role:
            out.append((role, []))
            kind, rest = _mark(line)
            if kind < len(ROLES):
                line = rest
        elif not out:
            out.append((role, []))
        if line.strip():
            out[-1][1].extend([*gap, line] if out[-1][1] else [line])
        role_before = role
    return [(role, "\n".join(x)) for role, x in out], goes_on


def render(turns: list[tuple[str, str]], first: bool = True, goes_on: bool = False, last: bool = True) -> str:
    """Canonical form of a conversation or of a part of it; the markers cannot be made by a text, whose ``<|`` is written ``< |``.

    A part leaves its last turn open, for the next part to go on with or to end.
    """
    texts = [(role, text.replace("<|", "< |")) for role, text in turns]
    out = "\n<|end|>\n".join(f"<|{role}|>\n{text}" if i or not goes_on else f"\n\n{text}" for i, (role, text) in enumerate(texts))
    if out and not first and not goes_on:
        out = "\n<|end|>\n" + out
    return out + "\n<|end|>\n" if last and (out or not first) else out


_KEYS = ["conv_id", "part"]


def _matrices(model: Model):
    n = len(_STATES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = [observed(x or "")[2] for x in batch.column("transcript").to_pylist()]
            found = [model.matrix(x).ravel().tolist() if len(x) else None for x in seen]  # a part without lines changes nothing
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.float64()))],
                names=[*_KEYS, "scores"],
            )

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by conversation, parts in order: the best scores up to each part."""
        now, best = None, None
        for batch in batches:
            found = []
            for conv, scores in zip(batch.column("conv_id").to_pylist(), batch.column("scores").to_pylist(), strict=True):
                if conv != now:
                    now, best = conv, None
                found.append(None if best is None else best.tolist())
                if scores is not None:
                    each = np.array(scores).reshape(n + 1, n)
                    best = each[n] if best is None else (best[:, None] + each[:n]).max(axis=0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(pa.float64()))], names=[*batch.schema.names, "best"])

    def backward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by conversation, the last part first: the states before and at the end of each part."""
        now, state = None, None
        for batch in batches:
            before, last = [], []
            for conv, scores, best in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "scores", "best")), strict=True):
                if conv != now:
                    now, state = conv, None
                if scores is not None:
                    each = np.array(scores).reshape(n + 1, n)
                    total = each[n] if best is None else (np.array(best)[:, None] + each[:n]).max(axis=0)
                    state = int(total.argmax()) if state is None else state
                    last.append(state)
                    state = None if best is None else int((np.array(best) + each[:n, state]).argmax())
                else:
                    state = int(np.argmax(best)) if state is None and best is not None else state
                    last.append(state)
                before.append(state)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(before, pa.int32()), pa.array(last, pa.int32())],
                names=[*_KEYS, "before", "last"],
            )

    return run, forward, backward


def borders(plain: DataFrame, model: Model) -> DataFrame:
    """``conv_id, part, before, last``: states of the likeliest path before and at the end of parts of longer conversations."""
    run, forward, backward = _matrices(model)
    n = int(plain.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in plain.select(*_KEYS).schema)
    scores = plain.filter("parts > 1").select(*_KEYS, "transcript").mapInArrow(run, f"{keys}, scores array<double>")
    up = scores.repartition(n, "conv_id").sortWithinPartitions("conv_id", "part")
    best = up.mapInArrow(forward, f"{keys}, scores array<double>, best array<double>")
    down = best.repartition(n, "conv_id").sortWithinPartitions("conv_id", F.desc("part"))
    return cut(down.mapInArrow(backward, f"{keys}, before int, last int"), "borders")


def parse(plain: DataFrame, model: Model) -> DataFrame:
    """``plain`` with ``n_lines``, ``parsed array<struct<role,text>>``, ``goes_on`` and ``rendered`` in place of ``transcript``.

    Needs the columns of ``transcripts`` but for ``turns``; other columns pass through, unless they have the names of results.
    ``goes_on`` is true if a part's first turn goes on the last one of the part before it.
    """
    plain = plain.drop("n_lines", "parsed", "goes_on", "rendered", "before", "last", "border")
    rest = [f for f in plain.schema if f.name != "transcript"]
    pair = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
    found = borders(plain, model).withColumnRenamed("conv_id", "border")  # only of conversations with several parts
    met = (F.when(F.col("parts") > 1, F.col("conv_id")) == F.col("border")) & (plain["part"] == found["part"])
    joined = plain.join(found, met, "left").select(*(plain[f"`{f.name}`"] for f in rest), plain["transcript"], "before", "last")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, before, last, part, parts = (batch.column(x).to_pylist() for x in ("transcript", "before", "last", "part", "parts"))
            found = [turns_of(model, *x) for x in zip(texts, before, last, strict=True)]
            rendered = [render(x, b is None, goes_on, i == n - 1) for (x, goes_on), b, i, n in zip(found, before, part, parts, strict=True)]
            counts = pa.array([len(observed(x or "")[0]) for x in texts], pa.int64())
            turns = pa.array([[{"role": r, "text": t} for r, t in x] for x, _ in found], pair)
            columns = [
                *(batch.column(f.name) for f in rest),
                counts,
                turns,
                pa.array([x for _, x in found], pa.bool_()),
                pa.array(rendered, pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[*(f.name for f in rest), "n_lines", "parsed", "goes_on", "rendered"])

    own = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rest)
    return joined.mapInArrow(run, f"{own}n_lines long, parsed array<struct<role:string,text:string>>, goes_on boolean, rendered string")
