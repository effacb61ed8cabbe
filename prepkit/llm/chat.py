"""Chat formatting: a hidden Markov model recovers the roles of transcript lines.

A transcript is a table of lines, with speaker markers (``User:``, ``### Assistant:``, ``Q:``) before some
turns only. The model's states are a role and whether the line begins a turn. A line shows a marker and
what remains: its length, its end, whether it is the first. Start, step and observation probabilities are
relative frequencies over all labelled lines, counted in Spark. Viterbi decoding gives the likeliest roles;
lines from one begin to the next are a turn, written as its role in ``<|role|>`` and its text.

Lines are sorted over all executors by transcript and place, and each task decodes the transcripts it
holds whole. A transcript cut by the borders of tasks (a very long one may span many) is not gathered:
each part sends the best scores from every state to every state, one small matrix, the driver finds the
states at the borders, and the parts are decoded between them; the result is that of one pass.

Defined cases: a null transcript id is an id; a null line is an empty one; lines that share id and place
are in order of their text; a line of nothing but a marker begins a turn; an empty table gives no turns;
unlabelled lines do not count for fitting, and without labelled lines the model is even.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from prepkit.session import pin, pin_ordered

ROLES = ("system", "user", "assistant")
#: State 2 r begins a turn of role r, state 2 r + 1 continues it.
STATES = 2 * len(ROLES)

# Usual speaker marks.
MARKERS = {
    "system": ("system", "instruction", "instructions", "context"),
    "user": ("user", "human", "question", "q", "customer", "me"),
    "assistant": ("assistant", "ai", "bot", "answer", "a", "agent", "model"),
}
MARKER = (
    r"^\s*(?:#+\s*|\*\*|\[|<\|?)?(" + "|".join(w for words in MARKERS.values() for w in words)
    + r")(?:\s+\d+)?(?:\*\*:|:\*\*|\|?>|\]:?|\s*:)\s*"
)
_MARKER = re.compile(MARKER, re.IGNORECASE)
#: Values of each feature of a line: marker, length, last character, first line or not.
SHAPE = (len(ROLES) + 1, 5, 4, 2)


def split_marker(line: str) -> tuple[int, str]:
    """The marker (0: none, else role + 1) and the rest of a line."""
    m = _MARKER.match(line)
    if not m:
        return 0, line
    word = m.group(1).lower()
    return next(k + 1 for k, r in enumerate(ROLES) if word in MARKERS[r]), line[m.end() :]


def observe(line: str, first: bool) -> tuple[int, int, int, int]:
    """The features of a line."""
    marker, rest = split_marker(line)
    rest = rest.rstrip()
    length = 0 if not rest else 1 + sum(len(rest) > n for n in (40, 120, 360))
    end = 0 if not rest else 1 if rest[-1] in "?¿" else 2 if rest[-1] in ".!:;" else 3
    return marker, length, end, int(first)


class Model(NamedTuple):
    """Log probabilities of the first state, of steps, and of each feature's values by state."""

    start: np.ndarray
    step: np.ndarray
    values: tuple[np.ndarray, ...]

    def score(self, line: str, first: bool) -> np.ndarray:
        return sum(v[:, x] for v, x in zip(self.values, observe(line, first), strict=True))


def ordered(
    lines: DataFrame, key: str, order: Sequence[str], line: str, state: str | None = None
) -> DataFrame:
    """``key, line, state`` sorted by transcript and place over all tasks, as a checkpoint that keeps the order.

    Ranges are cut between lines and not between transcripts, so that a long transcript spans tasks.
    """
    cells = lines.select(
        F.col(key).alias("key"), F.coalesce(line, F.lit("")).alias("line"),
        (F.col(state).cast("int") if state else F.lit(None).cast("int")).alias("state"),
        *(F.col(o).alias(f"o{k}") for k, o in enumerate(order)),
    )
    sort = ["key", *(f"o{k}" for k in range(len(order))), "line"]
    tasks = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Rows that agree in everything are told apart by a number, so that they do not stay together.
    ranged = cells.withColumn("n", F.monotonically_increasing_id()).repartitionByRange(tasks, *sort, "n")
    return pin_ordered(ranged.sortWithinPartitions(*sort, "n").select("key", "line", "state"))


def fit(lines: DataFrame) -> Model:
    """A model from ``ordered`` lines whose state is known: relative frequencies over all, each plus one."""

    def count(batches):
        task, seen, ends = TaskContext.get().partitionId(), Counter(), []
        for name, held in _parts(batches):
            known = [(observe(t, k == 0), s) for k, (t, s) in enumerate(held)]
            for k, (found, s) in enumerate(known):
                if s is None or not 0 <= s < STATES:
                    continue
                for f, x in enumerate(found[:3]):
                    seen[f, s, x] += 1
                before = known[k - 1][1] if k else None
                if before is not None and 0 <= before < STATES:
                    seen[4, before, s] += 1
            ends.append((_text(name), known[0][1], known[-1][1]))
            if len(ends) > 2:
                # A transcript between two others of one task opens and ends in it.
                seen[5, 0, ends[1][1] if ends[1][1] is not None else -1] += 1
                del ends[1]
        rows = [{"what": w, "a": a, "b": b, "n": n, "key": None, "task": -1} for (w, a, b), n in seen.items()]
        for k, (name, first, last) in enumerate(ends):
            rows.append({"what": 6, "a": first, "b": last, "n": k, "key": name, "task": task})
        yield pa.RecordBatch.from_pylist(rows, schema=_COUNTS)

    got = pin(lines.mapInArrow(count, "what int, a int, b int, n long, key string, task int"), "counts")
    # One row per feature value and state, and two per task.
    sums = got.where("what < 6").groupBy("what", "a", "b").agg(F.sum("n").alias("n")).collect()
    values = [np.ones((STATES, n)) for n in SHAPE]
    start, step = np.ones(STATES), np.ones((STATES, STATES))
    for what, a, b, n in sums:
        if what < 4:
            values[what][a, b] += n
        elif what == 4:
            step[a, b] += n
        elif 0 <= b < STATES:
            start[b] += n
    last = None
    for row in sorted(got.where("what = 6").collect(), key=lambda r: (r["task"], r["n"])):
        joined = last is not None and row["n"] == 0 and last["key"] == row["key"]
        first = row["a"]
        if first is not None and 0 <= first < STATES:
            if not joined:
                start[first] += 1
            elif last["b"] is not None and 0 <= last["b"] < STATES:
                step[last["b"], first] += 1
        last = row
    values[3][:, 1] += start
    values[3][:, 0] += step.sum(axis=0)
    start[1::2] = 1e-6  # a transcript begins with the begin of a turn
    own = np.arange(STATES) // 2
    for s in range(1, STATES, 2):  # a turn is continued by its own role only
        step[own != own[s], s] = 1e-9
    normal = lambda m: np.log(m / m.sum(axis=-1, keepdims=True))
    return Model(normal(start), normal(step), tuple(map(normal, values)))


def _text(key) -> str:
    return "null" if key is None else f"={key}"


def transfer(model: Model, scores: np.ndarray, opens: bool) -> np.ndarray:
    """Best score of a part from each state before it to each state at its end.

    A part that opens a transcript has the same row for every state before.
    """
    best = np.tile(model.start, (STATES, 1)) if opens else model.step.copy()
    best = best + scores[0]
    for row in scores[1:]:
        best = (best[:, :, None] + model.step[None]).max(axis=1) + row
    return best


def decode(model: Model, scores: np.ndarray, before: int | None = None, last: int | None = None) -> np.ndarray:
    """The likeliest states, from the state before the part (None: it opens) to the given last state."""
    best = (model.start if before is None else model.step[before]) + scores[0]
    back = np.zeros((len(scores), STATES), np.int8)
    for k in range(1, len(scores)):
        total = best[:, None] + model.step
        back[k] = total.argmax(axis=0)
        best = total.max(axis=0) + scores[k]
    states = np.zeros(len(scores), np.int8)
    states[-1] = best.argmax() if last is None else last
    for k in range(len(scores) - 1, 0, -1):
        states[k - 1] = back[k, states[k]]
    return states


def _parts(batches) -> Iterator[tuple[object, list]]:
    """Runs of lines of one transcript, in order."""
    key, held = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and row[0] != key:
                yield key, held
                held = []
            key = row[0]
            held.append(row[1:])
    if held:
        yield key, held


def _borders(found: list) -> dict[int, dict[str, tuple]]:
    """By task, where its first and last part lie in transcripts that go beyond it: lines and states before, last state.

    ``found`` has the first and the last part of each task, in order.
    """
    chains: list[list] = []
    for row in found:
        if chains and row["first"] and chains[-1][-1]["key"] == row["key"]:
            chains[-1].append(row)
        else:
            chains.append([row])
    out: dict[int, dict[str, tuple]] = {}
    for chain in chains:
        if len(chain) < 2:
            continue
        best = np.array(chain[0]["opening"]).reshape(STATES, STATES)[0]
        back, lines = [], 0
        for row in chain[1:]:
            total = best[:, None] + np.array(row["inner"]).reshape(STATES, STATES)
            back.append(total.argmax(axis=0))
            best = total.max(axis=0)
        ends = [int(best.argmax())]
        for came in reversed(back):
            ends.append(int(came[ends[-1]]))
        ends.reverse()
        for k, row in enumerate(chain):
            place = (lines, None if k == 0 else ends[k - 1], ends[k])
            out.setdefault(row["task"], {})["first" if row["first"] else "last"] = place
            lines += row["lines"]
    return out


def parse(lines: DataFrame, model: Model) -> DataFrame:
    """``key, first_line, n_lines, role, text, begins, rendered`` of every turn of ``ordered`` lines.

    ``first_line`` counts the lines of the transcript from 0. A turn cut by the border of two tasks has a
    row for each part; ``begins`` is false for all but the first, and ``rendered`` joins up in order.
    """

    def ends(batches):
        task, first, last = TaskContext.get().partitionId(), None, None
        for part in _parts(batches):
            first, last = first or part, part
        rows = []
        for part in [] if first is None else [first] if last is first else [first, last]:
            texts = [t for t, _ in part[1]]
            inner = np.stack([model.score(t, False) for t in texts])
            opening = inner.copy()
            opening[0] = model.score(texts[0], True)
            rows.append(
                {"task": task, "key": _text(part[0]), "lines": len(texts), "first": part is first,
                 "opening": transfer(model, opening, True).ravel().tolist(),
                 "inner": transfer(model, inner, False).ravel().tolist()}
            )
        yield pa.RecordBatch.from_pylist(rows, schema=_ENDS)

    shape = "task int, key string, lines long, first boolean, opening array<double>, inner array<double>"
    # Two rows of fixed size per task.
    found = lines.mapInArrow(ends, shape).collect()
    borders = _borders(sorted(found, key=lambda r: (r["task"], not r["first"])))

    def turns(batches):
        own = borders.get(TaskContext.get().partitionId(), {})
        held, number = None, 0
        for part in _parts(batches):
            if held is not None:
                yield from _turns(model, *held, own.get("first") if number == 1 else None)
            held, number = part, number + 1
        if held is not None:
            # A task's only part is its first one.
            yield from _turns(model, *held, own.get("first" if number == 1 else "last"))

    kind = pa.schema(
        [("key", to_arrow_type(lines.schema["key"].dataType)), ("first_line", pa.int64()), ("n_lines", pa.int64()),
         ("role", pa.string()), ("text", pa.string()), ("begins", pa.bool_())]
    )

    def cells(batches):
        rows = []
        for row in turns(batches):
            rows.append(row)
            if len(rows) == 1000:
                yield pa.RecordBatch.from_pylist(rows, schema=kind)
                rows = []
        yield pa.RecordBatch.from_pylist(rows, schema=kind)

    of_key = lines.schema["key"].dataType.simpleString()
    shape = f"key {of_key}, first_line long, n_lines long, role string, text string, begins boolean"
    begin = F.when(F.col("begins"), F.concat(F.lit("<|"), "role", F.lit("|>\n"))).otherwise("\n")
    return lines.mapInArrow(cells, shape).withColumn("rendered", F.concat(begin, "text"))


def _turns(model: Model, key, held: list, place: tuple | None) -> Iterator[dict]:
    """The turns of one part of a transcript."""
    offset, before, last = place or (0, None, None)
    opens = before is None
    scores = np.stack([model.score(t, opens and k == 0) for k, (t, _) in enumerate(held)])
    states = decode(model, scores, before, last).tolist()
    cut = [k for k, s in enumerate(states) if k == 0 or s % 2 == 0]
    for a, b in zip(cut, [*cut[1:], len(states)], strict=True):
        begins = states[a] % 2 == 0 or opens and a == 0
        mark, rest = split_marker(held[a][0])
        # Only the mark of the role that was decoded; a turn's own text may begin like another's mark.
        first = rest if begins and mark == states[a] // 2 + 1 else held[a][0]
        yield {
            "key": key, "first_line": offset + a, "n_lines": b - a, "role": ROLES[states[a] // 2],
            "text": "\n".join([first, *(t for t, _ in held[a + 1 : b])]), "begins": begins,
        }


_COUNTS = pa.schema(
    [("what", pa.int32()), ("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64()), ("key", pa.string()),
     ("task", pa.int32())]
)
_ENDS = pa.schema(
    [("task", pa.int32()), ("key", pa.string()), ("lines", pa.int64()), ("first", pa.bool_()),
     ("opening", pa.list_(pa.float64())), ("inner", pa.list_(pa.float64()))]
)
