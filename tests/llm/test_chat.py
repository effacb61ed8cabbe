"""Roles of transcript lines: decoding beside brute force, borders of tasks, held-out accuracy."""

import itertools

import numpy as np
import pytest
from prepkit.llm import chat
from prepkit.llm.queries import transcripts
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"
#: Share of lines of unmarked turns whose role is found.
UNMARKED = 0.75


def a_model(seed=0):
    rng = np.random.default_rng(seed)
    return chat.Model(rng.normal(size=chat.STATES), rng.normal(size=(chat.STATES, chat.STATES)), ())


def test_decoding_beside_all_paths():
    model, rng = a_model(), np.random.default_rng(1)
    scores = rng.normal(size=(4, chat.STATES))
    paths = itertools.product(range(chat.STATES), repeat=4)

    def total(p):
        steps = sum(model.step[a, b] for a, b in itertools.pairwise(p))
        return model.start[p[0]] + steps + sum(scores[k, s] for k, s in enumerate(p))

    assert tuple(chat.decode(model, scores)) == max(paths, key=total)


def test_parts_decode_as_the_whole():
    model, rng = a_model(2), np.random.default_rng(3)
    scores = rng.normal(size=(60, chat.STATES))
    whole = chat.decode(model, scores)
    cuts = [0, 1, 20, 21, 45, 60]
    found = []
    for k, (a, b) in enumerate(itertools.pairwise(cuts)):
        part = scores[a:b]
        found.append({
            "task": k, "key": "=x", "lines": b - a, "first": True,
            "opening": chat.transfer(model, part, True).ravel().tolist(),
            "inner": chat.transfer(model, part, False).ravel().tolist(),
        })
    borders = chat._borders(found)
    got = []
    for k, (a, b) in enumerate(itertools.pairwise(cuts)):
        offset, before, last = borders[k]["first"]
        assert offset == a
        got += chat.decode(model, scores[a:b], before, last).tolist()
    assert got == whole.tolist()


@pytest.mark.parametrize(
    ("line", "marker", "rest"),
    [("User: hi", 2, "hi"), ("### Assistant: a", 3, "a"), ("[system] x", 1, "x"), ("Q: why?", 2, "why?"), ("A:", 3, ""),
     ("Users say: no", 0, "Users say: no"), ("An apple", 0, "An apple"), ("**Human:** yo", 2, "yo"), ("", 0, "")],
)
def test_markers(line, marker, rest):
    assert chat.split_marker(line) == (marker, rest)


def lines_of(spark, where):
    conversations = spark.read.parquet(f"{SF}/conversations.parquet").where(where)
    return transcripts(conversations)


def roles(turns):
    return {
        (r["key"], r["first_line"] + k): r["role"] for r in turns.collect() for k in range(r["n_lines"])
    }


def truth(lines):
    out, count = {}, {}
    for r in sorted(lines.collect(), key=lambda r: (r["conv_id"], r["turn"], r["part"])):
        k = count[r["conv_id"]] = count.get(r["conv_id"], -1) + 1
        out[r["conv_id"], k] = chat.ROLES[r["state"] // 2]
    return out


def test_held_out_roles(spark):
    train = chat.ordered(lines_of(spark, "conv_id % 2 = 0"), "conv_id", ["turn", "part"], "line", "state")
    held = lines_of(spark, "conv_id % 2 = 1")
    model = chat.fit(train)
    got = roles(chat.parse(chat.ordered(held, "conv_id", ["turn", "part"], "line"), model))
    want = truth(held)
    assert set(got) == set(want)
    assert sum(got[k] == want[k] for k in want) > 0.9 * len(want)


def unmarked(lines):
    """Places of the lines of turns that have no mark."""
    rows = lines.withColumn("bare", F.pmod(F.xxhash64("conv_id", "turn"), F.lit(5)) == 0).collect()
    out, count = set(), {}
    for r in sorted(rows, key=lambda r: (r["conv_id"], r["turn"], r["part"])):
        k = count[r["conv_id"]] = count.get(r["conv_id"], -1) + 1
        if r["bare"]:
            out.add((r["conv_id"], k))
    return out


def test_held_out_roles_of_turns_without_marks(spark):
    """Fitted on one half by a hash of the id, decoded on the other; turns without a mark are told by what stands around."""
    half = lambda k: lines_of(spark, f"pmod(hash(conv_id), 2) = {k}")
    model = chat.fit(chat.ordered(half(0), "conv_id", ["turn", "part"], "line", "state"))
    held = half(1)
    got = roles(chat.parse(chat.ordered(held, "conv_id", ["turn", "part"], "line"), model))
    want, bare = truth(held), unmarked(held)
    right = [got[k] == want[k] for k in bare]
    commonest = max(sum(want[k] == r for k in bare) for r in chat.ROLES)
    print(f"{sum(right)} of {len(right)} lines of unmarked turns, commonest role {commonest}")
    assert len(right) > 100 and sum(right) > max(UNMARKED * len(right), commonest)


def test_only_the_mark_of_the_decoded_role_is_taken_off(spark):
    """A user's turn that begins like another role's mark keeps its words."""
    lines = lines_of(spark, "conv_id < 40")
    model = chat.fit(chat.ordered(lines, "conv_id", ["turn", "part"], "line", "state"))
    for turn in chat._turns(model, 1, [("User: a question", None), ("Assistant: Context: this is so", None)], None):
        assert turn["text"] in ("a question", "Context: this is so")
    sure = chat.Model(np.array([-9.0] * 2 + [0.0] + [-9.0] * (chat.STATES - 3)), model.step, model.values)
    first = next(iter(chat._turns(sure._replace(values=tuple(0 * v for v in model.values)), 1, [("Context: mine", None)], None)))
    assert first["role"] == "user" and first["text"] == "Context: mine"


def test_one_long_transcript_over_many_tasks(spark):
    """All lines as one transcript: parts on all tasks give what one task gives."""
    one = lines_of(spark, "conv_id < 60").selectExpr("7 as conv_id", "conv_id * 100 + turn as turn", "part", "line", "state")
    spread = chat.ordered(one, "conv_id", ["turn", "part"], "line", "state")
    assert spread.rdd.getNumPartitions() > 1
    model = chat.fit(spread)
    many = chat.parse(spread, model)
    held = [(r["line"], None) for r in sorted(one.collect(), key=lambda r: (r["turn"], r["part"]))]
    alone = list(chat._turns(model, 7, held, None))
    want = {(7, r["first_line"] + k): r["role"] for r in alone for k in range(r["n_lines"])}
    assert roles(many) == want
    text = "".join("\n" * (not r["begins"]) + r["text"] for r in sorted(many.collect(), key=lambda r: r["first_line"]))
    assert text == "".join(r["text"] for r in alone)
    assert chat.fit(spread.coalesce(1)).step == pytest.approx(model.step)


def test_defined_cases(spark):
    rows = [(None, 0, "User: a"), (None, 1, None), (1, 0, "Q: b"), (1, 0, "A: c"), (1, None, "System: s"), (2, 0, "x")]
    df = spark.createDataFrame(rows, "id int, n int, t string")
    lines = chat.ordered(df.withColumn("key", df["t"]), "id", ["n"], "t")
    model = chat.fit(lines)
    assert np.isfinite(model.step).all()
    turns = chat.parse(lines, model).collect()
    assert {(r["key"], r["first_line"]) for r in turns if r["begins"]} >= {(None, 0), (1, 0), (2, 0)}
    assert all(r["rendered"].startswith(f"<|{r['role']}|>\n") == r["begins"] for r in turns)
    none = chat.ordered(df.where("false"), "id", ["n"], "t")
    assert chat.parse(none, chat.fit(none)).count() == 0
