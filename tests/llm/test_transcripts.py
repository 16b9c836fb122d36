import itertools
import random
import zlib

import numpy as np
import pytest

from playtrail.llm import transcripts as tr

SF = "/root/testdata/sf0.01"


def whole_path(model, seen):
    """Plain Viterbi over all lines at once: the weight of the best path and the path."""
    weight, back = model.start + model.emit[:, seen[0]], []
    for o in seen[1:]:
        reach = weight[:, None] + model.move
        back.append(reach.argmax(axis=0))
        weight = reach.max(axis=0) + model.emit[:, o]
    path = [int(weight.argmax())]
    for step in reversed(back):
        path.append(int(step[path[-1]]))
    return path[::-1]


def weight_of(model, seen, path):
    return model.start[path[0]] + model.emit[path[0], seen[0]] + sum(model.move[a, b] + model.emit[b, o] for a, b, o in zip(path, path[1:], seen[1:]))


def test_markers():
    cases = {"User: hi": ("user", "hi"), "### Human:": ("user", ""), "<|assistant|> ok": ("assistant", "ok"), "<|im_start|>system": ("system", ""), "[bot] x": ("assistant", "x"),
             "**AI**: y": ("assistant", "y"), "Note: z": ("other", "Note: z"), "plain": (None, "plain"), "": (None, "")}
    assert {c: tr.marker(c) for c in cases} == cases


def test_held_out_roles_are_recovered(spark):
    chats = spark.read.parquet(f"{SF}/conversations.parquet")
    raw = tr.raw_transcripts(chats)
    rows = tr.summary(tr.parse(raw, tr.fit(raw)), chats.select("conv_id", "turn", "role")).collect()
    assert len(rows) == chats.select("conv_id").distinct().count()
    held = [r for r in rows if zlib.crc32(str(r.conv_id).encode()) % 5 == 3]
    assert held and sum(r.n_right for r in held) / sum(r.n_lines for r in held) > 0.9


@pytest.mark.parametrize("block", [1, 3, 256])
def test_blocks_give_the_best_path(spark, frame, monkeypatch, block):
    monkeypatch.setattr(tr, "BLOCK", block)
    rng = random.Random(block)
    rows = [(c, t, rng.choice(["User: a?", "plain line", "A: " + "x" * 100, "### System:\nlong\n\nmore", "", "y" * 300 + "\nz?"])) for c in range(12) for t in range(rng.randint(1, 11))]
    chats = spark.read.parquet(f"{SF}/conversations.parquet")
    model = tr.fit(tr.raw_transcripts(chats))
    got = {}
    for r in tr.parse(frame(rows, "conv_id long, turn long, text string"), model).collect():
        got.setdefault(r.conv_id, []).append(((r.block, r.place), r.line, r.role, r.begins))
    for c, group in itertools.groupby(rows, key=lambda r: r[0]):
        group = list(group)
        lines = [line for r in group for line in r[2].split("\n")]
        mine = sorted(got[c])
        assert [m[1] for m in mine] == lines
        seen = [tr.observe(line, n == 0) for r in group for n, line in enumerate(r[2].split("\n"))]
        path = [tr.STATES.index((m[2], m[3])) for m in mine]
        assert abs(weight_of(model, seen, path) - weight_of(model, seen, whole_path(model, seen))) < 1e-9


def test_canonical_form(spark, frame):
    chats = spark.read.parquet(f"{SF}/conversations.parquet")
    model = tr.fit(tr.raw_transcripts(chats))
    out = tr.parse(frame([(1, 0, "User: what is it?"), (1, 1, "Assistant: It is a thing.\nSo it is."), (1, 2, "User: why?")], "conv_id long, turn long, text string"), model)
    text = "\n".join(r.rendered for r in out.orderBy("block", "place").collect())
    assert text == "<|user|>\nwhat is it?\n<|assistant|>\nIt is a thing.\nSo it is.\n<|user|>\nwhy?"


def test_edges(spark, frame):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, "assistant", "b"), (1, None, "user", "first"), (None, 3, "user", "x"), (None, 4, None, None), (2, -5, "robot", ""), (2, 10 ** 12, "user", "late")]
    chats = frame([(*r, 1, 2) for r in rows], "conv_id long, turn long, role string, text string, block int, place int")
    model = tr.fit(chats)
    got = tr.parse(chats, model).collect()
    assert len(got) == 7 and {r.role for r in got} <= set(tr.ROLES)
    one = sorted(((r.block, r.place), r.line) for r in got if r.conv_id == 1)
    assert [x[1] for x in one] == ["first", "a", "b"]
    assert all(np.isfinite(x).all() for x in (model.start, model.move, model.emit))
    empty = chats.limit(0)
    assert tr.parse(empty, tr.fit(empty)).count() == 0 and tr.parse(chats, tr.fit(empty)).count() == 7
    assert tr.summary(tr.parse(chats, model), chats).count() == 3
