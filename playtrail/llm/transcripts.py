"""Chat transcripts to turns: a hidden Markov model over lines recovers who speaks, then turns are rendered alike.

A state is a role and whether the line begins a turn. A line is observed through the marker it begins with, its length,
whether it asks and whether it opens a piece of the transcript. Start, transition and emission probabilities are counted on conversations with known roles. The
best path is found block by block: a block of turns is a table of best path weights from each state before it to each
state at its end, these few numbers are chained along the conversation, and each block is then decoded on its own
between its two border states. So a conversation with a third of all lines is spread over many tasks.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import in_fold, pieces, written

ROLES = ("system", "user", "assistant")
STATES = [(role, begins) for role in ROLES for begins in (True, False)]
# Names that speakers go by.
NAMES = {"system": ("system", "sys", "instructions", "context"), "user": ("user", "human", "q", "question", "prompter", "customer", "me"),
         "assistant": ("assistant", "ai", "bot", "a", "answer", "gpt", "agent", "model")}
ROLE_OF = {name: role for role, names in NAMES.items() for name in names}
MARKER = re.compile(r"^\s*(?:<\|im_start\|>\s*([a-z]+)|<\|?\s*([a-z]+)\s*\|?>|#{2,4}\s*([a-z]+)\s*:?|\[([a-z]+)\]\s*:?|\**([a-z]+)\**\s*:)\s*", re.IGNORECASE)
LENGTHS = (1, 60, 200)
BLOCK = 256  # turns of a block
SMOOTH = 0.5
HELD = (5, 3)  # folds of the key and the one never learnt from
FEATURES = (len(ROLES) + 2, len(LENGTHS) + 1, 2, 2)  # values of marker, length, asks, opens
SYMBOLS = int(np.prod(FEATURES))


def marker(line: str) -> tuple[str | None, str]:
    """The role a line's marker names ('other' for a name nobody goes by, none without marker) and the rest."""
    found = MARKER.match(line)
    if not found:
        return None, line
    role = ROLE_OF.get(next(g for g in found.groups() if g).lower())
    return (role, line[found.end():]) if role else ("other", line)


def observe(line: str, opens: bool) -> int:
    """The symbol of a line: its marker, length, whether it asks, and whether it opens a piece of the transcript."""
    role, rest = marker(line)
    kind = 0 if role is None else 1 if role == "other" else 2 + ROLES.index(role)
    return (kind * (len(LENGTHS) + 1) + sum(len(rest) >= n for n in LENGTHS)) * 4 + 2 * rest.rstrip().endswith("?") + opens


@dataclass(frozen=True)
class Model:
    """Log probabilities: start (state), move (state, next state), emit (state, observation)."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray


def best_from(model: Model, entry: np.ndarray, seen: list[int]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Weights of the best paths to each state after the lines, and where they came from."""
    back = []
    for o in seen:
        reach = entry[:, None] + model.move
        back.append(reach.argmax(axis=0))
        entry = reach.max(axis=0) + model.emit[:, o]
    return entry, back


def border_table(model: Model, seen: list[int], opens: bool) -> np.ndarray:
    """Best weights from each state before the lines to each state at their end; a conversation's first lines have the
    same row for every state before."""
    rows = []
    for before in range(len(STATES)):
        if opens:
            after, _ = best_from(model, model.start + model.emit[:, seen[0]], seen[1:])
        else:
            entry = np.full(len(STATES), -np.inf)
            entry[before] = 0.0
            after, _ = best_from(model, entry, seen)
        rows.append(after)
    return np.array(rows)


def decode(model: Model, seen: list[int], before: int | None, end: int) -> list[int]:
    """The states of the lines on the best path from `before` (none: the start) to `end`."""
    if before is None:
        _, back = best_from(model, model.start + model.emit[:, seen[0]], seen[1:])
    else:
        entry = np.full(len(STATES), -np.inf)
        entry[before] = 0.0
        _, back = best_from(model, entry, seen)
        back = back[1:]
    path = [end]
    for step in reversed(back):
        path.append(int(step[path[-1]]))
    return path[::-1]


def blocks(chats: DataFrame, key: str, turn: str, text: str, *more: str) -> DataFrame:
    """Rows with the block they belong to; null turns come first, in blocks by their text."""
    no_turn = F.pmod(F.xxhash64(text), F.lit(64))
    block = F.when(F.col(turn).isNull(), no_turn - F.lit(2 ** 60)).otherwise(F.floor(F.col(turn) / BLOCK)).cast("long")
    return chats.select(F.col(key).alias("conv_id"), block.alias("block"), F.col(turn).cast("long").alias("turn"), F.coalesce(text, F.lit("")).alias("text"), *more)


def ordered(group: pa.Table, *more: str) -> list[tuple]:
    """Distinct rows of a block in order of turn, then text."""
    rows = set(zip(*(group.column(c).to_pylist() for c in ("turn", "text", *more))))
    return sorted(rows, key=lambda r: tuple((v is not None, v if v is not None else 0) for v in r))


def lines_of(rows: list[tuple]) -> list[tuple[int, str, int]]:
    """(index of the row, line, observation) of all rows; an empty text is one empty line."""
    return [(i, line, observe(line, n == 0)) for i, r in enumerate(rows) for n, line in enumerate(r[1].split("\n"))]


def fit(chats: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
        held: tuple[int, int] = HELD) -> Model:
    """Probabilities counted over all conversations with known roles outside the held-out fold.

    A row is one turn. Unknown and null roles teach nothing. Without any row all paths are alike.
    """
    def run(group: pa.Table) -> pa.Table:
        counts: Counter = Counter()
        last = None
        for r in ordered(group, "role"):
            for n, line in enumerate(r[1].split("\n")):
                state = STATES.index((r[2], n == 0))
                counts["emit", state, observe(line, n == 0)] += 1
                counts["start" if last is None else "move", last or 0, state] += 1
                last = state
        rows = [(*k, c) for k, c in counts.items()]
        return pa.table({n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate((("kind", pa.string()), ("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64())))})

    known = chats.where(F.col(role).isin(*ROLES) & F.col(key).isNotNull() & ~in_fold(key, *held))
    counted = (blocks(known, key, turn, text, F.col(role).alias("role")).groupBy("conv_id", "block")
               .applyInArrow(run, "kind string, a int, b int, n long").groupBy("kind", "a", "b").agg(F.sum("n").alias("n")).collect())
    start, move, emit = np.full(len(STATES), SMOOTH), np.full((len(STATES), len(STATES)), SMOOTH), np.zeros((len(STATES), SYMBOLS))
    for r in counted:
        if r.kind == "emit":
            emit[r.a, r.b] += r.n
        elif r.kind == "move":
            move[r.a, r.b] += r.n
        else:
            start[r.b] += r.n
    opening = np.array([begins for _, begins in STATES])
    start[~opening] = 1e-9  # a conversation opens with the first line of a turn
    for i, (name, _) in enumerate(STATES):  # and a turn goes on in its own role
        move[i, [j for j, (other, begins) in enumerate(STATES) if not begins and other != name]] = 1e-9
    each, weights = np.unravel_index(np.arange(SYMBOLS), FEATURES), np.zeros_like(emit)
    for values, place in zip(FEATURES, each):  # features are independent given the state
        part = np.stack([np.bincount(place, weights=row, minlength=values) for row in emit]) + SMOOTH
        weights += np.log(part / part.sum(axis=1, keepdims=True))[:, place]
    return Model(np.log(start / start.sum()), np.log(move / move.sum(axis=1, keepdims=True)), weights)


def parse(chats: DataFrame, model: Model, key: str = "conv_id", turn: str = "turn", text: str = "text") -> DataFrame:
    """One row per line of every conversation: conv_id, block, place (order inside the block), turn, line, role, begins,
    rendered. Rows of `chats` are pieces of raw transcripts in order of `turn`; their roles are not read.

    rendered is the canonical form: '<|role|>' and a line break before the first line of a turn, markers taken off. The
    lines of a conversation in order (block, place), joined with line breaks, are its canonical transcript. Null texts
    are empty lines; null turns come first; rows alike count once; rows with a null key form a conversation of their
    own. An empty table gives no rows; other columns are not read.
    """
    shared = chats.sparkSession.sparkContext.broadcast(model)
    kind = chats.schema[key].dataType.simpleString()
    key_type = {"bigint": pa.int64(), "int": pa.int32()}.get(kind, pa.string())
    cut = blocks(chats, key, turn, text)

    def border(group: pa.Table) -> pa.Table:
        seen = [o for _, _, o in lines_of(ordered(group))]
        both = [border_table(shared.value, seen, opens) for opens in (True, False)]
        return pa.table({"conv_id": group.column("conv_id")[:1], "block": group.column("block")[:1],
                         "opening": pa.array([both[0][0].tolist()], pa.list_(pa.float64())), "table": pa.array([both[1].ravel().tolist()], pa.list_(pa.float64()))})

    def chain(group: pa.Table) -> pa.Table:
        group = group.sort_by("block")
        weights, back = None, []
        for opening, table in zip(group.column("opening").to_pylist(), group.column("table").to_pylist()):
            if weights is None:
                weights = np.array(opening)
            else:
                reach = weights[:, None] + np.array(table).reshape(len(STATES), -1)
                back.append(reach.argmax(axis=0))
                weights = reach.max(axis=0)
        ends = [int(weights.argmax())]
        for step in reversed(back):
            ends.append(int(step[ends[-1]]))
        ends.reverse()
        return pa.table({"conv_id": group.column("conv_id"), "block": group.column("block"), "before": pa.array([None, *ends[:-1]], pa.int32()), "end": pa.array(ends, pa.int32())})

    def lines(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = ordered(left)
        every = lines_of(rows)
        path = decode(shared.value, [o for _, _, o in every], right.column("before")[0].as_py(), right.column("end")[0].as_py())
        out = []
        for (i, line, _), state in zip(every, path):
            role, begins = STATES[state]
            named, rest = marker(line)
            plain = rest if named in ROLES else line
            out.append((rows[i][0], line, role, begins, f"<|{role}|>\n{plain}" if begins else plain))
        n = len(out)
        return pa.table([pa.array([left.column("conv_id")[0].as_py()] * n, key_type), pa.array([left.column("block")[0].as_py()] * n, pa.int64()), pa.array(range(n), pa.int32()),
                         *(pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.string())))],
                        names=["conv_id", "block", "place", "turn", "line", "role", "begins", "rendered"])

    borders = cut.groupBy("conv_id", "block").applyInArrow(border, f"conv_id {kind}, block long, opening array<double>, table array<double>")
    ends = written(borders.groupBy("conv_id").applyInArrow(chain, f"conv_id {kind}, block long, before int, end int"), "chat-borders")
    return (cut.groupBy("conv_id", "block").cogroup(ends.groupBy("conv_id", "block"))
            .applyInArrow(lambda a, b: lines(a, b), f"conv_id {kind}, block long, place int, turn long, line string, role string, begins boolean, rendered string"))


# Ways to mark speakers in raw transcripts; the last marks none.
STYLES = ({"system": "System: ", "user": "User: ", "assistant": "Assistant: "}, {"system": "### Instructions:\n", "user": "### Human:\n", "assistant": "### AI:\n"},
          {"system": "[context] ", "user": "Q: ", "assistant": "A: "}, {"system": "<|system|> ", "user": "<|user|> ", "assistant": "<|assistant|> "},
          {"system": "", "user": "", "assistant": ""})


def raw_transcripts(chats: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The turns as raw transcript pieces: each conversation marks speakers in one of STYLES, a sixth of the turns lack it."""
    style = F.crc32(F.concat(F.lit("style"), F.coalesce(F.col(key).cast("string"), F.lit("")))) % len(STYLES)
    bare = F.crc32(F.concat_ws(":", F.col(key).cast("string"), F.col(turn).cast("string"))) % 6 == 0
    mark = F.lit("")
    for number, marks in enumerate(STYLES):
        for name, shown in marks.items():
            mark = F.when((style == number) & (F.col(role) == name) & ~bare, shown).otherwise(mark)
    return chats.select(key, turn, role, F.concat(mark, F.coalesce(text, F.lit(""))).alias(text))


def summary(parsed: DataFrame, truth: DataFrame) -> DataFrame:
    """Per conversation: lines, turns, lines whose role is the true one, and a digest of the canonical transcript.

    truth: (conv_id, turn, role). The digest adds hashes of (block, place, rendered), so no task sees a whole long
    conversation. Turns that truth holds several times agree when any of them does.
    """
    known = truth.groupBy("conv_id", "turn").agg(F.collect_set("role").alias("roles"))
    both = parsed.join(known, ["conv_id", "turn"], "left")
    part = F.xxhash64("block", "place", "rendered").cast("decimal(38,0)")
    return both.groupBy("conv_id").agg(
        F.count("*").alias("n_lines"), F.sum(F.col("begins").cast("long")).alias("n_turns"),
        F.sum(F.coalesce(F.array_contains("roles", F.col("role")), F.lit(False)).cast("long")).alias("n_right"),
        F.sum(part).cast("string").alias("digest"))
