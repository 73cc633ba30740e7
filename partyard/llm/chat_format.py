"""Transcripts into chat turns: a hidden Markov model names the speaker of every line.

The lines of a conversation are the observations: a speaker marker, if the line starts
with one, the line's length class, whether it asks, and whether it opens a turn.  The
hidden states are the roles.  Start, transition and emission tables are counted over
all turns whose role is given; pseudo-counts tie markers to their roles, so a marker
decides where no data speak against it.  Viterbi finds the likeliest role sequence
without looking at the given roles, and runs of lines with one role become segments,
rendered in one canonical form.

A conversation is cut into blocks of at most ``BLOCK`` rows and about ``LINES`` lines:
rows are sorted over all tasks by conversation, turn and text digest, and each task
numbers the blocks of its own range, so one conversation may lie in many.  Each block gives the best score from
every entering to every leaving role; these small tables are combined in levels, the
roles at the cuts are settled from the top down, and then each block is decoded on
its own.  So no task holds a conversation, only a block of it (a single text
is never cut).

A null turn number counts as 0, a null conversation id is a conversation of its own.
Rows of a conversation that repeat turn and text are decoded once; ``copies`` says how
many they are, and each trains the model.  Null and empty texts are one empty line.
Roles other than the known ones do not train the model.  Other columns are not
read; an empty table gives no rows.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from partyard.llm.common import column, map_columns, map_runs
from partyard.session import stored

ROLES = ("system", "user", "assistant", "tool")
ALIASES = {
    "system": "system",
    "instruction": "system",
    "user": "user",
    "human": "user",
    "customer": "user",
    "question": "user",
    "q": "user",
    "assistant": "assistant",
    "ai": "assistant",
    "bot": "assistant",
    "agent": "assistant",
    "answer": "assistant",
    "a": "assistant",
    "tool": "tool",
    "function": "tool",
}
MARKER = re.compile(
    r"\s{0,3}(?:#{1,4}\s{1,3}|<\|(?:im_start\|>)?|\[|\*\*|>\s?)?("
    + "|".join(sorted(ALIASES, key=len, reverse=True))
    + r")\s?(?:\d{1,3}\s?)?(?::\*\*|\*\*:|\|>|\]:?|:)\s?",
    re.IGNORECASE,
)
LENGTHS = 10  # classes of line length: powers of two, the last one open
BLOCK = 256
LINES = 65_536
MARKER_PRIOR = 200.0
#: Probability that the speaker changes inside a turn, at a line without and with a marker.
CHANGE, CHANGE_MARKED = 1e-4, 0.5

S = len(ROLES)
N = S + 1  # the last state stands before the first line and is never entered


def marker_of(line: str) -> tuple[int, int]:
    """Marker class (0: none, k + 1: role k) and where the line's content starts."""
    m = MARKER.match(line)
    return (ROLES.index(ALIASES[m[1].lower()]) + 1, m.end()) if m else (0, 0)


def observe(text: str | None) -> list[int]:
    """One code per line: marker, length class, question, first line of the turn."""
    out = []
    for k, line in enumerate((text or "").split("\n")):
        length = min(len(line).bit_length(), LENGTHS - 1)
        asks = line.rstrip().endswith("?")
        out.append(((marker_of(line)[0] * LENGTHS + length) * 2 + asks) * 2 + (k == 0))
    return out


def parts(code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return code // (4 * LENGTHS), code // 4 % LENGTHS, code // 2 % 2, code % 2


class Model:
    """Log tables of the model, from counted codes, starts and turn changes."""

    def __init__(self, codes: dict[tuple[int, int], int], starts: dict[int, int], changes: dict[tuple[int, int], int]) -> None:
        marks = np.ones((2, S, S + 1))
        marks[:, :, 0] = MARKER_PRIOR
        for r in range(S):
            marks[:, r, r + 1] = MARKER_PRIOR
        lengths, asks = np.ones((2, S, LENGTHS)), np.ones((2, S, 2))
        for (role, code), n in codes.items():
            mark, length, ask, first = (int(x) for x in parts(np.array(code)))
            marks[first, role, mark] += n if mark in (0, role + 1) else 0
            lengths[first, role, length] += n
            asks[first, role, ask] += n
        # How often lines carry markers at all says nothing about the role.
        marks[:, :, 0] = 1
        self.marks, self.lengths, self.asks = (np.log(t / t.sum(axis=2, keepdims=True)) for t in (marks, lengths, asks))
        self.marks[:, :, 0] = 0.0
        start, change = np.ones(S), np.ones((S, S))
        for role, n in starts.items():
            start[role] += n
        for (a, b), n in changes.items():
            change[a, b] += n
        start, change = np.log(start / start.sum()), np.log(change / change.sum(axis=1, keepdims=True))
        self.change = np.full((N, N), -np.inf)
        self.change[:S, :S], self.change[S, :S] = change, start
        self.inside = [_stay(CHANGE), _stay(CHANGE_MARKED)]

    def steps(self, codes: np.ndarray) -> np.ndarray:
        """For every line the score of coming from role i into role j, its emission included."""
        mark, length, ask, first = parts(codes)
        emit = self.marks[first, :, mark] + self.lengths[first, :, length] + self.asks[first, :, ask]
        kinds = np.stack([*self.inside, self.change])
        out = kinds[np.where(first == 1, 2, (mark > 0).astype(int))]
        out[:, :, :S] += emit[:, None, :]
        return out


def _stay(p: float) -> np.ndarray:
    out = np.full((N, N), -np.inf)
    out[:S, :S] = np.log(p / (S - 1))
    np.fill_diagonal(out[:S, :S], np.log(1 - p))
    return out


def product(steps: np.ndarray) -> np.ndarray:
    """Best score from every entering to every leaving role over a chain of steps."""
    out = steps[0]
    for step in steps[1:]:
        out = (out[:, :, None] + step[None]).max(axis=1)
    return out


def viterbi(steps: np.ndarray, enter: int | None, leave: int | None) -> list[int]:
    """Roles after each step of the best path between two roles.

    Without ``enter`` the path starts before the first line; without ``leave`` it may
    end anywhere.
    """
    score = np.full(N, -np.inf)
    score[S if enter is None else enter] = 0.0
    back = []
    for step in steps:
        ways = score[:, None] + step
        back.append(ways.argmax(axis=0))
        score = ways.max(axis=0)
    state = int(score.argmax()) if leave is None else leave
    path = [state]
    for choice in back[:0:-1]:
        state = int(choice[state])
        path.append(state)
    return path[::-1]


OBSERVED = (
    "conv_id long, turn long, text_key string, text string, copies long, as_role array<long>,"
    " part int, block long, codes array<int>"
)


def _observed(rows: DataFrame) -> DataFrame:
    """Line codes of every row, and its block among those of its task and conversation."""

    def make():
        conv, block, held, lines = None, -1, 0, 0

        def work(cols):
            nonlocal conv, block, held, lines
            codes = [observe(t) for t in cols["text"]]
            blocks = []
            for own, found in zip(cols["conv_id"], codes, strict=True):
                if block < 0 or own != conv:
                    conv, block, held, lines = own, 0, 0, 0
                elif held == BLOCK or lines + len(found) > LINES:
                    block, held, lines = block + 1, 0, 0
                held, lines = held + 1, lines + len(found)
                blocks.append(block)
            return cols | {"codes": codes, "block": blocks}

        return work

    order = ("conv_id", "turn", "text_key")
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return map_columns(ordered.withColumn("part", F.spark_partition_id()), OBSERVED, make)


def _blocks(observed: DataFrame) -> DataFrame:
    """The rows with their block's place in the whole conversation."""
    sizes = observed.groupBy("conv_id", "part").agg((F.max("block") + 1).alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select(F.col("conv_id").alias("c"), F.col("part").alias("p"), F.sum("n").over(before).alias("first"))
    moved = stored(first.filter("first > 0"))  # a row per task at most: its range starts inside one conversation
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p"))
    placed = observed.join(F.broadcast(moved), same, "left")
    return placed.withColumn("block", F.col("block") + F.coalesce("first", F.lit(0))).drop("c", "p", "first", "part")


def fit(observed: DataFrame) -> Model:
    """Count the model's tables over all rows with a known role."""
    known = observed.select("conv_id", "turn", "codes", F.posexplode("as_role").alias("r", "n")).filter("n > 0")
    codes = known.select("r", "n", F.explode("codes").alias("code")).groupBy("r", "code").agg(F.sum("n").alias("n"))
    turns = known.groupBy("conv_id", "turn").agg(F.min("r").alias("r"))
    before = turns.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("r").alias("p"))
    moves = turns.join(before, ["conv_id", "turn"], "left").groupBy("p", "r").count().collect()
    return Model(
        {(x.r, x.code): x.n for x in codes.collect()},
        {x.r: x["count"] for x in moves if x.p is None},
        {(x.p, x.r): x["count"] for x in moves if x.p is not None},
    )


def _products(blocks: DataFrame, model: Model) -> DataFrame:
    """Score table of every block of turns."""

    def make():
        def work(run):
            codes = np.array([c for turn in run["codes"] for c in turn])
            table = product(model.steps(codes)).ravel().tolist()
            return {"conv_id": run["conv_id"][:1], "block": run["block"][:1], "scores": [table]}

        return work

    lean = blocks.select("conv_id", "block", "turn", "text_key", "codes")
    return map_runs(
        lean, ["conv_id", "block"], ["turn", "text_key"], "conv_id long, block long, scores array<double>", make
    )


def _chains(tables: list[DataFrame]) -> DataFrame:
    """Entering and leaving role of every block, from the top level down to the blocks.

    Level k + 1 has one table per ``BLOCK`` tables of level k.
    """

    def joined(run) -> np.ndarray:
        return np.array(run["scores"]).reshape(-1, N, N)

    def combine():
        def work(run):
            return {
                "conv_id": run["conv_id"][:1],
                "block": run["upper"][:1],
                "scores": [product(joined(run)).ravel().tolist()],
            }

        return work

    def settle():
        def work(run):
            enter = run["enter"][0]
            path = viterbi(joined(run), enter, run["leave"][0])
            return {
                "conv_id": run["conv_id"],
                "block": run["block"],
                "enter": [enter, *path[:-1]],
                "leave": path,
            }

        return work

    upper = F.floor(F.col("block") / BLOCK).cast("long").alias("upper")
    while tables[-1].agg(F.max("block")).first()[0]:
        grouped = tables[-1].select("conv_id", upper, "block", "scores")
        tables.append(
            stored(
                map_runs(
                    grouped, ["conv_id", "upper"], ["block"], "conv_id long, block long, scores array<double>", combine
                )
            )
        )
    free = F.lit(None).cast("int")  # the best role may start and end a conversation
    settled = tables[-1].select("conv_id", "block", free.alias("enter"), free.alias("leave"))
    for table in tables[-2::-1]:
        above = settled.select(F.col("conv_id").alias("c"), F.col("block").alias("upper"), "enter", "leave")
        children = table.select("conv_id", upper, "block", "scores")
        same = F.col("conv_id").eqNullSafe(F.col("c")) & (children["upper"] == above["upper"])
        ready = children.join(above, same).select("conv_id", children["upper"], "block", "scores", "enter", "leave")
        settled = stored(
            map_runs(
                ready, ["conv_id", "upper"], ["block"], "conv_id long, block long, enter int, leave int", settle
            )
        )
    return settled


def segments(text: str | None, roles: list[int]) -> list[tuple[int, str]]:
    """Runs of lines with one role: role and content without its markers."""
    out: list[tuple[int, list[str]]] = []
    for line, role in zip((text or "").split("\n"), roles, strict=True):
        mark, start = marker_of(line)
        content = line[start:] if mark == role + 1 else line
        if out and out[-1][0] == role and mark != role + 1:
            out[-1][1].append(content)
        else:
            out.append((role, [content]))
    return [(r, "\n".join(lines).strip("\n")) for r, lines in out]


def render(role: str, content: str) -> str:
    """Canonical form of a turn; its own control marks inside a content are broken up."""
    safe = content.replace("<|", "< |")
    return f"<|im_start|>{role}\n{safe}<|im_end|>\n"


def format_chats(rows: DataFrame) -> DataFrame:
    """conv_id, turn, segment, role, content, rendered turn and copies of every segment.

    ``rows`` has conv_id, turn, text and, for training, role.
    """
    raw = rows.select(
        column(rows, "conv_id", "long"),
        F.coalesce(column(rows, "turn", "long"), F.lit(0)).alias("turn"),
        column(rows, "role", "string"),
        column(rows, "text", "string"),
    )
    numbers = {name: ROLES.index(role) for name, role in ALIASES.items()}
    number = F.create_map(*(F.lit(x) for pair in numbers.items() for x in pair))[F.lower("role")]
    keyed = raw.withColumns({"text_key": F.md5(F.coalesce("text", F.lit(""))), "r": number})
    once = keyed.groupBy("conv_id", "turn", "text_key").agg(
        F.first("text").alias("text"),
        F.count("*").alias("copies"),
        F.array(*(F.count_if(F.col("r") == k) for k in range(S))).alias("as_role"),
    )
    observed = stored(_observed(once))
    model = fit(observed)
    blocks = _blocks(observed)
    ends = _chains([stored(_products(blocks, model))])
    named = ends.select(F.col("conv_id").alias("c"), F.col("block").alias("b"), "enter", "leave")
    ready = blocks.join(named, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b"))).select(
        "conv_id", "block", "turn", "text_key", "text", "copies", "codes", "enter", "leave"
    )

    def make():
        def work(run):
            codes = np.array([c for turn in run["codes"] for c in turn])
            path = viterbi(model.steps(codes), run["enter"][0], run["leave"][0])
            out = {n: [] for n in ("conv_id", "turn", "segment", "role", "content", "rendered", "copies")}
            at = 0
            rows = zip(*(run[n] for n in ("conv_id", "turn", "text", "copies", "codes")), strict=True)
            for conv, turn, text, copies, own in rows:
                for k, (role, content) in enumerate(segments(text, path[at : at + len(own)])):
                    values = (conv, turn, k, ROLES[role], content, render(ROLES[role], content), copies)
                    for name, value in zip(out, values, strict=True):
                        out[name].append(value)
                at += len(own)
            return out

        return work

    return map_runs(
        ready,
        ["conv_id", "block"],
        ["turn", "text_key"],
        "conv_id long, turn long, segment long, role string, content string, rendered string, copies long",
        make,
    )
