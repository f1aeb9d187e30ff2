"""Transcripts to chat turns: a hidden Markov model over lines, decoded by Viterbi.

Each line of a transcript either begins or continues a turn of a role. A line shows the
kind of its speaker marker, if it has one, and what it looks like. The model is counted
from labelled turns; the best sequence of states gives the roles, and the turns are
rendered in one canonical form without markers.

A null, empty or blank transcript has no turns and is rendered as an empty text. Repeated
rows and ids are parsed alike; columns other than those read change nothing; an empty
table gives an empty result. Turns without a conversation's id belong to nothing: each is
a transcript of its own, and the model is not counted from them.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardstream.llm.arrow import batch, fields, map_arrow
from shardstream.shared import pin

ROLES = ("system", "user", "assistant")
#: Turns the model is counted from, at most.
SAMPLE_TURNS = 20_000

# Names of speakers by role.
SPEAKERS = {
    "system": ("System", "Instructions", "Context"),
    "user": ("User", "Human", "Customer", "Question", "Q"),
    "assistant": ("Assistant", "AI", "Bot", "Agent", "Answer", "A"),
}
# Forms of a marker around a speaker's name.
FORMS = ("{}: ", "### {}\n", "**{}:** ", "[{}]: ", "<|{}|>\n", "{} - ", "{}> ")
_ROLE_OF = {name.lower(): i for i, role in enumerate(ROLES) for name in SPEAKERS[role]}
_MARKER = re.compile(r"\s*(?:#{1,4}\s*|\*\*|\[|<\|?)?([A-Za-z]{1,14})(?:\*\*|\]|\|?>)?\s*(?::|>|-|$)(?:\*\*)?\s*")
_LOOKS = 6  # blank, question, list or code, short, middle, long


def observe(line: str) -> tuple[int, int, int]:
    """The marker's role (3: none), the looks of a line, and where its text begins."""
    found = _MARKER.match(line)
    role = _ROLE_OF.get(found.group(1).lower(), 3) if found else 3
    begin = found.end() if found and role < 3 else 0
    body = line[begin:].strip()
    if not body:
        looks = 0
    elif body.endswith("?"):
        looks = 1
    elif re.match(r"[-*•`]|\d+[.)]", body):
        looks = 2
    else:
        looks = 3 + (len(body) > 60) + (len(body) > 240)
    return role, looks, begin


@dataclass
class Model:
    """Log probabilities; state ``2 * role`` begins a turn of a role, the next one continues it."""

    start: np.ndarray
    step: np.ndarray
    marker: np.ndarray
    looks: np.ndarray

    def roles(self, lines: list[tuple[int, int, int]]) -> list[int]:
        """The most probable state of each line, by Viterbi."""
        shown = np.array([(m, k) for m, k, _ in lines])
        emitted = self.marker[:, shown[:, 0]].T + self.looks[:, shown[:, 1]].T
        best, back = self.start + emitted[0], []
        for row in emitted[1:]:
            ways = best[:, None] + self.step
            back.append(ways.argmax(0))
            best = ways.max(0) + row
        states = [int(best.argmax())]
        for pointers in reversed(back):
            states.append(int(pointers[states[-1]]))
        return states[::-1]

    def parse(self, transcript: str | None) -> list[tuple[str, str]]:
        """The turns of a transcript: role and text."""
        lines = (transcript or "").split("\n")
        if not (transcript or "").strip():
            return []
        seen = [observe(line) for line in lines]
        turns: list[tuple[str, list[str]]] = []
        for line, (_, _, begin), state in zip(lines, seen, self.roles(seen), strict=True):
            if state % 2 == 0 or not turns:
                turns.append((ROLES[state // 2], [line[begin:]]))
            else:
                turns[-1][1].append(line)
        return [(role, "\n".join(body).strip()) for role, body in turns]


class _Counts:
    """What is counted of labelled turns, in the order of their conversations."""

    def __init__(self) -> None:
        self.start, self.step = np.zeros(6), np.zeros((6, 6))
        self.marker, self.looks = np.zeros((6, 4)), np.zeros((6, _LOOKS))
        self.last: int | None = None

    def add(self, role: str, text: str | None, first: bool, marked: float | None = None) -> None:
        """A turn, ``first`` of its conversation or not; with ``marked`` its text has no marker,
        but that share of such turns has."""
        if first:
            self.last = None
        for k, line in enumerate((text or "").split("\n")):
            state = 2 * ROLES.index(role) + (k > 0)
            shown, looks, _ = observe(line)
            if marked is None:
                self.marker[state, shown] += 1
            else:
                self.marker[state, ROLES.index(role)] += marked * (k == 0)
                self.marker[state, 3] += 1 - marked * (k == 0)
            self.looks[state, looks] += 1
            if self.last is None:
                self.start[state] += 1
            else:
                self.step[self.last, state] += 1
            self.last = state

    def pack(self) -> np.ndarray:
        return np.concatenate([a.ravel() for a in (self.start, self.step, self.marker, self.looks)])


def _model(counts: np.ndarray) -> Model:
    """The model of packed counts."""
    start, step, marker, looks = np.split(counts, np.cumsum([6, 36, 24]))
    start, step = start + 0.1, step.reshape(6, 6) + 0.01
    marker, looks = marker.reshape(6, 4) + 0.02, looks.reshape(6, _LOOKS) + 0.5
    # Before anything is seen, lines continue their turn and have no marker then.
    marker[1::2, 3] += 1
    step[range(0, 6, 2), range(1, 6, 2)] += 1
    step[range(1, 6, 2), range(1, 6, 2)] += 1
    # A turn's lines continue it, or another turn begins.
    for a in range(6):
        for b in range(1, 6, 2):
            if a // 2 != b // 2:
                step[a, b] = 1e-9
    start[1::2] = 1e-9
    share = lambda x: np.log(x / x.sum(-1, keepdims=True))
    return Model(share(start), share(step), share(marker), share(looks))


def train(turns: list[tuple[list[tuple[str, str]], float]]) -> Model:
    """Count conversations of (role, text); ``marked`` is the share of turns with a marker."""
    counts = _Counts()
    for conversation, marked in turns:
        for k, (role, text) in enumerate(conversation):
            counts.add(role, text, k == 0, marked)
    return _model(counts.pack())


def _drawn(known: DataFrame, turns: int) -> DataFrame:
    """Whole conversations of at most ``turns`` turns in all, chosen by a hash of their id.

    A conversation that alone passes the bound is not drawn.
    """
    sizes = known.groupBy("conv_id").agg(F.count("*").alias("n")).where(F.col("n") <= turns)
    sizes = pin(sizes.withColumn("draw", F.xxhash64("conv_id")), "conversations")
    upto = F.sum("n").over(Window.orderBy("draw", "conv_id").rowsBetween(Window.unboundedPreceding, 0))
    # Each has a turn or more, so the first ``turns`` of them are enough to add up.
    chosen = sizes.orderBy("draw", "conv_id").limit(turns).withColumn("upto", upto).where(F.col("upto") <= turns)
    return known.join(pin(chosen.select("conv_id"), "drawn"), "conv_id")


def learn(conversations: DataFrame, marked: float = 0.9, turns: int = SAMPLE_TURNS) -> Model:
    """Count a sample of whole conversations of at most ``turns`` turns in all.

    Turns that say how they are ``shown`` (see ``show``) teach the model which have markers;
    of others the share ``marked`` is taken to. Tasks count, and only sums reach the driver.
    """
    seen = "shown" in conversations.columns
    known = conversations.select("conv_id", "turn", "role", F.col("shown" if seen else "text").alias("text"))
    known = known.where(F.col("role").isin(*ROLES) & F.col("conv_id").isNotNull())

    def run(batches):
        counts, last = _Counts(), None
        for rows in batches:
            for conv_id, role, text in zip(*(rows.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
                counts.add(role, text, conv_id != last, None if seen else marked)
                last = conv_id
        yield batch(schema, pa.array([counts.pack().tolist()], pa.list_(pa.float64())))

    schema = fields(counts=T.ArrayType(T.DoubleType()))
    ordered = _drawn(known, turns).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "text")
    # Whole or tenth counts: rounding makes their sum the same in any order of tasks.
    sums = map_arrow(ordered, run, schema).select(F.posexplode("counts").alias("at", "n")).groupBy("at").agg(F.round(F.sum("n"), 6).alias("n"))
    return _model(np.array([row.n for row in sorted(sums.collect())] or _Counts().pack()))


def render(turns: list[tuple[str, str]]) -> str:
    return "".join(f"<|{role}|>\n{text}\n<|end|>\n" for role, text in turns)


def format_chats(transcripts: DataFrame, model: Model, conv_id: str = "conv_id", text: str = "transcript") -> DataFrame:
    """``conv_id``, ``n_turns``, ``roles`` and ``rendered`` for each transcript."""

    def run(batches):
        for rows in batches:
            parsed = [model.parse(text) for text in rows.column("transcript").to_pylist()]
            yield batch(
                schema, rows.column("conv_id"), pa.array([len(turns) for turns in parsed], pa.int64()),
                pa.array([[role for role, _ in turns] for turns in parsed], pa.list_(pa.string())),
                pa.array([render(turns) for turns in parsed], pa.string()),
            )

    schema = fields(
        conv_id=transcripts.schema[conv_id].dataType, n_turns=T.LongType(), roles=T.ArrayType(T.StringType()), rendered=T.StringType()
    )
    return map_arrow(transcripts.select(F.col(conv_id).alias("conv_id"), F.col(text).alias("transcript")), run, schema)


def show(conversations: DataFrame, unmarked: int = 8) -> DataFrame:
    """The turns with their text as ``shown`` in a transcript: behind a marker of one of
    ``FORMS`` and one of its role's names, or, for one in ``unmarked`` turns, without any.

    Both are chosen by a hash of the conversation and the turn. Rows of other roles have none.
    """
    draw = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(1 << 40))
    marker = F.lit("")
    for role, names in SPEAKERS.items():
        listed = [form.format(name) for name in names for form in FORMS]
        choice = F.get(F.array(*map(F.lit, listed)), F.pmod(draw, F.lit(len(listed))).cast("int"))
        marker = F.when(F.col("role") == role, choice).otherwise(marker)
    marker = F.when(F.pmod(F.shiftright(draw, 20), F.lit(unmarked)) == 0, F.lit("")).otherwise(marker)
    return conversations.withColumn("shown", F.concat(marker, F.coalesce("text", F.lit(""))))


def transcribe(conversations: DataFrame) -> DataFrame:
    """``conv_id`` and ``transcript``: a conversation's turns in order, as they are ``shown``.

    Turns without that column (see ``show``) get a name and a colon, those of unknown role
    nothing. A transcript is one row, so a conversation has to fit one; each turn without a
    conversation's id is a transcript of its own.
    """
    line = F.col("shown")
    if "shown" not in conversations.columns:
        draw = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(60))
        name = F.lit("")
        for role, names in SPEAKERS.items():
            choice = F.get(F.array(*(F.lit(f"{n}: ") for n in names)), F.pmod(draw, F.lit(len(names))).cast("int"))
            name = F.when(F.col("role") == role, choice).otherwise(name)
        line = F.concat(name, F.coalesce("text", F.lit("")))
    lines = conversations.select("conv_id", "turn", line.alias("line"))
    turns = lines.where("conv_id IS NOT NULL").groupBy("conv_id")
    turns = turns.agg(F.sort_array(F.collect_list(F.struct("turn", "line"))).alias("turns"))
    whole = turns.select("conv_id", F.array_join("turns.line", "\n").alias("transcript"))
    return whole.unionByName(lines.where("conv_id IS NULL").select("conv_id", F.col("line").alias("transcript")))
