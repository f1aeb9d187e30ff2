"""Repairing the structure of conversations: generalised LR parsing with weighted edits.

The roles of a conversation have to follow a grammar: nothing, or user and assistant in turn,
perhaps behind a system turn. Its LR tables are made from the productions. A parser keeps a
graph-structured stack whose tops advance over the rows together; a row is kept, rerolled or
deleted, and turns are inserted, each at a cost. Tops that are equal after a row have the
same ways to go on, so they are merged and the least cost stays, ties by the least audit: the
initials of the edits so far (Keep, Rerole, Delete, Insert). Audits of equal cost over the
same rows are never one the beginning of the other, so what is less stays less. A top
that costs more than any way from another can save is dropped, and what the audits of all
tops begin with is decided.

Rows are ordered by range partitioning, so a conversation may hold any share of them. One
that lies within a partition is parsed there. A partition's first and last conversation may
go on in others: its part is parsed once from each top, and the parts' tables of ``(top,
top) -> (cost, audit)`` are joined in order afterwards. Only tables meet in one task then;
rows are edited where they are dealt to, part by part.

Rows are read by turn, nulls first; rows of one turn by role and a digest of the text. A null
id is a conversation like others; a null role or text is one space. The first of repeated
rows stays. An empty table gives empty results. Columns other than the four are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby, islice

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from shardstream.llm.arrow import batch, fields, map_arrow
from shardstream.shared import pin

#: The grammar of roles, by initials. The first production's side is what is parsed.
PRODUCTIONS = (("C", ()), ("C", ("P",)), ("C", ("s", "P")), ("P", ("u", "a")), ("P", ("P", "u", "a")))
ROLE_OF = {"u": "user", "a": "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: What another top accepts, a top accepts for at most so much more: an ``s`` kept there is
#: deleted (3), and one turn (2) or, behind ``s``, two turns without it are inserted.
SLACK = 5
_BLANK = " \t\n\x0b\x0c\r"
_LEGAL = {"su", "ua", "au"}

Item = tuple[int, int]
Stack = tuple[int, ...]
#: The least (cost, audit) of each top, and the stack below it.
Tops = dict[int, tuple[int, str, Stack]]


class Tables:
    """LR tables: the item sets of the productions, and what follows a nonterminal."""

    def __init__(self, productions=PRODUCTIONS):
        self.productions = productions
        self.start = productions[0][0]
        self.heads = {head for head, _ in productions}
        self.states: list[frozenset[Item]] = [self._closure({(i, 0) for i, (head, _) in enumerate(productions) if head == self.start})]
        self.goto: dict[tuple[int, str], int] = {}
        for at, items in enumerate(self.states):
            for symbol in sorted({self._next(item) for item in items} - {None}):
                moved = self._closure({(i, dot + 1) for i, dot in items if self._next((i, dot)) == symbol})
                if moved not in self.states:
                    self.states.append(moved)
                self.goto[at, symbol] = self.states.index(moved)
        self.follow = self._follow()

    def _next(self, item: Item) -> str | None:
        body = self.productions[item[0]][1]
        return body[item[1]] if item[1] < len(body) else None

    def _closure(self, items: set[Item]) -> frozenset[Item]:
        while True:
            wanted = {self._next(item) for item in items}
            more = {(i, 0) for i, (head, _) in enumerate(self.productions) if head in wanted} - items
            if not more:
                return frozenset(items)
            items = items | more

    def _first(self, symbol: str) -> set[str]:
        """What a symbol begins with; no nonterminal inside a body is empty in these grammars."""
        if symbol not in self.heads:
            return {symbol}
        bodies = [body for head, body in self.productions if head == symbol and body and body[0] != symbol]
        return set().union(*(self._first(body[0]) for body in bodies))

    def _follow(self) -> dict[str, set[str]]:
        follow = {head: {"$"} if head == self.start else set() for head in self.heads}
        for _ in self.productions:
            for head, body in self.productions:
                for symbol, after in zip(body, (*body[1:], None), strict=False):
                    if symbol in self.heads:
                        follow[symbol] |= follow[head] if after is None else self._first(after)
        return follow

    @lru_cache(maxsize=4096)  # noqa: B019
    def reduced(self, stack: Stack, ahead: str) -> tuple[Stack, ...]:
        """The stack itself, and those it is reduced to before ``ahead``."""
        found = [stack]
        for one in found:
            for i, dot in self.states[one[-1]]:
                head, body = self.productions[i]
                if dot == len(body) and ahead in self.follow[head]:
                    below = one[: len(one) - len(body)]
                    if (below[-1], head) in self.goto:
                        found.append((*below, self.goto[below[-1], head]))
        return tuple(found)

    @lru_cache(maxsize=4096)  # noqa: B019
    def shifted(self, stack: Stack, symbol: str) -> tuple[Stack, ...]:
        return tuple((*one, self.goto[one[-1], symbol]) for one in self.reduced(stack, symbol) if (one[-1], symbol) in self.goto)

    @lru_cache(maxsize=4096)  # noqa: B019
    def accepts(self, stack: Stack) -> bool:
        for one in self.reduced(stack, "$"):
            for i, dot in self.states[one[-1]]:
                head, body = self.productions[i]
                if head == self.start and dot == len(body) and len(one) == len(body) + 1:
                    return True
        return False

    def stacks(self) -> dict[int, tuple[Stack, str]]:
        """A stack with each top that rows can lead to, and the symbol before it."""
        found = {0: ((0,), "")}
        for stack, _ in (todo := list(found.values())):
            for symbol in "sua":
                for one in self.shifted(stack, symbol):
                    if one[-1] not in found:
                        found[one[-1]] = one, symbol
                        todo.append((one, symbol))
        return found


TABLES = Tables()
STACKS = TABLES.stacks()


def _merge(tops: Tops, cost: int, audit: str, stack: Stack) -> bool:
    held = tops.get(stack[-1])
    if held is None or (cost, audit) < held[:2]:
        tops[stack[-1]] = cost, audit, stack
        return True
    return False


def _insert(tops: Tops) -> None:
    """Insert turns at all tops while that is worth it."""
    fresh = list(tops.values())
    while fresh:
        limit, made = min(cost for cost, _, _ in tops.values()) + SLACK, []
        for cost, audit, stack in fresh:
            if cost + INSERT <= limit:
                for symbol in ROLE_OF:
                    for one in TABLES.shifted(stack, symbol):
                        if _merge(tops, cost + INSERT, audit + "I", one):
                            made.append(tops[one[-1]])
        fresh = made


def _edit(tops: Tops, initial: str, must_go: bool, truncated: bool) -> Tops:
    """Take up one row."""
    out: Tops = {}
    more = TRUNCATED if truncated else 0
    for cost, audit, stack in tops.values():
        _merge(out, cost + DELETE, audit + "D", stack)
        if not must_go:
            for one in TABLES.shifted(stack, initial):
                _merge(out, cost + more, audit + "K", one)
            for symbol in ROLE_OF:
                for one in TABLES.shifted(stack, symbol):
                    _merge(out, cost + REROLE + more, audit + "R", one)
    limit = min(cost for cost, _, _ in out.values()) + SLACK
    return {top: held for top, held in out.items() if held[0] <= limit}


#: Of a row: its role's initial, whether it has to go, whether it is truncated.
Row = tuple[str, bool, bool]


def parse(rows: list[Row], top: int = 0) -> dict[int, tuple[int, str]]:
    """The least cost and audit from a top over all rows to each top."""
    tops: Tops = {top: (0, "", STACKS[top][0])}
    decided: list[str] = []
    for row in rows:
        _insert(tops)
        tops = _edit(tops, *row)
        if len(next(iter(tops.values()))[1]) > 64:
            same = os.path.commonprefix([audit for _, audit, _ in tops.values()])
            decided.append(same)
            tops = {at: (cost, audit[len(same) :], stack) for at, (cost, audit, stack) in tops.items()}
    begin = "".join(decided)
    return {at: (cost, begin + audit) for at, (cost, audit, _) in tops.items()}


def finish(tops: dict[int, tuple[int, str]]) -> tuple[int, str, int]:
    """The least cost and audit that end the roles, after inserting what lacks, and from which top."""
    found = []
    for top, (cost, audit) in tops.items():
        ends: Tops = {top: (cost, audit, STACKS[top][0])}
        _insert(ends)
        found += [(*held[:2], top) for held in ends.values() if TABLES.accepts(held[2])]
    return min(found)


def edited(audit: str, rows: Iterator[tuple], last: str) -> Iterator[tuple[str, str | None, tuple | None]]:
    """Each edit, the role it leads to and the row it is about; ``last`` is the symbol before."""
    for edit in audit:
        row = None if edit == "I" else next(rows)
        wanted = "a" if last == "u" else "u"
        role = {"K": row and row[0], "D": None}.get(edit, ROLE_OF[wanted])
        if role is not None:
            last = role[:1]
        yield edit, role, row


def joined(parts: list[dict]) -> tuple[dict, list[tuple[str, str]]]:
    """The report of the parts of a conversation, and each one's audit and the symbol before it."""
    report, decided = None, []
    tops: dict[int, tuple[int, str, tuple[int, ...]]] = {0: (0, "", (0,))}
    for part in parts:
        report = part["counts"] if report is None else _added(report, part["counts"])
        moved: dict[int, tuple[int, str, tuple[int, ...]]] = {}
        for a, (cost, audit, way) in tops.items():
            for b, (more, rest) in part["table"][str(a)].items():
                held = cost + more, audit + rest, (*way, int(b))
                if int(b) not in moved or held < moved[int(b)]:
                    moved[int(b)] = held
        same = os.path.commonprefix([audit for _, audit, _ in moved.values()])
        decided.append(same)
        tops = {at: (cost, audit[len(same) :], way) for at, (cost, audit, way) in moved.items()}
    cost, audit, top = finish({at: held[:2] for at, held in tops.items()})
    audit, way = "".join([*decided, audit]), tops[top][2]
    own = [part["table"][str(a)][str(b)][1] for part, a, b in zip(parts, way, way[1:], strict=False)]
    own[-1] += audit[sum(map(len, own)) :]  # what is inserted at the end
    return report | {"cost": cost, "audit": audit}, [(one, STACKS[a][1]) for one, a in zip(own, way, strict=False)]


_COUNTS = ("blank", "duplicate", "truncated", "illegal")


def counted(rows: list[tuple]) -> dict:
    """Counts of a run of rows ``(role, turn, blank, duplicate, truncated, …)`` in order."""
    turns = [turn for _, turn, *_ in rows if turn is not None]
    initials = [role[:1] for role, *_ in rows]
    return {
        "blank": sum(row[2] for row in rows), "duplicate": sum(row[3] for row in rows), "truncated": sum(row[4] for row in rows),
        "illegal": sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:], strict=False)),
        "ends": [initials[0], initials[-1]] if rows else None,
        "turns": [turns[0], turns[-1]] if turns else None, "distinct": len(set(turns)),
    }


def _added(a: dict, b: dict) -> dict:
    out = {name: a[name] + b[name] for name in _COUNTS}
    if a["ends"] and b["ends"]:
        out["illegal"] += a["ends"][1] + b["ends"][0] not in _LEGAL
    x, y = a["turns"], b["turns"]
    out["ends"] = [a["ends"][0], b["ends"][1]] if a["ends"] and b["ends"] else a["ends"] or b["ends"]
    out["turns"] = [x[0], y[1]] if x and y else x or y
    out["distinct"] = a["distinct"] + b["distinct"] - bool(x and y and x[1] == y[0])
    return out


def _gaps(report: dict) -> int:
    return report["turns"][1] - report["turns"][0] + 1 - report["distinct"] if report["turns"] else 0


def damage(conversations: DataFrame) -> DataFrame:
    """The rows as the check damages them, by a digest of id and turn; dropped ones are ``gone``."""
    space = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    case = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = F.when(case == 1, F.lit("")).when(case == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    return conversations.select(
        "conv_id", "turn", F.when(case == 4, F.lit("user")).otherwise(space("role")).alias("role"), text.alias("text"),
        (case == 0).alias("gone"), F.explode(F.sequence(F.lit(1), F.when(case == 3, F.lit(2)).otherwise(F.lit(1)))).alias("copy"),
    ).drop("copy")


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Repair conversations of ``conv_id``, ``turn`` (whole numbers), ``role`` and ``text``.

    A row whose ``gone`` is true, if there is that column, only says that its conversation
    exists. Gives the edited turns (``conv_id``, ``segment`` and ``at``, which order them,
    ``edit``, ``role`` (null where deleted), ``turn`` and ``text``) and a report for each
    conversation: ``gaps``, ``blank``, ``duplicate``, ``truncated`` and ``illegal`` as found,
    ``cost`` and ``audit`` of the edits. Both are written tables.
    """
    space = lambda name: F.coalesce(F.col(name), F.lit(" "))
    gone = F.coalesce(F.col("gone"), F.lit(False)) if "gone" in rows.columns else F.lit(False)
    given = rows.select("conv_id", F.col("turn").cast("bigint").alias("turn"), space("role").alias("role"), space("text").alias("text"), gone.alias("gone"))
    text_end = F.rtrim(F.col("text"), F.lit(_BLANK))
    given = pin(
        given.withColumns(
            {
                "digest": F.md5("text"), "blank": text_end == "", "open": ~F.right(text_end, F.lit(1)).isin(".", "!", "?"),
                "position": F.monotonically_increasing_id(),
            }
        ),
        "turns",
    )
    # The first of equal rows, by a number that no other row has, so that no join is skewed.
    firsts = given.where("NOT gone").groupBy("conv_id", "role", "digest").agg(F.min(F.struct("turn", "position")).alias("first"))
    firsts = firsts.select("first.position", F.lit(True).alias("first"))
    order = ["conv_id", "turn", "role", "digest", "position"]
    flagged = given.join(firsts, "position", "left").select(
        *order, "text", "gone", "blank", (F.col("first").isNull() & ~F.col("blank")).alias("duplicate"), "open",
    )
    ordered = flagged.repartitionByRange(*order).sortWithinPartitions(*order)

    counts = ["gaps", *_COUNTS, "cost"]
    long, string = T.LongType(), T.StringType()
    schema = fields(
        kind=string, conv_id=rows.schema["conv_id"].dataType, segment=long, at=long, edit=string, role=string, turn=long,
        text=string, **dict.fromkeys(counts, long), audit=string, part=string,
    )
    kinds, empty = [to_arrow_type(f.dataType) for f in schema], dict.fromkeys(schema.fieldNames())

    def packed(found: Iterator[dict]) -> Iterator[pa.RecordBatch]:
        while some := list(islice(found, 4000)):
            yield batch(schema, *(pa.array([row[name] for row in some], kind) for name, kind in zip(schema.names, kinds, strict=True)))

    def turns_of(edits, conv_id, segment: int) -> Iterator[dict]:
        for at, (edit, role, row) in enumerate(edits):
            known = {"turn": row[1], "text": row[5]} if row else {"text": ""}
            yield empty | {"kind": "turn", "conv_id": conv_id, "segment": segment, "at": at, "edit": edit, "role": role} | known

    def reported(report: dict, conv_id) -> dict:
        known = {name: report[name] for name in (*_COUNTS, "cost", "audit")}
        return empty | {"kind": "report", "conv_id": conv_id, "gaps": _gaps(report)} | known

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        partition, edges = TaskContext.get().partitionId(), 0
        for conv_id, run, is_edge in _conversations(batches):
            tokens = [(role[:1], blank or duplicate, truncated) for role, _, blank, duplicate, truncated, _ in run]
            if not is_edge:
                cost, audit, _ = finish(parse(tokens))
                yield reported(counted(run) | {"cost": cost, "audit": audit}, conv_id)
                yield from turns_of(edited(audit, iter(run), ""), conv_id, 2 * partition)
                continue
            part = json.dumps({"counts": counted(run), "table": {top: parse(tokens, top) for top in STACKS}})
            here = empty | {"conv_id": conv_id, "segment": 2 * partition + edges}
            edges = 1
            yield here | {"kind": "part", "part": part}
            for at, (role, turn, _, _, _, text) in enumerate(run):
                yield here | {"kind": "open", "at": at, "role": role, "turn": turn, "text": text}

    def join_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for given in batches:
            for row in given.to_pylist():
                report, audits = joined([json.loads(part["part"]) for part in row["parts"]])
                yield reported(report, row["conv_id"])
                for part, (audit, last) in zip(row["parts"], audits, strict=True):
                    yield empty | {"kind": "part", "conv_id": row["conv_id"], "segment": part["segment"], "at": -1, "audit": audit, "part": last}

    def second_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        found = (row for given in batches for row in given.to_pylist())
        for segment, run in groupby(found, lambda row: row["segment"]):
            head = next(run)  # the audit comes first
            rest = ((row["role"], row["turn"], None, None, None, row["text"]) for row in run)
            yield from turns_of(edited(head["audit"], rest, head["part"]), head["conv_id"], segment)

    def mapped(df: DataFrame, step, purpose: str) -> DataFrame:
        return pin(map_arrow(df, lambda batches: packed(step(batches)), schema), purpose)

    parsed = mapped(ordered, first_pass, "parsed")
    parts = parsed.where("kind = 'part'").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("segment", "part"))).alias("parts"))
    decided = mapped(parts, join_parts, "decided")
    rest = decided.where("kind = 'part'").unionByName(parsed.where("kind = 'open'"))
    replayed = mapped(rest.repartition("segment").sortWithinPartitions("segment", "at"), second_pass, "replayed")
    turns = parsed.where("kind = 'turn'").unionByName(replayed)
    reports = parsed.where("kind = 'report'").unionByName(decided.where("kind = 'report'"))
    return turns.select("conv_id", "segment", "at", "edit", "role", "turn", "text"), reports.select("conv_id", *counts, "audit")


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Each conversation's id and rows out of sorted batches, and whether it is the first or last."""
    columns = ("conv_id", "gone", "role", "turn", "blank", "duplicate", "open", "text")
    held, ids, is_edge = [], [], True
    for given in batches:
        for conv_id, gone, role, turn, blank, duplicate, is_open, text in zip(*(given.column(c).to_pylist() for c in columns), strict=True):
            if ids and conv_id != ids[0]:
                yield ids[0], held, is_edge
                held, is_edge = [], False
            ids = [conv_id]
            if not gone:
                held.append((role, turn, blank, duplicate, is_open and not blank and not duplicate, text))
    if ids:
        yield ids[0], held, True


def digests(turns: DataFrame) -> DataFrame:
    """``conv_id`` and ``sha256`` of the lines ``role:text`` that are left, newline-joined.

    A digest reads its lines one after the other: a conversation goes through one task,
    which holds a batch of it at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines = (
            row for given in batches
            for row in zip(*(given.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True)
        )
        for given in _digested(lines):
            yield batch(schema, pa.array([i for i, _ in given], kind), pa.array([digest for _, digest in given]))

    schema = fields(conv_id=turns.schema["conv_id"].dataType, sha256=T.StringType())
    kind = to_arrow_type(turns.schema["conv_id"].dataType)
    left = turns.where("role IS NOT NULL").repartition("conv_id").sortWithinPartitions("conv_id", "segment", "at")
    return map_arrow(left.select("conv_id", "role", "text"), run, schema)


def _digested(lines: Iterator[tuple]) -> Iterator[list[tuple]]:
    found = []
    for conv_id, run in groupby(lines, lambda line: line[0]):
        digest = hashlib.sha256()
        for at, (_, role, text) in enumerate(run):
            digest.update(f"{chr(10) if at else ''}{role}:{text}".encode())
        found.append((conv_id, digest.hexdigest()))
        if len(found) == 4000:
            yield found
            found = []
    if found:
        yield found
