"""Repairs against trying all edits, and a plain version of the whole report."""

from __future__ import annotations

import hashlib
import json
import random
import re
import zlib
from collections import defaultdict
from itertools import product

import pytest
from pyspark.sql import functions as F

from shardstream.llm import queries, repair

SF_DIR = "/root/testdata/sf0.01"
COLUMNS = "conv_id long, turn long, role string, text string"
GRAMMAR = re.compile(r"(s?(ua)+)?")


def every_edit(rows):
    """All (cost, audit) whose roles follow the grammar, with at most two insertions in each place."""
    choices = []
    for initial, must_go, truncated in rows:
        one = [("D", "", 3)]
        if not must_go:
            one += [("K", initial, int(truncated)), ("R", "u", 2 + truncated), ("R", "a", 2 + truncated)]
        choices.append(one)
    inserts = ["", "u", "a", "ua", "au"]
    for script in product(*choices):
        for added in product(inserts, repeat=len(rows) + 1):
            roles = added[0] + "".join(symbol + more for (_, symbol, _), more in zip(script, added[1:], strict=True))
            if GRAMMAR.fullmatch(roles):
                audit = "I" * len(added[0]) + "".join(edit + "I" * len(more) for (edit, _, _), more in zip(script, added[1:], strict=True))
                yield 2 * sum(map(len, added)) + sum(cost for _, _, cost in script), audit


def plain_parse(rows):
    """The least (cost, audit) over all rows by the state of a plain automaton."""
    step = {("0", "s"): "s", ("0", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    best = {"0": (0, "")}

    def relax():
        for _ in range(4):
            for (state, symbol), to in step.items():
                if state in best and symbol != "s":
                    cost, audit = best[state]
                    best[to] = min(best.get(to, (10**9, "")), (cost + 2, audit + "I"))

    for initial, must_go, truncated in rows:
        relax()
        after: dict = {}
        for state, (cost, audit) in best.items():
            ways = [(state, cost + 3, "D")]
            if not must_go:
                ways += [(step[state, initial], cost + truncated, "K")] if (state, initial) in step else []
                ways += [(step[state, x], cost + 2 + truncated, "R") for x in "ua" if (state, x) in step]
            for to, more, edit in ways:
                after[to] = min(after.get(to, (10**9, "")), (more, audit + edit))
        best = after
    relax()
    return min(best[state] for state in ("0", "a") if state in best)


def random_rows(rng, n):
    return [(rng.choice("suauauat "), rng.random() < 0.15, rng.random() < 0.2) for _ in range(n)]


def test_parses_agree_with_trying_all_edits():
    rng = random.Random(1)
    for n in (0, 1, 2, 3):
        for _ in range(12):
            rows = random_rows(rng, n)
            assert repair.finish(repair.parse(rows))[:2] == min(every_edit(rows)) == plain_parse(rows)


def test_long_parses_and_parts_agree_with_a_plain_automaton():
    rng = random.Random(2)
    for _ in range(60):
        rows = random_rows(rng, rng.randint(4, 300))
        want = plain_parse(rows)
        assert repair.finish(repair.parse(rows))[:2] == want
        cuts = sorted(rng.choices(range(len(rows) + 1), k=3))
        parts = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)], strict=True)]
        tables = [{"counts": repair.counted([]), "table": {top: repair.parse(part, top) for top in repair.STACKS}} for part in parts]
        report, audits = repair.joined(json.loads(json.dumps(tables)))
        assert (report["cost"], report["audit"]) == want and "".join(audit for audit, _ in audits) == want[1]
        for part, (audit, _) in zip(parts, audits, strict=True):
            assert len(audit.replace("I", "")) == len(part)
        roles = [role for part, (audit, last) in zip(parts, audits, strict=True) for _, role, _ in repair.edited(audit, iter(part), last)]
        assert GRAMMAR.fullmatch("".join(role[0] for role in roles if role))


def plain_reports(rows):
    """The whole contract, conversation by conversation."""
    ends = re.compile(r"[^\x20\x09-\x0D]")
    given = defaultdict(list)
    space = lambda x: " " if x is None else str(x)
    for conv_id, turn, role, text in rows:
        role, text = space(role), space(text)
        case = zlib.crc32(f"{space(conv_id)}:{space(turn)}".encode()) % 20
        text = "" if case == 1 else re.sub("[.!?]", "", text) if case == 2 else text
        role = "user" if case == 4 else role
        given[conv_id] += [] if case == 0 else [(turn, role, text)] * (2 if case == 3 else 1)
    out = {}
    for conv_id, turns in given.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), hashlib.md5(t[2].encode()).hexdigest()))
        seen, faults = set(), []
        for _, role, text in turns:
            marks = ends.findall(text)
            faults.append("blank" if not marks else "duplicate" if (role, text) in seen else "truncated" if marks[-1] not in ".!?" else "")
            seen.add((role, text))
        cost, audit = plain_parse([(role[:1], f in ("blank", "duplicate"), f == "truncated") for (_, role, _), f in zip(turns, faults, strict=True)])
        lines, at, last = [], iter(turns), ""
        for edit in audit:
            _, role, text = (None, None, "") if edit == "I" else next(at)
            if edit in "RI":
                role = "assistant" if last == "u" else "user"
            if edit != "D":
                last = role[:1]
                lines.append(f"{role}:{text}")
        numbers = [t for t, *_ in turns if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        initials = [role[:1] for _, role, _ in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        out[conv_id] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def found(table):
    turns, reports = repair.repair(repair.damage(table))
    lines = {r.conv_id: r.sha256 for r in repair.digests(turns).collect()}
    empty = hashlib.sha256().hexdigest()
    columns = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    rows = reports.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: (*(r[c] for c in columns), lines.get(r.conv_id, empty)) for r in rows}


def given(rng):
    texts = ["Hi.", "What now?", "no end", "no end ", "", " \n", None, "Same.", "Same.", "done! ", "x. y", "日本。", "wait...  "]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, "", "User"]
    rows = [(i % 40, rng.randint(0, 9), rng.choice(roles), rng.choice(texts)) for i in range(260)]
    rows += [(None, rng.choice([None, 1, 2]), rng.choice(roles), rng.choice(texts)) for _ in range(60)]
    rows += [(50, t, rng.choice(roles), rng.choice(texts) and f"{rng.choice(texts)} {t}") for t in range(700)]  # over half of all
    return rows + [rows[0]] * 5 + [(60 + i, 1, "user", None) for i in range(40)] + [(-1, 7, "assistant", "x" * 100_000 + ".")]


@pytest.mark.parametrize("partitions", [1, 7])
def test_reports_agree_with_a_plain_version(spark, partitions):
    rows = given(random.Random(partitions))
    clashes = {name: F.lit("clash") for name in ("segment", "position", "kind", "digest", "first", "a.b")}
    table = spark.createDataFrame(rows, COLUMNS).withColumns(clashes).repartition(3)
    shuffles = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        assert found(table) == plain_reports(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", shuffles)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_query_on_given_conversations(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    columns = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    assert {r.conv_id: tuple(r[c] for c in columns) for r in queries.op11_repair(spark, SF_DIR).collect()} == plain_reports(rows)


def test_no_conversations(spark):
    assert found(spark.createDataFrame([], COLUMNS)) == {}
