"""Mixing against a plain version on the driver."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from shardstream.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = "doc_id long, text string, source string, favour int"


def table(spark, rows):
    clashes = {name: F.lit("clash") for name in ("rank", "size", "number", "target", "row", "a.b")}
    return spark.createDataFrame(rows, COLUMNS).withColumns(clashes).repartition(3)


def given(rng):
    """A source with a third of all words, tiny ones, one of a single long text, nulls and repeats."""
    text = lambda n: " ".join(rng.choice("abcdefg") * rng.randint(1, 6) for _ in range(n))
    rows = [(i, text(rng.randint(1, 60)), rng.choice(["hot"] * 6 + ["b", "é", "Z", "𝄞", "ﬁ"]), rng.randint(0, 5)) for i in range(300)]
    rows += [(1000, text(2000), "long", 1), (1001, None, "b", 1), (1002, " \n\t ", "b", None), (1003, "", None, 1)]
    rows += [(None, text(20), None, 2), (None, text(30), None, 1), (1004, None, "nothing", 1), *[rows[0]] * 40]
    return rows


def targets(sizes, weights=(1, 2, 3), most=3):
    """Shares by weight, again and again, each up to its limit."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full: set = set()
    while True:
        left = sum(sizes.values()) - sum(most * sizes[s] for s in full)
        by = sum(weight[s] for s in sizes.keys() - full)
        above = {s for s in sizes.keys() - full if most * sizes[s] * by <= weight[s] * left}
        if not above:
            return {s: most * sizes[s] if s in full else weight[s] * left / by for s in sizes}
        full |= above


def test_sources_meet_their_targets(spark):
    rows = given(random.Random(3))
    found = mixing.mix(table(spark, rows)).collect()
    size = lambda text: len(WORD.findall(text or ""))
    by_id, sizes = defaultdict(list), Counter()
    for i, text, source, _ in rows:
        sizes[source] += size(text)
        by_id[i, size(text)].append(source)
    want, taken = targets(sizes), Counter()
    assert len(found) == len(rows)
    for r in found:
        source = by_id[r.doc_id, r.size].pop()
        assert r.source_size == sizes[source] and r.target == pytest.approx(want[source], abs=1e-6)
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size + r.part
        whole = int(r.target / r.source_size) if r.source_size else 0
        assert whole * r.size <= r.taken <= (whole + 1) * r.size
        taken[source] += r.taken
    for source, target in want.items():
        assert abs(taken[source] - target) <= 0.51
        partly = [r for r in found if r.part and r.source_size == sizes[source]]
        assert len(partly) <= 1
    again = mixing.mix(table(spark, rows[::-1])).collect()
    assert Counter(again) == Counter(found)


def test_documents_are_taken_in_order_of_their_odds(spark):
    """Digit by digit the border is where it is in the sorted rows."""
    rng = random.Random(4)
    rows = [(s, rng.choice([0, 5, rng.randrange(1 << 52)]), rng.choice([7, rng.randrange(1 << 52)]), i, rng.randint(1, 9)) for i, s in enumerate([0] * 200 + [1] * 5 + [2])]
    ranked = spark.createDataFrame(rows, "number long, rank long, tie long, row long, size long")
    for share in (0.01, 0.77):
        sums = Counter()
        for row in rows:
            sums[row[0]] += row[-1]
        budget = {n: max(1, int(share * total)) for n, total in sums.items()}
        budgets = spark.createDataFrame(list(budget.items()), "number long, budget long")
        want = {}
        for n, left in budget.items():
            for _, rank, tie, at, size in sorted(row for row in rows if row[0] == n):
                if left <= size:
                    want[n] = ((rank, tie, at), left)
                    break
                left -= size
        for rows_per_task in (1, 100_000):
            found = mixing.borders(ranked, budgets, rows_per_task).collect()
            assert {r.number: (tuple(r.border), r.part) for r in found} == want


def test_favoured_documents_come_in_proportion(spark):
    rows = given(random.Random(5))
    docs = table(spark, rows)
    found = mixing.mix(docs, favour="favour", most_copies=4)
    sums = found.groupBy("source_size", "target").agg(F.sum("taken").alias("taken"), F.sum("size").alias("size")).collect()
    wanted = {(i, len(WORD.findall(text or ""))): favour for i, text, _, favour in rows}
    assert all(r.taken == 0 for r in found.collect() if not wanted[r.doc_id, r.size])
    assert all(r.taken <= 4 * r.size for r in found.collect())
    hot = max(sums, key=lambda r: r.size)
    assert abs(hot.taken - hot.target) <= 1
    means = defaultdict(list)
    for r in found.where(F.col("source_size") == hot.source_size).collect():
        means[wanted[r.doc_id, r.size]].append(r.taken / r.size)
    low, high = (sum(means[f]) / len(means[f]) for f in (1, 5))
    assert high > 2 * low


def test_inclusion_does_not_depend_on_size(spark):
    rows = [(i, "w " * (1 + i % 4), "s" if i % 3 else "t", 1) for i in range(6000)]
    found = mixing.mix(spark.createDataFrame(rows, COLUMNS), weights=(1, 3)).where("source_size > target").collect()
    share = found[0].target / found[0].source_size
    for size in range(1, 5):
        taken = [r.taken / size for r in found if r.size == size]
        assert sum(taken) / len(taken) == pytest.approx(share, abs=0.05)


def test_nothing_to_mix(spark):
    assert mixing.mix(table(spark, []).limit(0)).count() == 0
    found = mixing.mix(spark.createDataFrame([(1, None, None, 1), (2, "", "a", 1)], COLUMNS)).collect()
    assert sorted((r.doc_id, r.size, r.target, r.taken) for r in found) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]
