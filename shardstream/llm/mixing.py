"""Mixing sources to target weights: certain whole copies, then Pareto order sampling.

Each document has an expected number of copies: what its source's target gives a word of
that source, more for documents a column favours. The whole part of it is certain. For the
fraction, its inclusion probability, documents are ranked by random odds divided by
inclusion odds, and the first ones fill to the word what the source's target has left. The
one across that border is taken in part, so no source misses its target by a word.

No source is sorted: the border is found digit by digit, from sums over the digits of the
rank that are aggregated before they are shuffled. So a source may hold any share of the
rows. The random numbers come from the id and the text, so reruns agree; a written row
number decides among equal rows only, which shows in no result.

A null text has no words, like an empty one, and nothing is taken of it. The null source is
a source, behind all others; null and repeated ids, and repeated rows, are documents like
others. Tables without rows or words give targets of zero. Only the id, the source, the
text and the favouring column are read, whatever other columns there are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardstream.shared import pin

#: Bits of the rank that one pass tells apart.
DIGIT_BITS = 12
#: Documents of a source that are ranked in one task, once the border is this near.
ROWS_PER_TASK = 100_000

_RANK_BITS = 52
#: What ranks rows, then tells different ones apart, then equal ones; with their bits.
_ORDER = {"rank": _RANK_BITS, "tie": _RANK_BITS, "row": 63}


def count_words(text: Column) -> Column:
    """The number of words ``[^\\x20\\x09-\\x0D]+``; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def levels(rows: DataFrame, totals: DataFrame, group: str) -> DataFrame:
    """How far a group's total goes, if it is shared by weight up to each row's limit.

    ``rows`` have the group, ``weight`` and ``limit`` (longs), ``totals`` the group and
    ``total``; both are written tables. A row gets its limit if ``limit * by <= weight *
    left``, else ``weight * left / by``; the result has the group, ``left`` and ``by``. What
    goes beyond limits is shared out again until no row is above, an aggregate a round.
    """
    whole = rows.groupBy(group).agg(F.sum("weight").alias("all"))
    state = pin(totals.join(whole, group).select(group, "total", "all", F.col("total").alias("left"), F.col("all").alias("by")), "levels")
    full_before = None
    while True:
        held = rows.join(state, group).where(is_full()).groupBy(group)
        held = held.agg(F.sum("limit").alias("held"), F.sum("weight").alias("held_weight"), F.count("*").alias("full"))
        state = pin(
            state.select(group, "total", "all").join(held, group, "left").select(
                group, "total", "all",
                (F.col("total") - F.coalesce("held", F.lit(0))).alias("left"),
                (F.col("all") - F.coalesce("held_weight", F.lit(0))).alias("by"),
                F.coalesce("full", F.lit(0)).alias("full"),
            ),
            "levels",
        )
        full = state.agg(F.sum("full")).first()[0]
        if full == full_before:
            return state.select(group, "left", "by")
        full_before = full


def is_full() -> Column:
    """Whether a row reaches its limit; all rows with a weight do once ``by`` is zero."""
    wide = "decimal(38,0)"
    reached = F.col("limit").cast(wide) * F.col("by") <= F.col("weight").cast(wide) * F.col("left")
    return (F.col("weight") > 0) & ((F.col("by") == 0) | reached)


def source_targets(sizes: DataFrame, weights: Sequence[int], most_copies: int) -> DataFrame:
    """Add ``number`` (from 0, by code point, null last) and ``target`` to ``source``, ``source_size``.

    Sources weigh ``weights`` in turn and share the sum of all sizes, each up to
    ``most_copies`` times its own.
    """
    order = F.col("source").asc_nulls_last()
    placed = sizes.repartitionByRange(order).sortWithinPartitions(order).withColumn("place", F.monotonically_increasing_id())
    placed = pin(placed.withColumn("range", F.shiftright("place", 33)), "sources")
    ranges = placed.groupBy("range").agg(F.count("*").alias("rows"), F.min("place").alias("first"))
    before = F.coalesce(F.sum("rows").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shifts = ranges.select("range", (before - F.col("first")).alias("shift"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("number") % len(weights) + 1).cast("int")).cast("bigint")
    rows = (
        placed.join(shifts, "range").withColumn("number", F.col("place") + F.col("shift"))
        .select("source", "source_size", "number", weight.alias("weight"), (F.col("source_size") * most_copies).alias("limit"), F.lit(0).alias("mix"))
    )
    rows = pin(rows, "weights")
    level = levels(rows, pin(rows.groupBy("mix").agg(F.sum("source_size").alias("total")), "total"), "mix")
    share = (F.col("weight") * F.col("left")).cast("double") / F.col("by")
    target = F.when(is_full(), F.col("limit").cast("double")).otherwise(share)
    return pin(rows.join(level, "mix").select("source", "source_size", "number", target.alias("target")), "targets")


def borders(ranked: DataFrame, budgets: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """The row of each source at which its documents, in order, fill its budget.

    ``ranked`` has ``number``, ``size`` above 0 and the columns of the order, ``budgets``
    has ``number`` and ``budget`` above 0, at most the source's size. Gives ``number``, the
    columns of the order as ``border``, and ``part``, the words that the row at the border
    has to give. Each pass sums sizes by one more digit of the order and narrows every
    source to the digit that holds its border.
    """
    at, known = budgets, []

    def inside() -> DataFrame:
        rows = ranked.join(at, "number")
        for name, shift in known:
            rows = rows.where(F.shiftright(name, shift) == F.col(f"at_{name}"))
        return rows

    digits = [(name, shift) for name, bits in _ORDER.items() for shift in _shifts(bits)]
    by_digit = Window.partitionBy("number").orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)
    for name, shift in digits:
        kept = [f"at_{other}" for other, _ in known if other != name]
        sums = (
            inside().groupBy("number", "budget", *kept, F.shiftright(name, shift).alias("digit"))
            .agg(F.sum("size").alias("words"), F.count("*").alias("documents"))
            .withColumn("before", F.coalesce(F.sum("words").over(by_digit), F.lit(0)))
        )
        holds = (F.col("before") < F.col("budget")) & (F.col("budget") <= F.col("before") + F.col("words"))
        at = pin(
            sums.where(holds).select("number", (F.col("budget") - F.col("before")).alias("budget"), *kept, F.col("digit").alias(f"at_{name}"), "documents"),
            "borders",
        )
        known = [(other, s) for other, s in known if other != name] + [(name, shift)]
        if (at.agg(F.max("documents")).first()[0] or 0) <= rows_per_task:
            break
    in_order = Window.partitionBy("number").orderBy(*_ORDER).rowsBetween(Window.unboundedPreceding, -1)
    last = inside().withColumn("before", F.coalesce(F.sum("size").over(in_order), F.lit(0)))
    last = last.where((F.col("before") < F.col("budget")) & (F.col("budget") <= F.col("before") + F.col("size")))
    return pin(last.select("number", F.struct(*_ORDER).alias("border"), (F.col("budget") - F.col("before")).alias("part")), "border")


def _shifts(bits: int) -> list[int]:
    return list(range(bits - DIGIT_BITS, 0, -DIGIT_BITS)) + [0]


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (1, 2, 3),
    most_copies: int = 3,
    *,
    favour: str | None = None,
    seed: str = "mix",
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """What a mix of the size of all documents takes of each.

    Gives ``doc_id``, ``size`` in words, ``source_size``, the source's ``target``, the words
    ``taken``, and how: ``copies`` whole ones and the first ``part`` words of another.
    ``favour`` names a column of whole numbers: within a source, expected copies are in
    proportion to it, up to ``most_copies``. Null or below 0 counts as 0, and of such
    documents nothing is taken, also where a source then misses its target.
    """
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit(""))))
    bits = lambda first: F.conv(F.substring(digest, first, _RANK_BITS // 4), 16, 10).cast("bigint")
    wanted = F.lit(1) if favour is None else F.greatest(F.coalesce(F.col(favour), F.lit(0)), F.lit(0))
    rows = pin(
        docs.select(
            F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), count_words(F.col(text)).alias("size"),
            wanted.cast("bigint").alias("favour"), bits(1).alias("random"), bits(1 + _RANK_BITS // 4).alias("tie"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "mixed",
    )
    sources = source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most_copies)
    same = rows["source"].eqNullSafe(sources["source"])
    rows = rows.join(sources, same).drop("source")

    expected = F.col("target") / F.col("source_size")
    if favour is not None:
        rows = pin(rows.withColumns({"weight": F.col("favour") * F.col("size"), "limit": F.col("size") * most_copies}), "favoured")
        totals = sources.select("number", F.floor(F.col("target") + 0.5).alias("total"))
        rows = rows.join(levels(rows, totals, "number"), "number")
        level = F.col("favour") * F.col("left") / F.col("by")
        expected = F.when(is_full(), F.lit(float(most_copies))).when(F.col("favour") > 0, level).otherwise(F.lit(0.0))
    rows = rows.withColumn("expected", F.when(F.col("size") > 0, expected).otherwise(F.lit(0.0)))
    rows = rows.withColumn("whole", F.floor("expected")).withColumn("chance", F.col("expected") - F.col("whole"))
    # Random odds over inclusion odds, as the probability that has these odds.
    u, chance = (F.col("random") + 0.5) / float(1 << _RANK_BITS), F.col("chance")
    odds = u * (1 - chance) / (u * (1 - chance) + chance * (1 - u))
    rank = F.least(F.floor(odds * float(1 << _RANK_BITS)), F.lit((1 << _RANK_BITS) - 1))
    rows = rows.withColumn("rank", rank)

    certain = rows.groupBy("number", "target").agg(F.sum(F.col("whole") * F.col("size")).alias("certain"))
    budgets = certain.select("number", (F.floor(F.col("target") + 0.5) - F.col("certain")).alias("budget"))
    ranked = rows.where("size > 0 and chance > 0").select("number", "size", *_ORDER)
    border = borders(ranked, pin(budgets.where("budget > 0"), "budgets"))
    here = F.struct(*_ORDER)
    more = F.when(F.col("chance") > 0, F.when(here < F.col("border"), F.col("size")).when(here == F.col("border"), F.col("part"))).cast("bigint")
    mixed = rows.join(border, "number", "left").withColumn("more", F.coalesce(more, F.lit(0).cast("bigint")))
    is_whole = (F.col("more") == F.col("size")) & (F.col("size") > 0)
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("whole") * F.col("size") + F.col("more")).alias("taken"),
        (F.col("whole") + is_whole.cast("bigint")).alias("copies"), F.when(is_whole, F.lit(0)).otherwise(F.col("more")).cast("bigint").alias("part"),
    )
