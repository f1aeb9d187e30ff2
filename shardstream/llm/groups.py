"""Connected components, and groups of sorted rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardstream.shared import pin


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal keys out of sorted batches; one run is in memory at a time."""
    open_run: list[pa.RecordBatch] = []
    last = None
    for rows in batches:
        if not rows.num_rows:
            continue
        columns = [rows.column(k).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(rows.num_rows, bool)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        new[0] = last is not None and tuple(c[0] for c in columns) != last
        last = tuple(c[-1] for c in columns)
        cuts = [0, *np.flatnonzero(new[1:]) + 1, rows.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if new[a] and open_run:
                yield pa.Table.from_batches(open_run)
                open_run = []
            open_run.append(rows.slice(a, b - a))
    if open_run:
        yield pa.Table.from_batches(open_run)


def components(edges: DataFrame) -> DataFrame:
    """``id`` and ``component`` (its least id) for each end of the edges ``a``, ``b`` (longs).

    Each round, every vertex moves to whichever of itself and its neighbours has the least
    hash, pointers are followed, and edges are drawn between where vertices went; hashes
    differ by round, so that the graph shrinks by a factor whatever its shape. A vertex's
    minimum is aggregated before the shuffle, joins on a vertex with many edges are split
    by adaptive execution, and each round is written to the shared folder.
    """
    edges = pin(
        edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "edges"
    )
    maps: list[DataFrame] = []
    while not edges.isEmpty():
        order = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(len(maps))).alias("h"), F.col(c).alias("id"))  # noqa: B023, E731
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min(order("b")).alias("best"))
        parents = pin(least.select(F.col("a").alias("id"), F.least("best", order("a"))["id"].alias("parent")), "parents")
        for _ in range(2):
            above = parents.select(F.col("id").alias("parent"), F.col("parent").alias("top"))
            parents = parents.join(above, "parent").select("id", F.col("top").alias("parent"))
            parents = pin(parents, "parents")
        maps.append(parents)
        ends = lambda c: parents.select(F.col("id").alias(c), F.col("parent").alias(f"new_{c}"))  # noqa: B023, E731
        moved = edges.join(ends("a"), "a").join(ends("b"), "b").where("new_a <> new_b")
        edges = pin(
            moved.select(F.least("new_a", "new_b").alias("a"), F.greatest("new_a", "new_b").alias("b")).distinct(), "edges"
        )
    if not maps:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    roots = maps.pop()
    while maps:
        later = roots.select(F.col("id").alias("parent"), F.col("parent").alias("top"))
        roots = pin(
            maps.pop().join(later, "parent", "left").select("id", F.coalesce("top", "parent").alias("parent")), "roots"
        )
    least = roots.groupBy("parent").agg(F.min("id").alias("component"))
    return roots.join(least, "parent").select("id", "component")
