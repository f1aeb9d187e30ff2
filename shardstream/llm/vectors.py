"""Embedding near-duplicates by an inverted multi-index.

Unit vectors are cut in two halves with a codebook each; pairs of codes are the cells of
a grid. A vector looks for neighbours in the cells nearest to it: the two codebooks'
sequences, sorted by how far beyond the bisector between codes a half would have to go,
are merged cell by cell until what is left holds neighbours at the threshold with less
than the probability that the target recall leaves, or, for a recall of 1, until no cell
can hold a neighbour. Candidates are verified in double
precision, in blocks of cells, by matrix products inside tasks; per block only sums of
links and a spanning set of them leave the task.

Vectors with a null label, that are null, empty, zero, or hold null or non-finite
numbers link with nothing; nor do vectors of different lengths. Equal vectors are
collapsed first and count as links of each other. Rows are vectors: a repeated row is one
more. A null id is never a component's id unless the vector is alone. Columns other than
the three read change nothing; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardstream.llm.arrow import batch, fields, map_arrow
from shardstream.llm.groups import components, sorted_groups
from shardstream.shared import pin

#: Vectors the codebooks are fitted on, about, and codes of each half: the least, and the
#: most, which bounds what is sent to tasks. Beyond it cells hold more vectors.
SAMPLE_VECTORS, CODES, MOST_CODES = 20_000, 32, 512
#: Vectors of a block; a task verifies one block against another.
BLOCK = 256
#: Vectors of a cell, about, where the codes are as many as their number asks for.
CELL = 4 * BLOCK
#: Sampled vectors whose nearest ones in the sample are looked for.
PROBES = 2_000


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors.astype(np.float64)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _squares(x: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return np.maximum((x**2).sum(1)[:, None] - 2 * x @ codes.T + (codes**2).sum(1), 0)


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 15) -> np.ndarray:
    codes = x[rng.choice(len(x), k, replace=len(x) < k)]
    for _ in range(rounds):
        nearest = _squares(x, codes).argmin(1)
        for j in range(k):
            if (nearest == j).any():
                codes[j] = x[nearest == j].mean(0)
    return codes


@dataclass
class MultiIndex:
    codebooks: tuple[np.ndarray, np.ndarray]
    reach: float = 0.0

    @property
    def dimension(self) -> int:
        return sum(book.shape[1] for book in self.codebooks)

    def _halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = self.codebooks[0].shape[1]
        return x[:, :cut], x[:, cut:]

    def cells(self, x: np.ndarray) -> np.ndarray:
        a, b = (_squares(h, book).argmin(1) for h, book in zip(self._halves(x), self.codebooks, strict=True))
        return a * len(self.codebooks[1]) + b

    def distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each half and code, the square of the way to the code's side of any bisector."""
        found = []
        for half, book in zip(self._halves(x), self.codebooks, strict=True):
            squares = _squares(half, book)
            apart = np.sqrt(_squares(book, book)) + 1e-12
            way = np.zeros_like(squares)
            for j in range(len(book)):
                over = (squares - squares[:, [j]]) / (2 * apart[j])
                over[:, j] = 0
                np.maximum(way, over, out=way)
            found.append(way**2)
        return found[0], found[1]

    def visits(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(vector, cell) for each cell to visit, nearest first: the multi-sequence traversal.

        All vectors step together. A vector's frontier has, for each code of the first half,
        the nearest code of the second half not visited with it.
        """
        first, second = self.distances(x)
        order_a, order_b = first.argsort(1), second.argsort(1)
        sorted_a, sorted_b = np.take_along_axis(first, order_a, 1), np.take_along_axis(second, order_b, 1)
        sorted_b = np.concatenate([sorted_b, np.full((len(x), 1), np.inf)], 1)
        at = np.zeros(first.shape, np.int64)
        frontier = sorted_a + sorted_b[:, :1]
        active, vectors, cells = np.arange(len(x)), [], []
        while len(active):
            row = frontier[active].argmin(1)
            near = frontier[active, row] <= self.reach
            active, row = active[near], row[near]
            column = at[active, row]
            vectors.append(active)
            cells.append(order_a[active, row] * len(self.codebooks[1]) + order_b[active, column])
            at[active, row] += 1
            frontier[active, row] = sorted_a[active, row] + sorted_b[active, column + 1]
        return np.concatenate(vectors or [np.zeros(0, int)]), np.concatenate(cells or [np.zeros(0, int)])


def codes_for(vectors: int) -> int:
    """Codes of each half for so many vectors."""
    return int(np.clip(np.ceil(np.sqrt(vectors / CELL)), CODES, MOST_CODES))


def _turned(x: np.ndarray, towards: np.ndarray, threshold: float) -> np.ndarray:
    """Each vector turned by the threshold's angle, in the direction of another one."""
    aside = towards - (towards * x).sum(1, keepdims=True) * x
    norms = np.linalg.norm(aside, axis=1, keepdims=True)
    return threshold * x + np.sqrt(1 - threshold**2) * np.divide(aside, norms, out=np.zeros_like(aside), where=norms > 1e-12)


def _nearest(x: np.ndarray, probes: np.ndarray, near: int, rows: int = 128) -> tuple[np.ndarray, ...]:
    """Each probe, its nearest other vectors, and their cosines; a few probes at a time."""
    found, cosines = [], []
    for some in np.array_split(probes, len(probes) // rows + 1):
        cosine = x[some] @ x.T
        cosine[np.arange(len(some)), some] = -2
        nearest = np.argpartition(cosine, -near, axis=1)[:, -near:]
        found.append(nearest.ravel())
        cosines.append(np.take_along_axis(cosine, nearest, 1).ravel())
    return np.repeat(probes, near), np.concatenate(found), np.concatenate(cosines)


def fit(sample: np.ndarray, threshold: float, recall: float, codes: int = CODES, seed: int = 7) -> MultiIndex:
    """Fit codebooks, and the reach that finds ``recall`` of neighbours at the threshold.

    The neighbours lie at the threshold's angle from sampled vectors in three kinds of
    direction: any one, that of another sampled vector, and that of the nearest ones in the
    sample. Where data lie near a span or in clusters, the last two keep to it. Pairs of the
    sample beyond the threshold are a fourth kind. The reach suits the hardest kind; nearer
    neighbours are found more often. With a recall of 1 it is the square of the distance at
    the threshold: the way to a neighbour's cell is never longer, so none is lost.
    """
    rng = np.random.default_rng(seed)
    x = unit(sample)
    cut = max(1, x.shape[1] // 2)
    books = tuple(_kmeans(h.copy(), min(codes, max(1, len(x))), rng) for h in (x[:, :cut], x[:, cut:]))
    index = MultiIndex(books)  # type: ignore[arg-type]
    if recall >= 1:
        index.reach = 2 - 2 * threshold + 1e-9
        return index
    first, second = index.distances(x)
    width = len(books[1])

    def reach(rows: np.ndarray, neighbours: np.ndarray) -> float:
        cells = index.cells(neighbours)
        return float(np.quantile(first[rows, cells // width] + second[rows, cells % width], recall))

    rows = np.arange(len(x))
    kinds = [(rows, _turned(x, rng.normal(size=x.shape), threshold)), (rows, _turned(x, x[rng.permutation(len(x))], threshold))]
    near = min(8, len(x) - 1)
    if near:
        asks, nearest, cosines = _nearest(x, rng.permutation(len(x))[:PROBES], near)
        kinds.append((asks, _turned(x[asks], x[nearest], threshold)))
        if (linked := cosines >= threshold).any():
            kinds.append((asks[linked], x[nearest[linked]]))
    index.reach = max(reach(*kind) for kind in kinds) + 1e-9
    return index


def _prepared(vectors: DataFrame, vec_id: str, embedding: str, label: str, kind: str) -> DataFrame:
    """``vec_id``, ``label``, and for vectors that can link a ``key`` and the numbers as bytes."""
    usable = F.col("label").isNotNull() & (F.size("v") > 0) & F.forall(
        "v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    ) & F.exists("v", lambda x: x != 0)

    def digest(label, x: bytes) -> bytes:
        name = repr(label).encode()
        return hashlib.blake2b(len(name).to_bytes(8, "big") + name + x, digest_size=16).digest()

    def run(batches):
        for rows in batches:
            v = [None if x is None else np.array(x, kind) for x in rows.column("v").to_pylist()]
            data = [None if x is None else x.tobytes() for x in v]
            keys = [
                None if x is None else digest(label, x)
                for x, label in zip(data, rows.column("label").to_pylist(), strict=True)
            ]
            yield batch(schema, rows.column("vec_id"), rows.column("label"), pa.array(keys, pa.binary()), pa.array(data, pa.binary()))

    element = "float" if kind == "<f4" else "double"
    given = vectors.select(
        F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(embedding).cast(f"array<{element}>").alias("v"),
    )
    schema = fields(vec_id=given.schema["vec_id"].dataType, label=given.schema["label"].dataType, key=T.BinaryType(), data=T.BinaryType())
    return map_arrow(given.withColumn("v", F.when(usable, F.col("v"))), run, schema)


def _matrix(data: list[bytes], kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(data), kind).reshape(len(data), -1)


def _verify(threshold: float, kind: str, schema: T.StructType):
    """Sums of links, and edges of a spanning forest of the links, for each block of pairs."""

    def run(batches):
        for group in sorted_groups(batches, ["cell_key", "member_block", "query_block"]):
            asks = group.column("asks").to_numpy()
            ids, times = group.column("id").to_numpy(), group.column("times").to_numpy()
            home = group.column("home").to_numpy()
            q, m = np.flatnonzero(asks), np.flatnonzero(~asks)
            if not len(q) or not len(m):
                continue
            x = unit(_matrix(group.column("data").to_pylist(), kind))
            links = (x[q] @ x[m].T >= threshold) & (ids[q][:, None] != ids[m][None])
            if not links.any():
                continue
            count = np.zeros(len(ids), np.int64)
            count[q] += links @ times[m]
            # A pair within one cell is met from both sides, another one only from this.
            count[m] += times[q] @ (links & ~home[q][:, None])
            root = np.arange(len(ids))
            while True:
                from_m = np.where(links, root[m][None], len(ids)).min(1)
                root[q] = np.minimum(root[q], from_m)
                from_q = np.where(links, root[q][:, None], len(ids)).min(0)
                changed = from_q < root[m]
                root[m] = np.minimum(root[m], from_q)
                if not changed.any():
                    break
            some = np.flatnonzero((count > 0) | (root != np.arange(len(ids))))
            yield batch(schema, ids[some], ids[root[some]], count[some])

    return run


def near_duplicates(
    vectors: DataFrame, threshold: float = 0.93, recall: float = 0.99, vec_id: str = "vec_id",
    embedding: str = "embedding", label: str = "label",
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` for each vector.

    Links are pairs of equal label and a cosine of at least ``threshold``. A ``recall`` of 1
    finds all of them, at the price of visiting most cells where vectors have no structure.
    """
    kind = "<f4" if vectors.schema[embedding].dataType == T.ArrayType(T.FloatType(), True) else "<f8"
    rows = pin(_prepared(vectors, vec_id, embedding, label, kind).withColumn("row", F.monotonically_increasing_id()), "vectors")
    usable = rows.where(F.col("key").isNotNull())
    distinct = usable.groupBy("key").agg(
        F.min("vec_id").cast("bigint").alias("first_id"), F.min("row").alias("row"), F.count("*").alias("times"), F.first("label").alias("label"), F.first("data").alias("data")
    )
    # A written number names a distinct vector in links: ids may be null or shared.
    distinct = pin(distinct.withColumn("id", F.monotonically_increasing_id()), "distinct-vectors")
    n = distinct.count()
    share = min(1.0, SAMPLE_VECTORS / max(n, 1))
    drawn = F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < int(share * (1 << 30))
    sample = distinct.where(drawn | F.lit(share == 1.0)).select("data").orderBy("data").toArrow().column("data").to_pylist()
    if sample:
        sizes, many = np.unique([len(x) for x in sample], return_counts=True)
        size = sizes[many.argmax()]
        index = fit(_matrix([x for x in sample if len(x) == size], kind), threshold, recall, codes_for(n))
    else:
        index = MultiIndex((np.zeros((1, 1)), np.zeros((1, 1))))

    def place(batches):
        for rows in batches:
            data = rows.column("data").to_pylist()
            own, which, cells = np.zeros(len(data), np.int64), [], []
            fits = np.array([len(x) == index.dimension * np.dtype(kind).itemsize for x in data], bool)
            other = np.flatnonzero(~fits)
            own[other] = [-1 - len(data[i]) for i in other]  # one cell for each other length
            for some in np.array_split(np.flatnonzero(fits), fits.sum() // 2048 + 1):
                if len(some):
                    x = unit(_matrix([data[i] for i in some], kind))
                    own[some] = index.cells(x)
                    vector, cell = index.visits(x)
                    ahead = cell > own[some[vector]]  # of two cells the lower one asks
                    which.append(some[vector[ahead]])
                    cells.append(cell[ahead])
            everyone = np.arange(len(data))
            which = np.concatenate([everyone, everyone, *which])
            cells = np.concatenate([own, own, *cells])
            asks = np.arange(len(which)) >= len(data)
            home = cells == own[which]
            taken = rows.take(pa.array(which))
            columns = (taken.column(c) for c in ("id", "times", "label", "data"))
            yield batch(place_schema, *columns, cells, pa.array(asks), pa.array(home))

    kinds = {f.name: f.dataType for f in distinct.schema.fields}
    place_schema = fields(
        id=T.LongType(), times=T.LongType(), label=kinds["label"], data=T.BinaryType(), cell=T.LongType(),
        asks=T.BooleanType(), home=T.BooleanType(),
    )
    placed = map_arrow(distinct.select("id", "times", "label", "data"), place, place_schema)
    placed = pin(placed.withColumn("cell_key", F.xxhash64("label", "cell")), "placed-vectors")
    sizes = placed.groupBy("cell_key").agg(
        *(F.ceil(F.count_if(side) / BLOCK).cast("int").alias(name) for name, side in (("queries", F.col("asks")), ("members", ~F.col("asks"))))
    )
    sizes = pin(sizes.where((F.col("queries") > 0) & (F.col("members") > 0)), "cells")
    blocked = placed.join(sizes, "cell_key").withColumn(
        "own", F.pmod(F.xxhash64("id"), F.when(F.col("asks"), F.col("queries")).otherwise(F.col("members"))).cast("int")
    )
    others = F.explode(F.sequence(F.lit(0), F.when(F.col("asks"), F.col("members")).otherwise(F.col("queries")) - 1))
    blocked = blocked.withColumn("other", others).select(
        "cell_key", F.when(F.col("asks"), F.col("other")).otherwise(F.col("own")).alias("member_block"),
        F.when(F.col("asks"), F.col("own")).otherwise(F.col("other")).alias("query_block"), "asks", "home", "id", "times", "data",
    )
    keys = ["cell_key", "member_block", "query_block"]
    together = blocked.repartition(*keys).sortWithinPartitions(*keys)
    schema = fields(a=T.LongType(), b=T.LongType(), links=T.LongType())
    found = pin(map_arrow(together, _verify(threshold, kind, schema), schema), "links")
    classes = components(found.select("a", "b"))
    links = found.groupBy(F.col("a").alias("id")).agg(F.sum("links").alias("links"))
    linked = distinct.join(links, "id", "left").join(classes, "id", "left").select(
        "key", (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"), F.coalesce("component", "id").alias("class")
    )
    linked = pin(linked, "linked")
    names = (
        distinct.join(linked, "key").groupBy("class").agg(F.min(F.struct(F.col("first_id").isNull(), "first_id", "key", "row")).alias("least"))
    )
    least = F.col("least.first_id").alias("least_id"), F.col("least.key").alias("least_key"), F.col("least.row").alias("least_row")
    linked = pin(linked.join(names, "class").select("key", "n_links", *least), "classes")
    kind = rows.schema["vec_id"].dataType
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("least_id").cast(kind))
    # Of vectors with the least id the one of the least key is kept, of a component without ids one row.
    chosen = (F.col("key") == F.col("least_key")) & (F.col("least_id").isNotNull() | (F.col("row") == F.col("least_row")))
    kept = F.col("vec_id").eqNullSafe(component) & F.coalesce(chosen, F.lit(True))
    return rows.select("vec_id", "key", "row").join(linked, "key", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
        kept.alias("kept"),
    )
