"""The index's recall against all pairs, on vectors of different structure."""

from __future__ import annotations

import numpy as np
import pytest

from shardstream.llm import vectors

THRESHOLD = 0.93


def low_rank(rng):
    return rng.normal(size=(4000, 6)) @ rng.normal(size=(6, 64))


def clustered(rng):
    return rng.normal(size=(80, 64))[rng.integers(80, size=4000)] + 0.26 * rng.normal(size=(4000, 64))


def isotropic(rng):
    """Without links of their own, so half of them lie about the threshold from another one."""
    x = vectors.unit(rng.normal(size=(2000, 64)))
    return np.concatenate([x, vectors._turned(x, rng.normal(size=x.shape), 0.94)])


def within_a_span(rng):
    """Neighbours turned within a span of eight dimensions, at and little beyond the threshold."""
    basis = np.linalg.qr(rng.normal(size=(64, 8)))[0].T
    x = vectors.unit(rng.normal(size=(2000, 8)) @ basis)
    return np.concatenate([x, vectors._turned(x, rng.normal(size=(2000, 8)) @ basis, 0.932)])


def recall(x, index):
    """The share of links that the cells visited hold, each looked for from its lower cell."""
    x = vectors.unit(x)
    own = index.cells(x)
    which, cells = index.visits(x)
    visited = np.zeros((len(x), own.max() + 1 + cells.max()), bool)
    visited[which, cells] = True
    a, b = np.nonzero(np.triu(x @ x.T >= THRESHOLD, 1))
    low, high = np.where(own[a] <= own[b], a, b), np.where(own[a] <= own[b], b, a)
    return visited[low, own[high]].mean(), len(a)


@pytest.mark.parametrize("kind", [low_rank, clustered, isotropic, within_a_span])
def test_recall_is_kept_whatever_the_structure(kind):
    x = kind(np.random.default_rng(11))
    index = vectors.fit(x, THRESHOLD, 0.99)
    found, links = recall(x, index)
    print(kind.__name__, links, "links, recall", found, "reach", index.reach)
    assert links > 1000 and found >= 0.985
    assert recall(x, vectors.fit(x, THRESHOLD, 1.0))[0] == 1


def test_codes_grow_with_the_vectors():
    assert [vectors.codes_for(n) for n in (0, 50_000, 10**7, 10**12)] == [32, 32, 99, 512]


def test_all_links_where_asked(spark):
    """With a recall of 1, the operator's links are those of all pairs."""
    x = vectors.unit(low_rank(np.random.default_rng(4))[:600])
    table = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    found = {r.vec_id: r.n_links for r in vectors.near_duplicates(table, recall=1.0).collect()}
    links = (x @ x.T >= THRESHOLD).sum(1) - 1
    assert sum(links) > 100 and found == dict(enumerate(links.tolist()))
