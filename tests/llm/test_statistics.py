"""The sample models are fitted on, and trees against plain versions."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import functions as F

from shardstream.llm import quality
from shardstream.llm.statistics import RATIOS, labelled_sample


def test_sample_is_bounded_by_ids(spark):
    """An id on most rows, labelled twice; ids labelled both ways, by neither label, without an id."""
    ids = [7] * 4000 + list(range(100, 400))
    table = spark.createDataFrame([(i, float(k)) for k, i in enumerate(ids)], "doc_id long, x double")
    table = table.select("doc_id", *(F.col("x").alias(name) for name in RATIOS)).repartition(4)
    marks = [(7, 1, 0), (7, 1, 0), (100, 0, 0), (100, 1, 0), (101, 2, 0), (102, None, 0), (None, 1, 0)]
    marks += [(i, i % 2, 0) for i in range(103, 400)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    found = labelled_sample(table, labels, "quality", 10**6, held_out=False)
    want = sorted((zlib.crc32(str(i).encode()) % 3, i % 2, 0 if i == 7 else 4000 + i - 100) for i in [7, *range(103, 400)])
    assert sorted(map(tuple, found[:, :3].astype(int).tolist())) == want
    held = labelled_sample(table, labels, "quality", 10**6, held_out=True)
    assert len(held) == sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in [7, *range(103, 400)])
    few = labelled_sample(table, labels, "quality", 20, held_out=False)
    assert len(few) <= 60 and {tuple(r) for r in few} <= {tuple(r) for r in found}


def walk(trees, row):
    """The score of one row, node by node."""
    margin = trees.base
    for feature, threshold, leaf in zip(trees.feature, trees.threshold, trees.leaf, strict=True):
        node = 0
        while node < len(feature):
            node = 2 * node + 1 + int(row[feature[node]] > threshold[node])
        margin += leaf[node - len(feature)]
    return 1 / (1 + np.exp(-margin))


def test_flattened_trees_agree_with_walking_them():
    rng = np.random.default_rng(2)
    x = rng.random((600, 5)).round(2)
    y = ((x[:, 0] > 0.5) ^ (x[:, 3] > 0.3)).astype(float)
    trees = quality.fit(x, y)
    found = trees.scores(x)
    assert np.allclose(found, [walk(trees, row) for row in x])
    assert ((found > 0.5) == y).mean() > 0.97  # neither feature tells alone
    assert np.allclose(trees.scores(x[::-1]), found[::-1])


def test_first_split_is_the_best_of_all():
    """The first tree's root takes the cut of most gain, found by trying every feature and value."""
    rng = np.random.default_rng(5)
    x = rng.integers(0, 12, (300, 4)).astype(float)
    y = (x[:, 2] + rng.normal(scale=2, size=300) > 6).astype(float)
    trees = quality.fit(x, y)
    g, h = y - y.mean(), y.mean() * (1 - y.mean())

    def gain(feature, cut, smooth=1.0):
        left = x[:, feature] <= cut
        return sum(g[side].sum() ** 2 / (h * side.sum() + smooth) for side in (left, ~left))

    best = max(gain(f, cut) for f in range(4) for cut in np.unique(x[:, f]))
    assert trees.feature[0, 0] == 2 and gain(2, trees.threshold[0, 0]) >= best - 1e-6
