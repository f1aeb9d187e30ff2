"""Quality scores: histogram gradient-boosted trees over document statistics.

The trees are fitted on a bounded sample of labelled rows and laid out in arrays, level
by level, so that a batch of documents walks all trees in a few numpy steps. Every row
gets a score, also null and empty texts; without labels of both kinds the score is the
share of label 1 learned, or one half. Repeated rows are scored alike, columns other
than the id and the text are not read, an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardstream.llm.arrow import batch, fields, map_arrow
from shardstream.llm.statistics import RATIOS, document_statistics, labelled_sample
from shardstream.shared import pin

#: Labelled rows the trees are fitted on, about.
SAMPLE_ROWS = 20_000


@dataclass
class Trees:
    """Complete binary trees of one depth; node ``i`` has the children ``2i + 1`` and ``2i + 2``."""

    base: float
    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray
    leaf: np.ndarray  # trees x leaves

    def scores(self, x: np.ndarray) -> np.ndarray:
        trees = np.arange(len(self.feature))
        node = np.zeros((len(x), len(trees)), np.int64)
        inner = self.feature.shape[1]
        while inner:
            value = np.take_along_axis(x, self.feature[trees, node], 1)
            node = 2 * node + 1 + (value > self.threshold[trees, node])
            inner //= 2
        return 1 / (1 + np.exp(-(self.base + self.leaf[trees, node - self.feature.shape[1]].sum(1))))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 3, bins: int = 64, rate: float = 0.15) -> Trees:
    """Boost the logistic loss; each split is found on histograms of gradients."""
    prior = np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3)
    base, inner = float(np.log(prior / (1 - prior))), 2**depth - 1
    if not 0 < y.sum() < len(y):
        return Trees(base, np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    cuts = [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) for column in x.T]
    binned = np.stack([np.searchsorted(c, column) for c, column in zip(cuts, x.T, strict=True)], 1)
    slots = binned + np.arange(x.shape[1]) * bins
    feature, threshold = np.zeros((trees, inner), int), np.full((trees, inner), np.inf)
    leaf, margin, smooth = np.zeros((trees, inner + 1)), np.full(len(y), base), 1.0
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, hessian = y - p, p * (1 - p)
        node = np.zeros(len(y), int)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            at = ((node - first)[:, None] * (x.shape[1] * bins) + slots).ravel()
            shape = (width, x.shape[1], bins)
            sums = [
                np.bincount(at, np.repeat(v, x.shape[1]), width * x.shape[1] * bins).reshape(shape).cumsum(2)
                for v in (gradient, hessian)
            ]
            g, h = sums[0], sums[1]
            total_g, total_h = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + smooth) + (total_g - g) ** 2 / (total_h - h + smooth) - total_g**2 / (total_h + smooth)
            for i in range(width):
                f, b = np.unravel_index(np.argmax(gain[i]), gain[i].shape)
                if gain[i, f, b] > 1e-6 and b < len(cuts[f]):
                    feature[t, first + i], threshold[t, first + i] = f, cuts[f][b]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[t, node]] > threshold[t, node])
        g, h = (np.bincount(node - inner, v, inner + 1) for v in (gradient, hessian))
        leaf[t] = rate * g / (h + smooth)
        margin += leaf[t, node - inner]
    return Trees(base, feature, threshold, leaf)


def score(statistics: DataFrame, trees: Trees, threshold: float = 0.3) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` for each row of statistics."""

    def run(batches):
        for rows in batches:
            x = np.stack([rows.column(name).to_numpy(zero_copy_only=False) for name in RATIOS], 1)
            scores = trees.scores(x)
            yield batch(schema, rows.column("doc_id"), scores, pa.array((scores >= threshold).astype(np.int32)))

    schema = fields(doc_id=statistics.schema["doc_id"].dataType, score=T.DoubleType(), predicted=T.IntegerType())
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    scored = map_arrow(statistics.select("doc_id", *RATIOS), run, schema)
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Learn ``labels.quality`` from rows that are not held out and score all documents."""
    statistics = pin(document_statistics(docs), "statistics")
    sample = labelled_sample(statistics, labels, "quality", sample_rows, held_out=True)
    return score(statistics, fit(sample[:, 2:], sample[:, 1]), threshold)
