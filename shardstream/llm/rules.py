"""Quality rules: a decision list learned by sequential covering.

Rules for rejecting are grown one after the other from labelled statistics: conditions
on single statistics are added while they gain, and dropped again while that does not
hurt on rows kept apart. The list is emitted as one Spark conditional expression.

Null and empty texts have no words and fail the base rules; repeated rows and ids are
judged alike; columns other than the id and the text are not read. Without labels of
both kinds there are no learned rules.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardstream.llm.statistics import COUNTS, RATIOS, document_statistics, labelled_sample
from shardstream.shared import pin

#: Labelled rows the rules are learned from, about.
SAMPLE_ROWS = 20_000


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value, limit = F.col(self.feature), F.lit(self.threshold)
        return value > limit if self.above else value <= limit

    def holds(self, x: np.ndarray) -> np.ndarray:
        value = x[:, RATIOS.index(self.feature)]
        return value > self.threshold if self.above else value <= self.threshold


Rule = tuple[Condition, ...]


def _covered(rule: Rule, x: np.ndarray) -> np.ndarray:
    return np.logical_and.reduce([c.holds(x) for c in rule]) if rule else np.ones(len(x), bool)


def _grow(x: np.ndarray, bad: np.ndarray, most: int) -> Rule:
    """Add the condition that gains most information about bad rows until none is wrong."""
    rule: list[Condition] = []
    inside = np.ones(len(x), bool)
    while len(rule) < most and (~bad[inside]).any():
        p, n = bad[inside].sum(), (~bad[inside]).sum()
        best, gain = None, 0.0
        for f, feature in enumerate(RATIOS):
            values = x[inside, f]
            cuts = np.unique(np.quantile(values, np.linspace(0.01, 0.99, 99)))
            middles = (cuts[1:] + cuts[:-1]) / 2
            if not len(middles):
                continue
            order = np.searchsorted(middles, values)  # value > middles[k] for k < order
            low_p = np.cumsum(np.bincount(order[bad[inside]], minlength=len(middles) + 1))[:-1]
            low_n = np.cumsum(np.bincount(order[~bad[inside]], minlength=len(middles) + 1))[:-1]
            for above, ps, ns in ((False, low_p, low_n), (True, p - low_p, n - low_n)):
                gains = ps * (np.log2((ps + 1e-9) / (ps + ns + 1e-9) + 1e-12) - np.log2(p / (p + n)))
                k = int(np.argmax(gains))
                if gains[k] > gain + 1e-9:
                    best, gain = Condition(feature, above, float(middles[k])), float(gains[k])
        if best is None:
            break
        rule.append(best)
        inside &= best.holds(x)
    return tuple(rule)


def _worth(rule: Rule, x: np.ndarray, bad: np.ndarray) -> float:
    inside = _covered(rule, x)
    p, n = (bad & inside).sum(), (~bad & inside).sum()
    return (p - n) / (p + n) if p + n else -1.0


def _prune(rule: Rule, x: np.ndarray, bad: np.ndarray) -> Rule:
    """Drop final conditions while the rule is not worse for it on rows it did not grow on."""
    best = rule
    for k in range(len(rule) - 1, 0, -1):
        if _worth(rule[:k], x, bad) >= _worth(best, x, bad):
            best = rule[:k]
    return best


def learn(
    x: np.ndarray, bad: np.ndarray, fold: np.ndarray, precision: float = 0.9, least: int = 5, most_rules: int = 12,
    most_conditions: int = 4,
) -> list[Rule]:
    """Cover the bad rows by rules, each right for ``precision`` of the rows it meets in
    either part; rows of fold 0 prune, the others grow."""
    rules: list[Rule] = []
    left = np.ones(len(x), bool)
    while len(rules) < most_rules:
        grow, prune = left & (fold != 0), left & (fold == 0)
        if (bad & grow).sum() < least:
            break
        rule = _grow(x[grow], bad[grow], most_conditions)
        rule = _prune(rule, x[prune], bad[prune])
        inside = _covered(rule, x) & left
        parts = [inside & part for part in (grow, prune) if (inside & part).any()]
        if not rule or (bad & inside).sum() < least or min(bad[part].mean() for part in parts) < precision:
            break
        rules.append(rule)
        left &= ~inside
    return rules


def verdict(rules: list[Rule]) -> Column:
    """True for rows that no rule rejects: the rules in order, as one conditional expression."""
    chain = F.when(F.lit(False), F.lit(False))
    for rule in rules:
        chain = chain.when(reduce(and_, [c.column() for c in rule]), F.lit(False))
    return chain.otherwise(F.lit(True))


def judge(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, more: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, the columns ``more``, the counts of ``COUNTS``, ``base_failed`` and ``kept`` for each document.

    The base rules reject fewer than 50 words, and texts of which more than half the
    words lie in repeated three-word windows. The learned ones judge what is left; they
    are learned from labelled rows that pass the base rules.
    """
    statistics = pin(document_statistics(docs, more=more), "statistics")
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    sample = labelled_sample(statistics.where(~base_failed), labels, "quality", sample_rows, held_out=False)
    rules = learn(sample[:, 2:], sample[:, 1] == 0, sample[:, 0])
    return statistics.select("doc_id", *more, *COUNTS, base_failed.alias("base_failed"), (~base_failed & verdict(rules)).alias("kept"))
