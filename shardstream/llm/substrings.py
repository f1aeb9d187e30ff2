"""Removal of repeated passages by minimizer nodes and their contexts.

This is a form of de Bruijn compaction that builds no edges between nodes, joins no nodes
into paths and verifies no source coordinates: which windows repeat is decided node by node.

Compared are all windows of ``WINDOW`` consecutive words. The nodes are the ``NODE``-word
k-mers that are least by hash in some window (the leftmost of equal ones), so each window
belongs to one node, equal windows to equal nodes at equal places. What lies around a node
as far as its windows reach is its context. A node that occurs once has no repeated
window. One that occurs in one context only does not branch: all its windows are repeated
and take one row per text and context; a long passage keeps a row for each of its nodes.
Only at branching nodes are windows
compared one by one, for contexts found once, against one source text of each other
context. Spark joins carry the decisions to the coordinates of the texts, where the
windows are found again and the words they cover are removed.

Nodes, contexts and windows are compared as keyed 64-bit hashes, two of them at a time.
Windows are judged on the input. Null and empty texts have no words; texts of fewer words
than a window, repeated rows and rows without id are handled like others. Columns other
than the two read change nothing; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardstream.llm.arrow import batch, fields, map_arrow
from shardstream.llm.columns import own
from shardstream.llm.words import Words, blocks, mix, powers, shingles
from shardstream.shared import pin

WINDOW, NODE = 35, 16
#: Nodes that a window chooses from.
_CHOICE = WINDOW - NODE + 1
_BASE = 0xA24BAED4963EE407
_INVERSE = pow(_BASE, -1, 2**64)
_U = np.uint64


class Graph:
    """Nodes and windows of a block of texts, as arrays.

    Window ``i`` starts at word ``starts[i]`` and belongs to node ``node[i]``; node ``j`` is
    at word ``at[j]`` with the hash ``name[j]`` and the context ``context[j]``.
    """

    def __init__(self, texts: pa.Array):
        self.words = words = Words(texts)
        hashes = words.hashes()
        self._sums = np.concatenate((np.zeros(1, _U), np.cumsum(hashes * powers(_BASE, len(hashes)))))
        self._inverse = powers(_INVERSE, len(hashes) + 1)
        names, at = shingles(words, hashes, NODE)
        n = len(names) - _CHOICE + 1
        self.starts = self.node = np.zeros(0, np.int64)
        self.at, self.name, self.context = np.zeros(0, np.int64), np.zeros(0, _U), np.zeros(0, _U)
        if n <= 0:
            return
        # The leftmost least of 1, 2, 4, 8, 16 and then of all choices.
        least, width = np.arange(len(names)), 1
        while 2 * width <= _CHOICE:
            least = self._left(names, least[:-width], least[width:])
            width *= 2
        rest = _CHOICE - width
        least = self._left(names, least[: len(least) - rest], least[rest:]) if rest else least
        whole = words.doc[at[:n]] == words.doc[at[_CHOICE - 1 :]]
        self.starts, least = at[:n][whole], least[:n][whole]
        chosen, self.node = np.unique(least, return_inverse=True)
        self.at, self.name = at[chosen], names[chosen]
        doc = words.doc[self.at]
        low = np.maximum(self.at - (WINDOW - NODE), words.first[doc])
        high = np.minimum(self.at + WINDOW, words.first[doc + 1])
        place = (self.at - low).astype(_U) * _U(64) + (high - self.at).astype(_U)
        self.context = mix(self._spans(low, high) + place * _U(0x9FB21C651E98DF25))

    @staticmethod
    def _left(names: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(names[a] <= names[b], a, b)

    def _spans(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return mix((self._sums[high] - self._sums[low]) * self._inverse[low])

    def windows(self, some: np.ndarray) -> np.ndarray:
        return self._spans(self.starts[some], self.starts[some] + WINDOW)


def _long(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _nodes(docs: DataFrame) -> DataFrame:
    """A row per text, node and context: ``node``, ``context``, ``key`` and whether it is there ``twice``."""

    def run(batches):
        for block in blocks(batches, "text", 1 << 18):
            graph = Graph(block.column("text"))
            if not len(graph.at):
                continue
            doc = graph.words.doc[graph.at]
            order = np.lexsort((graph.context, graph.name, doc))
            names, contexts, doc = graph.name[order], graph.context[order], doc[order]
            new = np.ones(len(doc), bool)
            new[1:] = (names[1:] != names[:-1]) | (contexts[1:] != contexts[:-1]) | (doc[1:] != doc[:-1])
            first = np.flatnonzero(new)
            twice = np.diff(np.append(first, len(doc))) > 1
            keys = block.column("key").take(pa.array(doc[first]))
            yield batch(schema, _long(names[first]), _long(contexts[first]), keys, pa.array(twice))

    schema = fields(node=T.LongType(), context=T.LongType(), key=T.LongType(), twice=T.BooleanType())
    return map_arrow(docs.select("key", "text"), run, schema)


def _windows(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The windows of the wanted contexts of each text: ``node``, ``window``, ``context``, ``key`` and ``single``."""

    def run(batches):
        for block in blocks(batches, "text", 1 << 18):
            graph = Graph(block.column("text"))
            doc = graph.words.doc[graph.at] if len(graph.at) else np.zeros(0, np.int64)
            state = np.zeros(len(graph.at), np.int8)
            cuts = np.searchsorted(doc, np.arange(block.num_rows + 1))
            for name, value in (("single", 1), ("several", 2)):
                for row, contexts in enumerate(block.column(name).to_pylist()):
                    if contexts:
                        own = slice(cuts[row], cuts[row + 1])
                        state[own][np.isin(graph.context[own].view(np.int64), contexts)] = value
            some = np.flatnonzero(state[graph.node]) if len(graph.at) else np.zeros(0, np.int64)
            node = graph.node[some]
            keys = block.column("key").take(pa.array(doc[node], pa.int64()))
            yield batch(
                schema, _long(graph.name[node]), _long(graph.windows(some)), _long(graph.context[node]), keys,
                pa.array(state[node] == 1),
            )

    long = T.LongType()
    schema = fields(node=long, window=long, context=long, key=long, single=T.BooleanType())
    lists = wanted.groupBy("key").agg(
        *(F.collect_list(F.when(c, F.col("context"))).alias(name) for name, c in (("single", ~F.col("several")), ("several", F.col("several"))))
    )
    return map_arrow(docs.join(pin(lists, "wanted"), "key").select("key", "text", "single", "several"), run, schema)


def _cut(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Remove what the found contexts and windows of each text cover."""

    def run(batches):
        for block in blocks(batches, "text", 1 << 18):
            graph = Graph(block.column("text"))
            words = graph.words
            hit = np.zeros(len(graph.starts), bool)
            cuts = np.searchsorted(words.doc[graph.starts], np.arange(block.num_rows + 1)) if len(hit) else None
            for row, (contexts, windows) in enumerate(
                zip(block.column("contexts").to_pylist(), block.column("windows").to_pylist(), strict=True)
            ):
                if cuts is not None and (contexts or windows):
                    own = np.arange(cuts[row], cuts[row + 1])
                    hit[own] = np.isin(graph.context[graph.node[own]].view(np.int64), contexts)
                    if windows:
                        hit[own] |= np.isin(graph.windows(own).view(np.int64), windows)
            step = np.zeros(len(words.starts) + 1, np.int64)
            np.add.at(step, graph.starts[hit], 1)
            np.add.at(step, graph.starts[hit] + WINDOW, -1)
            keep = np.cumsum(step)[:-1] == 0
            kept_before = np.concatenate(([0], np.cumsum(keep)))
            kept = kept_before[words.first[1:]] - kept_before[words.first[:-1]]
            texts = block.column("text").fill_null("").cast(pa.binary()).to_pylist()
            left = [
                b" ".join(compress(text.split(), keep[a:b].tolist()))
                for text, a, b in zip(texts, words.first, words.first[1:], strict=False)
            ]
            rest = [block.column(name) for name in names]
            yield batch(
                schema, *rest, pa.array(words.counts.astype(np.int64)), pa.array((words.counts - kept).astype(np.int64)),
                pa.array(left, pa.binary()).cast(pa.string()),
            )

    lists = pin(
        found.distinct().groupBy("key").agg(
            *(F.collect_list(F.when(c, F.col("hash"))).alias(name) for name, c in (("contexts", F.col("whole")), ("windows", ~F.col("whole"))))
        ),
        "found",
    )
    names = [name for name in docs.columns if name != "key"]
    kinds = {name: docs.schema[name].dataType for name in names}
    schema = fields(**kinds, n_words=T.LongType(), n_removed=T.LongType(), kept=T.StringType())
    return map_arrow(docs.join(lists, "key", "left"), run, schema)


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``text``, ``n_words``, ``n_removed`` and ``kept`` (the words left, joined by one space)."""
    return _remove(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")))


def cut_repeats(docs: DataFrame) -> DataFrame:
    """The documents, all columns, with ``text`` changed where words of it were removed."""
    cut = _remove(docs.select("text", F.struct(*(own(name) for name in docs.columns if name != "text")).alias("row")))
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text")).alias("text")
    return cut.select(*(text if name == "text" else F.col("row").getField(name).alias(name) for name in docs.columns))


def _remove(docs: DataFrame) -> DataFrame:
    docs = docs.withColumn("key", F.when(F.col("text").isNotNull(), F.xxhash64("text")))
    nodes = _nodes(docs)
    repeated = nodes.groupBy("node").agg(F.count("*").alias("n"), F.max("twice").alias("twice")).where("n > 1 OR twice")
    nodes = pin(nodes.join(repeated.select("node"), "node"), "nodes")
    contexts = pin(
        nodes.groupBy("node", "context").agg(F.count("*").alias("n"), F.max("twice").alias("twice"), F.min("key").alias("key"))
        .select("node", "context", "key", ((F.col("n") > 1) | F.col("twice")).alias("several")),
        "contexts",
    )
    branching = contexts.groupBy("node").agg(F.count("*").alias("n")).where("n > 1").select("node")
    wanted = contexts.join(branching, "node").select("key", "context", "several")
    windows = pin(_windows(docs, wanted), "windows")
    shared = windows.groupBy("node", "window").agg(F.min("context").alias("low"), F.max("context").alias("high"))
    shared = shared.where("low <> high").select("node", "window")
    whole = nodes.join(contexts.where("several").select("node", "context"), ["node", "context"])
    single = windows.where("single").join(shared, ["node", "window"])
    found = whole.select("key", F.col("context").alias("hash"), F.lit(True).alias("whole")).unionByName(
        single.select("key", F.col("window").alias("hash"), F.lit(False).alias("whole"))
    )
    return _cut(docs, found)
