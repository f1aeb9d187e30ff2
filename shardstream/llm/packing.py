"""Packing token sequences: shortest-pack-first over the histogram of lengths.

A document is tokenized once. What exceeds the capacity is cut into full sequences; the
rest, of fewer than ``capacity`` tokens, counts in a histogram of at most ``capacity``
lengths. The driver plans on that histogram alone: it places the lengths, longest first,
in the shortest pack with room, and counts how many packs follow each pattern. Packs
left with much room are then filled by cutting up the emptiest ones. Documents find
their place by their rank among those of the same length; ranks come from small groups
of hashed rows and the group counts before them, so no length is ranked in one task.

Rows are independent: a null text is an empty one, repeated rows and repeated or null
ids are packed like any other, an empty table gives no pieces. Only the id and the text
column are read, whatever else there is.
"""

from __future__ import annotations

import heapq
import os
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardstream.llm.arrow import batch, fields, map_arrow
from shardstream.llm.words import blocks
from shardstream.shared import pin

#: Words whose ids a Python worker keeps; beyond it the cache starts anew.
CACHED_WORDS = 900_000
#: Words that go to the tokenizer as one text.
_AT_ONCE = 500
#: Marks between a letter (ASCII's or U+00C0 to U+00FF) and white space: no token holds both.
_MARK = re.compile(rb"[.,!?;:#$%&*](?:(?<=[a-z].)|(?<=\xc3[\x80-\x96\x98-\xb6\xb8-\xbf].))[.,!?;:#$%&*]*(?=\s)")

_tokenizers: dict[str, _Tokens] = {}


class _Tokens(dict):
    """Ids of single words as bytes.

    The tokenizer drops white space and case and never joins across white space, nor
    letters with the marks behind them. So a text has the ids of its words one after the
    other, and each word is tokenized once while cached. One of small letters only is what
    the tokenizer's model sees, with its bytes shown as characters, and goes straight to it.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.shown = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str

    def _learn(self, words: set[bytes]) -> None:
        tokenize, mixed = self.model.tokenize, []
        for word in words:
            shown = word.decode()
            if not word.isalpha():  # of ASCII letters, all of which are small here
                if not shown.isalpha() or shown != shown.lower() or not is_normalized("NFC", shown):
                    mixed.append(word)
                    continue
                shown = self.shown(shown)[0][0]
            self[word] = array("I", [token.id for token in tokenize(shown)]).tobytes()
        for i in range(0, len(mixed), _AT_ONCE):
            some = [word.decode() for word in mixed[i : i + _AT_ONCE]]
            encoded = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            ids, starts = np.array(encoded.ids, "<u4"), np.array([a for a, _ in encoded.offsets], np.int64)
            word = np.searchsorted(np.cumsum([len(x) + 1 for x in some]), starts, "right")
            cuts = np.searchsorted(word, np.arange(len(some) + 1))
            for key, a, b in zip(mixed[i : i + _AT_ONCE], cuts, cuts[1:], strict=False):
                self[key] = ids[a:b].tobytes()

    def texts(self, texts: list[bytes]) -> Iterator[bytes]:
        split = [_MARK.sub(rb" \g<0>", text.lower()).split() for text in texts]  # lower case of ASCII letters
        missing = set().union(*split).difference(self)
        if len(self) + len(missing) > CACHED_WORDS:
            self.clear()
            missing = set().union(*split)
        self._learn(missing)
        return (b"".join(map(self.__getitem__, words)) for words in split)


def tokenize(docs: DataFrame, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit), the end id last."""

    def run(batches):
        if tokenizer not in _tokenizers:
            _tokenizers[tokenizer] = _Tokens(tokenizer)
        tokens, end = _tokenizers[tokenizer], np.array([end_id], "<u4").tobytes()
        for block in blocks(batches, "text"):
            texts = block.column("text").fill_null("").cast(pa.binary()).to_pylist()
            ids = [x + end for x in tokens.texts(texts)]
            sizes = pa.array([len(x) // 4 for x in ids], pa.int64())
            yield batch(schema, block.column("doc_id"), sizes, pa.array(ids, pa.binary()))

    schema = fields(doc_id=docs.schema[doc_id].dataType, n_tokens=T.LongType(), ids=T.BinaryType())
    return map_arrow(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), run, schema)


@dataclass
class Packs:
    """``count`` packs of one pattern. Pack ``j`` holds the document of rank ``first + j``
    for each slot ``(length, first, offset)``."""

    count: int
    total: int = 0
    slots: list[tuple[int, int, int]] = field(default_factory=list)

    def split(self, n: int) -> tuple[Packs, Packs]:
        rest = [(length, first + n, offset) for length, first, offset in self.slots]
        return Packs(n, self.total, self.slots), Packs(self.count - n, self.total, rest)

    def add(self, length: int, first: int) -> None:
        self.slots = [*self.slots, (length, first, self.total)]
        self.total += length


def pack_histogram(counts: dict[int, int], capacity: int) -> list[Packs]:
    """Place ``counts[length]`` documents of each length in packs of ``capacity`` tokens.

    A length adds at most three patterns, so there are at most ``3 * capacity`` whatever
    the number of documents.
    """
    done: list[Packs] = []
    open_packs: list[tuple[int, int, Packs]] = []  # shortest first
    made = 0

    def put(packs: Packs) -> None:
        nonlocal made
        made += 1
        if packs.total == capacity:
            done.append(packs)
        else:
            heapq.heappush(open_packs, (packs.total, made, packs))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left and open_packs and open_packs[0][0] + length <= capacity:
            packs = heapq.heappop(open_packs)[2]
            if packs.count > left:
                packs, rest = packs.split(left)
                put(rest)
            packs.add(length, rank)
            rank += packs.count
            left -= packs.count
            put(packs)
        per_pack = capacity // length
        for count, slots in ((left // per_pack, per_pack), (1, left % per_pack)):
            if count and slots:
                packs = Packs(count)
                for _ in range(slots):
                    packs.add(length, rank)
                    rank += count
                put(packs)
    return done + [packs for _, _, packs in open_packs]


@dataclass
class Plan:
    """Where a document of a length and rank goes, as arrays sorted by (length, rank).

    ``bound[length]`` is where the slots of a length begin. A slot lies in sequence
    ``sequence + rank - first`` or, where ``line`` is not negative, in tokens
    ``line + (rank - first) * step`` on, of the line of tokens that fills the room left
    in other packs (``fill_*``, by where each run of packs begins on that line).
    """

    bound: np.ndarray
    first: np.ndarray
    offset: np.ndarray
    sequence: np.ndarray
    line: np.ndarray
    step: np.ndarray
    fill_at: np.ndarray
    fill_room: np.ndarray
    fill_used: np.ndarray
    fill_sequence: np.ndarray
    room: int
    capacity: int
    sequences: int

    def pieces(self, length: int, rank: int) -> list[tuple[int, int, int, int]]:
        """``(from, tokens, sequence, offset)`` for each piece of a document's rest."""
        k = self.bound[length] + np.searchsorted(
            self.first[self.bound[length] : self.bound[length + 1]], rank, "right"
        ) - 1
        j = rank - int(self.first[k])
        if self.line[k] < 0:
            return [(0, length, int(self.sequence[k]) + j, int(self.offset[k]))]
        at, out, done = int(self.line[k]) + j * int(self.step[k]), [], 0
        while done < length:
            if at >= self.room:
                out.append((done, length - done, self.sequences - 1, at - self.room))
                break
            g = int(np.searchsorted(self.fill_at, at, "right")) - 1
            pack, used = divmod(at - int(self.fill_at[g]), int(self.fill_room[g]))
            n = min(length - done, int(self.fill_room[g]) - used)
            out.append((done, n, int(self.fill_sequence[g]) + pack, int(self.fill_used[g]) + used))
            done, at = done + n, at + n
        return out


def plan(counts: dict[int, int], capacity: int, least_cut: int) -> Plan:
    """Pack, then take the emptiest packs apart to fill rooms of ``least_cut`` tokens or more."""
    packs = sorted(pack_histogram(counts, capacity), key=lambda p: p.total)
    room = sum(p.count * (capacity - p.total) for p in packs if capacity - p.total >= least_cut)
    given, donors, rest = 0, [], []
    for p in packs:
        space = capacity - p.total
        if given >= room or space < least_cut:
            rest.append(p)
            continue
        n = min(p.count, -(-(room - given) // capacity))  # each gives its tokens and its room
        taken, kept = p.split(n)
        donors.append(taken)
        given, room = given + n * p.total, room - n * space
        if kept.count:
            rest.append(kept)
    rows, fill, sequence, line = [], [], 0, 0
    for p in rest:
        rows += [(length, first, offset, sequence, -1, 0) for length, first, offset in p.slots]
        if capacity - p.total >= least_cut:
            fill.append((capacity - p.total, p.total, sequence, p.count))
        sequence += p.count
    for p in donors:
        rows += [(length, first, 0, 0, line + offset, p.total) for length, first, offset in p.slots]
        line += p.count * p.total
    columns = np.array(sorted(rows), np.int64).reshape(-1, 6).T
    fills = np.array(fill, np.int64).reshape(-1, 4).T
    filled = np.concatenate(([0], np.cumsum(fills[0] * fills[3])))
    return Plan(
        np.searchsorted(columns[0], np.arange(capacity + 2)), *columns[1:], filled[:-1], *fills[:3], int(filled[-1]),
        capacity, sequence + (line > filled[-1]),
    )


def pack(tokens: DataFrame, capacity: int = 4096, least_cut: int = 64) -> DataFrame:
    """Pack tokenized rows into sequences of at most ``capacity`` tokens.

    ``tokens`` has ``doc_id``, ``n_tokens`` and ``ids`` and is read three times: give a
    written table. One row per piece: ``doc_id``, ``start``, ``length``, ``ids``,
    ``doc_tokens``, ``sequence_id`` and ``offset``. At most one sequence is short for lack
    of documents; others lack less than ``least_cut`` tokens.
    """
    spark = tokens.sparkSession
    chunks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rest, full = F.col("n_tokens") % capacity, F.floor(F.col("n_tokens") / capacity)
    placed = tokens.select(
        "*", rest.alias("rest"), full.alias("full"), F.pmod(F.xxhash64("doc_id", "ids"), F.lit(chunks)).alias("chunk")
    )
    groups = placed.groupBy("rest", "chunk").agg(F.count("*").alias("docs"), F.sum("full").alias("fulls"))
    groups = pin(groups, "packing-groups")  # at most capacity * chunks rows
    sizes = groups.groupBy("rest").agg(F.sum("docs").alias("docs"), F.sum("fulls").alias("fulls")).collect()
    plan_ = plan({row.rest: row.docs for row in sizes if row.rest}, capacity, least_cut)
    # Full sequences are numbered after the packs, by length, group and rank.
    base, bases = plan_.sequences, {}
    for row in sorted(sizes):
        bases[row.rest] = base
        base += row.fulls
    starts = np.array([bases.get(n, 0) for n in range(capacity)], np.int64)

    def before(name, window):
        return F.coalesce(F.sum(name).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    by_chunk = Window.partitionBy("rest").orderBy("chunk")
    offsets = groups.select(
        "rest", "chunk", before("docs", by_chunk).alias("docs_before"), before("fulls", by_chunk).alias("fulls_before")
    )
    in_group = Window.partitionBy("rest", "chunk").orderBy("doc_id")
    ranked = placed.select(
        "doc_id", "ids", "rest", "chunk",
        (F.row_number().over(in_group) - 1).alias("rank"), before("full", in_group).alias("fulls"),
    )
    ranked = ranked.join(offsets, ["rest", "chunk"]).select(
        "doc_id", "ids", "rest",
        (F.col("rank") + F.col("docs_before")).alias("rank"), (F.col("fulls") + F.col("fulls_before")).alias("fulls"),
    )

    def cut(batches):
        for rows in batches:
            which, out = [], []
            columns = (rows.column(c).to_pylist() for c in ("ids", "rest", "rank", "fulls"))
            for row, (ids, rest, rank, fulls) in enumerate(zip(*columns, strict=True)):
                n = len(ids) // 4
                pieces = [(i * capacity, capacity, int(starts[rest]) + fulls + i, 0) for i in range(n // capacity)]
                if rest:
                    pieces += [(n - rest + a, *piece) for a, *piece in plan_.pieces(rest, rank)]
                which += [row] * len(pieces)
                out += [(a, m, ids[4 * a : 4 * (a + m)], n, sequence, at) for a, m, sequence, at in pieces]
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
            columns = zip(*out, strict=True) if out else [()] * 6
            yield batch(
                schema, rows.column("doc_id").take(pa.array(which, pa.int64())),
                *(pa.array(list(c), kind) for c, kind in zip(columns, kinds, strict=True)),
            )

    long = T.LongType()
    schema = fields(
        doc_id=tokens.schema["doc_id"].dataType, start=long, length=long, ids=T.BinaryType(), doc_tokens=long,
        sequence_id=long, offset=long,
    )
    return map_arrow(ranked, cut, schema)


def pack_documents(
    docs: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = 4096, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Tokenize whole texts, write the ids to the shared folder and pack them."""
    return pack(pin(tokenize(docs, tokenizer, end_id, doc_id, text), "tokens"), capacity)
