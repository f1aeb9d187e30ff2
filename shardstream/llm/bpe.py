"""Byte-level BPE in DuckDB queries that run inside each partition.

Texts are split by the tokenizer's pattern. A block's pieces are coded by an Arrow
dictionary, so Python meets each distinct one once. The new words among them go to a
recursive query: a row per word and token position, joined with the merge table; each
step contracts every word's leftmost pair of least rank, until no pair of any word is in
the table. Decoding joins ids with the vocabulary and aggregates bytes in id order.

A null text is an empty one (no ids, no bytes), null ids decode to no bytes. Repeated
rows and ids, null ids of documents and further columns change nothing; an empty table
gives an empty result.
"""

from __future__ import annotations

import base64
import heapq
import re

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardstream.llm.arrow import batch, fields, map_arrow
from shardstream.llm.words import blocks

#: Words and longer pieces of text whose ids a Python worker keeps; beyond it the cache starts anew.
CACHED_WORDS = 450_000
#: Distinct words of one recursive query, and ids of one decoding query.
QUERY_WORDS, QUERY_IDS = 10_000, 1 << 17
#: Bytes beyond which a word's pairs are kept in a heap: the query's steps, each over
#: all positions of a word, would take time with the square of its length.
LONG_WORD = 256

#: All in 32 bits: a pair's rank and its place, below ``LONG_WORD``, make one number.
_ENCODE = f"""
WITH RECURSIVE step(word, pos, id, next_pos, next_id, turn) AS (
  SELECT word, pos, id, next_pos, next_id, 0 FROM start
  UNION ALL
  (WITH best AS (
     SELECT word, min(rank * {LONG_WORD} + pos) AS pick, arg_min(next_pos, rank * {LONG_WORD} + pos) AS gone
     FROM step JOIN merges ON a = id AND b = next_id GROUP BY word),
   made AS (
     SELECT b.word, pick % {LONG_WORD} AS pos, pick // {LONG_WORD} AS id, gone, g.next_pos, g.next_id
     FROM best b JOIN step g ON g.word = b.word AND g.pos = b.gone)
   SELECT s.word, s.pos, if(s.pos = m.pos, m.id, s.id),
          if(s.pos = m.pos, m.next_pos, s.next_pos),
          if(s.pos = m.pos, m.next_id, if(s.next_pos = m.pos, m.id, s.next_id)), turn + 1
   FROM step s JOIN made m USING (word) WHERE s.pos <> m.gone)
)
SELECT word, id
FROM step JOIN (SELECT word, max(turn) AS turn FROM step GROUP BY word) USING (word, turn)
ORDER BY word, pos
"""

_DECODE = """
SELECT doc, string_agg(bytes, '' ORDER BY pos) AS bytes
FROM tokens JOIN vocabulary USING (id) GROUP BY doc
"""

_coders: dict[tuple[str, str], _Coder] = {}


class _Coder:
    """The tables of one vocabulary in an in-process database without files, and caches."""

    def __init__(self, ranks_path: str, pattern: str):
        with open(ranks_path, "rb") as lines:
            pairs = (line.split() for line in lines)
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.pattern = regex.compile(pattern)
        self.bytes = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        # Of words, and of pieces that are several; a word on its own is one match again.
        self.ids: dict[str, bytes] = {"": b""}
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "200MB", "temp_directory": ""})
        self.can_encode = False
        # Bytes travel as the characters of the same numbers.
        text = [token.decode("latin-1") for token in self.ranks]
        self._table("vocabulary", pa.table({"id": list(self.ranks.values()), "bytes": text}))

    def _merges(self) -> pa.Table:
        merges = [
            (self.ranks[token[:i]], self.ranks[token[i:]], rank)
            for token, rank in self.ranks.items()
            for i in range(1, len(token))
            if token[:i] in self.ranks and token[i:] in self.ranks
        ]
        columns = [pa.array(column, pa.int32()) for column in zip(*merges, strict=True)]
        return pa.table(dict(zip(("a", "b", "rank"), columns, strict=True)))

    def _table(self, name: str, rows: pa.Table) -> None:
        self.db.register("given", rows)
        self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    def _contract(self, words: list[str]) -> list[bytes]:
        encoded = [word.encode() for word in words]
        lengths = np.array([len(word) for word in encoded])
        last = np.cumsum(lengths) - 1
        ids = self.bytes[np.frombuffer(b"".join(encoded), np.uint8)]
        pos = np.arange(len(ids)) - np.repeat(last + 1 - lengths, lengths)
        next_id, next_pos = np.append(ids[1:], -1), pos + 1
        next_id[last] = next_pos[last] = -1
        columns = {"word": np.repeat(np.arange(len(words)), lengths), "pos": pos, "id": ids}
        start = columns | {"next_pos": next_pos, "next_id": next_id}
        self.db.register("start", pa.table({k: v.astype(np.int32) for k, v in start.items()}))
        found = self.db.execute(_ENCODE).fetchnumpy()
        flat = found["id"].astype("<i4").tobytes()
        ends = (4 * np.cumsum(np.bincount(found["word"], minlength=len(words)))).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def _contract_long(self, word: str) -> list[int]:
        """The same contraction with the pairs in a heap by rank and place."""
        parts: list[bytes | None] = [bytes([b]) for b in word.encode()]
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap: list[tuple[int, int, bytes]] = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < len(parts):
                pair = parts[i] + parts[after[i]]
                if pair in self.ranks:
                    heapq.heappush(heap, (self.ranks[pair], i, pair))

        for i in range(len(parts)):
            offer(i)
        while heap:
            _, i, pair = heapq.heappop(heap)
            if parts[i] is None or after[i] >= len(parts) or parts[i] + parts[after[i]] != pair:
                continue
            gone = after[i]
            parts[i], parts[gone], after[i] = pair, None, after[gone]
            if after[i] < len(parts):
                before[after[i]] = i
            offer(before[i])
            offer(i)
        return [self.ranks[part] for part in parts if part is not None]

    def _learn_words(self, words: set[str]) -> None:
        short = []
        for word in words:
            if len(word) * 4 <= LONG_WORD or len(word.encode()) <= LONG_WORD:
                short.append(word)
            else:
                self.ids[word] = np.array(self._contract_long(word), "<i4").tobytes()
        for i in range(0, len(short), QUERY_WORDS):
            some = short[i : i + QUERY_WORDS]
            self.ids.update(zip(some, self._contract(some), strict=True))

    def _learn(self, pieces: list[str]) -> None:
        new = set(pieces).difference(self.ids)
        if len(self.ids) + len(new) > CACHED_WORDS:
            self.ids = {"": b""}
            new = set(pieces).difference(self.ids)
        found = {piece: self.pattern.findall(piece) for piece in new if not _is_word(piece)}
        words = set().union(*found.values()).difference(self.ids)
        self._learn_words(words.union(new.difference(found)))
        for piece, words in found.items():
            if len(words) > 1:
                self.ids[piece] = b"".join([self.ids[word] for word in words])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one text behind the other, and how many each has."""
        if not self.can_encode:
            self._table("merges", self._merges())
            self.can_encode = True
        lists = pc.split_pattern(pa.array([_marked(text) for text in texts], pa.large_string()), _MARK)
        count = lists.value_lengths().to_numpy()
        first = np.cumsum(count, dtype=np.int64) - count
        coded = lists.flatten().dictionary_encode()
        code, pieces = coded.indices.to_numpy().copy(), coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        for at, text in enumerate(texts):
            if _MARK in text:
                code[first[at]] = len(pieces)
                pieces.append(text)
        self._learn(pieces)
        ids = [self.ids[piece] for piece in pieces]
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        begin, sizes = np.cumsum(size) - size, size[code]
        at = np.repeat(begin[code] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        return np.frombuffer(b"".join(ids), "<i4")[at], np.add.reduceat(sizes, first)

    def decode(self, ids: np.ndarray, lengths: np.ndarray) -> list[bytes]:
        """The bytes of each run of ``lengths`` ids."""
        doc = np.repeat(np.arange(len(lengths)), lengths)
        pos = np.arange(len(ids)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        self.db.register("tokens", pa.table({"doc": doc, "pos": pos, "id": ids}))
        out = [b""] * len(lengths)
        for at, text in self.db.execute(_DECODE).fetchall():
            out[at] = text.encode("latin-1")
        return out


#: A space between other white space: the pattern's matches may run across it.
_INNER_SPACE = regex.compile(r"\s (?:\s|$)")
#: Marks between a letter and white space, and a line end between other characters: matches of their own.
#: They begin with a set of characters, which the search skips to.
_ALONE = re.compile(r"[.,!?;:\n](?:(?<=[a-z][.,!?;:])[.,!?;:]*(?=\s)|(?<=\S\n)(?=\S))")


_MARK = "\0"


def _marked(text: str) -> str:
    """A text with marks between the pieces that the pattern splits independently of each other.

    A space before something else begins a match, and one behind something else cannot
    lie within one, so a text may be cut before each unless white space is on both sides.
    What is a match of its own is cut out. Pieces may be empty. A text that has the mark
    itself is one piece, which has to be taken as it is; for it there is an empty one.
    """
    if _MARK in text:
        return ""
    if _INNER_SPACE.search(text):
        return text
    return _ALONE.sub(f"{_MARK}\\g<0>{_MARK}", text).replace(" ", f"{_MARK} ")


def _is_word(piece: str) -> bool:
    """Whether a piece is letters, behind a space or not: one match."""
    return piece.isalpha() or (piece[0] == " " and piece[1:].isalpha())


def _coder(ranks_path: str, pattern: str) -> _Coder:
    key = (ranks_path, pattern)
    if key not in _coders:
        _coders[key] = _Coder(*key)
    return _coders[key]


def encode(docs: DataFrame, ranks_path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``ids`` of each whole text, without special tokens."""

    def run(batches):
        coder = _coder(ranks_path, pattern)
        for block in blocks(batches, "text", 1 << 19):
            ids, lengths = coder.encode(block.column("text").fill_null("").to_pylist())
            offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))
            yield batch(schema, block.column("doc_id"), lists)

    schema = fields(doc_id=docs.schema[doc_id].dataType, ids=T.ArrayType(T.IntegerType()))
    return map_arrow(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), run, schema)


def decode(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Add ``decoded`` (binary) to rows of ``doc_id`` and ``ids``."""

    def run(batches):
        coder = _coder(ranks_path, pattern)
        for rows in batches:
            column = rows.column("ids")
            lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = column.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(lengths)
            cuts = [0, *(np.flatnonzero(np.diff(ends // QUERY_IDS)) + 1), len(lengths)]
            # A batch for each query: a worker holds the bytes of one only.
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a < b:
                    decoded = coder.decode(flat[ends[a] - lengths[a] : ends[b - 1]], lengths[a:b])
                    yield batch(schema, *rows.slice(a, b - a).columns, pa.array(decoded, pa.binary()))

    encoded = encoded.select("doc_id", "ids")
    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.BinaryType())])
    return map_arrow(encoded, run, schema)
