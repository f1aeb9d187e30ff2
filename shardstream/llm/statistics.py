"""Statistics of whole documents, in one pass over their bytes.

Null and empty texts have zero everywhere. Only the id and the text are read; the
result has ``doc_id``, the columns of ``COUNTS`` (long) and those of ``RATIOS`` (double).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardstream.llm.arrow import batch, fields, map_arrow
from shardstream.llm.words import Words, blocks, mix, shingles, span_hashes

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RATIOS = (
    "log_words", "word_length", "symbols_per_word", "upper_share", "letter_share", "digit_share", "mark_share",
    "exclaim_per_word", "dup_line_share", "repeat_share", "distinct_share", "same_next_share", "top_word_share",
    "words_per_line", "ended_line_share",
)


def _bytes(characters: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(characters.encode())] = True
    return table


_SYMBOLS, _ENDS = _bytes("#*$%&|<>"), _bytes(".!?")
_UPPER = _bytes("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_DIGITS = _bytes("0123456789")
_LETTERS = _UPPER | _bytes("abcdefghijklmnopqrstuvwxyz")
_LETTERS[0xC0:] = True  # the first byte of a character beyond ASCII
_MARKS = np.zeros(256, bool)
_MARKS[0x21:0x7F] = True
_MARKS &= ~(_LETTERS | _DIGITS)


def _within(doc: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The hashes made different for each text of the block."""
    return mix(hashes + mix(doc.astype(np.uint64) + np.uint64(1)))


def measure(texts: pa.Array) -> dict[str, np.ndarray]:
    words = Words(texts)
    n, data = len(texts), words.data

    def count(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return np.diff(sums[words.offsets])

    def of_words(flags: np.ndarray) -> np.ndarray:
        return np.bincount(words.doc[flags], minlength=n)

    hashes = words.hashes()
    own = _within(words.doc, hashes)
    _, first, times = np.unique(own, return_index=True, return_counts=True)
    distinct = np.bincount(words.doc[first], minlength=n)
    most = np.zeros(n, np.int64)
    np.maximum.at(most, words.doc[first], times)
    same = np.zeros(len(own), bool)
    same[1:] = own[1:] == own[:-1]

    triples, at = shingles(words, hashes, 3)
    _, inverse, times = np.unique(_within(words.doc[at], triples), return_inverse=True, return_counts=True)
    found = at[times[inverse] > 1] if len(at) else at
    repeated = np.zeros(len(own), bool)
    for j in range(3):
        repeated[found + j] = True

    # Lines end at a newline or with their text; those without a word do not count.
    cuts = np.union1d(np.flatnonzero(data == 0x0A), words.offsets[1:])
    line = np.searchsorted(cuts, words.starts, "right")  # a cut at a word is the end of the text before
    line_first = np.flatnonzero(np.diff(line, prepend=-1))
    line_of, line_doc = line[line_first], words.doc[line_first]
    ends = cuts[line_of]
    before = cuts[np.maximum(line_of - 1, 0)]
    starts = np.where(line_of > 0, before + ((before < len(data)) & (data[np.minimum(before, len(data) - 1)] == 0x0A)), 0)
    line_hash = span_hashes(data, starts, ends)
    lines = np.bincount(line_doc, minlength=n)
    line_firsts = np.unique(_within(line_doc, line_hash), return_index=True)[1]
    dup_lines = lines - np.bincount(line_doc[line_firsts], minlength=n)
    ended = np.bincount(line_doc[_ENDS[data[words.ends[np.append(line_first[1:], len(own))[: len(line_first)] - 1] - 1]]], minlength=n)

    in_words = (data & 0xC0) != 0x80
    in_words &= ~((data == 0x20) | ((data >= 0x09) & (data <= 0x0D)))
    word_chars = count(in_words)
    upper = _UPPER[data]
    if len(data) > 1:  # capitals of the Latin-1 block
        upper[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
    letters, n_words = count(_LETTERS[data]), words.counts
    symbols, repeat = count(_SYMBOLS[data]), of_words(repeated)

    def share(part, whole):
        return part / np.maximum(whole, 1)

    return {
        "n_words": n_words, "word_chars": word_chars, "n_symbols": symbols, "n_dup_lines": dup_lines,
        "n_repeat_words": repeat,
        "log_words": np.log1p(n_words), "word_length": share(word_chars, n_words),
        "symbols_per_word": share(symbols, n_words), "upper_share": share(count(upper), letters),
        "letter_share": share(letters, word_chars), "digit_share": share(count(_DIGITS[data]), word_chars),
        "mark_share": share(count(_MARKS[data]), word_chars), "exclaim_per_word": share(count(data == 0x21), n_words),
        "dup_line_share": share(dup_lines, lines), "repeat_share": share(repeat, n_words),
        "distinct_share": share(distinct, n_words), "same_next_share": share(of_words(same), n_words),
        "top_word_share": share(most, n_words), "words_per_line": share(n_words, lines),
        "ended_line_share": share(ended, lines),
    }


def document_statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", more: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, the columns ``more``, ``COUNTS`` and ``RATIOS`` for each row."""

    def run(batches):
        for block in blocks(batches, "text", 1 << 18):
            found = measure(block.column("text"))
            counts = [pa.array(found[name].astype(np.int64)) for name in COUNTS]
            taken = (block.column(name) for name in ("doc_id", *more))
            yield batch(schema, *taken, *counts, *(pa.array(found[name].astype(float)) for name in RATIOS))

    schema = fields(
        doc_id=docs.schema[doc_id].dataType, **{name: docs.schema[name].dataType for name in more},
        **dict.fromkeys(COUNTS, T.LongType()), **dict.fromkeys(RATIOS, T.DoubleType())
    )
    return map_arrow(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), *more), run, schema)


def labelled_sample(statistics: DataFrame, labels: DataFrame, label: str, bound: int, held_out: bool) -> np.ndarray:
    """About ``bound`` labelled documents as an array: a fold by id, the label, then ``RATIOS``.

    Labels other than 0 and 1 are left out, as are ids labelled both ways. With ``held_out``,
    so are rows whose ``crc32(doc_id as text) mod 5`` is 0. Ids are chosen by their hash. An
    id gives one row however many documents or labels share it: the least by its ratios.
    """
    given = labels.select("doc_id", F.col(label).cast("int").alias("label")).where(F.col("label").isin(0, 1))
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    if held_out:
        given = given.where(fold % 5 != 0)
    given = given.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("most")).where("label = most")
    share = min(1.0, bound / max(given.count(), 1))
    chosen = given.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30))).drop("most")
    rows = chosen.join(statistics.select("doc_id", *RATIOS), "doc_id")
    # The minimum is taken before the shuffle, so that an id on many rows meets as one per task.
    rows = rows.groupBy("doc_id", "label").agg(F.min(F.struct(*RATIOS)).alias("least"))
    columns = rows.select((fold % 3).alias("fold"), "label", "least.*").toArrow()
    found = np.array([columns.column(i).to_numpy() for i in range(columns.num_columns)], float).T
    return found.reshape(-1, 2 + len(RATIOS))[np.lexsort(found.T) if len(found) else slice(0)]
