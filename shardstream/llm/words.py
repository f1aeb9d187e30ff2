"""Words of whole texts as flat numpy arrays.

A word is a match of ``[^\\x20\\x09-\\x0D]+``: those separators are single bytes in
UTF-8, so words are found and hashed on the bytes of an Arrow column, without a Python
object per word. Hashes are keyed 64-bit polynomials over the bytes with a final mix.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; one longer text is handled alone and whole.
BLOCK_BYTES = 1 << 21

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_KEYS = np.random.Generator(np.random.PCG64(20240817)).integers(1, 2**64, 512, dtype=np.uint64)
_BYTE, _ODD = _KEYS[:256], _KEYS[256:] | np.uint64(1)
_powers = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo 2**64."""
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def _byte_powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        _powers = powers(int(_ODD[0]), 1 << int(n - 1).bit_length())
    return _powers


def blocks(batches: Iterator[pa.RecordBatch], column: str, size: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of all batches in slices of about ``size`` bytes of text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        block = np.cumsum(sizes, dtype=np.int64) // size
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(a, b - a)


class Words:
    """The words of a column of texts: ``starts``, ``ends``, ``doc`` and a hash for each.

    ``first[d]`` is the index of the first word of text ``d``, ``first[d + 1]`` one
    past its last. A null text has no words.
    """

    def __init__(self, texts: pa.Array):
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        buffer = texts.buffers()[2]
        base = int(offsets[0]) if len(offsets) else 0
        end = int(offsets[-1]) if len(offsets) else 0
        data = np.frombuffer(buffer, np.uint8)[base:end] if end > base else np.zeros(0, np.uint8)
        self.data, self.offsets = data, offsets - base
        text = ~_SPACE[data]
        before = np.zeros(len(data), bool)
        before[1:] = text[:-1]
        bounds = self.offsets[:-1][self.offsets[:-1] < len(data)]
        before[bounds] = False
        self.starts = np.flatnonzero(text & ~before)
        after = np.zeros(len(data), bool)
        after[:-1] = text[1:]
        ends = self.offsets[1:]
        after[ends[ends > 0] - 1] = False
        self.ends = np.flatnonzero(text & ~after) + 1
        self.first = np.searchsorted(self.starts, self.offsets)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.first))

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each non-empty, non-overlapping span of bytes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    inside = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    at = inside + np.arange(len(inside))
    place = at - np.repeat(starts, lengths)
    values = _BYTE[data[at]] * _byte_powers(int(lengths.max()))[place]
    sums = np.add.reduceat(values, np.concatenate(([0], np.cumsum(lengths)[:-1])))
    return mix(sums + lengths.astype(np.uint64) * _ODD[1])


def shingles(words: Words, hashes: np.ndarray, k: int, seed: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """The hash and the start (a word index) of each run of ``k`` words within one text."""
    n = len(hashes)
    if n < k:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(n - k + 1, np.uint64)
    for j in range(k):
        total = total * _ODD[seed] + hashes[j : n - k + 1 + j]
    at = np.flatnonzero(words.doc[: n - k + 1] == words.doc[k - 1 :])
    return mix(total[at] + _ODD[seed + 1]), at
