"""Language identification: n-grams in bit-sliced Bloom filters.

Each learned language has a set of frequent character n-grams. All sets share one
filter: a slot holds a bit for each language, so the AND of an n-gram's slots names all
languages that contain it. A text's n-grams are counted per language, the counts are
corrected for the filter's false positives, and the largest decides.

A text that is null or without letters is ``und`` with score 0. Ties go to the first
language by name. With no learned language every text is ``und``. Repeated rows are
judged alike, columns but the id and the text are not read, an empty table gives an
empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardstream.llm.arrow import batch, fields, map_arrow
from shardstream.llm.words import blocks, mix

#: Learned from about so many documents of each language.
SAMPLE_DOCUMENTS = 4_000
#: Lengths of n-grams in characters, and the least share of a language's n-grams of that
#: length that one has in its filter: at most ``1 / LEAST_SHARE`` per language and length.
LENGTHS, LEAST_SHARE = (2, 3, 4), 2e-4
#: Slots of the filter for each n-gram in it, and slots that an n-gram sets.
SLOTS_PER_NGRAM, HASHES = 24, 3

_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters


def ngrams(texts: list[str]) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Hash and text number of each n-gram, by length; and whether a text has letters.

    Lower-case letters count, runs of anything else are one space, also before and behind
    a text. N-grams lie in one text and have a letter.
    """
    texts = [text.lower() + " " for text in texts]
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    letter, end = _letter_table()[points], np.zeros(len(points), bool)
    end[np.cumsum([len(text) for text in texts]) - 1] = True
    keep = letter | end
    keep[1:] |= letter[:-1]  # the first of a run of others
    points, letter, end = np.where(letter, points, 32)[keep], letter[keep], end[keep]
    doc = np.cumsum(end) - end
    has = np.bincount(doc[letter], minlength=len(texts)) > 0
    # A text begins with the space that ends the one before it.
    code, out = mix(points.astype(np.uint64) + np.uint64(7)), []
    for n in LENGTHS:
        if len(code) < n:
            out.append((np.zeros(0, np.uint64), np.zeros(0, np.int64)))
            continue
        m = len(code) - n + 1
        total, letters = np.full(m, n, np.uint64), np.zeros(m, bool)
        for j in range(n):
            total = total * np.uint64(0x9E3779B97F4A7C15) + code[j : m + j]
            letters |= letter[j : m + j]
        own = (doc[:m] == doc[n - 1 :]) | (end[:m] & (doc[:m] + 1 == doc[n - 1 :]))
        at = np.flatnonzero(letters & own)
        out.append((mix(total[at]), doc[at + n - 1]))
    return out, has


@dataclass
class Filter:
    """``slots[i]`` holds the languages of slot ``i`` as bits, in as many words as needed."""

    languages: list[str]
    slots: np.ndarray
    false_positive: np.ndarray

    def masks(self, hashes: np.ndarray) -> np.ndarray:
        return np.bitwise_and.reduce([self.slots[p] for p in _places(hashes, len(self.slots))])

    def decide(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        n, names = len(texts), len(self.languages)
        if not names:
            return ["und"] * n, np.zeros(n)
        grams, has = ngrams(texts)
        hits, total = np.zeros((n, names)), np.zeros(n)
        for hashes, doc in grams:
            masks = self.masks(hashes)
            total += np.bincount(doc, minlength=n)
            for i in range(names):
                bit = (masks[:, i // 8] >> np.uint8(i % 8)) & np.uint8(1)
                hits[:, i] += np.bincount(doc[bit.view(bool)], minlength=n)
        corrected = np.maximum(hits - total[:, None] * self.false_positive, 0) / (1 - self.false_positive)
        # What the best has more than the others counts: all share the commonest n-grams.
        share = corrected / np.maximum(total, 1)[:, None]
        odds = np.exp(20 * (share - share.max(1, keepdims=True)))
        best, scores = share.argmax(1), odds.max(1) / odds.sum(1)
        return [self.languages[i] if h else "und" for i, h in zip(best, has, strict=True)], np.where(has, scores, 0.0)


def _places(hashes: np.ndarray, slots: int) -> list[np.ndarray]:
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    return [((hashes + np.uint64(i) * step) % np.uint64(slots)).astype(np.int64) for i in range(HASHES)]


def build(sets: dict[str, np.ndarray]) -> Filter:
    """The filter of each language's n-gram hashes."""
    languages = sorted(sets)
    size = SLOTS_PER_NGRAM * max([1, *(len(x) for x in sets.values())])
    slots = np.zeros((size, (len(languages) + 7) // 8), np.uint8)
    for i, language in enumerate(languages):
        for places in _places(sets[language], size):
            slots[np.unique(places), i // 8] |= np.uint8(1 << (i % 8))
    bits = np.unpackbits(slots, axis=1, bitorder="little")[:, : len(languages)]
    return Filter(languages, slots, bits.mean(0) ** HASHES)


def learn(docs: DataFrame, sample_documents: int = SAMPLE_DOCUMENTS) -> Filter:
    """Learn the n-gram sets from ``text`` and ``lang`` of rows that are not held out.

    Whole texts of about ``sample_documents`` rows per language, chosen by a hash of the
    id, are counted by Spark; only the sets reach the driver, each bounded by
    ``LEAST_SHARE``.
    """
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    known = docs.select("doc_id", F.col("lang").alias("lang"), "text").where(F.col("lang").isNotNull() & (fold != 0))
    sizes = {row.lang: row.n for row in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return build({})
    share = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, sample_documents / n))])
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    sample = known.where(draw < share[F.col("lang")]).select("lang", "text")

    def count(batches):
        for block in blocks(batches, "text", 1 << 18):
            lang = block.column("lang").dictionary_encode()
            number = lang.indices.to_numpy()
            names = lang.dictionary.to_pylist()
            texts = block.column("text").fill_null("").to_pylist()
            for length, (hashes, doc) in zip(LENGTHS, ngrams(texts)[0], strict=True):
                for i, name in enumerate(names):
                    found, times = np.unique(hashes[number[doc] == i], return_counts=True)
                    yield batch(
                        schema, pa.array([name] * len(found), pa.string()), pa.array(np.full(len(found), length, np.int32)),
                        found.view(np.int64), times,
                    )

    schema = fields(lang=T.StringType(), length=T.IntegerType(), ngram=T.LongType(), n=T.LongType())
    counts = map_arrow(sample, count, schema).groupBy("lang", "length", "ngram").agg(F.sum("n").alias("n"))
    counts.persist()
    totals = {(r.lang, r.length): r.n for r in counts.groupBy("lang", "length").agg(F.sum("n").alias("n")).collect()}
    if not totals:
        counts.unpersist()
        return build({name: np.zeros(0, np.uint64) for name in sizes})
    least = F.create_map(*[F.lit(x) for (a, b), n in totals.items() for x in (f"{b} {a}", n * LEAST_SHARE)])
    frequent = counts.where(F.col("n") >= least[F.concat_ws(" ", "length", "lang")]).select("lang", "ngram")
    sets: dict[str, list[int]] = {name: [] for name in sizes}
    for row in frequent.collect():
        sets[row.lang].append(row.ngram)
    counts.unpersist()
    return build({name: np.array(sorted(found), np.int64).view(np.uint64) for name, found in sets.items()})


def predict(docs: DataFrame, model: Filter, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` of every whole text."""

    def run(batches):
        for block in blocks(batches, "text", 1 << 18):
            texts = block.column("text").fill_null("").to_pylist()
            names, scores = model.decide(texts)
            yield batch(schema, block.column("doc_id"), pa.array(names, pa.string()), scores)

    schema = fields(doc_id=docs.schema[doc_id].dataType, lang_pred=T.StringType(), score=T.DoubleType())
    rows = map_arrow(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), run, schema)
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return rows.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the documents' languages and predict all of them."""
    return predict(docs, learn(docs))
