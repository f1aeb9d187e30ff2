"""Phrases whose words belong together, mined from stripes.

A stripe is what follows a prefix of one to four words: an associative counter of next
words, and of how often none that matters follows. Tasks count stripes over whole texts and
combine them before the shuffle; stripes of a prefix are then merged element by element.
One merged stripe gives the prefix's extensions (its phrases of one more word), its total
(the frequency of the prefix itself, which scores are made of) and its maximum (whether an
extension is as frequent as the prefix and so subsumes it).

Levels go by length. A phrase cannot be more frequent than its parts, so a level counts only
where the prefix and the words behind its first one were found frequent before. Tasks ask
that of a filter of bits, of a fixed greatest size: it may let rare phrases pass, which
costs time and is put right by the counts, but never holds back a frequent one. Prefixes
with at least a thousandth of all words (at most a thousand there are) have their stripes
split by next word, so none is merged in one task however much text it has.

Words and phrases go by 64-bit hashes that include the language. Two words of one hash
are noticed when words are counted, and all is hashed anew.

Null and empty texts have no words. A null language is ``und``. Repeated rows count as often
as they are there. Only text and language are read, whatever other columns there are; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardstream.llm.arrow import batch, fields, map_arrow
from shardstream.llm.words import blocks, mix, span_hashes
from shardstream.shared import pin

MOST_WORDS = 5
#: The most bits of a level's filter; with more phrases than a sixteenth of it more rare ones pass.
FILTER_BITS = 1 << 26
#: Prefixes with this share of all words are split, by next word, into so many parts.
HOT_SHARE, HOT_PARTS = 1000, 64
#: Entries that a task combines before it passes on what it has.
ENTRIES_AT_ONCE = 1_500_000

_FACTOR = np.uint64(0xD6E8FEB86659FD93)
_NO_NEXT = np.uint64(0)
_BREAK, _SPLIT = np.zeros(256, bool), np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True  # between pieces
_SPLIT[[0x20, 0x09]] = True  # between the words of one
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def _key_of(text: str, seed: int) -> int:
    return int.from_bytes(hashlib.blake2b(f"{seed}:{text}".encode(), digest_size=8).digest(), "little")


def extended(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The key of a phrase and one more word."""
    return mix(prefix * _FACTOR + word)


class Pieces:
    """The words of a block of texts: ``keys``, and ``joined``, whether the next word is in the same piece."""

    def __init__(self, block: pa.RecordBatch, seed: int):
        texts = pc.fill_null(block.column("text").cast(pa.large_string()), "")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        begin, end = int(offsets[0]), int(offsets[-1])
        data = np.frombuffer(texts.buffers()[2], np.uint8)[begin:end] if end > begin else np.zeros(0, np.uint8)
        self.data = data = _LOWER[data]
        bounds = offsets[:-1] - begin
        bounds = bounds[bounds < len(data)]
        in_word = ~(_BREAK[data] | _SPLIT[data])
        edge = np.diff(in_word.astype(np.int8), prepend=0)
        starts = edge == 1
        starts[bounds] |= in_word[bounds]
        self.starts = np.flatnonzero(starts)
        stops = np.append(edge[1:] == -1, True) if len(data) else np.zeros(0, bool)
        stops[bounds[bounds > 0] - 1] = True
        self.ends = np.flatnonzero(stops & in_word) + 1
        breaks = _BREAK[data].astype(np.int32)
        breaks[bounds] += 1  # where texts begin; a break that begins one counts twice, which is no matter
        piece = np.cumsum(breaks)[self.starts]
        self.joined = np.append(piece[1:] == piece[:-1], False) if len(piece) else np.zeros(0, bool)
        self.langs = pc.fill_null(block.column("lang"), "und").dictionary_encode()
        text = np.searchsorted(offsets[1:] - begin, self.starts, "right")
        self.lang = self.langs.indices.to_numpy()[text]
        self.lang_keys = np.array([_key_of(name, seed) for name in self.langs.dictionary.to_pylist()], np.uint64)
        hashes = span_hashes(data, self.starts, self.ends) + np.uint64(seed)
        self.keys = mix(hashes * _FACTOR + self.lang_keys[self.lang]) if len(hashes) else hashes

    def phrases(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The key of the ``n`` words from each word on, and whether they are in one piece."""
        count = max(len(self.keys) - n + 1, 0)
        keys, whole = self.keys[:count], np.ones(count, bool)
        for j in range(1, n):
            keys = extended(keys, self.keys[j : count + j])
            whole &= self.joined[j - 1 : count + j - 1]
        return keys, whole


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where runs of equal rows begin."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def _combine(prefix: np.ndarray, word: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums by prefix and next word."""
    if not len(prefix):
        return prefix, word, count
    order = np.lexsort((word, prefix))
    prefix, word = prefix[order], word[order]
    at = _runs(prefix, word)
    return prefix[at], word[at], np.add.reduceat(count[order], at)


def _signed(keys: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(keys).view(np.int64)


def _strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    lengths = ends - starts
    offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
    at = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], lengths)
    return pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[at])))


def frequent_words(texts: DataFrame, least: int) -> tuple[DataFrame, DataFrame, int]:
    """``key``, ``lang``, ``word`` and ``f`` of frequent words; ``lang`` and ``n`` of all; the seed of the keys."""
    schema = fields(key=T.LongType(), lang=T.StringType(), word=T.StringType(), f=T.LongType())
    seed = 0
    while True:

        def run(batches, seed=seed):
            for block in blocks(batches, "text"):
                pieces = Pieces(block, seed)
                keys, first, times = np.unique(pieces.keys, return_index=True, return_counts=True)
                langs = pieces.langs.dictionary.take(pa.array(pieces.lang[first]))
                words = _strings(pieces.data, pieces.starts[first], pieces.ends[first])
                yield batch(schema, pa.array(_signed(keys)), langs, words, pa.array(times.astype(np.int64)))
                # A language's row of all words has no word.
                n = np.bincount(pieces.lang, minlength=len(pieces.lang_keys))
                yield batch(schema, pa.array(_signed(pieces.lang_keys)), pieces.langs.dictionary, pa.array([""] * len(n)), pa.array(n.astype(np.int64)))

        name = F.struct("lang", "word")
        words = map_arrow(texts, run, schema).groupBy("key").agg(
            F.sum("f").alias("f"), F.min(name).alias("name"), F.max(name).alias("other")
        )
        is_all = F.col("name.word") == ""
        words = pin(words.where(is_all | (F.col("f") >= least)), "words")
        if words.where("name <> other").isEmpty():
            words = words.select("key", "name.lang", "name.word", "f")
            return words.where("word <> ''"), words.where("word = ''").select("lang", F.col("f").alias("n")), seed
        seed += 1


def phrase_filter(keys: DataFrame) -> np.ndarray:
    """Bits by the keys' last digits, in bytes; at most ``FILTER_BITS``, so sent to the driver and on."""
    bits = 1 << 16
    count = keys.count()
    while bits < min(16 * count, FILTER_BITS):
        bits *= 2
    places = keys.select(F.col("key").bitwiseAND(F.lit(bits - 1)).alias("place"))
    rows = places.groupBy(F.shiftright("place", 5).alias("at")).agg(F.expr("bit_or(shiftleft(1L, cast(place & 31 as int)))").alias("bits"))
    found = rows.toArrow()
    out = np.zeros(bits // 32, "<u4")
    out[found.column("at").to_numpy()] = found.column("bits").to_numpy().astype(np.uint32)
    return out.view(np.uint8)


def _passes(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    place = keys & np.uint64(8 * len(bits) - 1)
    return (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def count_stripes(texts: DataFrame, length: int, seed: int, bits: np.ndarray, hot: np.ndarray, least: int) -> DataFrame:
    """Stripes of the prefixes of ``length - 1`` words that pass the filter, merged.

    Gives ``prefix``, ``total``, ``most`` and the ``words`` and ``counts`` of next words
    with at least ``least`` occurrences; a hot prefix has several rows.
    """
    sent = texts.sparkSession.sparkContext.broadcast((bits, hot))
    stripe = fields(prefix=T.LongType(), part=T.IntegerType(), words=T.BinaryType(), counts=T.BinaryType())
    longs = T.ArrayType(T.LongType())
    merged = fields(prefix=T.LongType(), total=T.LongType(), most=T.LongType(), words=longs, counts=longs)

    def stripes(prefix: np.ndarray, word: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
        part = np.where(np.isin(prefix, sent.value[1]), (word % np.uint64(HOT_PARTS)).astype(np.int32), np.int32(0))
        order = np.lexsort((part, prefix))
        prefix, part, word, count = prefix[order], part[order], word[order], count[order]
        at = _runs(prefix, part)
        ends = np.append(at, len(prefix))

        def packed(values: np.ndarray) -> pa.Array:
            offsets = (ends * values.itemsize).astype(np.int32)
            return pa.BinaryArray.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])

        return batch(stripe, pa.array(_signed(prefix[at])), pa.array(part[at]), packed(word), packed(count.astype(np.int64)))

    def count(batches: Iterator[pa.RecordBatch]):
        bits = sent.value[0]
        held: list[tuple[np.ndarray, ...]] = []

        def combined() -> tuple[np.ndarray, ...]:
            return _combine(*map(np.concatenate, zip(*held, strict=True)))

        for block in blocks(batches, "text"):
            pieces = Pieces(block, seed)
            prefix, whole = pieces.phrases(length - 1)
            frequent = whole & _passes(bits, prefix)
            at = np.flatnonzero(frequent)
            # The next word counts where the words behind the first one are frequent, too.
            follows = at + 1 < len(prefix)
            follows[follows] = frequent[at[follows] + 1] & pieces.joined[at[follows] + length - 2]
            word = np.full(len(at), _NO_NEXT)
            word[follows] = pieces.keys[at[follows] + length - 1]
            held.append(_combine(prefix[at], word, np.ones(len(at), np.int64)))
            if sum(len(entries[0]) for entries in held) > ENTRIES_AT_ONCE:
                held = [combined()]
                if 2 * len(held[0][0]) > ENTRIES_AT_ONCE:
                    yield stripes(*held.pop())
        if held:
            yield stripes(*combined())

    def merge(batches: Iterator[pa.RecordBatch]):
        hot = sent.value[1]
        empty = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        held = empty

        def rows(prefix: np.ndarray, word: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
            at = _runs(prefix)
            total = np.add.reduceat(count, at)
            real = np.where(word == _NO_NEXT, 0, count)
            most = np.maximum.reduceat(real, at)
            keep = real >= least
            kept = np.add.reduceat(keep.astype(np.int64), at)
            chosen = (total >= least) | np.isin(prefix[at], hot)
            keep &= np.repeat(chosen, np.diff(np.append(at, len(prefix))))
            offsets = pa.array(np.concatenate(([0], np.cumsum(kept[chosen]))).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(values[keep])) for values in (_signed(word), count)]
            return batch(merged, pa.array(_signed(prefix[at][chosen])), pa.array(total[chosen]), pa.array(most[chosen]), *lists)

        for given in batches:
            if not given.num_rows:
                continue
            sizes = pc.binary_length(given.column("words")).to_numpy(zero_copy_only=False) // 8
            prefix = np.repeat(given.column("prefix").to_numpy().view(np.uint64), sizes)
            word = np.frombuffer(b"".join(given.column("words").to_pylist()), np.uint64)
            counts = np.frombuffer(b"".join(given.column("counts").to_pylist()), np.int64)
            held = _combine(*map(np.concatenate, zip(held, (prefix, word, counts), strict=True)))
            last = held[0] == prefix[-1]  # its stripe may go on in the next batch
            if not last.all():
                yield rows(*(column[~last] for column in held))
                held = tuple(column[last] for column in held)
        if len(held[0]):
            yield rows(*held)

    # Rows of one prefix and part are sorted together; those of a hot prefix are other tasks', part by part.
    dealt = map_arrow(texts, count, stripe).repartition("prefix", "part").sortWithinPartitions("prefix", "part")
    return map_arrow(dealt, merge, merged)


def _with_parts(phrases: DataFrame, length: int) -> DataFrame:
    """Add ``key``, and the keys of both sides of each cut: ``lefts`` and ``rights``."""
    longs = T.ArrayType(T.LongType())
    schema = T.StructType([*phrases.schema.fields, *fields(key=T.LongType(), lefts=longs, rights=longs)])

    def run(batches):
        for rows in batches:
            words = rows.column("words").flatten().to_numpy().view(np.uint64).reshape(-1, length)

            def key(a: int, b: int, words: np.ndarray = words) -> np.ndarray:
                out = words[:, a]
                for j in range(a + 1, b):
                    out = extended(out, words[:, j])
                return _signed(out)

            offsets = pa.array(np.arange(rows.num_rows + 1, dtype=np.int32) * (length - 1))
            lefts = np.stack([key(0, j) for j in range(1, length)], 1).ravel()
            rights = np.stack([key(j, length) for j in range(1, length)], 1).ravel()
            sides = [pa.ListArray.from_arrays(offsets, pa.array(side)) for side in (lefts, rights)]
            yield batch(schema, *rows.columns, pa.array(key(0, length)), *sides)

    return map_arrow(phrases, run, schema)


def collocations(docs: DataFrame, least: int = 100, top: int = 2000, text: str = "text", lang: str = "lang") -> DataFrame:
    """The ``top`` phrases of two to five words of each language, by their weakest cut.

    A phrase has ``a >= least`` occurrences. Cut in two, it scores ``floor(1000 * a * n / (l
    * r))`` by the frequencies of both sides and the number of all words; its lowest cut
    counts. Phrases that lie in a longer one as frequent are left out. Gives ``lang``,
    ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n`` and ``score``.
    """
    texts = docs.select(F.col(text).alias("text"), F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"))
    words, sizes, seed = frequent_words(texts, least)
    total = sizes.agg(F.sum("n")).first()[0] or 0
    level = words.select("key", "lang", F.col("word").alias("phrase"), F.array("key").alias("words"), F.col("f").alias("a"))
    next_word = words.select(F.col("key").alias("next"), "word")
    found, totals, longer = [], [], []
    for length in range(2, MOST_WORDS + 1):
        if level.isEmpty():
            break
        # At most HOT_SHARE prefixes have that share.
        hot = level.where(F.col("a") * HOT_SHARE >= total).select("key").toArrow().column("key").to_numpy().view(np.uint64)
        stripes = pin(count_stripes(texts, length, seed, phrase_filter(level.select("key")), hot, least), "stripes")
        known = level.select("key", "lang", "phrase", F.col("words").alias("before"))
        prefixes = stripes.groupBy("prefix").agg(F.sum("total").alias("total"), F.max("most").alias("most"))
        prefixes = pin(prefixes.join(level.select(F.col("key").alias("prefix")), "prefix"), "prefixes")
        totals.append(prefixes.select(F.col("prefix").alias("key"), F.col("total").alias("f")))
        longer.append(prefixes.select(F.col("prefix").alias("key"), "most"))
        phrases = (
            stripes.select("prefix", F.explode(F.arrays_zip("words", "counts")).alias("e"))
            .select(F.col("prefix").alias("key"), F.col("e.words").alias("next"), F.col("e.counts").alias("a"))
            .join(known, "key").join(next_word, "next")
            .select("lang", F.concat_ws(" ", "phrase", "word").alias("phrase"), F.concat("before", F.array("next")).alias("words"), "a")
        )
        level = pin(_with_parts(phrases, length), "phrases")
        longer.append(level.select(level["rights"][0].alias("key"), F.col("a").alias("most")))
        found.append(level)

    names = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    if not found:
        kinds = ["string", "int", "string", *["long"] * 5]
        return docs.sparkSession.createDataFrame([], ", ".join(f"{a} {b}" for a, b in zip(names, kinds, strict=True)))
    phrases, frequency, most = (_all(tables) for tables in (found, totals, longer))
    # A phrase as frequent as one that holds it is as frequent as one with a single word more.
    most = most.groupBy("key").agg(F.max("most").alias("most"))
    kept = phrases.join(most, "key", "left").where("most IS NULL OR 100 * most < 100 * a")
    cuts = kept.select("key", "lang", "phrase", "a", F.posexplode(F.arrays_zip("lefts", "rights")).alias("cut", "sides"))
    left, right = (frequency.select(F.col("key").alias(side), F.col("f").alias(name)) for side, name in (("left", "l"), ("right", "r")))
    cuts = cuts.select("key", "lang", "phrase", "a", "cut", F.col("sides.lefts").alias("left"), F.col("sides.rights").alias("right"))
    cuts = cuts.join(left, "left").join(right, "right").join(sizes, "lang")
    wide = "cast({} as decimal(38, 0))"
    score = F.expr(f"({wide.format('a')} * n * 1000) div ({wide.format('l')} * r)")
    lowest = (
        cuts.withColumn("score", score)
        .groupBy("key", "lang", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("lowest"))
        .select("lang", "phrase", "a", "lowest.l", "lowest.r", "n", "lowest.score")
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = lowest.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.withColumn("rank", F.col("rank").cast("bigint")).select(names)


def _all(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table)
    return out
