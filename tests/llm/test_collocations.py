"""Phrases against counting them all in Python."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from shardstream.llm import collocations

COLUMNS = "text string, lang string"
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(_LOWER)):
        yield re.findall(r"[^\x20\x09]+", piece)


def plain(rows, least, top):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            n[lang] += len(words)
            for k in range(1, 6):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        inside = Counter()
        for p, a in candidates.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i : i + k]] = max(inside[p[i : i + k]], a)
        found = []
        for p, a in candidates.items():
            if 100 * inside[p] >= 100 * a:
                continue
            score, _, left, right = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def given(rng):
    odd = ["the", "The", "é", "É", "日本", "x", "un real", "a\x0bb", "#", "\x1f"]
    marks = [" ", " ", "  ", "\t", ", ", ". ", "\n", "; ", "!", " - "]
    rows = []
    for _ in range(150):
        words = rng.choices(odd + ["of", "in", "new", "york"], [9, 3, 2, 1, 2, 3, 1, 1, 1, 1, 6, 5, 2, 2], k=rng.randint(0, 60))
        rows.append(("".join(w + rng.choice(marks) for w in words), rng.choice(["en", "en", "de", None])))
    rows += [("salt and pepper on top of it. " * 30, "en"), ("a a a a a a a a a a", "de"), (None, "en"), ("", None), (" .\n", "fr"), ("...", None)]
    return rows + [("same text as ever", "und")] * 12


def found(spark, rows, least, top):
    table = spark.createDataFrame(rows, COLUMNS).withColumns({c: F.lit("clash") for c in ("key", "word", "n", "words", "a.b")})
    return sorted(map(tuple, collocations.collocations(table.repartition(3), least, top).collect()))


def test_phrases_agree_with_counting_all(spark):
    rows = given(random.Random(7))
    assert found(spark, rows, 5, 2000) == plain(rows, 5, 2000)


def test_hot_prefixes_and_a_short_list(spark, monkeypatch):
    monkeypatch.setattr(collocations, "HOT_SHARE", 10**6)  # every prefix is split
    monkeypatch.setattr(collocations, "FILTER_BITS", 1 << 16)
    rows = given(random.Random(8))
    assert found(spark, rows, 3, 7) == plain(rows, 3, 7)


def test_nothing_to_find(spark):
    assert found(spark, [("one two three", "en"), (None, None)], 2, 10) == []
    assert collocations.collocations(spark.createDataFrame([], COLUMNS)).count() == 0


def test_words_and_pieces_of_odd_texts():
    rng = random.Random(9)
    texts = ["".join(rng.choices("aB é.\n\t,日!\x0b", k=rng.randint(0, 30))) for _ in range(200)] + [None, "", ".", "a", ".a", "a."]
    block = pa.record_batch({"text": pa.array(texts), "lang": pa.array(["x"] * len(texts))}).slice(3)
    found = collocations.Pieces(block, 0)
    words = [bytes(found.data[a:b]).decode() for a, b in zip(found.starts, found.ends, strict=True)]
    want = [piece for text in texts[3:] for piece in pieces(text)]
    assert words == [word for piece in want for word in piece]
    assert found.joined.tolist() == [i + 1 < len(piece) for piece in want for i in range(len(piece))]
    keys, whole = found.phrases(3)
    assert whole.sum() == sum(max(len(piece) - 2, 0) for piece in want)
    assert len(np.unique(keys[whole])) == len({tuple(piece[i : i + 3]) for piece in want for i in range(len(piece) - 2)})
