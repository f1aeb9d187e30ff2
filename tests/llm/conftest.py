from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
LABELS = "doc_id long, quality int, toxic int"

SYLLABLES = {"en": ["the", "er", "on", "an", "nd", "ing"], "de": ["ach", "ein", "ung", "sch", "ö", "ge"], "fr": ["eau", "é", "ou", "tion", "ch", "ç"]}


def prose(rng, words, lang="en"):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) for _ in range(words))


@pytest.fixture(scope="session")
def texts():
    """Texts with copies, near copies, shared passages, junk, personal data, and odd ones."""
    rng = random.Random(5)
    found = [(prose(rng, rng.randint(60, 200), lang), lang) for lang in SYLLABLES for _ in range(15)]
    base = prose(rng, 150).split()
    for i in range(6):
        changed = list(base)
        changed[20 * i] = "changed"
        found.append((" ".join(changed), "en"))
    found += [(found[0][0], "en")] * 3
    passage = prose(rng, 50)
    found += [(f"{prose(rng, 60)}\n{passage} {prose(rng, 60)}", "en") for _ in range(3)]
    found += [(" ".join(f"{w}###" for w in prose(rng, 80).split()), "en") for _ in range(12)]
    found += [("a b " * 300, "en"), (prose(rng, 6000, "de"), "de"), ("x" * 3000, None), ("one two", "en"), ("one two", "en")]
    found += [("", None), ("   \n\t ", None), (None, "en"), (None, None), ("12 34 !?", "en")]
    found += [("write to ann.b7@mail3.example.com or +1 (988) 555-2485 from 42.144.35.254", "en")]
    return found


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The texts as documents, with one row repeated, one without id, and columns that clash."""
    rows = [(i, text, lang, "src0", len(text or "")) for i, (text, lang) in enumerate(texts)]
    rows += [rows[3], (None, "no id for this text", "en", None, None)]
    return (
        spark.createDataFrame(rows, DOCUMENTS)
        .withColumns({"key": F.lit("k"), "score": F.lit(1), "id": F.lit(None).cast("int"), "label": F.lit("x")})
        .repartition(3)
    )


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture(scope="session")
def labels(spark, texts):
    rows = [(i, 0 if "###" in (text or "") else 1, 0) for i, (text, _) in enumerate(texts)]
    return spark.createDataFrame([*rows, (1, None, None), (None, 1, 0)], LABELS)
