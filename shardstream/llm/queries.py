"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardstream.llm import bpe, chat, collocations, langid, minhash, mixing, packing, pii, quality, repair, rules, substrings, vectors


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings within their labels."""
    return vectors.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096 tokens."""
    docs = _table(spark, sf_dir, "documents")
    pieces = packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for every document."""
    return quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with surrogates for personal data."""
    replaced = pii.replace_entities(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return replaced.withColumnRenamed("__entities", "n_entities")


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations as transcripts with markers of all forms, one in eight turns without,
    parsed and rendered as chat turns."""
    turns = chat.show(_table(spark, sf_dir, "conversations"))
    return chat.format_chats(chat.transcribe(turns), chat.learn(turns))


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    return langid.identify(_table(spark, sf_dir, "documents"))


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the passages that repeat."""
    cut = substrings.remove_repeats(_table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded by the multilingual byte-level vocabulary, and decoded again."""
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = bpe.encode(_table(spark, sf_dir, "documents"), *vocabulary)
    return bpe.decode(encoded, *vocabulary).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base statistics of every document, and whether the rules keep it."""
    return rules.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document."""
    return minhash.near_duplicates(_table(spark, sf_dir, "documents")).drop("key")


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports on all conversations, damaged and repaired, with a digest of what they became."""
    turns, reports = repair.repair(repair.damage(_table(spark, sf_dir, "conversations")))
    lines = repair.digests(turns).select(F.col("conv_id").alias("of"), F.col("sha256").alias("repaired_sha256"))
    joined = reports.join(lines, reports["conv_id"].eqNullSafe(lines["of"]), "left").drop("of")
    return joined.fillna(hashlib.sha256().hexdigest(), "repaired_sha256")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 phrases of each language of all documents."""
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix of sources by weights 1, 2, 3 takes of each document."""
    return mixing.mix(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_vectors": op1_vectors,
    "op2_packing": op2_packing,
    "op3_quality": op3_quality,
    "op4_pii": op4_pii,
    "op5_chat": op5_chat,
    "op6_langid": op6_langid,
    "op7_substrings": op7_substrings,
    "op8_bpe": op8_bpe,
    "op9_rules": op9_rules,
    "op10_minhash": op10_minhash,
    "op11_repair": op11_repair,
    "op12_collocations": op12_collocations,
    "op13_mixing": op13_mixing,
}

_WORDS = r"length(regexp_replace(regexp_replace(coalesce(text, ''), '[^\x20\x09-\x0D]+', 'w', 'g'), '[\x20\x09-\x0D]', '', 'g'))"

_MIXING = f"""
    WITH RECURSIVE mixed AS (
        SELECT doc_id, source, {_WORDS} AS size,
               md5(concat_ws(':', 'mix', coalesce(doc_id::VARCHAR, ''), coalesce(text, ''))) AS digest
        FROM documents
    ), sources AS (
        SELECT source, sum(size)::BIGINT AS source_size, 3 * sum(size)::HUGEINT AS "limit",
               1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 AS weight
        FROM mixed GROUP BY source
    ), levels AS (
        SELECT 0 AS round, sum(source_size)::HUGEINT AS "left", sum(weight)::HUGEINT AS "by" FROM sources
        UNION ALL
        SELECT round + 1,
               (SELECT sum(source_size) FROM sources) - coalesce(sum("limit") FILTER ("limit" * "by" <= weight * "left"), 0),
               (SELECT sum(weight) FROM sources) - coalesce(sum(weight) FILTER ("limit" * "by" <= weight * "left"), 0)
        FROM levels, sources WHERE round < 30 GROUP BY round
    ), targets AS (
        SELECT sources.*,
               if("by" = 0 OR "limit" * "by" <= weight * "left", "limit"::DOUBLE,
                  (weight * "left")::DOUBLE / "by"::DOUBLE) AS target
        FROM sources, levels WHERE round = 30
    ), expected AS (
        SELECT doc_id, size, source_size, target, digest,
               if(size > 0, target / source_size, 0) AS copies,
               floor(copies)::BIGINT AS whole, copies - whole AS chance,
               (('0x' || substr(digest, 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
        FROM mixed JOIN targets ON mixed.source IS NOT DISTINCT FROM targets.source
    ), ranked AS (
        SELECT *, least(floor(u * (1 - chance) / (u * (1 - chance) + chance * (1 - u)) * 4503599627370496::DOUBLE),
                        4503599627370495::DOUBLE)::BIGINT AS rank
        FROM expected
    ), placed AS (
        SELECT *, floor(target + 0.5)::BIGINT - sum(whole * size) OVER (PARTITION BY source_size, target) AS budget,
               coalesce(sum(size) FILTER (chance > 0) OVER (
                   PARTITION BY source_size, target ORDER BY rank, substr(digest, 14, 13)
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
        FROM ranked
    ), more AS (
        SELECT *, if(chance > 0, greatest(least(budget - before, size), 0), 0)::BIGINT AS more FROM placed
    )
    SELECT doc_id, size::BIGINT AS size, source_size, target, (whole * size + more)::BIGINT AS taken,
           whole + if(more = size AND size > 0, 1, 0) AS copies, if(more = size, 0, more)::BIGINT AS part
    FROM more
"""

_COLLOCATIONS = """
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang,
               unnest(string_split_regex(
                   translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[.,;:!?\\x0A-\\x0D]')) AS piece
        FROM documents
    ), lines AS (
        SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words FROM pieces
    ), counts AS (
        SELECT lang, words[i : i + k - 1] AS phrase, count(*) AS f
        FROM (SELECT lang, words, k, unnest(range(1, len(words) - k + 2)) AS i
              FROM lines, (SELECT unnest(range(1, 6)) AS k) WHERE len(words) >= k)
        GROUP BY ALL
    ), sizes AS (
        SELECT lang, sum(f) AS n FROM counts WHERE len(phrase) = 1 GROUP BY lang
    ), candidates AS (
        SELECT * FROM counts WHERE len(phrase) > 1 AND f >= 100
    ), inside AS (
        SELECT lang, f, phrase, unnest(range(2, len(phrase))) AS k FROM candidates
    ), subsumed AS (
        SELECT lang, part, max(f) AS most
        FROM (SELECT lang, f, phrase[i : i + k - 1] AS part
              FROM (SELECT *, unnest(range(1, len(phrase) - k + 2)) AS i FROM inside))
        GROUP BY ALL
    ), kept AS (
        SELECT c.* FROM candidates c LEFT JOIN subsumed s ON c.lang = s.lang AND c.phrase = s.part
        WHERE most IS NULL OR 100 * most < 100 * f
    ), cuts AS (
        SELECT lang, phrase, f AS a, unnest(range(1, len(phrase))) AS k FROM kept
    ), scored AS (
        SELECT c.lang, c.phrase, k, a, x.f AS l, y.f AS r, n::BIGINT AS n,
               ((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
        FROM cuts c JOIN sizes USING (lang)
        JOIN counts x ON x.lang = c.lang AND x.phrase = c.phrase[:k]
        JOIN counts y ON y.lang = c.lang AND y.phrase = c.phrase[k + 1:]
    ), lowest AS (
        SELECT * FROM scored
        QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
    )
    SELECT lang, row_number() OVER (
               PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(phrase, ' ')) AS rank,
           array_to_string(phrase, ' ') AS phrase, a, l, r, n, score
    FROM lowest QUALIFY rank <= 2000
"""

_VECTORS = """
    WITH RECURSIVE usable AS (
        SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
        WHERE label IS NOT NULL AND len([x for x in embedding if x <> 0]) > 0
          AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
    ), links AS (
        SELECT a.vec_id AS a, b.vec_id AS b
        FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id
        WHERE list_cosine_similarity(a.v, b.v) >= 0.93
    ), reachable AS (
        SELECT vec_id, vec_id AS other FROM embeddings
        UNION
        SELECT vec_id, b FROM reachable JOIN links ON other = a
    ), classes AS (
        SELECT vec_id, min(other) AS component_id FROM reachable GROUP BY vec_id
    ), counts AS (
        SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a
    )
    SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
    FROM classes LEFT JOIN counts USING (vec_id)
"""

_PASSAGES = """
    WITH texts AS (
        SELECT row_number() OVER () AS document, doc_id,
               regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
        FROM documents
    ), words AS (
        SELECT document, unnest(words) AS word, unnest(range(len(words))) AS place FROM texts
    ), windows AS (
        SELECT document, place, word, list(word) OVER (
                   PARTITION BY document ORDER BY place ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING) AS following
        FROM words
    ), counted AS (
        SELECT document, place, word,
               len(following) = 35 AND count(*) OVER (PARTITION BY array_to_string(following, ' ')) > 1 AS repeated
        FROM windows
    ), judged AS (
        SELECT document, place, word, bool_or(repeated) OVER (
                   PARTITION BY document ORDER BY place ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS removed
        FROM counted
    ), joined AS (
        SELECT document, count_if(removed)::BIGINT AS n_removed,
               string_agg(word, ' ' ORDER BY place) FILTER (NOT removed) AS kept
        FROM judged GROUP BY document
    )
    SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed,
           sha256(coalesce(kept, '')) AS kept_sha256
    FROM texts LEFT JOIN joined USING (document)
"""

ORACLES: dict[str, str] = {"op1_vectors": _VECTORS, "op7_substrings": _PASSAGES, "op12_collocations": _COLLOCATIONS, "op13_mixing": _MIXING}
