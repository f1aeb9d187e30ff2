"""Near-duplicate documents by ProbMinHash, banding and verification.

A document is the weighted set of its runs of five words (weight: how often a run
occurs; a text of one to four words is one run). Similarity is the probability Jaccard
similarity of two such sets. Each run sends arrivals of a Poisson process with a rate in
proportion to its weight to random components of the signature; every component keeps
its first arrival, and a run stops once its next arrival is later than all of them.

Equal texts are collapsed first. Texts that share a band are linked with the least id of
that bucket and verified on whole texts. In buckets whose members are not all in one
class by then, all pairs across classes are taken up in blocks (members of the largest
class meet the others only, so a group linked by then costs what its outsiders cost); a
pair goes on if its signatures agree as links do with overwhelming probability, and is
verified unless the block has linked its classes already. So classes are those of all links found, with no
limit on bucket sizes; a pair of similarity 0.8 shares no band of 32 with probability
5e-8.

A null text is alone in its class, empty texts and texts without words are linked with
equal texts only. Rows with the same id and text are one document. The class of rows
without ids is null; one text of it is kept. Columns other than the two read change nothing; an empty table gives
an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardstream.llm.arrow import batch, fields, map_arrow
from shardstream.llm.columns import own, unused
from shardstream.llm.groups import components, sorted_groups
from shardstream.llm.words import Words, blocks, mix, shingles
from shardstream.shared import pin

#: Words of a run, components of a signature, components of a band.
RUN, COMPONENTS, BAND = 5, 128, 4
#: Documents of a block of a bucket.
BLOCK = 256
#: A link's signatures agree in fewer components than this share with probability 1e-8.
LEAST_AGREEMENT = 0.6

_U = np.uint64


def weighted_runs(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``first`` (by text), and hash and weight of each distinct run, sorted by text and hash."""
    words = Words(texts)
    hashes = words.hashes()
    runs, at = shingles(words, hashes, RUN)
    doc = words.doc[at]
    short = np.flatnonzero((words.counts > 0) & (words.counts < RUN))
    if len(short):
        whole = []
        for d in short:
            total = _U(int(words.counts[d]))
            for h in hashes[words.first[d] : words.first[d + 1]]:
                total = mix(np.array([total ^ h]))[0]
            whole.append(total)
        runs, doc = np.concatenate([runs, np.array(whole, _U)]), np.concatenate([doc, short])
    order = np.lexsort((runs, doc))
    runs, doc = runs[order], doc[order]
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:] != runs[:-1]) | (doc[1:] != doc[:-1])
    start = np.flatnonzero(new)
    weight = np.diff(np.append(start, len(runs))).astype(float)
    return np.searchsorted(doc[start], np.arange(len(texts) + 1)), runs[start], weight


def signatures(first: np.ndarray, runs: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The run that arrives first at each component, for each text with runs.

    Interleaved: each round takes up the next arrivals, twice as many as the last, of all
    runs still early enough for some component of their text.
    """
    n = len(first) - 1
    doc = np.repeat(np.arange(n), np.diff(first))
    arrival, winner = np.full(n * COMPONENTS, np.inf), np.zeros(n * COMPONENTS, _U)
    clock, made, each = np.zeros(len(runs)), 0, 1
    alive = np.arange(len(runs))
    while len(alive):
        step = np.arange(made, made + each, dtype=_U) * _U(0x9E3779B97F4A7C15)
        draw = mix(runs[alive][:, None] + step[None] + _U(0xD1B54A32D192ED03))
        waits = -np.log1p(-((draw >> _U(11)) * 2.0**-53))
        times = clock[alive][:, None] + np.cumsum(waits, 1) / (weight[alive][:, None] * COMPONENTS)
        place = (mix(draw) % _U(COMPONENTS)).astype(np.int64) + doc[alive][:, None] * COMPONENTS
        clock[alive] = times[:, -1]
        times, place = times.ravel(), place.ravel()
        early = times < arrival[place]
        times, place, run = times[early], place[early], np.repeat(runs[alive], each)[early]
        np.minimum.at(arrival, place, times)
        best = times == arrival[place]
        winner[place[best]] = run[best]
        latest = arrival.reshape(n, COMPONENTS).max(1)
        alive = alive[clock[alive] < latest[doc[alive]]]
        made, each = made + each, min(2 * each, 64)
    return winner.reshape(n, COMPONENTS)


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """The sum over common runs i of 1 / sum over runs j of max(a_j / a_i, b_j / b_i)."""
    (ka, wa), (kb, wb) = a, b
    common, ia, ib = np.intersect1d(ka, kb, assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    x, y = wa[ia], wb[ib]
    # Runs of b alone exceed every ratio, those of a alone none.
    only_a, only_b = wa.sum() - x.sum(), wb.sum() - y.sum()
    order = np.argsort(y / x, kind="stable")
    x, y = x[order], y[order]
    ratio = y / x
    upto = np.searchsorted(ratio, ratio, "right")
    sums_x, sums_y = np.concatenate(([0], np.cumsum(x))), np.concatenate(([0], np.cumsum(y)))
    whole = (only_a + sums_x[upto]) / x + (only_b + sums_y[-1] - sums_y[upto]) / y
    return float((1 / whole).sum())


def _distinct(docs: DataFrame) -> DataFrame:
    """A row per distinct text: ``key``, ``id`` (a number, to be written before use), ``first_id``
    and the bands (null without words)."""

    def run(batches):
        for block in blocks(batches, "text", 1 << 18):
            found = signatures(*weighted_runs(block.column("text")))
            some = np.isin(np.arange(block.num_rows), np.flatnonzero(found.any(1)))
            # A component counts by 16 bits, four of them are a band.
            bands = (mix(found) & _U(0xFFFF)).astype("<u2").view("<i8")
            rows = [list(row) if keep else None for row, keep in zip(bands.tolist(), some, strict=True)]
            yield batch(schema, block.column("doc_id"), block.column("key"), pa.array(rows, pa.list_(pa.int64())))

    schema = fields(doc_id=T.LongType(), key=T.BinaryType(), bands=T.ArrayType(T.LongType()))
    rows = map_arrow(docs.where("text IS NOT NULL"), run, schema)
    distinct = rows.groupBy("key").agg(F.min("doc_id").alias("first_id"), F.first("bands").alias("bands"))
    return distinct.withColumn("id", F.monotonically_increasing_id())


def _texts(docs: DataFrame, ids: DataFrame, distinct: DataFrame) -> DataFrame:
    """``id`` and ``text`` of the distinct texts with the given ids."""
    wanted = distinct.join(ids, "id").select("id", "key", F.col("first_id").alias("doc_id"))
    same = docs["doc_id"].eqNullSafe(wanted["doc_id"]) & (docs["key"] == wanted["key"])
    # Copies with other ids drop out in the join, repeated rows behind it.
    return docs.join(wanted, same).select("id", docs["key"], docs["text"]).groupBy("id", "key").agg(F.first("text").alias("text")).drop("key")


def _check(batches, schema, threshold):
    """The pairs of texts that are similar enough."""
    for block in blocks(batches, "text_a", 1 << 18):
        first_a, runs_a, weight_a = weighted_runs(block.column("text_a"))
        first_b, runs_b, weight_b = weighted_runs(block.column("text_b"))
        near = []
        for i in range(block.num_rows):
            a, b = slice(first_a[i], first_a[i + 1]), slice(first_b[i], first_b[i + 1])
            near.append(probability_jaccard((runs_a[a], weight_a[a]), (runs_b[b], weight_b[b])) >= threshold - 1e-12)
        rows = block.filter(pa.array(near, pa.bool_()))
        yield batch(schema, rows.column("a"), rows.column("b"))


def _across(batches, schema, threshold):
    """Links between the classes of each block of pairs of a bucket, enough to connect them."""
    for group in sorted_groups(batches, ["bucket", "block_a", "block_b"]):
        ids, classes = group.column("id").to_numpy(), group.column("class").to_numpy()
        own, band = group.column("own").to_numpy(), group.column("band")[0].as_py()
        a, b = (own == group.column(side)[0].as_py() for side in ("block_a", "block_b"))
        bands = np.array(group.column("bands").to_pylist(), "<i8")
        parts = bands.view("<u2")
        pairs = a[:, None] & b[None] & (classes[:, None] != classes[None])
        if (a == b).all():
            pairs &= ids[:, None] < ids[None]
        i, j = np.nonzero(pairs)
        if not len(i):
            continue
        slices = [slice(k, k + 8192) for k in range(0, len(i), 8192)]
        agree = np.concatenate([(parts[i[k]] == parts[j[k]]).sum(1) for k in slices])
        here = np.concatenate([(bands[i[k]] == bands[j[k]]).argmax(1) for k in slices])
        # Each pair is taken up in the first band it shares.
        chosen = np.flatnonzero((agree >= LEAST_AGREEMENT * COMPONENTS) & (here == band))
        if not len(chosen):
            continue
        first, runs, weight = weighted_runs(group.column("text").combine_chunks())
        sets = [(runs[s:e], weight[s:e]) for s, e in zip(first, first[1:], strict=False)]
        top = {int(c): int(c) for c in np.unique(classes)}

        def find(c, top=top):
            while top[c] != c:
                top[c] = c = top[top[c]]
            return c

        links = []
        for k in chosen[np.argsort(-agree[chosen], kind="stable")]:
            p, q = find(int(classes[i[k]])), find(int(classes[j[k]]))
            if p != q and probability_jaccard(sets[i[k]], sets[j[k]]) >= threshold - 1e-12:
                top[p] = q
                links.append((ids[i[k]], ids[j[k]]))
        if links:
            yield batch(schema, *(pa.array(c, pa.int64()) for c in zip(*links, strict=True)))


def near_duplicates(docs: DataFrame, threshold: float = 0.8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``key`` (of the text), ``class_id`` (the class's least id) and ``kept`` for each row."""
    docs = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    docs = docs.withColumn("key", F.unhex(F.md5("text")))
    edge = fields(a=T.LongType(), b=T.LongType())
    distinct = pin(_distinct(docs), "distinct-texts")
    banded = distinct.where(F.col("bands").isNotNull()).select("id", F.posexplode("bands").alias("band", "value"))
    buckets = banded.groupBy("band", "value").agg(F.count("*").alias("n"), F.min("id").alias("least")).where("n > 1")
    members = pin(banded.join(buckets, ["band", "value"]), "buckets")

    stars = pin(members.where("id <> least").select(F.col("least").alias("a"), F.col("id").alias("b")).distinct(), "stars")
    wanted = stars.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    texts = pin(_texts(docs, wanted, distinct), "texts")
    side = lambda c: texts.select(F.col("id").alias(c), F.col("text").alias(f"text_{c}"))
    pairs = stars.join(side("a"), "a").join(side("b"), "b").select("a", "b", "text_a", "text_b")
    links = pin(map_arrow(pairs, lambda rows: _check(rows, edge, threshold), edge), "star-links")
    classes = components(links)

    # What lies in buckets of more than one class.
    kind = pin(members.join(classes, "id", "left").withColumn("class", F.coalesce("component", "id")).drop("component"), "members")
    sizes = kind.groupBy("band", "value", "class").agg(F.count("*").alias("size"))
    mixed = sizes.groupBy("band", "value").agg(
        F.count("*").alias("classes"), F.sum("size").alias("all"), F.max(F.struct("size", "class")).alias("largest")
    )
    mixed = kind.join(mixed.where("classes > 1"), ["band", "value"])
    # The largest class's members meet the others only, not each other: their blocks are
    # the negative numbers.
    large = F.col("class") == F.col("largest.class")
    large_blocks = F.ceil(F.col("largest.size") / BLOCK).cast("int")
    other_blocks = F.ceil((F.col("all") - F.col("largest.size")) / BLOCK).cast("int")
    draw = F.xxhash64("id")
    own = F.when(large, -1 - F.pmod(draw, large_blocks)).otherwise(F.pmod(draw, other_blocks)).cast("int")
    met = F.sequence(F.when(large, F.lit(0)).otherwise(-large_blocks), other_blocks - 1)
    blocked = mixed.select(
        "band", "id", "class", F.xxhash64("band", "value").alias("bucket"), own.alias("own"), F.explode(met).alias("other")
    )
    keys = ["bucket", "block_a", "block_b"]
    blocked = pin(
        blocked.select(
            "band", "id", "class", "own", "bucket", F.least("own", "other").alias("block_a"), F.greatest("own", "other").alias("block_b")
        ),
        "blocks",
    )
    if not blocked.isEmpty():
        whole = blocked.join(distinct.select("id", "bands"), "id").join(texts, "id")
        whole = whole.repartition(*keys).sortWithinPartitions(*keys)
        more = pin(map_arrow(whole, lambda rows: _across(rows, edge, threshold), edge), "more-links")
        if not more.isEmpty():
            classes = components(links.unionByName(more))

    named = distinct.select("key", "id", "first_id").join(classes, "id", "left").withColumn("class", F.coalesce("component", "id"))
    named = pin(named.select("key", "first_id", "class"), "named")
    # Of texts with the least id, and in a class without ids, the one of the least key is kept.
    least = named.groupBy("class").agg(F.min(F.struct(F.col("first_id").isNull(), "first_id", "key")).alias("least"))
    chosen = F.col("key") == F.col("least.key")
    named = named.join(least, "class").select("key", F.col("least.first_id").alias("class_id"), chosen.alias("chosen"))
    class_id = F.when(F.col("chosen").isNotNull(), F.col("class_id")).otherwise(F.col("doc_id"))
    kept = F.col("doc_id").eqNullSafe(class_id) & F.coalesce("chosen", F.lit(True))
    return docs.select("doc_id", "key").join(named, "key", "left").select(
        "doc_id", "key", class_id.alias("class_id"), kept.alias("kept")
    )


def without_duplicates(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """The documents with one row of each class: that of its least id.

    Needs ``doc_id`` and ``text``; keeps all columns. Null texts stay.
    """
    found = near_duplicates(docs, threshold)
    keep = pin(found.where("kept").select("doc_id", "key").distinct(), "kept")
    key, key_id, key_kept = (unused(docs, name) for name in ("__key", "__id", "__keep"))
    rows = docs.withColumn(key, F.unhex(F.md5("text")))
    keep = keep.select(F.col("doc_id").alias(key_id), F.col("key").alias(key_kept))
    same = rows["doc_id"].eqNullSafe(F.col(key_id)) & (rows[key] == F.col(key_kept))
    kept = rows.join(keep, same).dropDuplicates(["doc_id", key]).select(*map(own, docs.columns))
    return kept.unionByName(docs.where("text IS NULL"))
