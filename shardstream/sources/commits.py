"""The commits of a log: which batches readers see, and what is in them.

``_commits/N.json`` is written once, when all files of batch ``N`` are in their place. It has
a line for each shard of the batch: its record count, its first and last number and arrival,
and its files. Readers go by commits: until it is there they see nothing of a batch, then all
of it. The same lines are the log's index, so streams, shards, positions and the bounds of
pages are known without opening a data file.

``compact_log`` merges commits to a table below ``_index/`` and expires old batches. Its
write-once summary ``_index/K.json`` names the table, the batches in it and the first one
kept; the one of the highest ``K`` counts. What a summary replaces, its successor deletes,
so that reads under way find what they were planned on.
"""

from __future__ import annotations

import json
import uuid
from bisect import bisect_right
from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardstream import shared
from shardstream.model import INDEX, RECORD, SHARD

#: Directory columns of a log, in their order. Spark puts them last in a table.
DIRECTORIES = [T.StructField("batch_id", T.LongType()), RECORD["stream"], RECORD["shard_id"]]
LAYOUT = T.StructType([f for f in RECORD if f.name not in SHARD] + DIRECTORIES)


def commit_path(log_dir: str, batch_id: int) -> str:
    return f"{log_dir}/_commits/{batch_id}.json"


@dataclass
class Commits:
    """Which batches of a log readers see."""

    single: list[int]  # the batches with a commit object, in order
    ranges: list[tuple[int, int]] = field(default_factory=list)  # first and last id of runs of merged ones
    table: str | None = None  # where the lines of merged batches are
    first_kept: int = 0

    def merged(self, batch_id: int) -> bool:
        at = bisect_right(self.ranges, (batch_id, float("inf"))) - 1
        return at >= 0 and batch_id <= self.ranges[at][1]

    def __contains__(self, batch_id: int) -> bool:
        """Whether the batch was committed, expired ones too."""
        at = bisect_right(self.single, batch_id) - 1
        return (at >= 0 and self.single[at] == batch_id) or self.merged(batch_id)

    @property
    def unmerged(self) -> list[int]:
        return [i for i in self.single if not self.merged(i)]

    @property
    def newest(self) -> int:
        return max([*self.single[-1:], *(last for _, last in self.ranges[-1:])], default=-1)


def _summaries(spark: SparkSession, log_dir: str) -> list[int]:
    return shared.numbers(spark, f"{log_dir}/_index", "", ".json")


def _summary(spark: SparkSession, log_dir: str, number: int) -> dict:
    return json.loads(shared.read_text(spark, f"{log_dir}/_index/{number}.json"))


def read_commits(spark: SparkSession, log_dir: str) -> Commits:
    """What is committed, from names and the newest summary alone."""
    # Objects first: one that is merged and deleted meanwhile is in the summary read after it.
    single = shared.numbers(spark, f"{log_dir}/_commits", "", ".json")
    if not (numbers := _summaries(spark, log_dir)):
        return Commits(single)
    found = _summary(spark, log_dir, numbers[-1])
    return Commits(single, [tuple(run) for run in found["batches"]], f"{log_dir}/_index/{found['table']}", found["first_kept"])


def is_committed(spark: SparkSession, log_dir: str, batch_id: int) -> bool:
    return shared.exists(spark, commit_path(log_dir, batch_id)) or batch_id in read_commits(spark, log_dir)


def visible(spark: SparkSession, log_dir: str) -> Column:
    """A filter on ``batch_id`` that lets committed batches pass that are kept.

    It is a range, less the batches within it whose put was broken off: few, as a log has
    one writer. Batches that land later are beyond it.
    """
    done = read_commits(spark, log_dir)
    found = shared.numbers(spark, log_dir, "batch_id=")
    seen = F.col("batch_id").between(done.first_kept, done.newest)
    broken = [i for i in found if done.first_kept <= i < done.newest and i not in done]
    return seen & ~F.col("batch_id").isin(broken) if broken else seen


def read_index(
    spark: SparkSession, log_dir: str, stream: str | None = None, *, from_batch: int = 0, to_batch: int | None = None
) -> DataFrame:
    """A row of ``INDEX`` for each shard of each committed batch in the range, from commits alone.

    A shard of which all batches have expired keeps one row, without records, that says
    which number was its last.
    """
    index = _read_index(spark, log_dir, read_commits(spark, log_dir), from_batch, to_batch)
    return index if stream is None else index.where(F.col("stream") == stream)


def _read_index(spark: SparkSession, log_dir: str, done: Commits, from_batch: int = 0, to_batch: int | None = None) -> DataFrame:
    ids = [i for i in done.unmerged if max(from_batch, done.first_kept) <= i and (to_batch is None or i <= to_batch)]
    parts = []
    if done.table is not None:
        merged = spark.read.schema(INDEX).parquet(done.table).where(F.col("batch_id") >= from_batch)
        parts.append(merged if to_batch is None else merged.where(F.col("batch_id") <= to_batch))
    if ids:
        read = T.StructType([T.StructField(f.name, T.StringType() if f.dataType == T.TimestampNTZType() else f.dataType) for f in INDEX])
        rows = spark.read.schema(read).json([commit_path(log_dir, i) for i in ids])
        parts.append(rows.select([F.col(f.name).cast(f.dataType) for f in INDEX]))
    if not parts:
        return spark.createDataFrame([], INDEX)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _joined(runs: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs of ids that do not overlap, in order and without neighbours."""
    joined: list[tuple[int, int]] = []
    for first, last in sorted(runs):
        if joined and first == joined[-1][1] + 1:
            joined[-1] = (joined[-1][0], last)
        else:
            joined.append((first, last))
    return joined


def _expired(index: DataFrame, first_kept: int) -> DataFrame:
    """The index without the batches before ``first_kept``, but for the last number of shards
    that have none left."""
    old, kept = index.where(F.col("batch_id") < first_kept), index.where(F.col("batch_id") >= first_kept)
    last = old.join(kept.select(*SHARD).distinct(), list(SHARD), "left_anti").groupBy(*SHARD)
    last = last.agg(F.max("batch_id").alias("batch_id"), F.max("last_sequence").alias("last_sequence"))
    nothing = F.lit(None).cast("timestamp_ntz")
    gone = last.select(
        "batch_id", *SHARD, F.lit(0).cast("bigint").alias("records"), (F.col("last_sequence") + 1).alias("first_sequence"),
        "last_sequence", nothing.alias("first_arrival"), nothing.alias("last_arrival"), F.lit(0).cast("bigint").alias("bytes"),
    )
    return kept.unionByName(gone)


def compact_log(
    spark: SparkSession, log_dir: str, *, keep_from: int | None = None, keep_since: datetime | None = None
) -> int:
    """Merge a log's commits to one table, and expire its oldest batches; gives the first one kept.

    Batches before ``keep_from`` expire, or those of which all records arrived before
    ``keep_since``, up to the first batch with a later one. The newest batch always stays,
    and expired ones never come back. Readers, pages and streams that start see the oldest
    batch kept as the log's begin; positions before it go on there. A running stream skips
    files that are gone before it came to them.

    Everything takes effect by one write-once summary. The objects and files it replaces are
    deleted by the next run, so runs should be further apart than the longest read takes. As
    puts do, runs need a single writer, but may run beside puts and readers.
    """
    log_dir = log_dir.rstrip("/")
    numbers = _summaries(spark, log_dir)
    done = read_commits(spark, log_dir)
    index = _read_index(spark, log_dir, done)
    if keep_since is not None:
        since = F.lit(keep_since).cast("timestamp_ntz")
        found = index.where(F.col("last_arrival") >= since).agg(F.min("batch_id")).first()[0]
        keep_from = max(keep_from or 0, done.newest if found is None else found)
    first_kept = max(done.first_kept, min(keep_from or 0, done.newest))
    if done.unmerged or first_kept > done.first_kept:
        merged = _joined([*done.ranges, *((i, i) for i in done.unmerged)])
        table = f"table-{uuid.uuid4().hex}"
        # In order of batches, so that a page from some batch on skips the lines before it.
        _expired(index, first_kept).sort("batch_id", *SHARD).write.parquet(f"{log_dir}/_index/{table}")
        summary = {"table": table, "first_kept": first_kept, "batches": merged}
        shared.write_once(spark, f"{log_dir}/_index/{(numbers[-1] if numbers else -1) + 1}.json", json.dumps(summary))
    if numbers:
        _delete_replaced(spark, log_dir, done, numbers)
    return first_kept


def _delete_replaced(spark: SparkSession, log_dir: str, before: Commits, numbers: list[int]) -> None:
    """Delete what the summary ``before`` replaced; ``numbers`` are those of it and the ones before it."""
    for batch_id in shared.numbers(spark, log_dir, "batch_id="):
        if batch_id < before.first_kept and batch_id in before:
            shared.remove(spark, f"{log_dir}/batch_id={batch_id}")
    for batch_id in before.single:
        if before.merged(batch_id):
            shared.remove(spark, commit_path(log_dir, batch_id))
    for number in numbers[:-1]:
        shared.remove(spark, f"{log_dir}/_index/{_summary(spark, log_dir, number)['table']}")
        shared.remove(spark, f"{log_dir}/_index/{number}.json")


def describe(spark: SparkSession, root: str, records: DataFrame) -> dict[int, list[dict]]:
    """The lines of the commit of each batch in a table below ``root``, from its key columns.

    The driver gets a row for each shard of a batch and the names of its files, which the
    writing job's own commit has passed through it before.
    """
    files = F.collect_set(F.struct(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes")))
    found = records.groupBy("batch_id", *SHARD).agg(
        F.count("*").alias("records"),
        F.min("sequence_number").alias("first_sequence"),
        F.max("sequence_number").alias("last_sequence"),
        F.min("arrival_ts").cast("string").alias("first_arrival"),
        F.max("arrival_ts").cast("string").alias("last_arrival"),
        files.alias("files"),
    )
    lines: dict[int, list[dict]] = {}
    for row in found.toLocalIterator():
        line = row.asDict(recursive=True)
        for file in line["files"]:
            path = unquote(file["path"])
            file["path"] = path[path.rindex(f"{root}/") + len(root) + 1 :]
        line["files"].sort(key=lambda file: file["path"])
        line["bytes"] = sum(file["bytes"] for file in line["files"])
        lines.setdefault(row["batch_id"], []).append(line)
    return lines


def to_text(lines: Iterable[dict]) -> str:
    ordered = sorted(lines, key=lambda line: (line["stream"], line["shard_id"]))
    return "".join(json.dumps(line) + "\n" for line in ordered)


def files_of(text: str) -> list[tuple[str, int]]:
    """The paths within the batch, and bytes, of a commit's files."""
    return [(file["path"], file["bytes"]) for line in text.splitlines() for file in json.loads(line)["files"]]


def adopt_batches(spark: SparkSession, log_dir: str) -> list[int]:
    """Commit batches that were written whole by other means, such as one partitioned write.

    All directories ``batch_id=N`` without a commit are taken, but for those whose put was
    broken off: these the next put completes. Returns their ids.
    """
    pending = set(shared.numbers(spark, f"{log_dir}/_landing", "", ".json"))
    landing = set(shared.numbers(spark, f"{log_dir}/_landing", "batch_id="))
    done = read_commits(spark, log_dir)
    found = {i for i in shared.numbers(spark, log_dir, "batch_id=") if i not in done} - pending - landing
    if found:
        records = spark.read.schema(LAYOUT).parquet(log_dir).where(F.col("batch_id").isin(sorted(found)))
        root = log_dir.rstrip("/").split("://")[-1]
        lines = describe(spark, root, records)
        for batch_id in sorted(found):
            for line in lines.get(batch_id, []):
                for file in line["files"]:
                    file["path"] = file["path"].split("/", 1)[1]
            shared.write_once(spark, commit_path(log_dir, batch_id), to_text(lines.get(batch_id, [])))
    return sorted(found)
