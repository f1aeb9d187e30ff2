"""Paths on the file system that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new path below the checkpoint folder the session names.

    The folder comes from ``spark.checkpoint.dir`` (or an earlier
    ``setCheckpointDir``). Only a ``local`` master may leave it unset: it then
    gets a temporary folder, which every task of that one process can see.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="shardstream-")
        context.setCheckpointDir(root)
    return f"{root.rstrip('/')}/shardstream-{purpose}-{uuid.uuid4().hex}"


def pin(df: DataFrame, purpose: str) -> DataFrame:
    """Write a small result to the shared folder and read it back.

    This cuts the lineage, survives lost executors, and gives Catalyst the real
    size, so that a join broadcasts the table only while its files stay below
    ``spark.sql.autoBroadcastJoinThreshold`` and sort-merges beyond that.
    """
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _locate(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _locate(spark, path)
    return fs.exists(target)


def matches(spark: SparkSession, pattern: str) -> bool:
    """Whether any path matches."""
    fs, target = _locate(spark, pattern)
    return bool(len(fs.globStatus(target) or []))


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a Spark job finished writing this directory."""
    return exists(spark, f"{path}/_SUCCESS")


def make_directory(spark: SparkSession, path: str) -> None:
    fs, target = _locate(spark, path)
    fs.mkdirs(target)


def remove(spark: SparkSession, path: str) -> None:
    fs, target = _locate(spark, path)
    fs.delete(target, True)


def length(spark: SparkSession, path: str) -> int | None:
    """The bytes of a file, ``None`` where there is none."""
    fs, target = _locate(spark, path)
    return fs.getFileStatus(target).getLen() if fs.exists(target) else None


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or directory to a path that must not exist yet; its parents are made."""
    fs, source_path = _locate(spark, source)
    _, target_path = _locate(spark, target)
    fs.mkdirs(target_path.getParent())
    if fs.exists(target_path) or not fs.rename(source_path, target_path):
        raise OSError(f"cannot move {source} to {target}")


def write_once(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that is there whole or not at all, and is never written again."""
    fs, draft = _locate(spark, f"{path}.{uuid.uuid4().hex}.draft")
    out = fs.create(draft)
    out.write(bytearray(text.encode()))
    out.close()
    rename(spark, draft.toString(), path)


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _locate(spark, path)
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def numbers(spark: SparkSession, folder: str, before: str, behind: str = "") -> list[int]:
    """The numbers in the names ``{before}{number}{behind}`` in a folder, in order."""
    fs, pattern = _locate(spark, f"{folder}/{before}*{behind}")
    jvm = spark.sparkContext._jvm
    paths = jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(fs.globStatus(pattern))
    # All names in one call: a log has many.
    names = jvm.org.apache.commons.lang3.ArrayUtils.toString(paths) if paths is not None else ""
    return sorted(map(int, re.findall(rf"/{re.escape(before)}(\d+){re.escape(behind)}(?=[,}}])", names)))
