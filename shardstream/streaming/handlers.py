"""Handlers that look at a batch."""

from __future__ import annotations

import logging
import uuid
from datetime import datetime, timezone

from pyspark import InheritableThread
from pyspark.sql import DataFrame

from shardstream.model import Handler
from shardstream.operators import batch_stats, preview

logger = logging.getLogger(__name__)


def _texts(batch: DataFrame) -> DataFrame:
    return batch.select("value") if "value" in batch.columns else batch


def print_preview(n: int = 10, *, header: bool = False) -> Handler:
    """Print the first ``n`` records, below a line with the time if ``header`` is set."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = preview(_texts(batch), n).collect()
        if header:
            print(f"--- batch {batch_id} at {datetime.now(timezone.utc):%Y-%m-%d %H:%M:%S} UTC ---")
        for row in rows:
            print(*row)

    return handle


def log_stats(n: int = 10) -> Handler:
    """Log the record count, the partition count and the first ``n`` records.

    A batch that is not cached yet is while this runs, so that it is read and shuffled once.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        shared = batch.is_cached
        if not shared:
            batch.persist()
        try:
            stats = batch_stats(batch).first()
            logger.info("batch %d holds %d records", batch_id, stats["records"])
            logger.info("batch %d lies in %d partitions", batch_id, stats["partitions"])
            for row in preview(_texts(batch), n).collect():
                logger.info("batch %d: %s", batch_id, ", ".join(map(str, row)))
        finally:
            if not shared:
                batch.unpersist()

    return handle


def compose(*handlers: Handler, concurrent: bool = False) -> Handler:
    """Run several handlers on a batch, in turn or all at once, reading the batch once.

    The first to raise ends the batch, so that none is lost unnoticed. With ``concurrent``
    each runs in a thread of its own with the local properties of the caller (a scheduler
    pool among them), the error of the first that fails cancels the jobs of the others, and
    the batch is done when all are.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if concurrent:
                _run_together(handlers, batch, batch_id)
                return
            for handler in handlers:
                handler(batch, batch_id)
        finally:
            batch.unpersist()

    return handle


def _run_together(handlers: tuple[Handler, ...], batch: DataFrame, batch_id: int) -> None:
    context, tag = batch.sparkSession.sparkContext, f"shardstream-{uuid.uuid4().hex}"
    errors: list[BaseException] = []

    def run(handler: Handler) -> None:
        context.addJobTag(tag)
        try:
            handler(batch, batch_id)
        except BaseException as error:  # noqa: BLE001
            errors.append(error)
            context.cancelJobsWithTag(tag)
        finally:
            context.removeJobTag(tag)

    threads = [InheritableThread(target=run, args=(handler,)) for handler in handlers]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    if errors:
        raise errors[0]
