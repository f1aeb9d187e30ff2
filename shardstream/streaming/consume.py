"""The consumer: a record stream, cut into micro-batches, given to a handler."""

from __future__ import annotations

import logging
import threading
import time
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from shardstream import shared
from shardstream.model import LATEST, TRIM_HORIZON, Handler
from shardstream.operators import decode_records
from shardstream.sources import record_stream
from shardstream.sources.commits import is_committed
from shardstream.sources.record_log import BATCH_OF, frozen_start

logger = logging.getLogger(__name__)

#: Seconds a micro-batch waits for the commit of a batch whose files it has met.
COMMIT_WAIT = 600

#: Options of the file source that bound a micro-batch, in lower case.
_BOUNDS = {"maxfilespertrigger", "maxbytespertrigger"}


def dispatch(
    records: DataFrame,
    handler: Handler,
    checkpoint: str,
    *,
    interval: str = "10 seconds",
    available_now: bool = False,
    parallelism: int | None = None,
    decode_errors: str | None = "replace",
    every_batch: Handler | None = None,
    query_name: str | None = None,
) -> StreamingQuery:
    """Call ``handler(batch, batch_id)`` on each non-empty micro-batch of a record stream.

    A batch holds the record columns with the payload decoded to ``value``, or the
    undecoded ``data`` with ``decode_errors=None``. ``every_batch`` is called
    before it on all batches, the empty ones too.

    The batch counts as done once the handler returns. If it raises, the query
    stops, and the next start runs the same batch again under the same id: a
    handler is called at least once per batch and must key what it writes by
    ``batch_id``, as the sinks here do.

    Records of a log's batch reach no handler before its commit. A micro-batch that met
    files of a batch still being moved waits for it up to ``COMMIT_WAIT`` seconds and then
    stops the query; the next start goes on with it.

    ``parallelism`` shuffles each batch into that many partitions before it is
    decoded. By default the file splits decide and nothing is shuffled.
    ``available_now`` works off what is there and ends; otherwise a batch starts
    every ``interval`` until the returned query is stopped.
    """

    def view(batch: DataFrame) -> DataFrame:
        records = batch.drop(BATCH_OF)
        return records if decode_errors is None else decode_records(records, decode_errors)

    def run(batch: DataFrame, batch_id: int) -> None:
        # Asked of the batch as read: behind a shuffle the first row would cost all.
        is_empty = _await_commits(batch) if BATCH_OF in batch.columns else batch.isEmpty()
        if every_batch is not None:
            every_batch(view(batch), batch_id)
        if is_empty:
            logger.info("batch %d is empty, handler skipped", batch_id)
            return
        handler(view(batch if parallelism is None else batch.repartition(parallelism)), batch_id)

    gate = _Gate()

    def gated(batch: DataFrame, batch_id: int) -> None:
        with gate.batch(batch_id):
            run(batch, batch_id)

    view(records)  # refuses records or options that cannot work before the query starts
    writer = records.writeStream.foreachBatch(gated).option("checkpointLocation", checkpoint)
    if query_name is not None:
        writer = writer.queryName(query_name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=interval)
    query = writer.start()
    _gates[query.runId] = gate
    return query


class _Gate:
    """Lets the batches of a query through, one at a time, until it is closed."""

    def __init__(self) -> None:
        self.open, self.idle, self.last = True, threading.Lock(), -1

    @contextmanager
    def batch(self, batch_id: int) -> Iterator[None]:
        with self.idle:
            if not self.open:
                # Not begun, so the next start of the query has it whole.
                raise RuntimeError("the query is being stopped")
            yield
            self.last = batch_id


_gates: dict[str, _Gate] = {}


def stop_between_batches(query: StreamingQuery) -> None:
    """Stop a query of ``dispatch`` or ``consume`` when no batch is under way.

    A batch that a handler has begun is finished and committed first, so the next start
    neither repeats nor lacks one.
    """
    gate = _gates.pop(query.runId, None)
    if gate is not None:
        with gate.idle:
            gate.open = False
        # Committed once the query says so, or has gone on to a batch the gate refused.
        while query.isActive and gate.last >= 0 and (query.lastProgress or {"batchId": -1})["batchId"] < gate.last:
            time.sleep(0.05)
    query.stop()


def await_consumers(
    queries: Iterable[StreamingQuery], stop_marker: str | None = None, poll_seconds: float = 5.0
) -> None:
    """Wait for several consumers at once, until all have ended.

    When ``stop_marker`` appears, a file on any file system, or when one of them fails, the
    others are stopped between their batches; a failure is raised then.
    """
    queries = list(queries)
    while any(query.isActive for query in queries):
        spark = SparkSession.active()
        failed = any(not query.isActive and query.exception() for query in queries)
        if failed or (stop_marker is not None and shared.exists(spark, stop_marker)):
            for query in queries:
                if query.isActive:
                    stop_between_batches(query)
            break
        next(query for query in queries if query.isActive).awaitTermination(poll_seconds)
    for query in queries:
        _gates.pop(query.runId, None)
        if (error := query.exception()) is not None and "the query is being stopped" not in str(error):
            raise error


def _await_commits(batch: DataFrame) -> bool:
    """Wait until all batches a micro-batch has records of are committed; whether it has none.

    The batches are directory names, so finding them opens no column.
    """
    spark = batch.sparkSession
    waiting = [row[0] for row in batch.select(BATCH_OF).distinct().collect()]
    is_empty, deadline = not waiting, time.monotonic() + COMMIT_WAIT
    while waiting := [b for b in waiting if not is_committed(spark, b["log"], b["batch_id"])]:
        if time.monotonic() > deadline:
            raise TimeoutError(f"no commit yet of {waiting}")
        time.sleep(0.2)
    return is_empty


def consume(
    spark: SparkSession,
    log_dir: str,
    handler: Handler,
    checkpoint: str,
    *,
    stream: str | None = None,
    columns: list[str] | None = None,
    position: str = TRIM_HORIZON,
    max_files: int | None = None,
    max_bytes: int | None = None,
    require_data: bool = True,
    source_options: dict[str, str] | None = None,
    **dispatch_options,
) -> StreamingQuery:
    """Consume a record log from the oldest or the newest record on.

    ``columns`` names the record columns the handler needs. They are best given: a
    batch reads what was asked for here, whatever its handler then selects. At least
    ``data`` belongs to them, unless ``decode_errors`` is ``None``.

    Progress is kept in ``checkpoint``, one per consumer: a restart goes on behind
    the last finished batch. Raises ``ValueError`` on a missing or empty log unless
    ``require_data`` is off. The further options are those of ``dispatch``.

    The bounds of a batch count the files of a backlog that ``position="latest"`` skips.
    The first start therefore passes them in one batch without bounds and waits for it;
    what lands meanwhile goes to the handler in that batch.
    """

    def records(options: dict[str, str], **bounds: int | None) -> DataFrame:
        found = record_stream(
            spark,
            log_dir,
            stream,
            position=position,
            start=start,
            require_data=require_data,
            options=options,
            **bounds,
        )
        return found if columns is None else found.select(*columns, BATCH_OF)

    start, options = f"{checkpoint}/start", source_options or {}
    bounded = records(options, max_files=max_files, max_bytes=max_bytes)
    unbounded = {name: value for name, value in options.items() if name.lower() not in _BOUNDS}
    has_bounds = max_files is not None or max_bytes is not None or unbounded != options
    if position == LATEST and has_bounds and not shared.matches(spark, f"{checkpoint}/commits/[0-9]*"):
        if frozen_start(spark, log_dir, start) >= 0:
            seeding = dispatch_options | {"available_now": True}
            dispatch(records(unbounded), handler, checkpoint, **seeding).awaitTermination()
    return dispatch(bounded, handler, checkpoint, **dispatch_options)
