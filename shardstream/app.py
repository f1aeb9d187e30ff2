"""The stock consumer job: preview, log and save every batch of a record log.

    spark-submit --py-files … shardstream/app.py LOG OUT CHECKPOINT [options]
"""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import SparkSession

from shardstream import (
    LATEST,
    TRIM_HORIZON,
    await_consumers,
    compose,
    consume,
    log_stats,
    print_preview,
    text_sink,
)


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("log", help="directory of the record log")
    parser.add_argument("out", help="directory for the text of each batch")
    parser.add_argument("checkpoint", help="directory for the progress of this consumer")
    parser.add_argument("--stream", help="consume this stream only")
    parser.add_argument("--position", choices=[TRIM_HORIZON, LATEST], default=TRIM_HORIZON)
    parser.add_argument("--interval", default="10 seconds", help="time between batches")
    parser.add_argument("--once", action="store_true", help="work off what is there, then end")
    parser.add_argument("--take", type=int, default=10, help="records to print and to log")
    parser.add_argument("--files", type=int, help="most text files per batch")
    parser.add_argument("--parallelism", type=int, help="partitions to spread a batch over")
    parser.add_argument("--stop-marker", help="end between two batches when this file appears")
    parser.add_argument("--max-bytes", type=int, help="most input bytes per batch")
    return parser.parse_args(arguments)


def main(arguments: list[str] | None = None) -> None:
    options = parse(arguments)
    logging.basicConfig(level=logging.INFO)
    spark = SparkSession.builder.appName("shardstream").getOrCreate()
    query = consume(
        spark,
        options.log,
        compose(
            print_preview(options.take),
            log_stats(options.take),
            text_sink(options.out, options.files),
        ),
        options.checkpoint,
        stream=options.stream,
        columns=["data"],
        position=options.position,
        max_bytes=options.max_bytes,
        interval=options.interval,
        available_now=options.once,
        parallelism=options.parallelism,
        every_batch=print_preview(options.take, header=True),
    )
    await_consumers([query], options.stop_marker)


if __name__ == "__main__":
    main()
