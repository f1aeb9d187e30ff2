from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_csv_with_header(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file or directory: names from the header line, every column a string.

    The types are not inferred, so no extra pass over the data is made.
    """
    return spark.read.option("header", True).csv(path)
