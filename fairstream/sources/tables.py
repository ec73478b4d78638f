"""Scans of stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fairstream.session import file_system


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stream_table(spark: SparkSession, folder: str, name: str, files_per_batch: int = 1000) \
        -> DataFrame:
    """The same table as a stream of its files."""
    schema = read_table(spark, folder, name).schema
    # as a pattern, the path may be a single file as well as a folder
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch) \
        .parquet(f"{folder}/{name}.parque[t]")


def stream_batches(rows: DataFrame, batch: str, folder: str) -> DataFrame:
    """``rows`` as a stream with one micro-batch for each value of ``batch``, an integer, in order.

    They are staged under ``folder`` as one file per value. A file source goes by file times, which
    are set to the order of the values.
    """
    spark = rows.sparkSession
    rows.repartition(batch).write.partitionBy(batch).parquet(folder)
    path, files = file_system(spark, folder)
    parts = {int(s.getPath().getName().partition("=")[2]): s.getPath()
             for s in files.listStatus(path) if s.isDirectory()}
    for i, value in enumerate(sorted(parts)):
        for file in files.listStatus(parts[value]):
            files.setTimes(file.getPath(), 1_000_000_000_000 + 1000 * i, -1)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(folder)
