"""Helpers that the operators of this package share."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fairstream.session import scratch_dir

#: Rows of which crc32(doc_id as text) leaves this remainder by 4 are never learned from.
HELD_OUT_REMAINDER = 2
#: Rows of an Arrow batch that a task turns into strings, and passes on, at once.
ROWS_AT_ONCE = 512


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows, written once to the cluster's shared folder and read back.

    It cuts the lineage: later jobs read the files, also after executors are lost.
    """
    spark = df.sparkSession
    folder = scratch_dir(spark, label)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def held_out(doc_id):
    """Whether a row is kept out of every training sample; a null id is not."""
    remainder = F.crc32(doc_id.cast("string").cast("binary")) % 4
    return F.coalesce(remainder == HELD_OUT_REMAINDER, F.lit(False))


def sampled(rows: DataFrame, group: str, at_most: int, mix: Column) -> DataFrame:
    """At most so many rows of every group, those with the smallest ``mix``, a hash of the row.

    A first cut by the group's size leaves about four times as many, wherever they are; only these
    are ordered. So what one task gets does not grow with the table.
    """
    sizes = rows.groupBy(group).agg(F.count(F.lit(1)).alias("size of group"))
    part = F.pmod("mix", F.lit(1 << 30)) / (1 << 30)
    cut = rows.withColumn("mix", mix).join(sizes, group) \
        .where(part * F.col("size of group") < 4 * at_most).drop("size of group")
    order = Window.partitionBy(group).orderBy(F.pmod("mix", F.lit(1 << 30)), "mix")
    return cut.withColumn("n", F.row_number().over(order)).where(F.col("n") <= at_most)


def texts(batch, name: str = "text") -> list[str]:
    """A column of an Arrow batch as strings, null as empty."""
    return ["" if v is None else v for v in batch.column(name).to_pylist()]


def slices(batches) -> Iterator:
    """The rows of Arrow batches, ``ROWS_AT_ONCE`` at a time: what a task makes of them stays small."""
    for batch in batches:
        for low in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(low, ROWS_AT_ONCE)
