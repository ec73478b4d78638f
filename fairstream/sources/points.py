"""Reading and writing labelled points: ``coords array<double>`` and a group ``grp``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairstream.sources.parsing import numbers


def read_lines(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """One row per text line. ``partitions`` spreads the lines evenly, at the cost of a shuffle;
    without it the file splits decide."""
    lines = spark.read.text(path)
    return lines.repartition(partitions) if partitions else lines


def labelled_points(lines: DataFrame, value: str = "value") -> DataFrame:
    """Parse ``x1,...,xd,label`` for any d. Label ``A`` is group A, every other label group B.

    Empty fields at the end of a line are ignored, so ``1,2,`` is a one-dimensional point with
    label ``2``. A field that is not a number fails the job.
    """
    text = F.col(value)
    kept = F.rtrim(text, F.lit(","))
    fields = F.when(
        (kept == "") & (text != ""), F.raise_error(F.concat(F.lit("no fields in line "), text))
    ).otherwise(F.split(kept, ",", -1))
    return (
        lines.withColumn("_fields", fields)
        .withColumn("coords", numbers(
            lines.sparkSession, F.slice("_fields", F.lit(1), F.size("_fields") - 1)))
        .withColumn("grp", F.when(F.element_at("_fields", -1) == "A", "A").otherwise("B"))
        .drop("_fields", value)
    )


def labelled_points_tolerant(lines: DataFrame, value: str = "value") -> DataFrame:
    """Keep lines of three or more fields: two coordinates and the class as written.

    Shorter lines are skipped and later fields ignored; a coordinate that is not a number fails
    the job. Fields are separated by commas only, without quoting.
    """
    fields = F.split(F.col(value), ",", -1)
    return (
        lines.withColumn("_fields", fields)
        .where(F.size("_fields") >= 3)
        .withColumn("coords", numbers(lines.sparkSession, F.slice("_fields", 1, 2)))
        .withColumn("grp", F.col("_fields")[2])
        .drop("_fields", value)
    )


def format_points(points: DataFrame) -> DataFrame:
    """The text form of two-dimensional points, four decimals: ``x,y,group``."""
    return points.select(
        F.format_string("%.4f,%.4f,%s", F.col("coords")[0], F.col("coords")[1], F.col("grp"))
        .alias("value")
    )


def write_points(points: DataFrame, path: str, mode: str = "error") -> None:
    format_points(points).write.mode(mode).text(path)
