"""Text to numbers. A field that is not a number fails the job, whatever the session's ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _ansi(spark: SparkSession) -> bool:
    return spark.conf.get("spark.sql.ansi.enabled") == "true"


def _strict(text: Column, kind: str) -> Column:
    complaint = F.raise_error(F.concat(F.lit(f"not a {kind}: "), text)).cast(kind)
    # a null text is a null number, as in a session that casts strictly
    return F.when(text.isNotNull(), F.coalesce(text.try_cast(kind), complaint))


def numbers(spark: SparkSession, fields: Column) -> Column:
    """An array of strings as ``array<double>``."""
    if _ansi(spark):
        return fields.cast("array<double>")
    return F.transform(fields, lambda v: _strict(v, "double"))


def parse_items(lines: DataFrame, value: str = "value") -> DataFrame:
    """``item``, the 64-bit integer on each line; batch or streaming."""
    text = F.col(value)
    item = text.cast("long") if _ansi(lines.sparkSession) else _strict(text, "long")
    return lines.select(item.alias("item"))
