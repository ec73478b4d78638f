"""Word counts over text lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairstream.functions.text import split_lines, split_words


def text_lines(texts: DataFrame, column: str = "text") -> DataFrame:
    """One row ``value`` per line of each text."""
    return texts.select(F.explode(split_lines(F.col(column))).alias("value"))


def tokenize(lines: DataFrame, drop_trailing: bool = True, value: str = "value") -> DataFrame:
    """One row ``word`` per word of each line."""
    return lines.select(F.explode(split_words(F.col(value), drop_trailing)).alias("word"))


def word_count(words: DataFrame) -> DataFrame:
    """``(word, cnt)`` in one round: counted within each task, then summed by word."""
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


def word_count_salted(lines: DataFrame, salts: int, drop_trailing: bool = True,
                      value: str = "value") -> DataFrame:
    """``(word, cnt)`` in two rounds: by (salt, word), then by word.

    The salt is a hash of the line, so a frequent word spreads over ``salts`` reducers, and a task
    that runs again sends every row where it went before (a random salt need not).
    """
    if salts < 1:
        raise ValueError("salts must be positive")
    salted = lines.select(
        F.pmod(F.xxhash64(value), F.lit(salts)).cast("int").alias("salt"),
        F.explode(split_words(F.col(value), drop_trailing)).alias("word"))
    first = salted.groupBy("salt", "word").agg(F.count(F.lit(1)).alias("cnt"))
    return first.groupBy("word").agg(F.sum("cnt").alias("cnt"))


def word_count_partitioned(lines: DataFrame, drop_trailing: bool = True,
                           value: str = "value") -> DataFrame:
    """``(word, cnt)`` in two rounds: by input partition and word, then by word.

    A frequent word goes to as many reducers as there are partitions. :func:`word_count` has one
    shuffle less and gives the same rows, as its partial counts already are per task.
    """
    words = lines.select(F.spark_partition_id().alias("part"),
                         F.explode(split_words(F.col(value), drop_trailing)).alias("word"))
    first = words.groupBy("part", "word").agg(F.count(F.lit(1)).alias("cnt"))
    return first.groupBy("word").agg(F.sum("cnt").alias("cnt"))


def avg_word_length(words: DataFrame) -> DataFrame:
    """One row ``avg_len``: mean length, in code points, of the distinct words."""
    return words.select("word").distinct().agg(F.avg(F.length("word")).alias("avg_len"))


def doc_word_totals(lines: DataFrame, drop_trailing: bool = True,
                    value: str = "value") -> DataFrame:
    """One row ``(n_docs, n_words)``: lines and distinct words, from one pass over the lines."""
    words = lines.select(F.posexplode_outer(split_words(F.col(value), drop_trailing))
                         .alias("pos", "word"))
    # the first word of a line, or the null that stands for a line without words
    starts = F.count_if(F.col("pos").isNull() | (F.col("pos") == 0))
    return words.groupBy("word").agg(starts.alias("starts")).agg(
        F.coalesce(F.sum("starts"), F.lit(0)).alias("n_docs"), F.count("word").alias("n_words"))
