"""Registered queries over text, each beside the SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairstream.functions.text import split_lines, split_words
from fairstream.operators.wordcount import (
    avg_word_length, doc_word_totals, text_lines, tokenize, word_count, word_count_partitioned,
    word_count_salted,
)
from fairstream.sources.tables import read_table

SALTS = 16


def lines(spark: SparkSession, folder: str) -> DataFrame:
    """The lines of all documents."""
    return text_lines(read_table(spark, folder, "documents"))


def tokenize_query(spark, folder):
    """Words, empty words and characters per document."""
    documents = read_table(spark, folder, "documents")
    words = documents.select("doc_id", F.explode(split_lines(F.col("text"))).alias("value")) \
        .select("doc_id", F.explode(split_words(F.col("value"))).alias("word"))
    return words.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_words"), F.count_if(F.col("word") == "").alias("n_empty"),
        F.sum(F.length("word")).alias("n_chars"))


def word_count_query(spark, folder):
    return word_count(tokenize(lines(spark, folder)))


def word_count_keep_trailing(spark, folder):
    return word_count(tokenize(lines(spark, folder), drop_trailing=False))


def word_count_salted_query(spark, folder):
    return word_count_salted(lines(spark, folder), SALTS)


def word_count_partitioned_query(spark, folder):
    return word_count_partitioned(lines(spark, folder))


def avg_word_length_query(spark, folder):
    out = avg_word_length(tokenize(lines(spark, folder)))
    return out.select(F.round("avg_len", 6).alias("avg_len"))


def doc_word_totals_query(spark, folder):
    return doc_word_totals(lines(spark, folder))


QUERIES = {
    "tokenize": tokenize_query,
    "word_count": word_count_query,
    "word_count_keep_trailing": word_count_keep_trailing,
    "word_count_salted": word_count_salted_query,
    "word_count_partitioned": word_count_partitioned_query,
    "avg_word_length": avg_word_length_query,
    "doc_word_totals": doc_word_totals_query,
}

_LINES = """lines AS MATERIALIZED (SELECT doc_id, unnest(string_split(CASE
    WHEN t[-1] = chr(10) THEN left(t, -1) ELSE t END, chr(10))) AS line
    FROM (SELECT doc_id, replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)) AS t
        FROM documents) WHERE t <> '')"""
_WORDS = f"""{_LINES},
words AS MATERIALIZED (SELECT doc_id, unnest(CASE WHEN line = '' THEN ['']
    WHEN rtrim(line, ' ') = '' THEN [] ELSE string_split(rtrim(line, ' '), ' ') END) AS word
    FROM lines)"""
_COUNT = f"WITH {_WORDS} SELECT word, count(*) AS cnt FROM words GROUP BY word"

ORACLE = {
    "tokenize": f"""WITH {_WORDS} SELECT doc_id, count(*) AS n_words,
    count(*) FILTER (word = '') AS n_empty, CAST(sum(length(word)) AS BIGINT) AS n_chars
    FROM words GROUP BY doc_id""",
    "word_count": _COUNT,
    "word_count_keep_trailing": f"""WITH {_LINES} SELECT word, count(*) AS cnt
    FROM (SELECT unnest(string_split(line, ' ')) AS word FROM lines) GROUP BY word""",
    "word_count_salted": _COUNT,
    "word_count_partitioned": _COUNT,
    "avg_word_length": f"""WITH {_WORDS} SELECT round(avg(length(word)), 6) AS avg_len
    FROM (SELECT DISTINCT word FROM words)""",
    "doc_word_totals": f"""WITH {_WORDS} SELECT (SELECT count(*) FROM lines) AS n_docs,
    (SELECT count(DISTINCT word) FROM words) AS n_words""",
}
