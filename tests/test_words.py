import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fairstream.functions.text import split_lines
from fairstream.operators.wordcount import (
    avg_word_length, doc_word_totals, text_lines, tokenize, word_count, word_count_partitioned,
    word_count_salted,
)

LINES = ["", " ", "   ", "a", "a b", " a", "a ", "a  b", "  a  ", "tab\tinside", "ünï cödé",
         "\U0001F600 face", "a a a b", "a" + " a" * 500]


def _words(line, drop_trailing):
    words = line.split(" ")
    if drop_trailing and line:
        while words and words[-1] == "":
            words.pop()
    return words


@pytest.fixture
def lines(spark):
    return spark.createDataFrame([(v,) for v in LINES], "value string").repartition(3)


@pytest.mark.parametrize("drop", [True, False])
def test_counts(lines, drop):
    want = Counter(w for line in LINES for w in _words(line, drop))
    for got in (word_count(tokenize(lines, drop)), word_count_salted(lines, 4, drop),
                word_count_salted(lines, 1, drop), word_count_partitioned(lines, drop)):
        assert {r["word"]: r["cnt"] for r in got.collect()} == want
    assert tuple(doc_word_totals(lines, drop).first()) == (len(LINES), len(want))
    assert avg_word_length(tokenize(lines, drop)).first()[0] == pytest.approx(
        sum(map(len, want)) / len(want))


@pytest.mark.parametrize("line, words", [
    ("", [""]), ("   ", []), (" a", ["", "a"]), ("a ", ["a"]), ("a  b ", ["a", "", "b"])])
def test_trailing_rule(spark, line, words):
    df = spark.createDataFrame([(line,)], "value string")
    assert [r["word"] for r in tokenize(df).collect()] == words


def test_nothing(spark):
    empty = spark.createDataFrame([], "value string")
    assert tuple(doc_word_totals(empty).first()) == (0, 0)
    assert avg_word_length(tokenize(empty)).first()[0] is None
    with pytest.raises(ValueError):
        word_count_salted(empty, 0)


@pytest.mark.parametrize("text", ["", "\n", "a", "a\n", "a\n\n", "\na", "a\r\nb\rc\n", "a\r",
                                  "a\n\r\nb", "\r\r\n"])
def test_lines_are_those_of_a_text_file(spark, tmp_path, text):
    (tmp_path / "f.txt").write_bytes(text.encode())
    df = spark.createDataFrame([(text,)], "text string")
    want = [r["value"] for r in spark.read.text(str(tmp_path / "f.txt")).collect()]
    assert df.select(split_lines(F.col("text"))).first()[0] == want
    assert [r["value"] for r in text_lines(df).collect()] == want
    assert want == re.split("\r\n|\r|\n", text)[:len(want)]
