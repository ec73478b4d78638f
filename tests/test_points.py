import math

import pytest
from pyspark.sql import functions as F

from fairstream.sources.generators import fair_balanced_points, fair_gap_points
from fairstream.sources.parsing import parse_items
from fairstream.sources.points import (
    format_points, labelled_points, labelled_points_tolerant, read_lines, write_points,
)


def _rows(df):
    return [(list(r["coords"]), r["grp"]) for r in df.collect()]


@pytest.mark.parametrize("line, coords, grp", [
    ("1.5,2,A", [1.5, 2.0], "A"),
    ("1,2,B", [1.0, 2.0], "B"),
    ("1,2,a", [1.0, 2.0], "B"),
    ("1,2, A", [1.0, 2.0], "B"),
    ("1,2", [1.0], "B"),
    ("1,2,A,", [1.0, 2.0], "A"),
    ("1,2,A,,,", [1.0, 2.0], "A"),
    ("-1e3,2,3,4,A", [-1000.0, 2.0, 3.0, 4.0], "A"),
    ("A", [], "A"),
])
def test_parse(points, line, coords, grp):
    assert _rows(points(line)) == [(coords, grp)]


@pytest.fixture(params=["true", "false"])
def ansi(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield
    spark.conf.set("spark.sql.ansi.enabled", before)


@pytest.mark.parametrize("line", ["x,2,A", "1,2,A,9", "1,,A", ",,,"])
def test_parse_rejects(points, ansi, line):
    assert _rows(points("1,2,A")) == [([1.0, 2.0], "A")]
    with pytest.raises(Exception):
        points(line).collect()


def test_items(spark, ansi):
    lines = spark.createDataFrame([("5",), ("-7",), (None,)], "value string")
    assert [r["item"] for r in parse_items(lines).collect()] == [5, -7, None]
    with pytest.raises(Exception):
        parse_items(spark.createDataFrame([("5.5",)], "value string")).collect()


def test_tolerant(spark):
    lines = spark.createDataFrame(
        [("1,2",), ("1,2,A,",), ("1,2,A,9",), ("3,4,C",), ("",)], "value string")
    assert _rows(labelled_points_tolerant(lines)) == [
        ([1.0, 2.0], "A"), ([1.0, 2.0], "A"), ([3.0, 4.0], "C")]
    with pytest.raises(Exception):
        labelled_points_tolerant(spark.createDataFrame([("x,2,A",)], "value string")).collect()


def test_text_round_trip(spark, points, tmp_path):
    source = points("40.7267,-74.0345,B", "0.00005,1,A")
    assert [r[0] for r in format_points(source).collect()] == [
        "40.7267,-74.0345,B", "0.0001,1.0000,A"]
    write_points(source, str(tmp_path / "out"))
    back = labelled_points(read_lines(spark, str(tmp_path / "out"), partitions=3))
    assert sorted(_rows(back)) == [([0.0001, 1.0], "A"), ([40.7267, -74.0345], "B")]


def test_gap_points(spark):
    n, k = 1000, 7
    df = fair_gap_points(spark, n, k).cache()
    rows = {r["point_id"]: r for r in df.collect()}
    assert len(rows) == n
    assert [i for i, r in rows.items() if r["grp"] == "B"] == [n - k]
    assert rows[n - k]["coords"] == [0.0, 0.0]
    assert [rows[n - k + i]["coords"] for i in range(1, k)] == [[500.0 * i, 0.0]
                                                               for i in range(1, k)]
    crowd = [rows[i]["coords"] for i in range(n - k)]
    for axis, center in ((0, 0.0), (1, 100.0)):
        values = [c[axis] for c in crowd]
        mean = sum(values) / len(values)
        var = sum((v - mean) ** 2 for v in values) / len(values)
        assert abs(mean - center) < 5 / math.sqrt(len(values))
        assert 0.8 < var < 1.2
    other = fair_gap_points(spark, n, k).repartition(13)
    assert other.exceptAll(df).count() == 0
    assert fair_gap_points(spark, n, k, seed=2).exceptAll(df).count() == n - k


def test_balanced_points(spark):
    n, k = 103, 10
    df = fair_balanced_points(spark, n, k, big_radius=0.0)
    sites = {(r["x"], r["grp"]): r["n"] for r in df.groupBy(
        F.col("coords")[0].alias("x"), "grp").agg(F.count("*").alias("n")).collect()}
    assert sites == {(500.0 * i, g): 1 if g == "B" else 9 + (i < 3)
                     for i in range(k) for g in "AB"}


@pytest.mark.parametrize("make, n, k", [
    (fair_gap_points, 5, 0), (fair_gap_points, 5, 6), (fair_balanced_points, 10, 5),
    (fair_balanced_points, 10, 0)])
def test_generator_arguments(spark, make, n, k):
    with pytest.raises(ValueError):
        make(spark, n, k)
