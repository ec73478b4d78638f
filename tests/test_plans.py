"""The physical plans hold what the operators promise for large inputs."""

import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from fairstream.operators.frequency import item_counts, top_k_heavy_hitters
from fairstream.operators.objectives import fair_objective
from fairstream.operators.sketches import cm_estimate, cm_sketch
from fairstream.operators.wordcount import tokenize, word_count
from fairstream.plans import clustering, frequency, words
from fairstream.session import scratch_dir

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# the operators over documents write tables while they build their plans; tests/llm covers them
OWN = sorted(n for n in contract.queries() if not re.match(r"op\d+_|pipeline$", n))


@pytest.mark.parametrize("name", OWN)
def test_no_cartesian_plan(spark, name):
    text = plan(contract.queries()[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_scan_reads_only_the_columns_used(spark):
    text = plan(clustering.fair_objective_query(spark, FOLDER))
    assert re.search(r"ReadSchema: struct<(l_quantity|l_discount|l_tax|l_linestatus)"
                     r":\w+(,(l_quantity|l_discount|l_tax|l_linestatus):\w+){3}>", text)
    text = plan(frequency.cm_sketch_query(spark, FOLDER))
    assert "ReadSchema: struct<l_partkey:bigint>" in text


def test_objective_stays_in_the_jvm_for_few_centers(spark):
    points = clustering.lineitem_points(spark, FOLDER)
    assert "MapInArrow" not in plan(fair_objective(points, clustering.START))
    assert "MapInArrow" in plan(fair_objective(points, clustering.START * 20))


def test_aggregates_combine_before_the_only_shuffle(spark):
    lines = spark.createDataFrame([("a b",)], "value string")
    text = plan(word_count(tokenize(lines)))
    assert text.count("Exchange") == 1 and "partial_count" in text.split("Exchange")[1]


def test_sketch_shuffles_residues_not_items(spark):
    items = frequency.parts(spark, FOLDER)
    text = plan(cm_sketch(items, 5, 256))
    first = text.split("Exchange")[-1]
    assert "pmod" in first and "partial_count" in first and "stack" not in first.lower()


def test_estimates_do_not_shuffle_the_keys(spark):
    items = frequency.parts(spark, FOLDER)
    keys = spark.range(100).select(F.col("id").alias("item"))
    text = plan(cm_estimate(keys, cm_sketch(items, 5, 256), 5, 256))
    # the keys are the first scan below the broadcast join
    join, _, rest = text.partition("BroadcastHashJoin")
    assert rest and "Exchange" not in join
    assert "Exchange" not in rest[:rest.index("Range (")]


def test_text_is_not_shuffled_before_it_is_split(spark):
    text = plan(words.word_count_query(spark, FOLDER))
    assert "RoundRobin" not in text and text.count("Exchange") == 1


def test_top_k_does_not_sort_all_counts(spark):
    df = top_k_heavy_hitters(item_counts(frequency.parts(spark, FOLDER)), 5)
    text = df._jdf.queryExecution().toString()
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_scratch_lies_under_the_named_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    assert scratch_dir(spark, "x").startswith(base)
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")
