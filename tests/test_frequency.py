import numpy as np
import pytest
from pyspark.sql import functions as F

from fairstream.functions.hashing import PRIME, bucket, hash_family, residue, sign
from fairstream.operators import sketches as sketches_module
from fairstream.operators.frequency import (
    distinct_count, distinct_items, frequency_summary, hh_avg_rel_error, hh_detail, item_counts,
    max_item, top_k_heavy_hitters,
)
from fairstream.operators.sketches import (
    cm_estimate, cm_sketch, cs_estimate, cs_sketch, merge_sketches, sketch_both, sketch_estimates,
)

# The family of seed 1, as (Count-Min, Count Sketch, sign) pairs per row.
FAMILY = [
    ((1006, 5457), (3908, 7693), (4095, 404)),
    ((645, 1457), (2909, 7190), (8000, 6260)),
    ((1028, 4396), (1963, 3810), (813, 2923)),
    ((3697, 5107), (2397, 1103), (131, 74)),
    ((915, 5046), (539, 3722), (4108, 7722)),
]


def _items(spark, values):
    return spark.createDataFrame([(int(v),) for v in values], "item long").repartition(3)


def _stream(seed=0, n=4000):
    rng = np.random.default_rng(seed)
    values = np.where(rng.random(n) < 0.4, rng.integers(0, 5, n),
                      rng.integers(-10**12, 10**12, n))
    return [int(v) for v in values]


def _model(values, d, w):
    """Both sketches and their estimates, row by row."""
    rows = hash_family(d)
    cm, cs = np.zeros((d, w), int), np.zeros((d, w), int)

    def at(pair, x, width):
        return (pair[0] * x + pair[1]) % PRIME % width

    for x in values:
        for j, r in enumerate(rows):
            cm[j, at(r.cm, x, w)] += 1
            cs[j, at(r.cs, x, w)] += 2 * at(r.sign, x, 2) - 1

    def estimate(x):
        low = min(cm[j, at(r.cm, x, w)] for j, r in enumerate(rows))
        mid = sorted((2 * at(r.sign, x, 2) - 1) * cs[j, at(r.cs, x, w)]
                     for j, r in enumerate(rows))
        if d % 2:
            return int(low), int(mid[d // 2])
        return int(low), int((mid[d // 2 - 1] + mid[d // 2]) / 2)

    return cm, cs, estimate


def test_family():
    assert [tuple(r) for r in hash_family(5)] == FAMILY
    assert hash_family(3) == hash_family(5)[:3]
    assert hash_family(2, seed=7) != hash_family(2)
    with pytest.raises(ValueError):
        hash_family(0)


def test_hash_columns(spark):
    values = [0, 1, 8190, 8191, 2**31 - 1, -1, -(2**63), 2**63 - 1]
    df = _items(spark, values)
    a, b = FAMILY[0][0]
    r = residue(F.col("item"))
    got = df.select("item", bucket(r, (a, b), 100).alias("h"), sign(r, (a, b)).alias("s"))
    for row in got.collect():
        h = (a * row["item"] + b) % PRIME
        assert row["h"] == h % 100 and row["s"] == h % 2 * 2 - 1


def test_exact_statistics(spark):
    df = _items(spark, [5, 5, -2, 9, 9, 9, 7])
    assert {tuple(r) for r in item_counts(df).collect()} == {(5, 2), (-2, 1), (9, 3), (7, 1)}
    assert distinct_items(df).count() == 4
    assert distinct_count(df).first()[0] == 4
    assert max_item(df).first()[0] == 9


@pytest.mark.parametrize("k, want", [
    (1, {3}), (2, {3, 1, 2}), (3, {3, 1, 2}), (4, {3, 1, 2, 4, 5}), (50, {3, 1, 2, 4, 5})])
def test_top_k_keeps_ties(spark, k, want):
    counts = item_counts(_items(spark, [3] * 5 + [1] * 4 + [2] * 4 + [4, 5]))
    assert {r["item"] for r in top_k_heavy_hitters(counts, k).collect()} == want


def test_top_k_of_nothing(spark):
    counts = item_counts(_items(spark, [1]).where("item > 5"))
    assert top_k_heavy_hitters(counts, 3).count() == 0
    with pytest.raises(ValueError):
        top_k_heavy_hitters(counts, 0)


@pytest.mark.parametrize("d, w", [(1, 10), (4, 32), (5, 64), (2, 20_000)])
def test_sketches_and_estimates(spark, monkeypatch, d, w):
    values = _stream()
    df = _items(spark, values)
    cm, cs, estimate = _model(values, d, w)
    sketch = sketch_both(df, d, w).cache()
    for kind, table in (("cm", cm), ("cs", cs)):
        got = np.zeros((d, w), int)
        for r in sketch.where(F.col("kind") == kind).collect():
            got[r["j"], r["col"]] = r["counter"]
        assert (got == table).all()
    # one the sketch never saw, and a null
    others = spark.createDataFrame([(123456789,), (None,)], "item long")
    keys = df.distinct().unionByName(others)
    want = {x: estimate(x) for x in {*values, 123456789}} | {None: (None, None)}
    for limit in (sketches_module.MAX_BROADCAST_COUNTERS, 0):  # broadcast or not
        monkeypatch.setattr(sketches_module, "MAX_BROADCAST_COUNTERS", limit)
        got = {r["item"]: (r["cm"], r["cs"])
               for r in sketch_estimates(keys, sketch, d, w).collect()}
        assert got == want


def test_count_min_never_underestimates(spark):
    counts = item_counts(_items(spark, _stream(1)))
    got = cm_estimate(counts, cm_sketch(counts, 3, 16, weight="cnt"), 3, 16)
    assert got.where("cm < cnt").count() == 0


def test_even_median_is_cut_toward_zero(spark):
    # d=2: the middle two are all there are; find a key whose sum is odd and negative
    values = _stream(2, 500)
    df = _items(spark, values)
    _, _, estimate = _model(values, 2, 3)
    keys = _items(spark, range(200))
    got = {r["item"]: r["cs"] for r in cs_estimate(keys, cs_sketch(df, 2, 3), 2, 3).collect()}
    assert got == {x: estimate(x)[1] for x in range(200)}
    assert any(v < 0 for v in got.values())


def test_weights_and_merge(spark):
    a, b = _items(spark, _stream(3)), _items(spark, _stream(4))
    whole = sketch_both(a.unionByName(b), 3, 50)
    parts = merge_sketches(sketch_both(a, 3, 50), sketch_both(b, 3, 50))
    weighted = sketch_both(item_counts(a.unionByName(b)), 3, 50, weight="cnt")
    assert whole.count() > 0
    for other in (parts, weighted):
        assert whole.exceptAll(other).count() == 0 and other.exceptAll(whole).count() == 0


def test_summary(spark):
    values = _stream(5)
    counts = item_counts(_items(spark, values)).cache()
    _, _, estimate = _model(values, 3, 20)
    detail = {r["item"]: tuple(r)[1:] for r in hh_detail(counts, 3, 20, 4).collect()}
    truth = {x: values.count(x) for x in detail}
    assert len(detail) >= 4
    assert detail == {x: (truth[x], *estimate(x)) for x in detail}
    errors = [np.mean([abs(c - e[i]) / c for c, *e in detail.values()]) for i in (0, 1)]
    assert np.allclose(hh_avg_rel_error(hh_detail(counts, 3, 20, 4)).first(),
                       (len(detail), *errors))
    assert np.allclose(frequency_summary(counts, 3, 20, 4).first(),
                       (len(values), len(set(values)), len(detail), *errors))


def test_summary_of_nothing(spark):
    empty = item_counts(_items(spark, [1]).where("item > 5"))
    assert tuple(frequency_summary(empty, 3, 20, 4).first()) == (0, 0, 0, None, None)
