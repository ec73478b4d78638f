import os

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from hypothesis.extra.numpy import arrays
from pyspark import StorageLevel
from pyspark.sql import functions as F

from fairstream.operators import assign as assign_module
from fairstream.operators import kmeans, rounds
from fairstream.operators.assign import (
    MAX_EXPRESSION_TERMS, as_centers, assign, centers_frame, nearest,
)
from fairstream.operators.blocks import pack_points
from fairstream.operators.kmeans import (
    fair_kmeans, fair_kmeans_step, fair_line_search, kmeans_centers, kmeans_init, line_search,
)
from fairstream.operators.moments import (
    fair_cluster_params, group_cluster_moments, group_dispersion,
)
from fairstream.operators.objectives import (
    cluster_stats, compare_centers, fair_objective, group_costs, group_sizes, standard_objective,
)
from fairstream.sources.generators import fair_gap_points
from fairstream.sources.points import labelled_points, read_lines

TRAP = ("0,0,A", "0,0,B", "10,0,A", "12,0,B", "11,3,A")


def _brute(x, centers):
    d = ((x[:, None, :] - centers[None, :, :]) ** 2).sum(axis=2)
    return d.argmin(axis=1), d.min(axis=1)


def _cloud(spark, n=3000, dim=5, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim)).round(3)
    grp = np.where(rng.random(n) < 0.7, "A", "B")
    df = spark.createDataFrame([(i, v.tolist(), str(g)) for i, (v, g) in enumerate(zip(x, grp))],
                               "id int, coords array<double>, grp string").repartition(3)
    return x, grp, df


@pytest.fixture(params=["expressions", "arrow"])
def path(request, monkeypatch):
    """Run with either way of finding the nearest center, whatever K * D is."""
    limit = 10_000 if request.param == "expressions" else 0
    monkeypatch.setattr(assign_module, "MAX_EXPRESSION_TERMS", limit)
    return request.param


@settings(max_examples=200, deadline=None)
@given(arrays(np.int64, st.tuples(st.integers(1, 30), st.just(2)), elements=st.integers(-3, 3)),
       arrays(np.int64, st.tuples(st.integers(1, 9), st.just(2)), elements=st.integers(-3, 3)),
       st.sampled_from([0.0, 1e6]))
def test_nearest_breaks_ties_by_index(x, centers, far):
    x, centers = x + far, centers + far
    cid, d = nearest(x, centers)
    want_cid, want_d = _brute(x, centers)
    assert (cid == want_cid).all() and (d == want_d).all()


def test_assign(spark, path):
    x, _, df = _cloud(spark)
    centers = np.vstack([x[:6], x[2]])  # the last repeats one: never chosen
    got = assign(df, centers).orderBy("id").collect()
    cid, d = _brute(x, centers)
    assert [r["cid"] for r in got] == cid.tolist()
    assert np.allclose([r["sqdist"] for r in got], d)
    assert got[0].asDict().keys() == {"id", "coords", "grp", "cid", "sqdist"}


def test_single_center(spark, path, points):
    assert assign(points("1,2,A"), [(1.0, 0.0)]).select("cid", "sqdist").first() == (0, 4.0)


@pytest.mark.parametrize("line", ["1,2,3,A", "1,A"])
def test_dimension_mismatch(path, points, line):
    with pytest.raises(Exception, match="differ in dimension"):
        standard_objective(points("1,2,A", line), [(0.0, 0.0)]).collect()
    with pytest.raises(Exception, match="differ in dimension"):
        assign(points("1,2,A", line), [(0.0, 0.0)]).collect()


def test_center_arguments(spark):
    with pytest.raises(ValueError):
        as_centers([(1.0, 2.0), (1.0,)])
    with pytest.raises(ValueError):
        as_centers([(1.0, float("nan"))])
    with pytest.raises(ValueError):
        as_centers(spark.createDataFrame([(1, [0.0])], "cid int, coords array<double>"))
    frame = centers_frame(spark, [(1.0, 2.0), (3.0, 4.0)])
    assert as_centers(frame).tolist() == [[1.0, 2.0], [3.0, 4.0]]


def test_objectives(spark, path):
    x, grp, df = _cloud(spark)
    a, b = x[:4], x[10:15]
    da, db = _brute(x, a)[1], _brute(x, b)[1]
    phi = [max(d[grp == g].mean() for g in "AB") for d in (da, db)]
    assert np.isclose(standard_objective(df, a).first()[0], da.mean())
    assert np.isclose(fair_objective(df, a).first()[0], phi[0])
    row = compare_centers(df, a, b).first()
    assert np.allclose(row, [phi[0], phi[1], phi[0] / phi[1]])
    assert phi[0] >= da.mean()
    sizes = {r["grp"]: r["n"] for r in group_costs(df, a).collect()}
    assert sizes == {g: int((grp == g).sum()) for g in "AB"}


def test_cluster_stats(spark, path):
    x, grp, df = _cloud(spark)
    centers = np.vstack([x[:4], [1e6] * 5])
    cid = _brute(x, centers)[0]
    got = cluster_stats(df, centers).collect()
    assert [(r["cid"], r["n_a"], r["n_b"]) for r in got] == [
        (i, int(((cid == i) & (grp == "A")).sum()), int(((cid == i) & (grp == "B")).sum()))
        for i in range(4)]
    assert [list(r["center"]) for r in got] == centers[:4].tolist()


@pytest.mark.parametrize("dim", [5, 40])
def test_moments(spark, path, dim):
    x, grp, df = _cloud(spark, dim=dim)
    x = x + 1e5  # far from the origin, where squares would lose digits
    df = df.withColumn("coords", F.transform("coords", lambda v: v + 1e5))
    centers = x[:4]
    cid = _brute(x, centers)[0]
    for source in (df, pack_points(df, dim)):
        for r in group_cluster_moments(source, centers).collect():
            own = x[(cid == r["cid"]) & (grp == r["grp"])]
            assert r["n"] == len(own)
            assert np.allclose(r["mu"], own.mean(axis=0), rtol=0, atol=1e-9)
            assert np.isclose(r["ssd"], ((own - own.mean(axis=0)) ** 2).sum(), rtol=1e-6)


def test_packed_points_give_the_same_costs(spark):
    x, _, df = _cloud(spark)
    packed = pack_points(df, 5)
    want = {r["grp"]: (r["n"], r["cost0"]) for r in group_costs(df, x[:4]).collect()}
    for r in group_costs(packed, x[:4]).collect():
        assert r["n"] == want[r["grp"]][0] and np.isclose(r["cost0"], want[r["grp"]][1])


def test_params_and_dispersion(spark):
    x, grp, df = _cloud(spark)
    centers = x[:3]
    cid = _brute(x, centers)[0]
    moments = group_cluster_moments(df, centers)
    own_mean = {(c, g): x[(cid == c) & (grp == g)].mean(axis=0) for c in range(3) for g in "AB"}
    spread = {g: np.mean([((x[i] - own_mean[cid[i], g]) ** 2).sum()
                          for i in np.flatnonzero(grp == g)]) for g in "AB"}
    got = {r["grp"]: r["dispersion"] for r in group_dispersion(moments).collect()}
    assert np.isclose(got["A"], spread["A"]) and np.isclose(got["B"], spread["B"])
    for r in fair_cluster_params(moments).collect():
        c = r["cid"]
        assert np.isclose(r["alpha"], ((cid == c) & (grp == "A")).sum() / (grp == "A").sum())
        assert np.isclose(r["beta"], ((cid == c) & (grp == "B")).sum() / (grp == "B").sum())
        assert np.isclose(r["ell"], np.linalg.norm(own_mean[c, "A"] - own_mean[c, "B"]))
        assert np.isclose(r["fixed_a"], spread["A"]) and np.isclose(r["fixed_b"], spread["B"])


def test_line_search_evens_out_the_groups():
    # one cluster, means one apart: the worse group pulls the center until the costs meet
    x = line_search(np.array([1.0]), np.array([1.0]), np.array([1.0]), 0.2, 0.0)
    assert abs((0.2 + x[0] ** 2) - (1 - x[0]) ** 2) < 0.01
    even = line_search(np.array([1.0]), np.array([1.0]), np.array([2.0]), 0.5, 0.5)
    assert even.tolist() == [1.0]


def test_lazy_search_is_the_driver_search(spark):
    x, _, df = _cloud(spark)
    params = fair_cluster_params(group_cluster_moments(df, x[:4])).cache()
    rows = sorted(params.collect(), key=lambda r: r["cid"])
    want = line_search(*[np.array([r[c] for r in rows]) for c in ("alpha", "beta", "ell")],
                       rows[0]["fixed_a"], rows[0]["fixed_b"])
    got = fair_line_search(params).orderBy("cid").collect()
    assert np.allclose([r["x"] for r in got], want)


def test_step_is_one_iteration(spark, path):
    x, _, df = _cloud(spark)
    step = as_centers(fair_kmeans_step(df, x[:4]))
    assert np.allclose(step, fair_kmeans(df, max_iter=1, init_centers=x[:4]))
    assert np.allclose(step, fair_kmeans(df, max_iter=1, init_centers=x[:4], storage=None))


@pytest.mark.parametrize("rounds", [1, 2, 3])
def test_coincident_means(path, points, rounds):
    df = points(*TRAP)
    centers = fair_kmeans(df, max_iter=rounds, init_centers=[(0, 0), (11, 1)])
    assert np.allclose(centers, [(0, 0), (10.69127, 1.30873)], atol=1e-5)
    assert np.isclose(fair_objective(df, centers).first()[0], 1.715446, atol=1e-6)


def test_empty_cluster_keeps_its_center(path, points):
    centers = fair_kmeans(points(*TRAP), max_iter=1, init_centers=[(0, 1), (11, 1), (500, 500)])
    assert np.allclose(centers, [(0, 0), (10.69127, 1.30873), (500, 500)], atol=1e-5)


def test_cluster_of_one_group(path, points):
    df = points("0,0,A", "2,0,A", "10,0,B", "12,0,B")
    centers = fair_kmeans(df, max_iter=1, init_centers=[(1, 1), (11, 1)])
    assert np.allclose(centers, [(1, 0), (11, 0)])


def test_missing_group(path, points):
    df = points("0,0,A", "2,0,A")
    assert fair_objective(df, [(0.0, 0.0)]).first()[0] == 2.0
    assert group_sizes(df).first() == (2, 2, 0)
    with pytest.raises(ValueError, match="each group"):
        fair_kmeans(df, max_iter=1, init_centers=[(0, 0)])


def test_no_points_no_centers(path, points):
    df = points("0,0,A").where("grp = 'B'")
    assert standard_objective(df, [(0.0, 0.0)]).first()[0] is None
    assert fair_objective(df, [(0.0, 0.0)]).first()[0] is None
    assert standard_objective(points("0,0,A"), []).first()[0] == 0.0
    assert fair_objective(points("0,0,A"), []).first()[0] == 0.0
    assert cluster_stats(points("0,0,A"), []).count() == 0


def test_fewer_distinct_points_than_centers(points):
    df = points(*["1,1,A"] * 5, *["2,2,B"] * 5)
    assert sorted(map(tuple, kmeans_centers(df, 4, 5))) == [(1, 1), (2, 2)]
    assert len(fair_kmeans(df, k=4, max_iter=2)) == 2
    assert len(kmeans_init(df, 4)) == 2


def test_one_center_is_the_mean(points):
    assert np.allclose(kmeans_centers(points("0,0,A", "2,4,B", "4,2,B"), 1, 5), [(2, 2)])


def test_lloyd_from_start_matches_numpy(spark):
    x, _, df = _cloud(spark, n=500)
    centers = x[:4].copy()
    for _ in range(5):
        cid = _brute(x, centers)[0]
        centers = np.array([x[cid == i].mean(axis=0) for i in range(4)])
    assert np.allclose(kmeans_centers(df, 4, 5, init_centers=x[:4], tol=0.0), centers)


def test_standard_kmeans_finds_separated_clusters(spark):
    rng = np.random.default_rng(3)
    sites = np.array([(0, 0), (100, 0), (0, 100), (100, 100)])
    x = np.repeat(sites, 50, axis=0) + rng.normal(size=(200, 2))
    df = spark.createDataFrame([(v.tolist(), "A") for v in x],
                               "coords array<double>, grp string")
    got = sorted(kmeans_centers(df, 4, 20, seed=1).round(0).tolist())
    assert got == sorted(sites.tolist())


@pytest.mark.parametrize("k", [4, 20, 39])
def test_standard_centers_are_unfair_on_the_gap_points(spark, k):
    """One B point is alone in the crowd's cluster; meeting in the middle quarters its cost."""
    df = fair_gap_points(spark, 2000, k).cache()
    start = [(0.0, 99.0)] + [(500.0 * i, 0.0) for i in range(1, k)]
    standard = kmeans_centers(df, k, 20, init_centers=start)
    fair = fair_kmeans(df, max_iter=5, init_centers=start)
    row = compare_centers(df, standard, fair).first()
    assert 3.9 < row["ratio"] < 4.1


LABELLED = [((0.0, 0.0), "A"), ((1.0, 0.0), "B"), ((0.0, 1.0), "C"), ((2.0, 0.0), None),
            ((5.0, 5.0), "A"), ((5.5, 5.0), "")]


@pytest.mark.parametrize("far", [0, 30])
def test_answers_do_not_depend_on_the_number_of_centers(spark, far):
    """Any label but A is group B, by arithmetic as well as by NumPy."""
    df = spark.createDataFrame(LABELLED, "coords array<double>, grp string")
    centers = [(0.0, 0.0), (5.0, 5.0)] + [(1e6 + i, 1e6) for i in range(far)]
    assert (len(centers) * 2 > MAX_EXPRESSION_TERMS) == bool(far)
    assert sorted(map(tuple, group_costs(df, centers).collect())) == [("A", 2, 0.0), ("B", 4, 6.25)]
    moments = {(r["cid"], r["grp"]): (r["n"], list(r["mu"]))
               for r in group_cluster_moments(df, centers).collect()}
    assert moments == {(0, "A"): (1, [0, 0]), (0, "B"): (3, [1, pytest.approx(1 / 3)]),
                       (1, "A"): (1, [5, 5]), (1, "B"): (1, [5.5, 5])}
    assert [(r["n_a"], r["n_b"]) for r in cluster_stats(df, centers).collect()] == [(1, 3), (1, 1)]
    assert fair_objective(df, centers).first()[0] == pytest.approx(6.25 / 4)
    assert group_sizes(df).first() == (6, 2, 4)
    assert sorted(r["cid"] for r in assign(df, centers).collect()) == [0, 0, 0, 0, 1, 1]


@pytest.mark.parametrize("far", [0, 30])
@pytest.mark.parametrize("coords", [[None, 1.0], [1.0, None], None, [1.0], [1.0, 2.0, 3.0]])
def test_missing_coordinates_are_errors(spark, far, coords):
    df = spark.createDataFrame([(coords, "A")], "coords array<double>, grp string")
    centers = [(0.0, 0.0), (5.0, 5.0)] + [(1e6 + i, 1e6) for i in range(far)]
    for query in (assign, fair_objective, group_cluster_moments):
        with pytest.raises(Exception):
            query(df, centers).collect()


def test_centers_have_one_limit(spark, monkeypatch):
    monkeypatch.setattr("fairstream.operators.assign.MAX_CENTERS", 3)
    for centers in ([(float(i),) for i in range(4)],
                    spark.range(4).selectExpr("cast(id as int) cid", "array(double(id)) coords")):
        with pytest.raises(ValueError, match="more than 3 centers"):
            as_centers(centers)


def test_k_must_agree_with_the_start(points):
    df = points("0,0,A", "2,4,B", "4,2,B")
    for run in (lambda: kmeans_centers(df, 3, 1, init_centers=[(0, 0), (1, 1)]),
                lambda: fair_kmeans(df, k=3, init_centers=[(0, 0), (1, 1)])):
        with pytest.raises(ValueError, match="2 starting centers for k = 3"):
            run()
    with pytest.raises(ValueError, match="no points"):
        kmeans_centers(df.limit(0), 1, 5)


def test_text_file_to_fair_centers(spark, tmp_path):
    """From a file of lines on, against numbers worked out by NumPy from the same points."""
    rng = np.random.default_rng(11)
    x = np.round(np.concatenate([rng.normal((0, 0), 1, (60, 2)), rng.normal((8, 1), 1, (40, 2)),
                                 rng.normal((3, 9), 1, (30, 2))]), 4)
    is_a = rng.random(len(x)) < 0.7
    (tmp_path / "points.csv").write_text("".join(
        f"{a},{b},{'A' if g else 'B'}\n" for (a, b), g in zip(x, is_a)))
    df = labelled_points(read_lines(spark, str(tmp_path / "points.csv")))
    centers = np.array([(0.0, 0.5), (7.0, 1.0), (3.0, 8.0)])
    d = ((x[:, None] - centers) ** 2).sum(axis=2)
    cid, least = d.argmin(axis=1), d.min(axis=1)
    assert group_sizes(df).first() == (130, is_a.sum(), (~is_a).sum())
    assert standard_objective(df, centers).first()[0] == pytest.approx(least.mean())
    assert fair_objective(df, centers).first()[0] == pytest.approx(
        max(least[is_a].mean(), least[~is_a].mean()))
    assert [(r["n_a"], r["n_b"]) for r in cluster_stats(df, centers).collect()] == [
        ((is_a & (cid == i)).sum(), (~is_a & (cid == i)).sum()) for i in range(3)]
    # one fair step: the best point of each segment between the group means, by a fine grid
    mean = [[x[(cid == i) & g].mean(axis=0) for i in range(3)] for g in (is_a, ~is_a)]
    share = [[((cid == i) & g).sum() / g.sum() for i in range(3)] for g in (is_a, ~is_a)]
    fixed = [sum(((x[(cid == i) & g] - m[i]) ** 2).sum() for i in range(3)) / g.sum()
             for g, m in zip((is_a, ~is_a), mean)]
    ell = np.array([np.linalg.norm(a - b) for a, b in zip(*mean)])
    step = fair_kmeans(df, max_iter=1, init_centers=centers)
    at = [np.linalg.norm(step[i] - mean[0][i]) / ell[i] for i in range(3)]

    def worse(w):
        w = np.asarray(w)
        return max(fixed[0] + (share[0] * (w * ell) ** 2).sum(),
                   fixed[1] + (share[1] * ((1 - w) * ell) ** 2).sum())

    grid = min(worse([(1 - g) * share[1][i] / (g * share[0][i] + (1 - g) * share[1][i])
                      for i in range(3)]) for g in np.linspace(1e-6, 1 - 1e-6, 20_001))
    assert worse(at) == pytest.approx(grid, rel=1e-3)


@pytest.mark.skipif("GOLDEN_POINTS" not in os.environ,
                    reason="GOLDEN_POINTS: path of the published 1012-point city sample")
def test_published_sample(spark):
    df = labelled_points(read_lines(spark, os.environ["GOLDEN_POINTS"]))
    assert group_sizes(df).first() == (1012, 782, 230)
    runs = [
        ([(40.750721, -73.980436), (40.724214, -74.193689), (40.779300, -73.428700),
          (40.663394, -73.786612)], "0.002035", "0.002653",
         [(749, 209), (22, 14), (1, 1), (10, 6)]),
        ([(40.749035, -73.984431), (40.873440, -74.192170), (40.693363, -74.178147),
          (40.746095, -73.830627)], "0.001909", "0.002407",
         [(725, 192), (7, 3), (19, 11), (31, 24)]),
    ]
    for centers, delta, phi, counts in runs:
        assert f"{standard_objective(df, centers).first()[0]:.6f}" == delta
        assert f"{fair_objective(df, centers).first()[0]:.6f}" == phi
        assert [(r["n_a"], r["n_b"]) for r in cluster_stats(df, centers).collect()] == counts
    start = [(40.7523488008342, -73.97825318039625), (40.72554857142857, -74.19309142857144),
             (40.7793, -73.42869999999999), (40.656025, -73.77448749999999)]
    fair = fair_kmeans(df, max_iter=20, init_centers=start)
    assert np.allclose(fair, [(40.735974, -73.986421), (40.724439, -74.193698),
                              (40.776139, -73.421235), (40.657238, -73.790808)], atol=1e-6)
    assert np.isclose(fair_objective(df, fair).first()[0], 0.002275743, atol=1e-9)
    one_part = df.coalesce(1)
    assert np.allclose(kmeans_centers(one_part, 4, 20, seed=1), runs[0][0], atol=1e-6)


def site_points(spark, n, sites, partitions):
    """Points around sites, every eleventh of group B and a little aside."""
    pid = F.col("id")
    around = [F.pmod(F.xxhash64(pid % sites, F.lit(d)), F.lit(1000)) / 10.0
              + F.pmod(F.xxhash64(pid, F.lit(100 + d)), F.lit(4001)) / 1000.0 for d in range(5)]
    return spark.range(0, n, 1, partitions).select(
        F.array(*[a + F.when(pid % 11 == 0, 3.0).otherwise(0.0) for a in around]).alias("coords"),
        F.when(pid % 11 == 0, "B").otherwise("A").alias("grp"))


def plain_lloyd(x, centers, rounds):
    centers = centers.copy()
    for _ in range(rounds):
        cid = ((x[:, None, :] - centers[None, :, :]) ** 2).sum(axis=2).argmin(axis=1)
        for c in np.unique(cid):
            centers[c] = x[cid == c].mean(axis=0)
    return centers


def test_rounds_skip_most_distances(spark):
    points = site_points(spark, 20_000, 100, 4).persist()
    x = np.array([r[0] for r in points.select("coords").collect()])
    centers = kmeans_init(points, 100)
    plain = plain_lloyd(x, centers, 8)
    loop = rounds.Loop(points, 5, StorageLevel.MEMORY_AND_DISK)
    for _ in range(8):
        moments = loop.moments(centers)
        assert moments.n.sum() == loop.n == 20_000
        centers = kmeans._pooled_means(moments, centers)
    loop.close()
    points.unpersist()
    np.testing.assert_allclose(centers, plain, rtol=0, atol=1e-9)
    assert loop.looked[0] == 20_000
    assert max(loop.looked[2:]) < 0.3 * 20_000


def test_centers_do_not_depend_on_the_partitioning(spark):
    x = site_points(spark, 3000, 12, 1)
    start = [r[0] for r in x.limit(12).collect()]
    few = [kmeans_centers(site_points(spark, 3000, 12, p).orderBy(F.xxhash64("coords", F.lit(p))),
                          12, 100, init_centers=start, tol=0.0, storage=s)
           for p, s in ((1, StorageLevel.MEMORY_AND_DISK), (7, StorageLevel.DISK_ONLY), (3, None))]
    for other in few[1:]:
        assert (few[0] == other).all()
    once = kmeans_centers(x, 12, 1, init_centers=few[0], tol=0.0)
    assert (once == few[0]).all()  # a fixed point, bit by bit
    fair = [fair_kmeans(site_points(spark, 3000, 12, p), max_iter=5, init_centers=start)
            for p in (1, 6)]
    assert (fair[0] == fair[1]).all()


def test_exact_sums_of_any_size():
    rng = np.random.default_rng(3)
    for scale in (1e-300, 1e-9, 1.0, 1e12, 1e300):
        values = rng.normal(size=5000) * scale
        exponent = rounds.grid(np.abs(values).max())
        sums = rounds.ExactSums(3, [exponent])
        key = rng.integers(0, 3, 5000)
        for part in np.array_split(np.arange(5000), 7):
            sums.add(key[part], 0, values[part])
        batch = sums.batch().to_pydict()
        whole = np.rint(np.ldexp(values, exponent)).astype(np.int64)
        assert [(h << 40) + low for h, low in zip(batch["high"], batch["low"])] \
            == [sum(whole[key == k].tolist()) for k in batch["key"]]


def test_loop_on_no_points_and_zeros(spark, points):
    empty = points("0,0,A").where("grp = 'none'")
    assert len(rounds.Loop(empty, 2, StorageLevel.MEMORY_ONLY).moments(np.zeros((2, 2))).n) == 0
    zeros = rounds.Loop(points("0,0,A", "0,0,B"), 2, None).moments(np.zeros((1, 2)))
    assert zeros.n.tolist() == [1, 1] and (zeros.mu == 0).all()


def test_packed_points_are_worked_on_in_parts():
    """What a task holds of a batch of packed rows does not grow with the batch."""
    import pyarrow as pa

    from fairstream.operators.blocks import _read_packed

    def largest(rows):
        x = [np.full((64, 2), float(i)).tobytes() for i in range(rows)]
        batch = pa.RecordBatch.from_arrays(
            [pa.array(x, pa.binary()), pa.array([b"\1" * 64] * rows, pa.binary())],
            ["coords", "flags"])
        parts = list(_read_packed([batch.slice(1)], 2))
        assert [v for x, _ in parts for v in x[::64, 0]] == list(range(1, rows))
        assert sum(len(flag) for _, flag in parts) == 64 * (rows - 1)
        return max(len(x) for x, _ in parts)

    assert largest(10_000) == largest(5_000)
