"""Registered queries over points, each beside the SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fairstream.operators.assign import assign, centers_frame
from fairstream.operators.kmeans import (
    fair_kmeans, fair_kmeans_step, fair_line_search, kmeans_centers, kmeans_init,
)
from fairstream.operators.moments import (
    fair_cluster_params, group_cluster_moments, group_dispersion,
)
from fairstream.operators.objectives import (
    cluster_stats, compare_centers, fair_objective, group_sizes, standard_objective,
)
from fairstream.sources.points import (
    format_points, labelled_points, labelled_points_tolerant,
)
from fairstream.sources.tables import read_table

START = [(10.5, 2.5, 2.5), (23.25, 7.25, 3.75), (34.75, 3.25, 6.25), (44.5, 6.5, 1.5)]
OTHER = [(8.67, 4.78, 3.95), (22.94, 5.48, 3.91), (34.36, 4.48, 4.37), (45.01, 5.23, 3.8)]
ROUNDS = 3


# ---------------------------------------------------------------- inputs

def lineitem_points(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.array(F.col("l_quantity"), F.col("l_discount") * 100, F.col("l_tax") * 100)
        .alias("coords"),
        F.when(F.col("l_linestatus") == "O", "A").otherwise("B").alias("grp"))


def embedding_points(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "embeddings").select(
        "vec_id", "label", F.col("embedding").cast("array<double>").alias("coords"),
        F.when(F.col("label") < 5, "A").otherwise("B").alias("grp"))


def embedding_centers(points: DataFrame) -> DataFrame:
    """One center per label: the mean of its vectors, to six places."""
    dims = len(points.select("coords").head()[0])
    x = F.col("coords")
    means = points.groupBy("label").agg(*[F.avg(x[d]).alias(f"m{d}") for d in range(dims)])
    return means.select(F.col("label").alias("cid"),
                        F.array(*[F.round(f"m{d}", 6) for d in range(dims)]).alias("coords"))


def customer_points(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "customer").select(
        F.array("c_acctbal", F.col("c_nationkey").cast("double")).alias("coords"),
        F.when(F.col("c_mktsegment") == "BUILDING", "A").otherwise("B").alias("grp"))


def customer_lines(spark: SparkSession, folder: str, label: Column) -> DataFrame:
    return read_table(spark, folder, "customer").select(
        "c_custkey", F.concat_ws(",", "c_acctbal", "c_nationkey", label).alias("value"))


def _rounded(df: DataFrame, array: str, prefix: str, dims: int) -> DataFrame:
    x = F.col(array)
    return df.withColumns({f"{prefix}{d}": F.round(x[d], 6) for d in range(dims)}).drop(array)


# ---------------------------------------------------------------- queries

def parse_points(spark, folder):
    label = F.when(F.col("c_mktsegment") == "BUILDING", "A") \
        .when(F.col("c_mktsegment") == "MACHINERY", "a") \
        .when(F.col("c_mktsegment") == "FURNITURE", "").otherwise(F.col("c_mktsegment"))
    points = labelled_points(customer_lines(spark, folder, label))
    x = F.col("coords")
    return points.select("c_custkey", F.size(x).alias("dims"), F.get(x, F.lit(0)).alias("x0"),
                         F.get(x, F.lit(1)).alias("x1"), "grp")


def parse_points_tolerant(spark, folder):
    # a null label leaves a line of two fields
    label = F.when(F.col("c_mktsegment") == "BUILDING", "A,extra") \
        .when(F.col("c_mktsegment") != "FURNITURE", F.col("c_mktsegment"))
    points = labelled_points_tolerant(customer_lines(spark, folder, label))
    return points.select("c_custkey", F.col("coords")[0].alias("x0"),
                         F.col("coords")[1].alias("x1"), "grp")


def format_points_query(spark, folder):
    return format_points(customer_points(spark, folder))


def nearest_center(spark, folder):
    return assign(lineitem_points(spark, folder), START).select(
        "l_orderkey", "l_linenumber", "l_partkey", "cid", F.round("sqdist", 6).alias("sqdist"))


def nearest_center_embeddings(spark, folder):
    points = embedding_points(spark, folder)
    return assign(points, embedding_centers(points)).select(
        "vec_id", "cid", F.round("sqdist", 6).alias("sqdist"))


def group_sizes_query(spark, folder):
    return group_sizes(lineitem_points(spark, folder))


def standard_objective_query(spark, folder):
    return standard_objective(lineitem_points(spark, folder), START) \
        .select(F.round("delta", 6).alias("delta"))


def fair_objective_query(spark, folder):
    return fair_objective(lineitem_points(spark, folder), START) \
        .select(F.round("phi", 6).alias("phi"))


def fair_objective_embeddings(spark, folder):
    points = embedding_points(spark, folder)
    return fair_objective(points, embedding_centers(points)).select(F.round("phi", 6).alias("phi"))


def compare_centers_query(spark, folder):
    out = compare_centers(lineitem_points(spark, folder), START, OTHER)
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


def cluster_stats_query(spark, folder):
    return _rounded(cluster_stats(lineitem_points(spark, folder), START), "center", "c", 3)


def group_cluster_moments_query(spark, folder):
    out = group_cluster_moments(lineitem_points(spark, folder), START)
    return _rounded(out.withColumn("ssd", F.round("ssd", 3)), "mu", "mu", 3)


def fair_cluster_params_query(spark, folder):
    out = fair_cluster_params(group_cluster_moments(lineitem_points(spark, folder), START))
    out = _rounded(_rounded(out, "mu_a", "mu_a", 3), "mu_b", "mu_b", 3)
    return out.withColumns({c: F.round(c, 6) for c in
                            ("alpha", "beta", "ell", "fixed_a", "fixed_b")})


def group_dispersion_query(spark, folder):
    out = group_dispersion(group_cluster_moments(lineitem_points(spark, folder), START))
    return out.withColumn("dispersion", F.round("dispersion", 6))


def fair_line_search_query(spark, folder):
    moments = group_cluster_moments(lineitem_points(spark, folder), START)
    return fair_line_search(fair_cluster_params(moments)).withColumn("x", F.round("x", 6))


def fair_kmeans_step_query(spark, folder):
    return _rounded(fair_kmeans_step(lineitem_points(spark, folder), START), "coords", "c", 3)


def fair_kmeans_step_embeddings(spark, folder):
    points = embedding_points(spark, folder)
    return _rounded(fair_kmeans_step(points, embedding_centers(points)), "coords", "c", 64)


def fair_kmeans_query(spark, folder):
    centers = fair_kmeans(lineitem_points(spark, folder), max_iter=ROUNDS, init_centers=START)
    return _rounded(centers_frame(spark, centers), "coords", "c", 3)


def kmeans_from_start(spark, folder):
    centers = kmeans_centers(lineitem_points(spark, folder), 4, ROUNDS, init_centers=START,
                             tol=0.0)
    return _rounded(centers_frame(spark, centers), "coords", "c", 3)


def kmeans_standard(spark, folder):
    """What the points alone determine of a standard k-means that ran to its fixed point.

    Only there is every center the mean of its own points, so that the centers weighed by their
    sizes average to the mean of all points. The start is drawn at random.
    """
    points = lineitem_points(spark, folder)
    start = kmeans_init(points, 4, seed=1)
    centers = kmeans_centers(points, 4, 1000, init_centers=start, tol=0.0)
    sizes = cluster_stats(points, centers).withColumn("n", F.col("n_a") + F.col("n_b"))
    total = standard_objective(points, centers).select("delta")
    before = standard_objective(points, start).select(F.col("delta").alias("start"))
    found = sizes.agg(
        F.count(F.lit(1)).alias("clusters"), F.sum("n").alias("points"),
        *(F.round(F.sum(F.col("center")[d] * F.col("n")) / F.sum("n"), 3).alias(f"mean{d}")
          for d in range(3)))
    return found.withColumn("no_worse", total.scalar() <= before.scalar() * (1 + 1e-9))


def kmeans_init_count(spark, folder):
    """The number of k-means|| starting centers, none of them equal."""
    centers = kmeans_init(lineitem_points(spark, folder), 4, seed=1)
    return centers_frame(spark, centers).agg(F.count_distinct("coords").alias("centers"))


def _segment_points(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with the raw market segment as label: one of them is A, all others are not."""
    segment = F.when(F.col("c_mktsegment") == "BUILDING", "A") \
        .when(F.col("c_mktsegment") != "FURNITURE", F.col("c_mktsegment"))
    return read_table(spark, folder, "customer").select(
        F.array(F.col("c_acctbal") / 100, F.col("c_nationkey").cast("double")).alias("coords"),
        segment.alias("grp"))


def _segment_moments(spark: SparkSession, folder: str, k: int) -> DataFrame:
    """Means of few amounts in cents often lie halfway between two roundings; a billionth more
    decides these alike wherever they are summed up."""
    out = group_cluster_moments(_segment_points(spark, folder), segment_centers(k))
    return _rounded(out.withColumns({
        "ssd": F.round("ssd", 3), "mu": F.transform("mu", lambda m: m + 1e-9)}), "mu", "mu", 2)


def segment_centers(k: int) -> list[tuple[float, float]]:
    return [(-10.0 + 110.0 * i / k, float(7 * i % 25)) for i in range(k)]


def segment_moments_few(spark, folder):
    return _segment_moments(spark, folder, 4)


def segment_moments_many(spark, folder):
    return _segment_moments(spark, folder, 40)


QUERIES = {
    "parse_points": parse_points,
    "parse_points_tolerant": parse_points_tolerant,
    "format_points": format_points_query,
    "nearest_center": nearest_center,
    "nearest_center_embeddings": nearest_center_embeddings,
    "group_sizes": group_sizes_query,
    "standard_objective": standard_objective_query,
    "fair_objective": fair_objective_query,
    "fair_objective_embeddings": fair_objective_embeddings,
    "compare_centers": compare_centers_query,
    "cluster_stats": cluster_stats_query,
    "group_cluster_moments": group_cluster_moments_query,
    "fair_cluster_params": fair_cluster_params_query,
    "group_dispersion": group_dispersion_query,
    "fair_line_search": fair_line_search_query,
    "fair_kmeans_step": fair_kmeans_step_query,
    "fair_kmeans_step_embeddings": fair_kmeans_step_embeddings,
    "fair_kmeans": fair_kmeans_query,
    "kmeans_from_start": kmeans_from_start,
    "kmeans_standard": kmeans_standard,
    "kmeans_init": kmeans_init_count,
    "segment_moments_few": segment_moments_few,
    "segment_moments_many": segment_moments_many,
}


# ---------------------------------------------------------------- SQL

def _each(dims: int, text: str, sep: str = ", ") -> str:
    return sep.join(text.format(d=d) for d in range(dims))


LINEITEM = """p AS MATERIALIZED (SELECT row_number() OVER () AS rid, l_orderkey, l_linenumber,
    l_partkey, l_quantity AS x0, l_discount * 100 AS x1, l_tax * 100 AS x2,
    CASE WHEN l_linestatus = 'O' THEN 'A' ELSE 'B' END AS grp FROM lineitem)"""

EMBEDDINGS = f"""p AS MATERIALIZED (SELECT vec_id AS rid, label,
    {_each(64, "CAST(embedding[{d} + 1] AS DOUBLE) AS x{d}")},
    CASE WHEN label < 5 THEN 'A' ELSE 'B' END AS grp FROM embeddings),
c0 AS MATERIALIZED (SELECT label AS cid, {_each(64, "round(avg(x{d}), 6) AS c{d}")}
    FROM p GROUP BY label)"""


def _literal(name: str, centers) -> str:
    dims = len(centers[0])
    rows = ", ".join(f"({i}, {', '.join(f'CAST({v} AS DOUBLE)' for v in c)})"
                     for i, c in enumerate(centers))
    return f"{name}(cid, {_each(dims, 'c{d}')}) AS (VALUES {rows})"


def _near(dims: int, centers: str, name: str) -> str:
    """Every point's nearest center: least (distance, index)."""
    distance = _each(dims, "(x{d} - c{d}) * (x{d} - c{d})", " + ")
    return f"""{name} AS MATERIALIZED (SELECT p.*, m.d AS sqdist, m.cid AS cid FROM p JOIN (
    SELECT rid, min({{'d': {distance}, 'cid': cid}}) AS m
    FROM p CROSS JOIN {centers} GROUP BY rid) USING (rid))"""


def _moments(dims: int, near: str, name: str) -> str:
    spread = _each(dims, "var_pop(x{d})", " + ")
    return f"""{name} AS MATERIALIZED (SELECT cid, grp, count(*) AS n,
    {_each(dims, "avg(x{d}) AS mu{d}")}, count(*) * ({spread}) AS ssd
    FROM {near} GROUP BY cid, grp)"""


def _params(dims: int, moments: str, name: str) -> str:
    gap = _each(dims, "(a{d} - b{d}) * (a{d} - b{d})", " + ")
    return f"""{name} AS MATERIALIZED (SELECT cid, na / ta AS alpha, nb / tb AS beta,
    sqrt({gap}) AS ell, sa / ta AS fixed_a, sb / tb AS fixed_b, na, nb,
    {_each(dims, "a{d}")}, {_each(dims, "b{d}")} FROM (
    SELECT cid, coalesce(sum(n) FILTER (grp = 'A'), 0) AS na,
        coalesce(sum(n) FILTER (grp = 'B'), 0) AS nb,
        {_each(dims, "max(mu{d}) FILTER (grp = 'A') AS a{d}")},
        {_each(dims, "max(mu{d}) FILTER (grp = 'B') AS b{d}")}
    FROM {moments} GROUP BY cid) CROSS JOIN (
    SELECT sum(n) FILTER (grp = 'A') AS ta, sum(n) FILTER (grp = 'B') AS tb,
        sum(ssd) FILTER (grp = 'A') AS sa, sum(ssd) FILTER (grp = 'B') AS sb FROM {moments}))"""


def _search(params: str, name: str) -> str:
    """The ten search rounds; nine of them move gamma before x is read off."""
    x = "(1 - gamma) * beta * coalesce(ell, 0) / (gamma * alpha + (1 - gamma) * beta)"
    parts = [f"{name}_g0 AS (SELECT CAST(0.5 AS DOUBLE) AS gamma, false AS done)"]
    step = 0.5
    for t in range(1, 10):
        step /= 2
        parts.append(f"""{name}_f{t} AS MATERIALIZED (SELECT gamma, done,
    any_value(fixed_a) + sum(alpha * x * x) AS fa,
    any_value(fixed_b) + sum(beta * (coalesce(ell, 0) - x) * (coalesce(ell, 0) - x)) AS fb
    FROM (SELECT *, {x} AS x FROM {params} CROSS JOIN {name}_g{t - 1}) GROUP BY gamma, done)""")
        parts.append(f"""{name}_g{t} AS MATERIALIZED (SELECT done OR fa = fb AS done,
    CASE WHEN done OR fa = fb THEN gamma WHEN fa > fb THEN gamma + {step}
    ELSE gamma - {step} END AS gamma FROM {name}_f{t})""")
    parts.append(f"""{name} AS MATERIALIZED (SELECT *, {x} AS x
    FROM {params} CROSS JOIN {name}_g9)""")
    return ",\n".join(parts)


def _moved(dims: int, search: str, old: str, name: str) -> str:
    one = ("CASE WHEN s.cid IS NULL THEN o.c{d} WHEN na = 0 THEN b{d} "
           "WHEN nb = 0 OR ell = 0 THEN a{d} ELSE ((ell - x) * a{d} + x * b{d}) / ell END AS c{d}")
    return f"""{name} AS MATERIALIZED (SELECT o.cid AS cid, {_each(dims, one)}
    FROM {old} o LEFT JOIN {search} s ON o.cid = s.cid)"""


def _fair_step(dims: int, old: str, new: str) -> str:
    return ",\n".join([
        _near(dims, old, f"{new}_near"), _moments(dims, f"{new}_near", f"{new}_m"),
        _params(dims, f"{new}_m", f"{new}_k"), _search(f"{new}_k", f"{new}_s"),
        _moved(dims, f"{new}_s", old, new)])


def _lloyd_step(dims: int, old: str, new: str) -> str:
    return f"""{_near(dims, old, f"{new}_near")},
{new} AS MATERIALIZED (SELECT o.cid AS cid, {_each(dims, "coalesce(m{d}, c{d}) AS c{d}")}
    FROM {old} o LEFT JOIN (SELECT cid, {_each(dims, "avg(x{d}) AS m{d}")}
        FROM {new}_near GROUP BY cid) USING (cid))"""


def _centers(dims: int, name: str) -> str:
    return f"SELECT cid, {_each(dims, 'round(c{d}, 6) AS c{d}')} FROM {name}"


def _phi(near: str, alias: str) -> str:
    return f"(SELECT max(m) AS {alias} FROM (SELECT avg(sqdist) AS m FROM {near} GROUP BY grp))"


_START = f"WITH {LINEITEM},\n{_literal('c0', START)}"
_NEAR = f"{_START},\n{_near(3, 'c0', 'near')}"
_MOMENTS = f"{_NEAR},\n{_moments(3, 'near', 'm')}"
_PARAMS = f"{_MOMENTS},\n{_params(3, 'm', 'k')}"

_LINE = """SELECT c_custkey, concat_ws(',', CAST(c_acctbal AS VARCHAR),
    CAST(c_nationkey AS VARCHAR), {label}) AS line FROM customer"""

def _segment_moments_sql(k: int) -> str:
    return f"""WITH p AS MATERIALIZED (SELECT row_number() OVER () AS rid, c_acctbal / 100 AS x0,
    CAST(c_nationkey AS DOUBLE) AS x1,
    CASE WHEN c_mktsegment = 'BUILDING' THEN 'A' ELSE 'B' END AS grp FROM customer),
{_literal('c0', segment_centers(k))},
{_near(2, 'c0', 'near')},
{_moments(2, 'near', 'm')}
SELECT cid, grp, n, round(ssd, 3) AS ssd, round(mu0 + 1e-9, 6) AS mu0,
    round(mu1 + 1e-9, 6) AS mu1 FROM m"""


def _chain(step, rounds: int) -> str:
    return ",\n".join(step(3, f"c{i}", f"c{i + 1}") for i in range(rounds))


ORACLE = {
    "parse_points": f"""WITH l AS ({_LINE.format(label='''CASE c_mktsegment
        WHEN 'BUILDING' THEN 'A' WHEN 'MACHINERY' THEN 'a' WHEN 'FURNITURE' THEN ''
        ELSE c_mktsegment END''')}),
f AS (SELECT c_custkey, string_split(rtrim(line, ','), ',') AS f FROM l)
SELECT c_custkey, CAST(len(f) - 1 AS INTEGER) AS dims, CAST(f[1] AS DOUBLE) AS x0,
    CASE WHEN len(f) > 2 THEN CAST(f[2] AS DOUBLE) END AS x1,
    CASE WHEN f[-1] = 'A' THEN 'A' ELSE 'B' END AS grp FROM f""",
    "parse_points_tolerant": f"""WITH l AS ({_LINE.format(label='''CASE
        WHEN c_mktsegment = 'BUILDING' THEN 'A,extra'
        WHEN c_mktsegment <> 'FURNITURE' THEN c_mktsegment END''')}),
f AS (SELECT c_custkey, string_split(line, ',') AS f FROM l)
SELECT c_custkey, CAST(f[1] AS DOUBLE) AS x0, CAST(f[2] AS DOUBLE) AS x1, f[3] AS grp
FROM f WHERE len(f) >= 3""",
    "format_points": """SELECT printf('%.4f,%.4f,%s', c_acctbal, CAST(c_nationkey AS DOUBLE),
    CASE WHEN c_mktsegment = 'BUILDING' THEN 'A' ELSE 'B' END) AS value FROM customer""",
    "kmeans_standard": f"""WITH {LINEITEM} SELECT CAST(4 AS BIGINT) AS clusters,
    count(*) AS points, {_each(3, "round(avg(x{d}), 3) AS mean{d}")}, true AS no_worse FROM p""",
    "kmeans_init": "SELECT CAST(4 AS BIGINT) AS centers",
    "segment_moments_few": _segment_moments_sql(4),
    "segment_moments_many": _segment_moments_sql(40),
    "nearest_center": f"""{_NEAR} SELECT l_orderkey, l_linenumber, l_partkey, cid,
    round(sqdist, 6) AS sqdist FROM near""",
    "nearest_center_embeddings": f"""WITH {EMBEDDINGS},
{_near(64, 'c0', 'near')} SELECT rid AS vec_id, cid, round(sqdist, 6) AS sqdist FROM near""",
    "group_sizes": f"""WITH {LINEITEM} SELECT count(*) AS n,
    count(*) FILTER (grp = 'A') AS n_a, count(*) FILTER (grp = 'B') AS n_b FROM p""",
    "standard_objective": f"{_NEAR} SELECT round(avg(sqdist), 6) AS delta FROM near",
    "fair_objective": f"{_NEAR} SELECT round(phi, 6) AS phi FROM {_phi('near', 'phi')}",
    "fair_objective_embeddings": f"""WITH {EMBEDDINGS},
{_near(64, 'c0', 'near')} SELECT round(phi, 6) AS phi FROM {_phi('near', 'phi')}""",
    "compare_centers": f"""{_NEAR},
{_literal('other', OTHER)},
{_near(3, 'other', 'near2')}
SELECT round(a, 6) AS phi_standard, round(b, 6) AS phi_fair, round(a / b, 6) AS ratio
FROM {_phi('near', 'a')} CROSS JOIN {_phi('near2', 'b')}""",
    "cluster_stats": f"""{_NEAR} SELECT cid, any_value(c0) AS c0, any_value(c1) AS c1,
    any_value(c2) AS c2, count(*) FILTER (grp = 'A') AS n_a, count(*) FILTER (grp = 'B') AS n_b
    FROM near JOIN c0 USING (cid) GROUP BY cid""",
    "group_cluster_moments": f"""{_MOMENTS} SELECT cid, grp, n, round(ssd, 3) AS ssd,
    {_each(3, "round(mu{d}, 6) AS mu{d}")} FROM m""",
    "fair_cluster_params": f"""{_PARAMS} SELECT cid, round(alpha, 6) AS alpha,
    round(beta, 6) AS beta, round(ell, 6) AS ell, round(fixed_a, 6) AS fixed_a,
    round(fixed_b, 6) AS fixed_b, {_each(3, "round(a{d}, 6) AS mu_a{d}")},
    {_each(3, "round(b{d}, 6) AS mu_b{d}")} FROM k""",
    "group_dispersion": f"""{_MOMENTS}
SELECT grp, round(sum(ssd) / sum(n), 6) AS dispersion FROM m GROUP BY grp""",
    "fair_line_search": f"""{_PARAMS},
{_search('k', 's')} SELECT cid, round(x, 6) AS x FROM s""",
    "fair_kmeans_step": f"{_START},\n{_fair_step(3, 'c0', 'c1')}\n{_centers(3, 'c1')}",
    "fair_kmeans_step_embeddings":
        f"WITH {EMBEDDINGS},\n{_fair_step(64, 'c0', 'c1')}\n{_centers(64, 'c1')}",
    "fair_kmeans": f"{_START},\n{_chain(_fair_step, ROUNDS)}\n{_centers(3, f'c{ROUNDS}')}",
    "kmeans_from_start":
        f"{_START},\n{_chain(_lloyd_step, ROUNDS)}\n{_centers(3, f'c{ROUNDS}')}",
}
