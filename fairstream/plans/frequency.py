"""Registered queries over item streams, each beside the SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairstream.functions.hashing import PRIME, hash_family
from fairstream.operators.frequency import (
    distinct_count, distinct_items, frequency_summary, hh_avg_rel_error, hh_detail, item_counts,
    max_item, top_k_heavy_hitters,
)
from fairstream.operators.sketches import (
    cm_estimate, cm_sketch, cs_estimate, cs_sketch, merge_sketches, sketch_both,
)
from fairstream.session import scratch_dir
from fairstream.sources.tables import read_table, stream_batches
from fairstream.streaming.admission import BatchLog, admit, batch_sizes
from fairstream.streaming.running import (
    COUNTS, ITEMS, RESIDUES, RunningTopK, Updates, running_counts, running_distinct,
    running_residues, running_sketches,
)

D, W = 5, 256
EVENTS_D, EVENTS_W, EVENTS_K = 3, 16, 5
WIDE_D, WIDE_W = 65, 4096
PARTS_K = 10
ADMIT_PERCENT = 35


def parts(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "lineitem").select(F.col("l_partkey").alias("item"))


def users(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "events").select(
        F.col("user_id").alias("item"), F.dayofmonth("ts").cast("long").alias("batch_id"))


def part_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The line items as a stream of micro-batches, one for each line number."""
    rows = read_table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("item"), F.col("l_linenumber").cast("int").alias("batch_id"))
    return stream_batches(rows, "batch_id", scratch_dir(spark, "parts"))


def user_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The events as a stream of micro-batches, one for each day."""
    return stream_batches(users(spark, folder), "batch_id", scratch_dir(spark, "users"))


def _errors(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in ("err_cm", "err_cs")})


def item_counts_query(spark, folder):
    return item_counts(parts(spark, folder))


def distinct_items_query(spark, folder):
    return distinct_items(parts(spark, folder))


def distinct_count_query(spark, folder):
    return distinct_count(parts(spark, folder))


def max_item_query(spark, folder):
    return max_item(parts(spark, folder))


def top_k_query(spark, folder):
    return top_k_heavy_hitters(item_counts(parts(spark, folder)), PARTS_K).orderBy("item")


def cm_sketch_query(spark, folder):
    return cm_sketch(parts(spark, folder), D, W)


def cs_sketch_query(spark, folder):
    return cs_sketch(parts(spark, folder), D, W)


def sketch_merge_query(spark, folder):
    """Sketches of the two halves of the table, merged: the sketch of the whole."""
    lines = read_table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("item"), "l_linestatus")
    open_lines = F.col("l_linestatus").eqNullSafe("O")
    return merge_sketches(sketch_both(lines.where(open_lines), D, W),
                          sketch_both(lines.where(~open_lines), D, W))


def cm_estimate_query(spark, folder):
    items = parts(spark, folder)
    return cm_estimate(distinct_items(items), cm_sketch(items, D, W), D, W)


def cs_estimate_query(spark, folder):
    items = parts(spark, folder)
    return cs_estimate(distinct_items(items), cs_sketch(items, D, W), D, W)


def cm_estimate_wide(spark, folder):
    items = parts(spark, folder)
    return cm_estimate(distinct_items(items), cm_sketch(items, WIDE_D, WIDE_W), WIDE_D, WIDE_W)


def cs_estimate_even(spark, folder):
    items = parts(spark, folder)
    return cs_estimate(distinct_items(items), cs_sketch(items, 4, W), 4, W)


def hh_detail_query(spark, folder):
    counts = item_counts(users(spark, folder))
    return hh_detail(counts, EVENTS_D, EVENTS_W, EVENTS_K).orderBy("item")


def hh_avg_rel_error_query(spark, folder):
    counts = item_counts(users(spark, folder))
    return _errors(hh_avg_rel_error(hh_detail(counts, EVENTS_D, EVENTS_W, EVENTS_K)))


def batch_sizes_query(spark, folder):
    return batch_sizes(users(spark, folder))


def threshold_admission(spark, folder):
    """Item counts over the batches (days) admitted until a share of all events is reached."""
    items = users(spark, folder)
    total = batch_sizes(items).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    share = F.call_function("div", total.scalar() * ADMIT_PERCENT, F.lit(100).cast("long"))
    return item_counts(admit(items, share))


def stream_admission(spark, folder):
    """The streaming form: it stops with the day that crosses the same threshold."""
    total = read_table(spark, folder, "events").count()
    log = BatchLog(scratch_dir(spark, "admission"), total * ADMIT_PERCENT // 100, every=4)
    log.run(user_stream(spark, folder))
    return log.item_counts(spark)


def running_counts_query(spark, folder):
    updates = Updates(scratch_dir(spark, "counts"), COUNTS, every=3)
    return updates.run(running_counts(part_stream(spark, folder))).latest(spark)


def running_distinct_query(spark, folder):
    updates = Updates(scratch_dir(spark, "distinct"), ITEMS, every=3)
    return updates.run(running_distinct(part_stream(spark, folder)), mode="append").latest(spark)


def running_sketches_query(spark, folder):
    updates = Updates(scratch_dir(spark, "sketches"), RESIDUES, every=3)
    updates.run(running_residues(part_stream(spark, folder)))
    return running_sketches(spark, updates, D, W)


def running_top_k(spark, folder):
    top = RunningTopK(scratch_dir(spark, "topk"), EVENTS_K).run(user_stream(spark, folder))
    return top.hitters(spark).orderBy("item")


def stream_summary(spark, folder):
    log = BatchLog(scratch_dir(spark, "summary"))
    log.run(user_stream(spark, folder))
    return _errors(frequency_summary(log.item_counts(spark), EVENTS_D, EVENTS_W, EVENTS_K))


QUERIES = {
    "item_counts": item_counts_query,
    "distinct_items": distinct_items_query,
    "distinct_count": distinct_count_query,
    "max_item": max_item_query,
    "top_k_heavy_hitters": top_k_query,
    "cm_sketch": cm_sketch_query,
    "cs_sketch": cs_sketch_query,
    "sketch_merge": sketch_merge_query,
    "cm_estimate": cm_estimate_query,
    "cm_estimate_wide": cm_estimate_wide,
    "cs_estimate": cs_estimate_query,
    "cs_estimate_even": cs_estimate_even,
    "hh_detail": hh_detail_query,
    "hh_avg_rel_error": hh_avg_rel_error_query,
    "batch_sizes": batch_sizes_query,
    "threshold_admission": threshold_admission,
    "stream_admission": stream_admission,
    "running_counts": running_counts_query,
    "running_distinct": running_distinct_query,
    "running_sketches": running_sketches_query,
    "running_top_k": running_top_k,
    "stream_summary": stream_summary,
}


# ---------------------------------------------------------------- SQL

_PARTS = "items AS MATERIALIZED (SELECT l_partkey AS item FROM lineitem)"
_USERS = ("items AS MATERIALIZED (SELECT user_id AS item, day(ts) AS batch_id FROM events)")
_COUNTS = "counts AS MATERIALIZED (SELECT item, count(*) AS cnt FROM items GROUP BY item)"


def _top(k: int) -> str:
    return f"""top AS MATERIALIZED (SELECT item, cnt FROM (
    SELECT *, rank() OVER (ORDER BY cnt DESC) AS r FROM counts) WHERE r <= {k})"""


def _family(d: int) -> str:
    rows = ", ".join(f"({j}, {r.cm[0]}, {r.cm[1]}, {r.cs[0]}, {r.cs[1]}, {r.sign[0]}, {r.sign[1]})"
                     for j, r in enumerate(hash_family(d)))
    return f"h(j, cm_a, cm_b, cs_a, cs_b, g_a, g_b) AS (VALUES {rows})"


def _hash(kind: str, w: int) -> str:
    return (f"CAST((({kind}_a * (item % {PRIME}) + {kind}_b) % {PRIME}) % {w} AS INTEGER)")


def _cells(w: int) -> str:
    """Every item of ``counts`` in its cells of both sketches."""
    return f"""cells AS MATERIALIZED (
    SELECT item, 'cm' AS kind, j, {_hash('cm', w)} AS col, 1 AS s, cnt FROM counts CROSS JOIN h
    UNION ALL SELECT item, 'cs', j, {_hash('cs', w)}, 2 * {_hash('g', 2)} - 1, cnt
    FROM counts CROSS JOIN h),
sketch AS MATERIALIZED (SELECT kind, j, col, CAST(sum(s * cnt) AS BIGINT) AS counter
    FROM cells GROUP BY kind, j, col)"""


def _estimates(d: int) -> str:
    """Estimates of every counted item, from sorted lists of its counters."""
    low, high = ((d + 1) // 2, d // 2 + 1)
    median = f"v[{high}]" if d % 2 else f"(v[{low}] + v[{high}]) // 2"
    return f"""found AS MATERIALIZED (SELECT item, kind, list_sort(list(s * counter)) AS v
    FROM cells JOIN sketch USING (kind, j, col) GROUP BY item, kind),
est AS MATERIALIZED (SELECT a.item AS item, CAST(a.v[1] AS BIGINT) AS cm,
    CAST(b.median AS BIGINT) AS cs FROM found a
    JOIN (SELECT item, {median} AS median FROM found WHERE kind = 'cs') b USING (item)
    WHERE a.kind = 'cm')"""


def _sketched(source: str, d: int, w: int) -> str:
    return f"WITH {source},\n{_COUNTS},\n{_family(d)},\n{_cells(w)}"


_PART_SKETCH = _sketched(_PARTS, D, W)
_PART_ESTIMATES = f"{_PART_SKETCH},\n{_estimates(D)}"
_USER_HITTERS = f"""{_sketched(_USERS, EVENTS_D, EVENTS_W)},
{_estimates(EVENTS_D)},
{_top(EVENTS_K)},
detail AS MATERIALIZED (SELECT item, cnt, cm, cs FROM top JOIN est USING (item))"""
_USER_ERRORS = """count(*) AS n_hitters, round(avg(abs(cnt - cm) / cnt), 6) AS err_cm,
    round(avg(abs(cnt - cs) / cnt), 6) AS err_cs FROM detail"""
_PART_COUNTS = f"WITH {_PARTS},\n{_COUNTS}"
_USER_COUNTS = f"WITH {_USERS},\n{_COUNTS}"

_ADMITTED = f"""WITH {_USERS},
before AS (SELECT batch_id, coalesce(sum(n) OVER (ORDER BY batch_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seen
    FROM (SELECT batch_id, count(*) AS n FROM items GROUP BY batch_id))
SELECT item, count(*) AS cnt FROM items JOIN before USING (batch_id)
WHERE seen < (SELECT count(*) * {ADMIT_PERCENT} // 100 FROM items) GROUP BY item"""

ORACLE = {
    "item_counts": f"{_PART_COUNTS} SELECT * FROM counts",
    "distinct_items": "SELECT DISTINCT l_partkey AS item FROM lineitem",
    "distinct_count": "SELECT count(DISTINCT l_partkey) AS distinct_items FROM lineitem",
    "max_item": "SELECT max(l_partkey) AS max_item FROM lineitem",
    "top_k_heavy_hitters": f"{_PART_COUNTS},\n{_top(PARTS_K)} SELECT item, cnt FROM top",
    "cm_sketch": f"{_PART_SKETCH} SELECT * FROM sketch WHERE kind = 'cm'",
    "cs_sketch": f"{_PART_SKETCH} SELECT * FROM sketch WHERE kind = 'cs'",
    "sketch_merge": f"{_PART_SKETCH} SELECT * FROM sketch",
    "cm_estimate": f"{_PART_ESTIMATES} SELECT item, cm FROM est",
    "cm_estimate_wide": f"{_sketched(_PARTS, WIDE_D, WIDE_W)},\n{_estimates(WIDE_D)} "
        "SELECT item, cm FROM est",
    "cs_estimate": f"{_PART_ESTIMATES} SELECT item, cs FROM est",
    "cs_estimate_even":
        f"{_sketched(_PARTS, 4, W)},\n{_estimates(4)} SELECT item, cs FROM est",
    "hh_detail": f"{_USER_HITTERS} SELECT * FROM detail",
    "hh_avg_rel_error": f"{_USER_HITTERS} SELECT {_USER_ERRORS}",
    "batch_sizes": f"WITH {_USERS} SELECT batch_id, count(*) AS n FROM items GROUP BY batch_id",
    "threshold_admission": _ADMITTED,
    "stream_admission": _ADMITTED,
    "running_counts": f"{_PART_COUNTS} SELECT * FROM counts",
    "running_distinct": "SELECT DISTINCT l_partkey AS item FROM lineitem",
    "running_sketches": f"{_PART_SKETCH} SELECT * FROM sketch",
    "running_top_k": f"{_USER_COUNTS},\n{_top(EVENTS_K)} SELECT item, cnt FROM top",
    "stream_summary": f"""{_USER_HITTERS}
SELECT (SELECT count(*) FROM items) AS processed, (SELECT count(*) FROM counts) AS distinct_items,
    {_USER_ERRORS}""",
}
