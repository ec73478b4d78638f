"""Count-Min and Count Sketch as sums of counters ``(kind, j, col, counter)``.

Every hash of an item depends on its residue modulo PRIME only. So the items are first counted by
residue: each task leaves at most PRIME rows, however many items it read and however the hot ones
are spread, and only that histogram is expanded into the d rows of the sketches. Cells nobody hit
are absent and count 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairstream.functions.hashing import PRIME, HashRow, bucket, hash_family, residue, sign

# counters of the estimates that are broadcast at most; beyond, the keys are joined by residue
MAX_BROADCAST_COUNTERS = 1 << 23
KINDS = ("cm", "cs")


def residue_counts(items: DataFrame, weight: str | None = None) -> DataFrame:
    """``(r, n)``: items per residue. ``weight`` names a column of counts to add instead of 1 per
    row. Works on a streaming DataFrame too, with at most PRIME rows of state."""
    amount = F.count(F.lit(1)) if weight is None else F.sum(F.col(weight).cast("long"))
    return items.groupBy(residue(F.col("item")).alias("r")).agg(amount.alias("n"))


def sketch_from_residues(residues: DataFrame, d: int, w: int, seed: int = 1,
                         kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """The sketches of ``d`` rows and ``w`` columns of the items behind :func:`residue_counts`."""
    if w < 1:
        raise ValueError("a sketch needs at least one column")
    r, n = F.col("r"), F.col("n")
    cells: list[Column] = []
    for j, row in enumerate(hash_family(d, seed)):
        if "cm" in kinds:
            cells += [F.lit("cm"), F.lit(j), bucket(r, row.cm, w), n]
        if "cs" in kinds:
            cells += [F.lit("cs"), F.lit(j), bucket(r, row.cs, w), sign(r, row.sign) * n]
    expanded = residues.select(
        F.stack(F.lit(d * len(kinds)), *cells).alias("kind", "j", "col", "delta"))
    return expanded.groupBy("kind", "j", "col").agg(F.sum("delta").alias("counter"))


def sketch_both(items: DataFrame, d: int, w: int, seed: int = 1,
                weight: str | None = None) -> DataFrame:
    """Both sketches of ``item`` from one pass."""
    return sketch_from_residues(residue_counts(items, weight), d, w, seed)


def cm_sketch(items: DataFrame, d: int, w: int, seed: int = 1,
              weight: str | None = None) -> DataFrame:
    return sketch_from_residues(residue_counts(items, weight), d, w, seed, ("cm",))


def cs_sketch(items: DataFrame, d: int, w: int, seed: int = 1,
              weight: str | None = None) -> DataFrame:
    return sketch_from_residues(residue_counts(items, weight), d, w, seed, ("cs",))


def merge_sketches(*sketches: DataFrame) -> DataFrame:
    """The sketch of all inputs together, from sketches of the same d, w and seed."""
    merged = sketches[0]
    for other in sketches[1:]:
        merged = merged.unionByName(other)
    return merged.groupBy("kind", "j", "col").agg(F.sum("counter").alias("counter"))


def _estimators(sketch: DataFrame, rows: list[HashRow], kinds: tuple[str, ...],
                w: int) -> DataFrame:
    """``_r`` and per kind the d signed counters of the items with that residue; PRIME rows."""
    r = F.col("_r")
    probes = sketch.sparkSession.range(PRIME).select(F.col("id").cast("int").alias("_r")).select(
        "_r", F.explode(F.array(*[
            F.struct(F.lit(kind).alias("kind"), F.lit(j).alias("j"),
                     bucket(r, getattr(row, kind), w).alias("col"),
                     (sign(r, row.sign) if kind == "cs" else F.lit(1)).alias("factor"))
            for j, row in enumerate(rows) for kind in kinds])).alias("p")).select("_r", "p.*")
    found = F.coalesce("counter", F.lit(0)) * F.col("factor")
    return probes.join(sketch, ["kind", "j", "col"], "left").groupBy("_r").agg(
        *[F.collect_list(F.when(F.col("kind") == kind, found)).alias(f"_{kind}")
          for kind in kinds])


def sketch_estimates(keys: DataFrame, sketch: DataFrame, d: int, w: int, seed: int = 1,
                     kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """Add the estimated count of each ``item``.

    ``cm`` is the least of its d Count-Min counters. ``cs`` is the median of its d signed Count
    Sketch counters; for even d half the sum of the middle two, cut toward zero. A key that the
    sketch never saw is estimated like any other; a null item has null estimates. The keys meet a
    broadcast table of at most PRIME rows, so they are not shuffled.
    """
    values = _estimators(sketch, hash_family(d, seed), kinds, w)
    if PRIME * d * len(kinds) <= MAX_BROADCAST_COUNTERS:
        values = F.broadcast(values)
    found = keys.withColumn("_r", residue(F.col("item"))).join(values, "_r", "left").drop("_r")
    ordered = F.sort_array("_cs")
    median = F.get(ordered, F.lit(d // 2))
    if d % 2 == 0:
        median = F.call_function("div", F.get(ordered, F.lit(d // 2 - 1)) + median,
                                 F.lit(2).cast("long"))
    estimates = {"cm": F.array_min("_cm"), "cs": median}
    return found.withColumns({kind: estimates[kind] for kind in kinds}) \
        .drop(*[f"_{kind}" for kind in kinds])


def cm_estimate(keys: DataFrame, sketch: DataFrame, d: int, w: int, seed: int = 1) -> DataFrame:
    """Add ``cm``, the Count-Min estimate, alone."""
    return sketch_estimates(keys, sketch, d, w, seed, ("cm",))


def cs_estimate(keys: DataFrame, sketch: DataFrame, d: int, w: int, seed: int = 1) -> DataFrame:
    """Add ``cs``, the Count Sketch estimate, alone."""
    return sketch_estimates(keys, sketch, d, w, seed, ("cs",))
