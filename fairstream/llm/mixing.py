"""Mixing sources to target weights by entropy balancing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fairstream.llm.common import stored

#: A word: a run of characters outside the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in their order, repeating; a document's largest rate.
WEIGHTS, MOST = (1, 2, 3), 3
#: Newton stops when every source is this close to its target, or after so many iterations.
TOLERANCE, ITERATIONS = 1e-7, 40
#: Bits of the rounding order, and of them those that each of the passes settles.
ORDER_BITS, PASS_BITS = 46, 12


def _key(source: Column) -> Column:
    """The source as a key that is never null."""
    return F.when(source.isNull(), "n").otherwise(F.concat(F.lit("s"), source.cast("string")))


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    size = F.coalesce(F.regexp_count(docs[text_col].cast("string"), F.lit(WORD)), F.lit(0))
    chance = F.pmod(F.xxhash64(F.lit("mix"), docs[id_col]), F.lit(1 << 30)) / (1 << 30)
    return docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"),
                       _key(docs[source_col]).alias("k"), docs[source_col].alias("source"),
                       size.cast("long").alias("size"), chance.alias("chance"))


def targets(sizes: DataFrame) -> DataFrame:
    """``k, source_size, target, mean`` per source from rows ``k, source, size``.

    Weighted shares of the total, none above ``MOST`` times its source: with the sources ordered by
    the level at which they reach that bound, the ones below the common level stop at it. The table
    has a row for each source; ordering it is the only work of a single task.
    """
    by_source = sizes.groupBy("k", "source").agg(
        F.sum("size").alias("source_size"), F.sum((F.col("size") > 0).cast("long")).alias("n"))
    in_order = Window.orderBy(F.col("source").isNull(), "source")
    weights = F.array(*(F.lit(float(w)) for w in WEIGHTS))
    weighed = by_source.withColumn(
        "weight", F.get(weights, (F.row_number().over(in_order) - 1) % len(WEIGHTS))) \
        .withColumn("bound", (MOST * F.col("source_size")).cast("double")) \
        .withColumn("level", F.col("bound") / F.col("weight"))
    everything = Window.partitionBy()
    upto = Window.orderBy("level", "k").rowsBetween(Window.unboundedPreceding, 0)
    # the common level if the sources up to this one stop at their bounds
    open_weight = F.sum("weight").over(everything) - F.sum("weight").over(upto)
    left = F.sum("source_size").over(everything) - F.sum("bound").over(upto)
    ordered = weighed.withColumn("after", F.when(open_weight > 0, left / open_weight)) \
        .withColumn("first", F.sum("source_size").over(everything)
                    / F.sum("weight").over(everything)) \
        .withColumn("before", F.coalesce(F.lag("after").over(Window.orderBy("level", "k")),
                                         F.col("first"))) \
        .withColumn("stops", F.col("level") <= F.col("before"))
    common = F.coalesce(F.max(F.when(F.col("stops"), F.col("after"))).over(everything),
                        F.col("first"))
    return ordered.withColumn("target", F.when(F.col("stops"), F.col("bound"))
                              .otherwise(F.col("weight") * common)) \
        .select("k", "source_size", F.col("target"),
                F.when(F.col("n") > 0, F.col("source_size") / F.col("n")).otherwise(1.0)
                .alias("mean"))


def _rate(size: Column, tilt: Column, mean: Column, full: Column) -> Column:
    """A document's rate: exponentially tilted by its size, at most ``MOST``."""
    power = F.least(tilt * size / mean, F.lit(2.0))  # e^2 is above MOST
    return F.when(full, float(MOST)).otherwise(F.least(F.lit(float(MOST)), F.exp(power)))


def balance(counts: DataFrame, wanted: DataFrame) -> DataFrame:
    """Every source's tilt, by Newton's method on the convex dual of the entropy problem.

    Minimising the rates' relative entropy under one token constraint for each source and the bound
    ``MOST`` gives rates min(MOST, exp(tilt * size / mean)). ``counts`` holds ``k, size, n``, a row
    for each distinct size of a source, so an iteration reads no documents: each task sums up values
    and derivatives for its rows, and one row for each source and task is shuffled. A step that
    leaves the interval known to hold the root is replaced by its middle.
    """
    state = stored(wanted.select(
        "*", (F.col("target") >= MOST * F.col("source_size") * (1 - 1e-12)).alias("full"),
        F.lit(0.0).alias("tilt"), F.lit(float("-inf")).alias("low"),
        F.lit(float("inf")).alias("high")), "mix")
    for _ in range(ITERATIONS):
        rate = _rate(F.col("size"), F.col("tilt"), F.col("mean"), F.col("full"))
        words = F.col("n") * F.col("size")
        sums = counts.join(state.select("k", "tilt", "mean", "full"), "k").groupBy("k").agg(
            F.sum(words * rate).alias("value"),
            F.sum(F.when(rate < MOST, words * F.col("size") / F.col("mean") * rate).otherwise(0.0))
            .alias("slope"))
        over = F.col("value") - F.col("target")
        done = F.col("full") | (F.col("target") <= 0) \
            | (F.abs(over) <= TOLERANCE * F.col("target"))
        low = F.when(over < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(over > 0, F.col("tilt")).otherwise(F.col("high"))
        reach = 2.0 * (1.0 + F.abs(F.col("tilt")))
        step = F.when(F.col("slope") > 0, -over / F.col("slope")).otherwise(
            F.when(over < 0, reach).otherwise(-reach))
        newton = F.col("tilt") + F.greatest(F.least(step, reach), -reach)
        inside = (newton > low) & (newton < high)
        bounded = (low > float("-inf")) & (high < float("inf"))
        state = stored(
            state.join(sums, "k").select(
                "k", "source_size", "target", "mean", "full",
                F.when(done | inside | ~bounded, F.when(done, F.col("tilt")).otherwise(newton))
                .otherwise((low + high) / 2).alias("tilt"),
                low.alias("low"), high.alias("high"), done.alias("done")), "mix")
        if state.where(~F.col("done")).isEmpty():
            break
        state = state.drop("done")
    return state.select("k", "source_size", "target", "mean", "full", "tilt")


def _place(chance: Column, size: Column, rate: Column, mean: Column) -> Column:
    """A document's place in its source's rounding order, null if its rate is whole for good.

    Rounding up the documents with ``chance`` below the fraction of their rate would be right on
    average. Their distance to that, times their squared size, orders the documents, so that the
    threshold that meets the target moves small documents first.
    """
    gap = (chance - (rate - F.floor(rate))) * F.pow(size / mean, F.lit(2.0))
    squeezed = F.signum(gap) * F.log1p(F.abs(gap) * 1e6)
    place = F.floor((F.greatest(F.lit(-31.0), F.least(F.lit(31.0), squeezed)) + 32.0)
                    * float(1 << (ORDER_BITS - 6)))
    return F.when((rate < MOST) & (size > 0), place.cast("long"))


def _rated(rows: DataFrame, state: DataFrame) -> DataFrame:
    rate = _rate(F.col("size"), F.col("tilt"), F.col("mean"), F.col("full"))
    return rows.join(state, "k").withColumn("rate", rate).withColumn(
        "place", _place(F.col("chance"), F.col("size"), F.col("rate"), F.col("mean")))


def _reach(rows: DataFrame, needs: DataFrame) -> DataFrame:
    """``k, below``: the threshold of every source below which rows hold ``need`` words.

    ``rows`` are ``k, place, size`` with places of ORDER_BITS bits, ``needs`` are ``k, need``. The
    passes sum the sizes of at most 2^PASS_BITS cells of a source and go on in the cell where the
    need is met; so no task holds a source's documents. The last cell is taken if that comes nearer.
    """
    zero = F.lit(0).cast("long")
    at = stored(needs.select("k", F.greatest("need", F.lit(0.0)).alias("need"),
                             zero.alias("cell"), zero.alias("words")), "mix")
    shift = ORDER_BITS
    while shift - PASS_BITS > 0:
        inside = rows.join(at.select("k", "need", "cell"), "k") \
            .where(F.shiftright("place", shift) == F.col("cell"))
        shift -= PASS_BITS
        cells = inside.groupBy("k", "need", F.shiftright("place", shift).alias("part")) \
            .agg(F.sum("size").alias("words"))
        upto = Window.partitionBy("k").orderBy("part") \
            .rowsBetween(Window.unboundedPreceding, 0)
        reached = cells.withColumn("before", F.sum("words").over(upto) - F.col("words"))
        at = stored(reached.where(F.col("before") <= F.col("need")).groupBy("k").agg(
            F.max(F.struct("part", "need", "before", "words")).alias("c")).select(
            "k", (F.col("c.need") - F.col("c.before")).alias("need"),
            F.col("c.part").alias("cell"), F.col("c.words").alias("words")), "mix")
    more = (F.col("need") >= F.col("words") / 2).cast("long")
    return stored(at.select("k", F.shiftleft(F.col("cell") + more, shift).alias("below")), "mix")


def _up(place: str, below: str) -> Column:
    return F.coalesce(F.col(place) < F.col(below), F.lit(False))


def _settled(rated: DataFrame) -> DataFrame:
    """Rated documents with ``up``: whether the copies are the rate rounded up, not down.

    First by the threshold in the rounding order, then turned for the smallest documents that make
    up for what that leaves, up or down as the source needs.
    """
    small = F.shiftleft(F.least(F.col("size"), F.lit((1 << 26) - 1)), ORDER_BITS - 26) \
        .bitwiseOR((F.col("chance") * (1 << (ORDER_BITS - 26))).cast("long"))
    first = rated.withColumn("first", _up("place", "below")) \
        .withColumn("small", F.when(F.col("place").isNotNull(), small))
    turned = F.coalesce((F.col("first") == (F.col("left") < 0)) & _up("small", "turn"),
                        F.lit(False))
    return first.withColumn("up", F.col("first") != turned)


def thresholds(rows: DataFrame, state: DataFrame) -> DataFrame:
    """``state`` with what settles the rounding of every source: ``below, left, turn``."""
    rated = _rated(rows, state)
    placed = rated.where(F.col("place").isNotNull())
    needs = rated.groupBy("k").agg(
        (F.first("target") - F.sum(F.floor("rate") * F.col("size"))).alias("need"))
    first = state.join(_reach(placed.select("k", "place", "size"), needs), "k", "left")
    none = {"left": F.lit(0.0), "turn": F.lit(None).cast("long")}
    so_far = _settled(_rated(rows, first.withColumns(none)))
    copies = F.floor("rate") + F.col("up").cast("long")
    left = stored(so_far.groupBy("k").agg(
        (F.first("target") - F.sum(copies * F.col("size"))).alias("left")), "mix")
    open_ = so_far.drop("left").join(left, "k").where(
        F.col("small").isNotNull() & (F.col("up") == (F.col("left") < 0)))
    second = _reach(open_.select("k", F.col("small").alias("place"), "size"),
                    left.select("k", F.abs("left").alias("need")))
    return stored(first.join(left, "k", "left").join(
        second.withColumnRenamed("below", "turn"), "k", "left"), "mix")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> DataFrame:
    """The documents in a struct ``row`` with ``size, source_size, target, copies, taken``.

    ``size`` counts words (null text: 0). Sources in code point order, null last, weigh 1, 2, 3,
    repeating; no target is above three times its source. ``copies`` is the document's rate after
    entropy balancing, rounded so that the source's words meet its target up to about one small
    document; ``taken`` is ``copies * size``. Documents without words get one copy. A null id is a
    value like any other; rows repeated with their id are rounded alike. All follows from ids and
    sizes, so reruns agree. An empty table gives an empty result.
    """
    sized = _sized(docs, id_col, text_col, source_col)
    narrow = stored(sized.select("k", "source", "size", "chance"), "mix")
    counts = stored(narrow.where(F.col("size") > 0).groupBy("k", "size")
                    .agg(F.count(F.lit(1)).alias("n")), "mix")
    state = balance(counts, targets(narrow))
    # a source without words has no rate to find
    empty = narrow.groupBy("k").agg(F.sum("size").alias("source_size")) \
        .where(F.col("source_size") == 0)
    none = F.lit(None).cast("long")
    settled = thresholds(narrow.select("k", "size", "chance"), state).unionByName(
        empty.withColumns({"target": F.lit(0.0), "mean": F.lit(1.0), "full": F.lit(True),
                           "tilt": F.lit(0.0), "below": none, "left": F.lit(0.0), "turn": none}))
    whole = F.floor("rate") + F.col("up").cast("long")
    # as a stored table of one row per source it is broadcast while Spark finds it small enough
    return _settled(_rated(sized, stored(settled, "mix"))).select(
        "row", "size", "source_size", "target",
        F.when(F.col("size") == 0, 1).otherwise(whole).cast("long").alias("copies")) \
        .withColumn("taken", F.col("copies") * F.col("size"))


def mixed_rows(docs: DataFrame, **columns: str) -> DataFrame:
    """The documents themselves, each repeated as often as the mix takes it."""
    taken = mix(docs, **columns).where(F.col("copies") > 0)
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")) \
        .select("row.*")
