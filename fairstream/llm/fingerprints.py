"""Document fingerprints by consistent weighted sampling, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fairstream.llm.common import stored

#: Samples of a fingerprint, and bits of each.
SAMPLES, BITS = 32, 24
_SPACE = r"[\x20\x09-\x0D]+"
_THIRD = 1 << 21
#: Stands for a null id, as the least key of all.
NO_KEY = -(1 << 63)


def _uniform(mix: Column, third: int) -> Column:
    """One of the three numbers in (0, 1) that a hash of 64 bits holds."""
    part = F.shiftrightunsigned(mix, 21 * third).bitwiseAND(F.lit(_THIRD - 1))
    return (part + F.lit(0.5)) / F.lit(float(_THIRD))


def _sample(term: Column, log_weight: Column, k: int) -> Column:
    """The k-th sampled value of a weighted term; the least of a text's values is its sample.

    r and c are drawn from Gamma(2, 1) and b from the unit interval, all by the term's hash. With
    t = floor(ln(weight) / r + b), the value is ln(c) - r * (t - b + 1). It depends on the weight
    through t only, which makes samples of different weights consistent. The value's rounded
    logarithm is packed above bits that name the term and t, so that one minimum finds both.
    """
    one, two = F.xxhash64(term, F.lit(2 * k)), F.xxhash64(term, F.lit(2 * k + 1))
    r = -F.ln(_uniform(one, 0) * _uniform(one, 1))
    log_c = F.ln(-F.ln(_uniform(one, 2) * _uniform(two, 0)))
    b = _uniform(two, 1)
    t = F.floor(log_weight / r + b)
    value = F.greatest(F.lit(-127.0), F.least(F.lit(127.0), log_c - r * (t - b + 1.0)))
    rank = F.floor((value + 128.0) * float(1 << 31)).cast("long")
    name = (F.shiftrightunsigned(two, 42) + t.cast("long") * 7919) \
        .bitwiseAND(F.lit((1 << BITS) - 1))
    return F.shiftleft(rank, BITS).bitwiseOR(name)


def signatures(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``keys`` and ``sig array<long>`` of the texts that have a word.

    A term is a word, and its weight how often it occurs. Grouped by keys under which ``rows`` are
    already placed, nothing is shuffled; every pair of a text and a word is one row of a hash
    aggregation, which spills when it has to.
    """
    words = rows.select(*keys, F.explode(F.split(text, _SPACE)).alias("word")) \
        .where(F.col("word") != "").select(*keys, F.xxhash64("word").alias("term"))
    weighed = words.groupBy(*keys, "term").agg(F.count(F.lit(1)).alias("n")) \
        .withColumn("log_weight", F.ln(F.col("n").cast("double")))
    least = weighed.groupBy(*keys).agg(
        *(F.min(_sample(F.col("term"), F.col("log_weight"), k)).alias(f"s{k}")
          for k in range(SAMPLES)))
    mask = F.lit((1 << BITS) - 1)
    return least.select(*keys, F.array(*(F.col(f"s{k}").bitwiseAND(mask)
                                         for k in range(SAMPLES))).alias("sig"))


def _likeness(a: Column, b: Column) -> Column:
    """Share of equal samples; texts without words are like each other only."""
    equal = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e)) / float(SAMPLES)
    return F.when(a.isNull() & b.isNull(), 1.0).when(a.isNull() | b.isNull(), 0.0).otherwise(equal)


def _text_of(sig: Column) -> Column:
    hexed = F.transform(sig, lambda s: F.lpad(F.lower(F.hex(s)), BITS // 4, "0"))
    return F.coalesce(F.concat_ws("", hexed), F.lit(""))


def following(keys: DataFrame) -> DataFrame:
    """``key, next`` of the distinct keys: the next smaller one, and after the last the first.

    Keys are placed by ranges, whose number is that of the shuffle partitions; only the ends of the
    ranges, a row for each, are ordered in one task.
    """
    ranged = stored(keys.select("key").distinct().repartitionByRange("key")
                    .withColumn("range", F.spark_partition_id()), "ranges")
    ends = ranged.groupBy("range").agg(F.max("key").alias("top"))
    down = Window.orderBy(F.desc("top"))
    after = ends.select("range", F.coalesce(
        F.lead("top").over(down), F.max("top").over(Window.partitionBy())).alias("after"))
    inside = Window.partitionBy("range").orderBy(F.desc("key"))
    return ranged.withColumn("inner", F.lead("key").over(inside)).join(after, "range") \
        .select("key", F.coalesce("inner", "after").alias("next"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of all texts and of their edited forms, and how alike they are.

    Consistent weighted sampling of words by their counts: the share of equal samples estimates the
    generalised Jaccard similarity. In a text's edited form its last floor(n / 2) characters are
    replaced by the first as many of the next document's text, in descending order of ids. Columns:
    the id, ``n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    A null text is empty; a text without words has the fingerprint ''. A null id comes last. Rows
    that share an id have the same next document, and where that id has several texts, the least
    of them by the part that it gives; repeated rows are kept. Each text is shuffled once by its id,
    and the part that the next document gives once more.
    """
    kind = docs.select(id_col).schema[0].dataType
    # placed by key once; both the texts' own rows and what they give to others read this shuffle
    rows = docs.select(F.coalesce(docs[id_col].cast("long"), F.lit(NO_KEY)).alias("key"),
                       F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text")) \
        .repartition("key")
    links = stored(following(docs.select(
        F.coalesce(docs[id_col].cast("long"), F.lit(NO_KEY)).alias("key"))), "links")
    # the longest half that any text under a key needs from its next document
    half = F.floor(F.length(F.coalesce(docs[text_col].cast("string"), F.lit(""))) / 2)
    sizes = docs.groupBy(F.coalesce(docs[id_col].cast("long"), F.lit(NO_KEY)).alias("key")) \
        .agg(F.max(half.cast("int")).alias("need"))
    given = links.join(sizes, "key").select(F.col("key").alias("to"), F.col("next"), "need")
    parts = given.join(rows.select(F.col("key").alias("next"), F.col("text").alias("other")),
                       "next").select("to", F.expr("left(other, need)").alias("part"),
                                      F.xxhash64("other").alias("other"))
    least = Window.partitionBy("to").orderBy("part", "other")
    donors = parts.withColumn("n", F.row_number().over(least)).where(F.col("n") == 1) \
        .select(F.col("to").alias("key"), "part", "other")
    joined = rows.join(donors, "key").select(
        "key", F.xxhash64("text").alias("uid"), "text", "other",
        F.concat(F.expr("left(text, length(text) - cast(floor(length(text) / 2) as int))"),
                 F.expr("left(part, cast(floor(length(text) / 2) as int))")).alias("edited"))
    own = signatures(rows.withColumn("uid", F.xxhash64("text")).dropDuplicates(["key", "uid"]),
                     ["key", "uid"], "text")
    edited = signatures(joined.select("key", "uid", "edited").dropDuplicates(["key", "uid"]),
                        ["key", "uid"], "edited").withColumnRenamed("sig", "edited_sig")
    base = joined.select("key", "uid", "other", F.length("text").cast("long").alias("n_chars"),
                         F.sha2(F.col("edited"), 256).alias("edited_sha256"))
    narrow = stored(base.join(own, ["key", "uid"], "left").join(edited, ["key", "uid"], "left"),
                    "fingerprints")
    nexts = links.join(narrow.select(F.col("key").alias("next"), F.col("uid").alias("other"),
                                     F.col("sig").alias("next_sig"))
                       .dropDuplicates(["next", "other"]), "next").drop("next")
    return narrow.join(nexts, ["key", "other"], "left").select(
        F.when(F.col("key") != NO_KEY, F.col("key")).cast(kind).alias(id_col),
        "n_chars", "edited_sha256",
        _text_of(F.col("sig")).alias("fingerprint"),
        _text_of(F.col("edited_sig")).alias("edited_fingerprint"),
        _likeness(F.col("sig"), F.col("edited_sig")).alias("near_edited"),
        _likeness(F.col("sig"), F.col("next_sig")).alias("near_next"))
