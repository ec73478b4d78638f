"""Processing a stream of items batch by batch until a number of items is reached.

A batch is admitted whole if fewer than ``threshold`` items came before it, so the batch that
crosses the threshold still counts in full.
"""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fairstream.session import finished_batches, remove_scratch

COUNTS = "item long, cnt long"
SIZES = "batch_id long, n long, total long"


def batch_sizes(items: DataFrame) -> DataFrame:
    """``(batch_id, n)`` of every batch that holds an item."""
    return items.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"))


def admit(items: DataFrame, threshold: int | Column, span_bits: int = 22) -> DataFrame:
    """The rows of the admitted batches, for items that carry their ``batch_id``.

    Sizes are accumulated level by level: over batch ids within spans of 2^22 ids, over these spans
    within spans of 2^44, and over those. So whatever the ids are, no task sees more than 2^22 rows
    of a level. ``threshold`` may be a column without reference to the items, such as a scalar
    subquery. A null batch id is an error.
    """
    named = items.withColumn("batch_id", F.coalesce(
        "batch_id", F.raise_error(F.lit("an item has no batch_id")).cast("long")))
    reached = batch_sizes(named).withColumn("before", F.lit(0).cast("long"))
    up_to_here = Window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for low in range(0, 64, span_bits):
        part, above = F.shiftright("batch_id", low), low + span_bits
        sums = reached.groupBy(part.alias("part")).agg(F.sum("n").alias("n"))
        window = up_to_here.orderBy("part")
        if above < 64:
            window = window.partitionBy(F.shiftright("part", span_bits))
        level = sums.select("part", (F.sum("n").over(window) - F.col("n")).alias("level"))
        # every part has its row
        reached = reached.withColumn("part", part).join(level, "part", "left").select(
            "batch_id", "n", (F.col("before") + F.col("level")).alias("before"))
    limit = threshold if isinstance(threshold, Column) else F.lit(threshold)
    last = reached.where((limit > 0) & (F.col("before") < limit)) \
        .agg(F.max("batch_id").alias("batch_id"))
    return named.where(F.col("batch_id") <= last.scalar())


class BatchLog:
    """A ``foreachBatch`` function that records the admitted batches under a folder.

    ``counts/batch=<id>`` holds a batch's ``(item, cnt)`` and ``sizes/batch=<id>`` its ``n`` and
    the ``total`` so far. Both are overwritten when a batch is replayed, and the total builds on
    the batch before, so a replay or a restart changes nothing. After every ``every`` batches all
    counts so far go into ``counts_snapshot/batch=<id>`` and all sizes into ``sizes_snapshot``, and
    the folders they replace are removed. Nothing is written once the threshold is reached.
    ``threshold=None`` admits all.
    """

    def __init__(self, folder: str, threshold: int | None = None, every: int = 16):
        self.folder = folder.rstrip("/")
        self.threshold = threshold
        self.every = every
        self.reached = threading.Event()
        self._totals: dict[int, int] = {}

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = self._total_before(spark, batch_id)
        if self.threshold is not None and before >= self.threshold:
            self._totals = {batch_id: before}
            self.reached.set()
            return
        rows = f"{self.folder}/counts/batch={batch_id}"
        batch.groupBy("item").agg(F.count(F.lit(1)).alias("cnt")) \
            .write.mode("overwrite").parquet(rows)
        n = spark.read.schema(COUNTS).parquet(rows) \
            .agg(F.coalesce(F.sum("cnt"), F.lit(0))).head()[0]
        total = before + n
        record = {"batch_id": batch_id, "n": n, "total": total}
        spark.range(1, numPartitions=1) \
            .select(*[F.lit(v).cast("long").alias(c) for c, v in record.items()]) \
            .write.mode("overwrite").parquet(f"{self.folder}/sizes/batch={batch_id}")
        self._totals = {batch_id: total}
        if (batch_id + 1) % self.every == 0:
            self._compact(spark, batch_id)
        if self.threshold is not None and total >= self.threshold:
            self.reached.set()

    def _compact(self, spark: SparkSession, batch_id: int) -> None:
        for part, rows in (("counts", self.item_counts), ("sizes", self._sizes)):
            kept = f"{self.folder}/{part}_snapshot"
            # one that is there already holds the rows of a replayed batch
            if batch_id not in finished_batches(spark, kept):
                rows(spark).write.mode("overwrite").parquet(f"{kept}/batch={batch_id}")
            for folder, upto in ((f"{self.folder}/{part}", batch_id), (kept, batch_id - 1)):
                for old in finished_batches(spark, folder):
                    if old <= upto:
                        remove_scratch(spark, f"{folder}/batch={old}")

    def _total_before(self, spark: SparkSession, batch_id: int) -> int:
        if batch_id == 0:
            return 0
        if batch_id - 1 not in self._totals:
            newest = self._sizes(spark).where(F.col("batch_id") < batch_id) \
                .agg(F.coalesce(F.max("total"), F.lit(0))).head()[0]
            self._totals[batch_id - 1] = newest
        return self._totals[batch_id - 1]

    def start(self, items: DataFrame, **trigger) -> StreamingQuery:
        """Start on a streaming DataFrame with an ``item`` column. ``trigger`` as for
        ``DataStreamWriter.trigger``, for example ``processingTime="1 second"``."""
        return items.select("item").writeStream.foreachBatch(self) \
            .option("checkpointLocation", f"{self.folder}/checkpoint") \
            .trigger(**(trigger or {"availableNow": True})).start()

    def run(self, items: DataFrame, **trigger) -> None:
        """Run until the threshold is reached or the stream ends. Never starts for a threshold
        that admits nothing."""
        if self.threshold is not None and self.threshold <= 0:
            return
        query = self.start(items, **trigger)
        try:
            while not self.reached.is_set() and not query.awaitTermination(0.2):
                pass
        finally:
            query.stop()

    def _read(self, spark: SparkSession, part: str, schema: str) -> DataFrame:
        """The last snapshot and the batches after it; empty before the first batch."""
        kept = finished_batches(spark, f"{self.folder}/{part}_snapshot")[-1:]
        paths = [f"{self.folder}/{part}_snapshot/batch={b}" for b in kept]
        paths += [f"{self.folder}/{part}/batch={b}"
                  for b in finished_batches(spark, f"{self.folder}/{part}")
                  if not kept or b > kept[0]]
        return spark.read.schema(schema).parquet(*paths) if paths \
            else spark.createDataFrame([], schema)

    def _sizes(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, "sizes", SIZES)

    def sizes(self, spark: SparkSession) -> DataFrame:
        """``(batch_id, n)`` of the admitted batches that hold an item."""
        return self._sizes(spark).where("n > 0").select("batch_id", "n")

    def item_counts(self, spark: SparkSession) -> DataFrame:
        """``(item, cnt)`` over the admitted batches."""
        return self._read(spark, "counts", COUNTS).groupBy("item") \
            .agg(F.sum("cnt").alias("cnt"))
