"""Statistics kept up to date over an endless stream of items, in the keyed state store.

The streaming DataFrames here emit the rows that changed in each batch. :class:`Updates` stores
them per batch and reads back the newest row of each key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fairstream.operators.frequency import item_counts, top_k_heavy_hitters
from fairstream.operators.sketches import residue_counts, sketch_from_residues
from fairstream.session import finished_batches, remove_scratch

COUNTS = "item long, cnt long"
ITEMS = "item long"
RESIDUES = "r int, n long"


def running_counts(items: DataFrame) -> DataFrame:
    """``(item, cnt)``; one state row per distinct item, partitioned by item."""
    return item_counts(items)


def running_distinct(items: DataFrame) -> DataFrame:
    """Each item once, in the batch that first holds it."""
    return items.select("item").dropDuplicates(["item"])


def running_residues(items: DataFrame) -> DataFrame:
    """``(r, n)``, what any sketch of the stream can be made from; a few thousand state rows."""
    return residue_counts(items)


class Updates:
    """A ``foreachBatch`` function that keeps the newest row of each key under a folder.

    ``schema`` names the key and, if there is one, the value. ``rows/batch=<id>`` holds a batch's
    rows and is overwritten when the batch is replayed. After every ``every`` batches the newest
    rows so far are written to ``snapshot/batch=<id>``; once that is committed, what it holds is
    removed elsewhere. So an answer reads one snapshot and fewer than ``every`` batches, however
    long the stream runs. ``then`` is called with the batch id after a batch's rows are stored.
    """

    def __init__(self, folder: str, schema: str = COUNTS, every: int = 16,
                 then: Callable[[SparkSession, int], None] | None = None):
        self.folder = folder.rstrip("/")
        self.schema = schema
        self.every = every
        self.then = then

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(self.path(batch_id))
        if self.then is not None:
            self.then(spark, batch_id)
        # a snapshot that is there already holds the rows of a replayed batch
        if (batch_id + 1) % self.every == 0 and batch_id not in self._snapshots(spark):
            self.latest(spark).write.mode("overwrite").parquet(self._snapshot(batch_id))
        last = max(self._snapshots(spark), default=-1)
        for kind, upto in (("rows", last), ("snapshot", last - 1)):
            for old in finished_batches(spark, f"{self.folder}/{kind}"):
                if old <= upto and old != batch_id:
                    remove_scratch(spark, f"{self.folder}/{kind}/batch={old}")

    def path(self, batch_id: int) -> str:
        return f"{self.folder}/rows/batch={batch_id}"

    def _snapshot(self, batch_id: int) -> str:
        return f"{self.folder}/snapshot/batch={batch_id}"

    def _snapshots(self, spark: SparkSession) -> list[int]:
        return finished_batches(spark, f"{self.folder}/snapshot")

    def start(self, stream: DataFrame, mode: str = "update", **trigger) -> StreamingQuery:
        return stream.writeStream.foreachBatch(self).outputMode(mode) \
            .option("checkpointLocation", f"{self.folder}/checkpoint") \
            .trigger(**(trigger or {"availableNow": True})).start()

    def run(self, stream: DataFrame, mode: str = "update") -> Updates:
        """Process what the source holds now."""
        query = self.start(stream, mode)
        try:
            query.awaitTermination()
        finally:
            query.stop()
        return self

    def latest(self, spark: SparkSession) -> DataFrame:
        """The newest row of each key; empty before the first batch."""
        last = max(self._snapshots(spark), default=-1)
        parts = [(last, self._snapshot(last))] if last >= 0 else []
        parts += [(b, self.path(b)) for b in finished_batches(spark, f"{self.folder}/rows")
                  if b > last]
        rows = spark.createDataFrame([], f"{self.schema}, batch long")
        for batch, path in parts:
            rows = rows.unionByName(spark.read.schema(self.schema).parquet(path)
                                    .withColumn("batch", F.lit(batch).cast("long")))
        key, *value = rows.columns[:-1]
        newest = [F.max_by(v, "batch").alias(v) for v in value]
        return rows.groupBy(key).agg(*newest) if newest else rows.select(key).distinct()


class RunningTopK:
    """The top-k heavy hitters after each batch, under ``hitters/batch=<id>``; two are kept.

    Counts only grow, so an item can enter the top k only in a batch that changes its count: the
    new hitters are found among the old ones and the changed items, never among all items.
    """

    def __init__(self, folder: str, k: int, every: int = 16):
        self.k = k
        self.folder = folder.rstrip("/")
        self.updates = Updates(folder, COUNTS, every, then=self._refresh)

    def _path(self, batch_id: int) -> str:
        return f"{self.folder}/hitters/batch={batch_id}"

    def _refresh(self, spark: SparkSession, batch_id: int) -> None:
        candidates = spark.read.schema(COUNTS).parquet(self.updates.path(batch_id))
        before = [b for b in finished_batches(spark, f"{self.folder}/hitters") if b < batch_id]
        if before:
            old = spark.read.schema(COUNTS).parquet(self._path(before[-1]))
            candidates = old.join(candidates, "item", "left_anti").unionByName(candidates)
        top_k_heavy_hitters(candidates, self.k).write.mode("overwrite") \
            .parquet(self._path(batch_id))
        # the one before stays, as a replay of this batch starts from it
        for old in before[:-1]:
            remove_scratch(spark, self._path(old))

    def run(self, items: DataFrame) -> RunningTopK:
        self.updates.run(running_counts(items))
        return self

    def hitters(self, spark: SparkSession) -> DataFrame:
        """``(item, cnt)`` after the last batch; empty before the first."""
        done = finished_batches(spark, f"{self.folder}/hitters")
        if not done:
            return spark.createDataFrame([], COUNTS)
        return spark.read.schema(COUNTS).parquet(self._path(done[-1]))


def running_sketches(spark: SparkSession, residues: Updates, d: int, w: int,
                     seed: int = 1) -> DataFrame:
    """Both sketches as of the last stored batch of :func:`running_residues`."""
    return sketch_from_residues(residues.latest(spark), d, w, seed)
