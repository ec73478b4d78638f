import os
from collections import Counter

import pytest

from pyspark.sql import functions as F

from fairstream.operators.frequency import item_counts, top_k_heavy_hitters
from fairstream.operators.sketches import sketch_both
from fairstream.session import finished_batches
from fairstream.sources.parsing import parse_items
from fairstream.sources.tables import stream_batches
from fairstream.streaming.admission import BatchLog, admit, batch_sizes
from fairstream.streaming.running import (
    ITEMS, RESIDUES, RunningTopK, Updates, running_counts, running_distinct, running_residues,
    running_sketches,
)

BATCHES = [[1, 1, 2, 3], [4, 4, 4], [2, 2, -7, 5, 5], [6], [4, 4, 9, 9, 9, 9]]


@pytest.fixture
def stream(spark, tmp_path):
    """The batches as a stream of one file per trigger, in order."""
    folder = tmp_path / "source"
    folder.mkdir()
    for i, batch in enumerate(BATCHES):
        file = folder / f"{i}.txt"
        file.write_text("".join(f"{v}\n" for v in batch))
        os.utime(file, (1_000_000 + i, 1_000_000 + i))
    return parse_items(spark.readStream.option("maxFilesPerTrigger", 1).text(str(folder)))


def _counts(batches):
    return Counter(v for b in batches for v in b)


def _as_dict(df):
    return {r[0]: r[1] for r in df.collect()}


def _admitted(threshold):
    seen, out = 0, []
    for batch in BATCHES:
        if seen >= threshold:
            break
        out.append(batch)
        seen += len(batch)
    return out


@pytest.mark.parametrize("threshold", [-1, 0, 1, 4, 5, 7, 12, 13, 19, 100])
@pytest.mark.parametrize("bits, step", [(16, 3), (22, 1 << 21), (32, 1 << 40)])
def test_admit(spark, threshold, bits, step):
    rows = [(v, 10 - 2 * step + step * i) for i, b in enumerate(BATCHES) for v in b]
    items = spark.createDataFrame(rows, "item long, batch_id long").repartition(3)
    assert _as_dict(item_counts(admit(items, threshold, bits))) == _counts(_admitted(threshold))


def test_admit_takes_a_column_and_no_null_batch(spark):
    items = spark.createDataFrame([(1, 1), (2, 2), (3, 3)], "item long, batch_id long")
    limit = batch_sizes(items).agg(F.sum("n")).scalar() - 1
    assert _as_dict(item_counts(admit(items, limit))) == {1: 1, 2: 1}
    with pytest.raises(Exception, match="no batch_id"):
        admit(spark.createDataFrame([(1, None)], "item long, batch_id long"), 5).collect()


def test_batch_sizes(spark):
    rows = [(v, i) for i, b in enumerate(BATCHES) for v in b]
    items = spark.createDataFrame(rows, "item long, batch_id long")
    assert _as_dict(batch_sizes(items)) == {i: len(b) for i, b in enumerate(BATCHES)}


@pytest.mark.parametrize("threshold", [0, 7, 8, 100, None])
def test_stream_admission(spark, stream, tmp_path, threshold):
    want = BATCHES if threshold is None else _admitted(threshold)
    log = BatchLog(str(tmp_path / "log"), threshold)
    log.run(stream)
    assert _as_dict(log.item_counts(spark)) == _counts(want)
    assert _as_dict(log.sizes(spark)) == {i: len(b) for i, b in enumerate(want)}


def test_replayed_batches_count_once(spark, tmp_path):
    frames = [spark.createDataFrame([(v,) for v in b], "item long") for b in BATCHES]
    log = BatchLog(str(tmp_path / "log"), 12)
    for i in (0, 0, 1, 1):
        log(frames[i], i)
    # a restart: the total so far comes from the folder
    log = BatchLog(str(tmp_path / "log"), 12)
    for i in (1, 2, 2, 3, 4):
        log(frames[i], i)
    assert log.reached.is_set()
    assert _as_dict(log.item_counts(spark)) == _counts(_admitted(12))
    assert _as_dict(log.sizes(spark)) == {i: len(b) for i, b in enumerate(_admitted(12))}


def test_empty_batch(spark, tmp_path):
    log = BatchLog(str(tmp_path / "log"), 100)
    empty = spark.createDataFrame([], "item long")
    for i, frame in enumerate([empty, spark.createDataFrame([(3,)], "item long"), empty]):
        log(frame, i)
    assert _as_dict(log.item_counts(spark)) == {3: 1}
    assert _as_dict(log.sizes(spark)) == {1: 1}


def test_running_counts(spark, stream, tmp_path):
    updates = Updates(str(tmp_path / "u"), every=2).run(running_counts(stream))
    assert _as_dict(updates.latest(spark)) == _counts(BATCHES)
    assert finished_batches(spark, f"{updates.folder}/snapshot") == [3]
    assert finished_batches(spark, f"{updates.folder}/rows") == [4]  # the rest is in the snapshot


def test_running_distinct(spark, stream, tmp_path):
    updates = Updates(str(tmp_path / "u"), ITEMS, every=2)
    updates.run(running_distinct(stream), mode="append")
    got = sorted(r["item"] for r in updates.latest(spark).collect())
    assert got == sorted(_counts(BATCHES))


def test_running_sketches(spark, stream, tmp_path):
    residues = Updates(str(tmp_path / "u"), RESIDUES).run(running_residues(stream))
    got = running_sketches(spark, residues, 3, 8)
    batch = spark.createDataFrame([(v,) for b in BATCHES for v in b], "item long")
    want = sketch_both(batch, 3, 8)
    assert want.count() == got.count() and want.exceptAll(got).count() == 0


@pytest.mark.parametrize("k", [1, 2, 3, 20])
def test_running_top_k(spark, stream, tmp_path, k):
    top = RunningTopK(str(tmp_path / "u"), k).run(stream)
    batch = spark.createDataFrame([(v,) for b in BATCHES for v in b], "item long")
    assert _as_dict(top.hitters(spark)) == _as_dict(top_k_heavy_hitters(item_counts(batch), k))
    # two batches are kept
    assert finished_batches(spark, f"{tmp_path}/u/hitters") == [3, 4]
    for i in (3, 4):
        so_far = _counts(BATCHES[:i + 1])
        kth = sorted(so_far.values(), reverse=True)[:k][-1]
        got = _as_dict(spark.read.parquet(f"{tmp_path}/u/hitters/batch={i}"))
        assert got == {x: c for x, c in so_far.items() if c >= kth}


def test_history_stays_bounded_and_replays_count_once(spark, tmp_path):
    log = BatchLog(str(tmp_path / "log"), every=3)
    updates = Updates(str(tmp_path / "u"), every=3)
    total = Counter()
    for i in range(11):
        rows = [i % 4, i % 4, i]
        total.update(rows)
        frame = spark.createDataFrame([(v,) for v in rows], "item long")
        changed = spark.createDataFrame([(v, total[v]) for v in set(rows)], "item long, cnt long")
        for _ in range(1 + (i in (2, 5, 6))):  # replays, of batches with a snapshot too
            log(frame, i)
            updates(changed, i)
        for folder in (log.folder, updates.folder):
            for part in os.listdir(folder):
                assert len(finished_batches(spark, f"{folder}/{part}")) <= 4
    assert _as_dict(log.item_counts(spark)) == total == _as_dict(updates.latest(spark))
    assert _as_dict(log.sizes(spark)) == {i: 3 for i in range(11)}
    # a restart goes on from the folder
    log = BatchLog(log.folder, every=3)
    log(spark.createDataFrame([(77,)], "item long"), 11)
    assert _as_dict(log.item_counts(spark)) == total + Counter([77])


def test_nothing_was_streamed(spark, tmp_path):
    assert Updates(f"{tmp_path}/a").latest(spark).collect() == []
    assert Updates(f"{tmp_path}/a", ITEMS).latest(spark).columns == ["item"]
    assert RunningTopK(f"{tmp_path}/b", 3).hitters(spark).collect() == []
    log = BatchLog(f"{tmp_path}/c")
    assert log.item_counts(spark).collect() == log.sizes(spark).collect() == []


def test_stream_batches_go_in_order(spark, tmp_path):
    rows = spark.createDataFrame([(v, 20 - i) for i, b in enumerate(BATCHES) for v in b],
                                 "item long, day int")
    log = BatchLog(str(tmp_path / "log"), 7)
    log.run(stream_batches(rows, "day", f"{tmp_path}/staged"))
    assert _as_dict(log.item_counts(spark)) == _counts(BATCHES[:2:-1])
