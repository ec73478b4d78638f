"""What a task holds of a large Arrow batch."""

import tracemalloc
from types import SimpleNamespace

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fairstream.llm import language_id, packing, secrets
from tests.llm.conftest import prose

TEXT = prose(1, 500)


@pytest.fixture
def handed(monkeypatch, docs):
    """Rows, and what operators hand to ``mapInArrow``: the frame and the function."""
    rows = [(1, prose(1, 60), "en", "a"), (2, prose(2, 60).upper(), "de", None), (3, None)]
    df, calls = docs(*rows).select("doc_id", "text", "lang"), []
    real = type(df).mapInArrow

    def noted(self, function, *rest):
        calls.append((self, function))
        return real(self, function, *rest)

    monkeypatch.setattr(type(df), "mapInArrow", noted)
    task = SimpleNamespace(partitionId=lambda: 0)
    monkeypatch.setattr(packing, "TaskContext", SimpleNamespace(get=lambda: task))
    return df, calls


def check_small(frame, function, text: str, n: int = 8000) -> int:
    """The output rows of a batch of many texts, of which a task holds and passes on a part."""
    batch = pa.RecordBatch.from_pydict(
        {f.name: pa.array([TEXT] * n if f.name == text else
                          list(range(n)) if f.dataType.typeName() == "long" else ["en"] * n)
         for f in frame.schema})
    function(iter([batch.slice(0, 1)])).__next__()
    tracemalloc.start()
    rows = largest = 0
    for out in function(iter([batch])):
        rows += out.num_rows
        largest = max(largest, out.nbytes)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert largest < n * len(TEXT) / 3
    assert peak < n * len(TEXT) / 2
    return rows


def test_language_takes_texts_once_and_some_at_a_time(handed):
    df, calls = handed
    network = language_id.train(df, F.lit(True))
    found = language_id.identify(df, network, df.columns, step=64)
    (frame, function), = calls
    assert frame.columns == ["c0", "c1", "c2"]
    assert check_small(frame, function, "c1") == 8000
    plain = language_id.identify(df, network, ["doc_id"], step=64)
    assert sorted(found.select(*plain.columns).collect()) == sorted(plain.collect())
    assert sorted(found.select(*df.columns).collect(), key=str) == sorted(df.collect(), key=str)
    # a text that is no string is cast for the network only
    cast = df.select("doc_id", F.col("text").cast("binary").alias("text"))
    again = language_id.identify(cast, network, cast.columns, step=64)
    assert again.select("text").dtypes == [("text", "binary")]
    assert sorted(again.select(*plain.columns).collect()) == sorted(plain.collect())


def test_secrets_some_at_a_time(handed, vocabulary):
    df, calls = handed
    secrets.scan_secrets(df, vocabulary["ranks"], vocabulary["pattern"], ["doc_id", "lang"])
    (frame, function), = calls
    assert check_small(frame, function, "text of row") == 8000


def test_packing_some_at_a_time(handed, vocabulary):
    df, calls = handed
    packing.pack(df, vocabulary["tokenizer"], vocabulary["ranks"], vocabulary["pattern"])
    (frame, function), = calls
    assert check_small(frame, function, "text") > 8000
