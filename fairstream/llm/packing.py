"""Harmonic packing of token sequences."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from fairstream.llm.common import slices, texts
from fairstream.llm.secrets import read_ranks

#: A rest below this is not cut further; at its class it leaves at most as much unused.
SHORT = 32
_OUT = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


class Ids:
    """Token ids of a text as little-endian bytes.

    The tokenizer file and the ranks hold one vocabulary, so both give the same ids; the encoder of
    the ranks is about four times as fast. Only a text that holds one of the tokenizer's added
    tokens is left to the tokenizer file's own encoder, which takes them as such.
    """

    def __init__(self, tokenizer_path: str, ranks: dict[bytes, int], pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(tokenizer_path)
        self.added = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.encoding = tiktoken.Encoding("pack", pat_str=pattern, mergeable_ranks=ranks,
                                          special_tokens={})

    def of(self, text: str) -> bytes:
        if any(a in text for a in self.added):
            ids = self.whole.encode(text, add_special_tokens=False).ids
        else:
            ids = self.encoding.encode_ordinary(text)
        return np.array(ids, dtype="<u4").tobytes()


def cut(n: int, size: int) -> list[int]:
    """Lengths of the pieces of a document: whole sequences, then the largest size/j that fits."""
    pieces = [size] * (n // size)
    rest = n % size
    while rest:
        piece = size // -(-size // rest)
        if rest < SHORT:
            piece = rest
        pieces.append(piece)
        rest -= piece
    return pieces


class Bins:
    """Open bins of one worker: one per class, of which class j takes exactly j pieces.

    A piece of more than size/(j+1) and at most size/j ids belongs to class j.
    """

    def __init__(self, size: int):
        self.size, self.open, self.sequences = size, {}, 0

    def add(self, piece: tuple, length: int):
        """The rows of the bin that this piece fills, if it does."""
        j = self.size // length
        waiting = self.open.setdefault(j, [])
        waiting.append((length, piece))
        return self._close(self.open.pop(j)) if len(waiting) == j else ()

    def _close(self, pieces):
        rows, offset = [], 0
        for length, piece in pieces:
            rows.append((*piece, self.sequences, offset))
            offset += length
        self.sequences += 1
        return rows

    def rest(self):
        """What is left in the open bins, longest piece first into the first bin with room."""
        left = sorted((p for pieces in self.open.values() for p in pieces),
                      key=lambda p: -p[0])
        bins, room = [], []
        for p in left:
            at = next((i for i, r in enumerate(room) if r >= p[0]), None)
            if at is None:
                bins.append([])
                room.append(self.size)
                at = len(bins) - 1
            bins[at].append(p)
            room[at] -= p[0]
        self.open = {}
        return [row for pieces in bins for row in self._close(pieces)]


def pack(docs: DataFrame, tokenizer_path: str, ranks_path: str, pattern: str, size: int = 1024,
         end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Packs all texts into sequences of at most ``size`` token ids.

    A document is its ids and ``end_id`` (a null text is an empty one). It is cut into whole
    sequences and pieces of size/j ids; every worker fills bins of class j with j pieces on its own,
    and at its end packs the at most j - 1 pieces left of each class together. So a worker leaves
    about one sequence unfilled, whatever it reads, and no text or id is shuffled. Rows, one per
    piece: the id, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id`` (the
    worker's number and its sequence's) and ``offset``. ``ranks_path`` and ``pattern`` are the same
    vocabulary's ranks and splitting pattern. Repeated rows are packed as often as they
    occur. Sequences depend on how the scan is split, not on timing.
    """

    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def run(batches):
        ids = Ids(tokenizer_path, ranks.value, pattern)
        end, bins = end_id.to_bytes(4, "little"), Bins(size)
        first = TaskContext.get().partitionId() << 33

        def emit(rows):
            columns = list(zip(*rows)) or [()] * 7
            arrays = [pa.array(columns[0], key_type)]
            arrays += [pa.array(c, pa.int64()) for c in columns[1:5]]
            arrays += [pa.array([first + s for s in columns[5]], pa.int64()),
                       pa.array(columns[6], pa.int64())]
            return pa.RecordBatch.from_arrays(arrays, _OUT)

        key_type = pa.int64()
        for batch in slices(batches):
            key_type = batch.schema.field("key").type
            keys, values, rows = batch.column("key").to_pylist(), texts(batch), []
            for key, text in zip(keys, values):
                data = ids.of(text) + end
                total, start = len(data) // 4, 0
                for length in cut(total, size):
                    crc = zlib.crc32(data[4 * start:4 * (start + length)])
                    rows += bins.add((key, start, length, crc, total), length)
                    start += length
            yield emit(rows)
        yield emit(bins.rest())

    narrow = docs.select(docs[id_col].alias("key"), docs[text_col].cast("string").alias("text"))
    kind = narrow.schema["key"].dataType.simpleString()
    packed = narrow.mapInArrow(run, f"doc_id {kind}, start long, length long, ids_crc32 long, "
                                    "doc_tokens long, sequence_id long, offset long")
    return packed.withColumnRenamed("doc_id", id_col)
