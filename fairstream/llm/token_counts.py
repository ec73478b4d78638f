"""Word-piece counts by a linear longest-match automaton."""

from __future__ import annotations

import base64
from collections import deque
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame

from fairstream.llm.common import texts

#: Words whose counts a task keeps at most before it starts anew.
CACHED_WORDS = 300_000


def read_pieces(path: str) -> tuple[set[bytes], set[bytes]]:
    """Pieces that start a word and pieces that continue one, of a vocabulary file of byte ranks.

    A token with a leading space starts a word; one without white space continues it. Where no
    token with a leading space fits, a word starts with a continuing piece: such pieces are
    starts too unless they begin with a start, so that they change no other word.
    """
    starts, inner = set(), set()
    with open(path, "rb") as lines:
        for line in lines:
            token = base64.b64decode(line.split()[0])
            if token[:1] == b" " and len(token) > 1 and len(token.split()) == 1:
                starts.add(token[1:])
            elif len(token.split()) == 1 and token == token.strip():
                inner.add(token)
    bare = {p for p in inner if not any(p[:n] in starts for n in range(1, len(p) + 1))}
    return starts | bare, inner


class Automaton:
    """Trie over both kinds of pieces with failure links and popped-token counts.

    ``step`` maps ``node * 256 + byte`` to a node. Node 0 is the start of a word, node 1 the state
    after a complete piece. Where a node has no step, ``link`` names the node that stands for what
    is left after the longest pieces are taken off, and ``popped`` how many pieces those were.
    A link of -1 means that no sequence of pieces covers the word.
    """

    def __init__(self, starts: Iterable[bytes], inner: Iterable[bytes]):
        self.step: dict[int, int] = {}
        final = {}
        size = 2
        for root, pieces in ((0, starts), (1, inner)):
            for piece in pieces:
                node = root
                for byte in piece:
                    key = node * 256 + byte
                    node = self.step.get(key, 0)
                    if not node:
                        node = self.step[key] = size
                        size += 1
                if piece:
                    final[node] = True
        children: list[list[tuple[int, int]]] = [[] for _ in range(size)]
        for key, node in self.step.items():
            children[key >> 8].append((key & 255, node))
        self.link, self.popped = [-1] * size, [0] * size
        queue = deque((0, 1))
        while queue:
            above = queue.popleft()
            for byte, node in children[above]:
                if node in final:
                    self.link[node], self.popped[node] = 1, 1
                else:
                    at, count = self.link[above], self.popped[above]
                    while at >= 0 and at * 256 + byte not in self.step:
                        at, count = self.link[at], count + self.popped[at]
                    if at >= 0:
                        self.link[node] = self.step[at * 256 + byte]
                        self.popped[node] = count
                queue.append(node)

    def count(self, word: bytes) -> int:
        """Pieces of the greedy longest-match split; 1, the unknown token, if there is no split."""
        step, link, popped = self.step, self.link, self.popped
        node = total = 0
        for byte in word:
            key = node * 256 + byte
            while key not in step:
                total += popped[node]
                node = link[node]
                if node < 0:
                    return 1
                key = node * 256 + byte
            node = step[key]
        while node > 1:
            total += popped[node]
            node = link[node]
            if node < 0:
                return 1
        return total


class _Counts(dict):
    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        n = self[word] = self.automaton.count(word)
        return n


def token_counts(docs: DataFrame, pieces: tuple[set[bytes], set[bytes]], id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Per document: ``n_words``, ``n_tokens`` and ``max_word_tokens``.

    Words are runs of bytes outside the six ASCII white-space characters. Each is split greedily
    into the longest pieces, of which only the number is found. Null and empty texts count 0.
    Repeated rows are counted row by row. The automaton, whose size is that of the vocabulary,
    is the only thing broadcast; nothing is shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Automaton(*pieces))

    def count(batches):
        known = _Counts(shared.value)
        for batch in batches:
            words, tokens, most = [], [], []
            for text in texts(batch, "text"):
                found = [known[w] for w in text.encode().split()]
                words.append(len(found))
                tokens.append(sum(found))
                most.append(max(found, default=0))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(words, pa.int64()), pa.array(tokens, pa.int64()),
                 pa.array(most, pa.int64())], ["key", "n_words", "n_tokens", "max_word_tokens"])

    narrow = docs.select(docs[id_col].alias("key"), docs[text_col].cast("string").alias("text"))
    kind = narrow.schema["key"].dataType.simpleString()
    counted = narrow.mapInArrow(
        count, f"key {kind}, n_words long, n_tokens long, max_word_tokens long")
    return counted.withColumnRenamed("key", id_col)
