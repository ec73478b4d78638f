"""Alignment of two tokenizers' tokens over the same bytes, and corpus counts of linked id pairs."""

from __future__ import annotations

import gc
import hashlib
import re
from collections import defaultdict
from functools import lru_cache
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairstream.llm.common import stored, texts

#: Links that a task gathers into one chunk, whose distinct pairs look up their counts together. A
#: longer document is a chunk of its own.
CHUNK_LINKS = 1 << 19
#: Characters that are encoded and aligned at once.
AT_ONCE = 1 << 17
#: Rows of an Arrow batch whose texts become strings at once.
ROWS_AT_ONCE = 512
#: Units and their tokens that a Python worker remembers before it forgets those not met again.
MOST_UNITS, MOST_TOKENS = 1 << 18, 1 << 21
#: Characters that are letters in every version of Unicode, ASCII characters that are none, and the
#: marks and digits among these; an apostrophe may stay with letters behind it.
LETTERS, OTHERS, MARKS = "A-Za-zÀ-ÖØ-öø-ɏΑ-ΡΣ-ώЀ-ҁ", r"\x00-@\[-`{-\x7f", r"!-&(-@\[-`{-~"
#: Letters, marks or a line feed of which neither end depends on what stands there.
WORD = (rf"[{LETTERS}]++(?![^{OTHERS}])", rf"[{MARKS}]++(?=[{LETTERS} \n]|\Z)")
LINE_FEED = rf"\n(?=[{LETTERS}{MARKS}])"
_PER_DOC = ["n_a", "n_b", "n_groups", "n_links"]


def byte_level_table(tokenizer) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary.

    Such a vocabulary writes a byte as a character: printable ones as themselves, the others in
    order as the characters from U+0100 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    of = {chr(b): b for b in plain}
    of |= {chr(0x100 + i): b for i, b in enumerate(sorted(set(range(256)) - set(plain)))}
    table = [b""] * tokenizer.get_vocab_size()
    for token, i in tokenizer.get_vocab().items():
        table[i] = bytes(of[c] for c in token) if all(c in of for c in token) else token.encode()
    return table


def piece_table(processor) -> list[bytes]:
    """The bytes of each sentencepiece id: U+2581 is a space, a byte piece its byte."""
    return [bytes([int(processor.id_to_piece(i)[3:5], 16)]) if processor.is_byte(i)
            else processor.id_to_piece(i).replace("▁", " ").encode()
            for i in range(processor.get_piece_size())]


def byte_places(places: np.ndarray, text: str, data: bytes) -> np.ndarray:
    """Places in a text, in characters, as places in its bytes."""
    if len(data) == len(text):
        return places
    raw = np.frombuffer(data, np.uint8)
    return np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(data))[places]


def byte_ends(begins: np.ndarray, ends: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Where each token ends, from coarse spans and the lengths of the decoded tokens, in bytes.

    A span's end is a cut where the span is not empty and the next one does not begin before it.
    Tokens that share a character, or stand for a byte of one, have no such end; theirs are counted
    in decoded bytes from the last cut before them.
    """
    cut = ends > begins
    cut[:-1] &= begins[1:] >= ends[:-1]
    if cut.all():
        return ends
    places = np.arange(len(ends))
    last = np.maximum.accumulate(np.where(cut, places, -1))
    total = np.cumsum(lengths)
    known = np.where(last >= 0, ends[last] - total[last], 0)
    return np.where(cut, ends, known + total)


is_letter = re.compile(f"[{LETTERS}]").match


class Rows:
    """A column of 32-bit integers that grows at its end."""

    def __init__(self):
        self._room, self._n = np.empty(1 << 12, np.int32), 0

    def extend(self, more: np.ndarray) -> None:
        upto = self._n + len(more)
        if upto > len(self._room):
            room = np.empty(max(upto, 2 * len(self._room)), np.int32)
            room[:self._n] = self.values
            self._room = room
        self._room[self._n:upto] = more
        self._n = upto

    @property
    def values(self) -> np.ndarray:
        return self._room[:self._n]

    def __len__(self) -> int:
        return self._n


class Units:
    """Tokens of distinct units, stretches of text whose tokens do not depend on their neighbours.

    New units are encoded together, one behind the other as one text, unless ``joins`` says that a
    unit's own ends would not hold there. One that does not begin with a space is encoded behind
    another, whose tokens are left out. Ids and byte ends are kept one behind the other, and of
    each unit where its tokens start, how many there are, its bytes and whether they came back; from
    these the tokens of any run of units are put together. ``row`` says where a unit's row is, by a
    number that both tokenizers use, or -1, and ``again`` whether it was met after it was encoded.
    """

    def __init__(self, encode, joins, table: list[bytes]):
        self._encode, self._joins, self._table = encode, joins, np.array(table, object)
        self.length = np.array([len(x) for x in table], np.int64)
        self.forget()

    def forget(self) -> None:
        self.row, self.again = Rows(), Rows()
        self.ids, self.ends, self.start, self.n, self.size, self.back = (Rows() for _ in range(6))

    def keep(self, kept: np.ndarray) -> None:
        """Remembers these units only, which are numbered anew in this order."""
        rows = self.row.values[kept]
        known = rows >= 0
        rows, row = rows[known], np.where(known, np.cumsum(known) - 1, -1)
        n, size, back = (x.values[rows] for x in (self.n, self.size, self.back))
        place = self._places(rows)
        ids, ends = self.ids.values[place], self.ends.values[place]
        self.forget()
        for column, more in ((self.row, row), (self.again, np.zeros(len(kept))), (self.ids, ids),
                             (self.ends, ends), (self.n, n), (self.size, size), (self.back, back),
                             (self.start, np.cumsum(n, dtype=np.int64) - n)):
            column.extend(more)

    def make_room(self, n_known: int) -> None:
        for column, value in ((self.row, -1), (self.again, 0)):
            column.extend(np.full(n_known - len(column), value))

    def rows(self, numbers: np.ndarray, units: list[str], n_known: int) -> np.ndarray:
        """The rows of units, by their numbers below ``n_known``; new units are encoded."""
        self.make_room(n_known)
        found = self.row.values[numbers] >= 0
        self.again.values[numbers[found]] = 1
        new = np.flatnonzero(~found)
        if len(new):
            _, first = np.unique(numbers[new], return_index=True)
            new = new[first]
            fresh = np.array([units[i] for i in new.tolist()], object)
            joined = np.fromiter(map(bool, map(self._joins, fresh)), bool, len(new))
            if joined.any() and not self._add(numbers[new[joined]], fresh[joined]):
                joined[:] = False
            for i in np.flatnonzero(~joined):
                self._add(numbers[new[i:i + 1]], fresh[i:i + 1], alone=True)
        return self.row.values[numbers]

    def _add(self, numbers: np.ndarray, units: np.ndarray, alone: bool = False) -> bool:
        parts = [part for u in units for part in (self._lead(u), u)]
        text = "".join(parts)
        data = text.encode()
        ids, begins, ends = self._encode(text, data)
        ends = byte_ends(begins, ends, self.length[ids])
        back = b"".join(self._table[ids].tolist()) == data
        stop = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
        stop = byte_places(stop, text, data)
        upto = np.searchsorted(ends, stop, "right")
        begin, size = stop[::2], stop[1::2] - stop[::2]
        n = (upto[1::2] - upto[::2]) * back
        if not alone and not (n.all() and (np.append(0, ends)[upto] == stop).all()):
            return False
        self.row.values[numbers] = len(self.n) + np.arange(len(units))
        self.start.extend(len(self.ids) + np.cumsum(n) - n)
        place = np.arange(n.sum()) + np.repeat(upto[::2] - (np.cumsum(n) - n), n)
        for column, more in ((self.ids, ids[place]), (self.ends, ends[place] - np.repeat(begin, n)),
                             (self.n, n), (self.size, size),
                             (self.back, np.full(len(units), back))):
            column.extend(more)
        return True

    @staticmethod
    def _lead(unit: str) -> str:
        """What a unit that does not begin with a space is encoded behind."""
        return "" if unit[0] == " " else " #" if is_letter(unit) else " a"

    def tokens(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, byte ends and the numbers of tokens of units' rows, one behind the other."""
        n, size = self.n.values[rows], self.size.values[rows]
        place, before = self._places(rows), np.cumsum(size, dtype=np.int64) - size
        return self.ids.values[place].astype(np.int64), \
            self.ends.values[place] + np.repeat(before, n), n

    def _places(self, rows: np.ndarray) -> np.ndarray:
        """Where the tokens of units' rows are."""
        n = self.n.values[rows]
        upto = np.cumsum(n, dtype=np.int64)
        return np.arange(upto[-1] if len(upto) else 0) + np.repeat(
            self.start.values[rows] - (upto - n), n)


class Aligner:
    """Encodes texts with both tokenizers and aligns the tokens of a run of texts.

    Neither tokenizer joins bytes over certain places, so what stands between these is a unit. A
    begins a new pre-token at each space before another character than white space, at each change
    between letters and other characters, but for an apostrophe before letters, and at a line feed
    between two of these. B has no piece with a space behind another character (where a vocabulary
    has one, texts are units as a whole) and none that holds such a change (where a vocabulary has
    one, or A's pre-tokens differ, only spaces count). So a word is one unit whatever marks stand
    around it. Where every space is a single one before such a character, the units of both are the
    same.
    """

    def __init__(self, tokenizer_path: str, model_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(tokenizer_path)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.bytes_a, self.bytes_b = byte_level_table(self.a), piece_table(self.b)
        self.space = self.b.piece_to_id("▁")
        apart = not any(b" " in x.lstrip(b" ") for x in self.bytes_b)
        fine = self._words_apart()
        self.split_a = self._splitter(" ?", r"(?s:.)[^ ]*(?: (?!\S)[^ ]*)*", fine)
        self.split_b = self._splitter(" *+", " +[^ ]*|[^ ]+", fine) if apart else \
            lambda text: [text]
        differs = re.compile(r" (?!\S)").search
        self.alike = lambda text: apart and not differs(text)
        self.units_a = Units(self._encode_a, re.compile(r"[^ ]| \S").match, self.bytes_a)
        self.units_b = Units(self._encode_b, re.compile(r"[^▁]+(?<! )\Z").match if apart else
                             lambda unit: False, self.bytes_b)
        self.numbers = defaultdict(count().__next__)  # of units, in the order of their first use
        self.names = {}
        for key, table, ends in (("a", self.bytes_a, ",|"), ("b", self.bytes_b, ",;")):
            self.names[key] = np.array([f"{i}{end}" for end in ends for i in range(len(table))],
                                       object)

    @staticmethod
    def _splitter(spaces: str, rest: str, fine: bool):
        """Cuts a text into units: words where ``fine``, and what else reaches to a space."""
        words = [*(spaces + word for word in WORD), LINE_FEED] if fine else []
        return re.compile("|".join([*words, rest])).findall

    def _words_apart(self) -> bool:
        """Whether both tokenizers part words from marks and line feeds."""
        parts = [" ab", "#", "cd", "\n", "é", "12", "-", "gh", "'s", "_", "d", "?", "\n", "!"]
        pre, whole = self.a.pre_tokenizer, "".join(parts)
        if pre is None or [whole[i:j] for _, (i, j) in pre.pre_tokenize_str(whole)] != parts:
            return False
        change = re.compile(rf"[{LETTERS}][{OTHERS}]|[{MARKS}][{LETTERS}\n]|\n[{LETTERS}{MARKS}]")
        named = (self.b.is_control, self.b.is_unknown)  # never found in a text
        return not any(change.search(x.decode(errors="replace"))
                       for i, x in enumerate(self.bytes_b) if not any(f(i) for f in named))

    def _forget(self) -> None:
        """Remembers only units that were met again, or none where that frees too little."""
        both, names = (self.units_a, self.units_b), list(self.numbers)
        again = np.zeros(len(names), bool)
        for units in both:
            units.make_room(len(names))
            again |= units.again.values > 0
        kept = np.flatnonzero(again)
        for units in both:
            units.keep(kept)
        if 4 * len(kept) > 3 * MOST_UNITS \
                or 4 * max(len(units.ids) for units in both) > 3 * MOST_TOKENS:
            kept = kept[:0]
            for units in both:
                units.forget()
        self.numbers = defaultdict(count(len(kept)).__next__,
                                   zip([names[i] for i in kept.tolist()], range(len(kept))))

    def _numbers(self, units: list[str]) -> np.ndarray:
        return np.fromiter(map(self.numbers.__getitem__, units), np.int64, len(units))

    def _encode_a(self, text: str, data: bytes):
        """Ids and spans in bytes, from the encoder's offsets in characters."""
        found = self.a.encode(text, add_special_tokens=False)
        spans = np.fromiter(chain.from_iterable(found.offsets), np.int64)
        spans = byte_places(spans, text, data)
        return np.array(found.ids, np.int64), spans[::2], spans[1::2]

    def _encode_b(self, text: str, data: bytes):
        """Ids and the byte spans of the encoder's proto; these do not count the space that it
        adds, which is the text's first."""
        if text == " ":
            return np.array([self.space]), np.array([0]), np.array([1])
        found = self.b.encode(text[1:], return_type="offset_mapping", return_bytes=True)
        spans = np.fromiter(chain.from_iterable(found["offsets"]), np.int64) + 1
        return np.array(found["ids"], np.int64), spans[::2], spans[1::2]

    def encode(self, values: list[str]):
        """Ids, byte ends and numbers of tokens of both tokenizers, and which texts they are of.

        Empty texts and those that either tokenizer does not give back byte by byte are left out.
        """
        if len(self.numbers) > MOST_UNITS \
                or max(len(self.units_a.ids), len(self.units_b.ids)) > MOST_TOKENS:
            self._forget()
        used, split = [], ([], [])
        for i, text in enumerate(values):
            if text:
                used.append(i)
                text = " " + text
                words = self.split_a(text)
                found = words, self._numbers(words)
                split[0].append(found)
                if not self.alike(text):
                    words = self.split_b(text)
                    found = words, self._numbers(words)
                split[1].append(found)
        sides = []
        for units, found in zip((self.units_a, self.units_b), split):
            owner = np.repeat(np.arange(len(used)), [len(n) for _, n in found])
            numbers = np.concatenate([np.zeros(0, np.int64), *(n for _, n in found)])
            words = list(chain.from_iterable(words for words, _ in found))
            sides.append((units, units.rows(numbers, words, len(self.numbers)), owner))
        good = np.ones(len(used), bool)
        for units, rows, owner in sides:
            good[owner[units.back.values[rows] == 0]] = False
        out = []
        for units, rows, owner in sides:
            ids, ends, n = units.tokens(rows[good[owner]])
            counts = np.bincount(owner[good[owner]], n, len(used))[good].astype(np.int64)
            out.append((ids, ends, counts))
        return *out, np.array(used, np.int64)[good]

    def align(self, values: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
        """For texts: numbers ``_PER_DOC``, link pairs, the text of each, groups.

        A pair is an id of A times 2^32 plus an id of B. Texts without tokens have zeros and an
        empty string of groups.
        """
        numbers, groups = np.zeros((len(values), 4), np.int64), [""] * len(values)
        (a, ends_a, n_a), (b, ends_b, _), used = self.encode(values)
        if not len(used):
            return numbers, np.zeros(0, np.int64), np.zeros(0, np.int64), groups
        last = ends_a[np.cumsum(n_a) - 1]  # of each text
        marks = np.zeros(last[-1] + 1, np.uint8)
        marks[ends_a] = 1
        marks[ends_b] |= 2
        cuts = np.flatnonzero(marks)
        marks = marks[cuts]
        of_a, of_b, both = (marks & 1) > 0, marks > 1, marks == 3
        # the bytes before a cut, back to the cut before it, are in one token of each
        pairs = (a[np.cumsum(of_a) - of_a] << 32) | b[np.cumsum(of_b) - of_b]
        doc = np.searchsorted(last, cuts)
        group = np.cumsum(both) - both
        counts = [np.bincount(doc[some], minlength=len(used))
                  for some in (of_a, of_b, both, slice(None))]
        numbers[used] = np.stack(counts, axis=1)
        group_a, group_b = group[of_a], group[of_b]
        n = int(group[-1]) + 1
        out = np.empty(len(a) + len(b), object)
        before = np.cumsum(np.bincount(group_b, minlength=n))
        before = np.concatenate(([0], before[:-1]))[group_a]
        out[np.arange(len(a)) + before] = self.names["a"][a + len(self.bytes_a) * both[of_a]]
        before = np.cumsum(np.bincount(group_a, minlength=n))[group_b]
        out[np.arange(len(b)) + before] = self.names["b"][b + len(self.bytes_b) * both[of_b]]
        words, at = out.tolist(), 0
        for i in used.tolist():
            upto = at + int(numbers[i, 0] + numbers[i, 1])
            groups[i] = "".join(words[at:upto])[:-1]
            at = upto
        return numbers, pairs, used[doc], groups


@lru_cache(maxsize=1)
def aligner(tokenizer_path: str, model_path: str) -> Aligner:
    """One for all tasks of a Python worker, so that later ones know the units of those before."""
    return Aligner(tokenizer_path, model_path)


def _chunk(number: int, keys: list, kind, numbers, pairs, docs, groups) -> pa.RecordBatch:
    """One row for a run of documents: their numbers, the distinct pairs with the number of
    documents that hold them, and which document holds which pair how often."""
    distinct, place = np.unique(pairs, return_inverse=True)
    held, times = np.unique(docs * len(distinct) + place, return_counts=True)
    owner, place = np.divmod(held, max(1, len(distinct)))
    lists = [pa.array([keys], pa.list_(kind))]
    lists += [pa.array([numbers[:, k]], pa.list_(pa.int64())) for k in range(4)]
    lists += [pa.array([groups], pa.list_(pa.string())),
              pa.array([np.bincount(owner, minlength=len(keys))], pa.list_(pa.int64())),
              pa.array([np.diff(held, prepend=0).astype("<u8").tobytes()], pa.binary()),
              pa.array([times.astype("<u4").tobytes()], pa.binary()),
              pa.array([distinct], pa.list_(pa.int64())),
              pa.array([np.bincount(place, minlength=len(distinct))], pa.list_(pa.int64()))]
    return pa.RecordBatch.from_arrays(
        [pa.array([number], pa.int64()), *lists],
        ["chunk", "keys", *_PER_DOC, "groups", "held", "steps", "times", "pairs", "holders"])


def chunks_of(docs: DataFrame, tokenizer_path: str, model_path: str, digest: bool) -> DataFrame:
    """Rows of :func:`_chunk` for ``key, text``."""

    def run(batches):
        both, task = aligner(tokenizer_path, model_path), TaskContext.get().partitionId() << 32
        keys, parts, links, kind = [], [], 0, pa.int64()

        def flush():
            nonlocal keys, parts, links, task
            shift = np.cumsum([0, *(len(p[0]) for p in parts)])
            row = _chunk(task, keys, kind, np.concatenate([p[0] for p in parts]),
                         np.concatenate([p[1] for p in parts]),
                         np.concatenate([p[2] + s for p, s in zip(parts, shift)]),
                         [g for p in parts for g in p[3]])
            keys, parts, links, task = [], [], 0, task + 1
            return row

        def take(run_keys, values):
            nonlocal links
            gc.disable()  # it would walk all remembered units, and nothing here forms cycles
            try:
                numbers, pairs, owner, groups = both.align(values)
            finally:
                gc.enable()
            if digest:
                groups = [g and hashlib.sha256(g.encode()).hexdigest() for g in groups]
            parts.append((numbers, pairs, owner, groups))
            keys.extend(run_keys)
            links += len(pairs)

        for batch in (whole.slice(at, ROWS_AT_ONCE) for whole in batches
                      for at in range(0, whole.num_rows, ROWS_AT_ONCE)):
            kind = batch.schema.field("key").type
            waiting, values, n = [], [], 0
            for key, text in zip(batch.column("key").to_pylist(), texts(batch)):
                waiting.append(key)
                values.append(text)
                n += len(text)
                if n >= AT_ONCE:
                    take(waiting, values)
                    waiting, values, n = [], [], 0
                    if links >= CHUNK_LINKS:
                        yield flush()
            if waiting:
                take(waiting, values)
                if links >= CHUNK_LINKS:
                    yield flush()
        if keys:
            yield flush()

    kind = docs.schema["key"].dataType.simpleString()
    lists = ", ".join(f"{c} array<long>" for c in _PER_DOC)
    return docs.mapInArrow(run, f"chunk long, keys array<{kind}>, {lists}, groups array<string>, "
                                "held array<long>, steps binary, times binary, "
                                "pairs array<long>, holders array<long>")


def pair_counts(chunks: DataFrame) -> DataFrame:
    """``pair, cnt``: how many documents hold a pair of ids linked."""
    rows = chunks.select(F.explode(F.arrays_zip("pairs", "holders")).alias("row"))
    return rows.groupBy(F.col("row.pairs").alias("pair")).agg(F.sum("row.holders").alias("cnt"))


def aligned(docs: DataFrame, tokenizer_path: str, model_path: str, id_col: str = "doc_id",
            text_col: str = "text", digest: bool = False) -> DataFrame:
    """Links the tokens of a byte-level tokenizer (A, over space and text) with those of a
    sentencepiece model (B, which adds the space itself).

    Character offsets of A and byte spans of B are coarse cuts; tokens that share a character are
    told apart by their decoded bytes. Bytes where tokens of both end cut them into groups; tokens
    that overlap are linked. Per row: the id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``,
    ``groups`` (decimal ids, as ``a1,a2|b1;a3|b2,b3``; with ``digest`` their lowercase-hex sha256,
    empty without tokens), ``n_best`` (links whose pair has its A id's highest count) and
    ``count_sum`` (counts added over links). A pair's count is the number of rows that hold it
    linked, over the whole table.

    A Python worker encodes each distinct unit once, as long as it remembers it. A task writes
    chunks of documents with their distinct pairs to the shared folder; counts are summed per pair,
    and every chunk looks up each of its pairs once, so a pair that all documents hold costs a row
    per chunk. The table of A's highest counts, which is broadcast, has at most a row for each id of
    its vocabulary.

    Null and empty texts, and those that either tokenizer does not give back byte by byte, have
    zeros and no groups. Repeated rows count row by row; a null id stays null. A very long text is
    a chunk of its own. An empty table gives an empty result; other columns are not read.
    """
    rows = docs.select(docs[id_col].alias("key"), docs[text_col].cast("string").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    chunks = stored(chunks_of(rows, tokenizer_path, model_path, digest), "chunks")
    counts = stored(pair_counts(chunks), "pairs")
    best = counts.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("cnt").alias("most"))
    counted = counts.withColumn("a", F.shiftright("pair", 32)).join(F.broadcast(best), "a") \
        .select("pair", "cnt", (F.col("cnt") == F.col("most")).alias("best"))
    asked = chunks.select("chunk", F.posexplode("pairs").alias("pos", "pair"))
    looked = asked.join(counted, "pair").groupBy("chunk").agg(
        F.array_sort(F.collect_list(F.struct("pos", "cnt", "best"))).alias("found"))

    def finish(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                n = len(row["pairs"])
                found = row["found"].values
                cnt, top = (found.field(c).to_numpy(zero_copy_only=False) if n else
                            np.zeros(0, np.int64) for c in ("cnt", "best"))
                held = row["held"].values.to_numpy(zero_copy_only=False)
                steps = np.frombuffer(row["steps"].as_py(), "<u8").astype(np.int64)
                place = np.cumsum(steps) % max(1, n)
                times = np.frombuffer(row["times"].as_py(), "<u4").astype(np.int64)
                upto = np.concatenate(([0], np.cumsum(held)))
                sums = []
                for value in (times * top[place], times * cnt[place]):
                    total = np.concatenate(([0], np.cumsum(value, dtype=np.int64)))
                    sums.append(pa.array(np.diff(total[upto]), pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [row["keys"].values, *(row[c].values for c in _PER_DOC),
                     row["groups"].values, *sums],
                    ["key", *_PER_DOC, "groups", "n_best", "count_sum"])

    numbers = ", ".join(f"{c} long" for c in _PER_DOC)
    return chunks.drop("holders").join(looked, "chunk", "left").mapInArrow(
        finish, f"key {kind}, {numbers}, groups string, n_best long, count_sum long") \
        .withColumnRenamed("key", id_col)
