"""Document quality by a linear-chain conditional random field over lines."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairstream.llm.common import held_out, sampled, texts

#: Texts of a label that are learned from at most, and lines of each of them.
SAMPLE_TEXTS, SAMPLE_LINES = 1500, 200
#: A feature's values fall into so many bins between quantiles of the sample.
BINS = 8
PREDICT_FROM = 0.7

# kinds of bytes
_SPACE, _UPPER, _LOWER, _DIGIT, _HIGH, _MARK = range(6)
_KIND = np.full(256, _MARK, np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = _SPACE
_KIND[65:91], _KIND[97:123], _KIND[48:58], _KIND[128:] = _UPPER, _LOWER, _DIGIT, _HIGH
#: log length, shares of upper case, digits, marks and spaces, mean word length, share of distinct
#: words, share of words that end with a mark, times the line stood before, ends like a sentence
FEATURES = 10


def line_features(data: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of every line of the texts, and the number of lines of each text.

    Counts of byte kinds come from sums over the joined bytes, distinct words from the words.
    """
    lines = [t.split(b"\n") for t in data]
    counts = np.array([len(of) for of in lines], np.int64)
    joined = np.frombuffer(b"\n".join(data) + b"\n", np.uint8)
    ends = np.flatnonzero(joined == 10)
    starts = np.append(0, ends[:-1] + 1)
    kinds = _KIND[joined]

    def total(marks: np.ndarray) -> np.ndarray:
        upto = np.append(0, np.cumsum(marks, dtype=np.int64))
        return upto[ends] - upto[starts]

    size = (ends - starts).astype(np.float64)
    word_end = (kinds[:-1] != _SPACE) & (kinds[1:] == _SPACE)
    word_end = np.append(word_end, False)
    n_words, n_upper = total(word_end), total(kinds == _UPPER)
    # the byte before a line's newline may end a word; the newline itself is outside the line
    n_marked = total(word_end & (kinds == _MARK))
    n = np.maximum(size, 1.0)
    words = np.maximum(n_words, 1)
    distinct, before = np.ones(len(ends)), np.zeros(len(ends))
    at = 0
    for of_text in lines:
        seen: dict[bytes, int] = {}
        for line in of_text:
            parts = line.split()
            if len(parts) > 1:
                distinct[at] = len(set(parts)) / len(parts)
            if parts:
                before[at] = seen.get(line, 0)
                seen[line] = seen.get(line, 0) + 1
            at += 1
    last = joined[np.maximum(ends - 1, 0)]
    closes = (size > 0) & np.isin(last, np.frombuffer(b".!?\"'", np.uint8))
    spaces = total(kinds == _SPACE)
    return np.column_stack([
        np.log1p(size), n_upper / n, total(kinds == _DIGIT) / n, total(kinds == _MARK) / n,
        spaces / n, (size - spaces) / words, distinct, n_marked / words, before,
        closes.astype(np.float64)]), counts


def _neighbours(cells: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The active weights of each line: those of its own bins and of the lines beside it."""
    width = FEATURES * (BINS + 1)
    own = cells + np.arange(FEATURES) * (BINS + 1)
    firsts = np.append(0, np.cumsum(counts)[:-1])
    above, below = np.roll(own, 1, axis=0) + width, np.roll(own, -1, axis=0) + 2 * width
    outside = np.arange(FEATURES) * (BINS + 1) + BINS  # the bin of no line
    above[firsts] = outside + width
    below[firsts + counts - 1] = outside + 2 * width
    return np.concatenate([own, above, below], axis=1)


@dataclass
class LineField:
    """A chain over lines with states bad (0) and good (1), and the scale of document scores."""

    edges: list[np.ndarray]
    weights: np.ndarray       # per active feature and state
    moves: np.ndarray         # 2 x 2
    slope: float = 1.0
    offset: float = 0.0

    def active(self, data: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        features, counts = line_features(data)
        cells = np.column_stack([np.searchsorted(e, features[:, i], side="right")
                                 for i, e in enumerate(self.edges)])
        lengths = np.expm1(features[:, 0]) + 1.0
        return _neighbours(cells, counts), counts, lengths

    def marginals(self, active: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """P(good) of every line, by the forward-backward recursion over all texts at once."""
        return _forward_backward(self.weights[active].sum(axis=1), self.moves, counts)[0]

    def raw(self, data: list[bytes]) -> np.ndarray:
        """Per text, the log odds of the mean P(good), lines weighing as much as they are long."""
        active, counts, lengths = self.active(data)
        good = np.clip(self.marginals(active, counts), 1e-6, 1 - 1e-6)
        firsts = np.append(0, np.cumsum(counts)[:-1])
        share = np.add.reduceat(good * lengths, firsts) / np.add.reduceat(lengths, firsts)
        share = np.clip(share, 1e-6, 1 - 1e-6)
        return np.log(share / (1 - share))

    def scores(self, data: list[bytes]) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-(self.slope * self.raw(data) + self.offset)))


def _padded(values: np.ndarray, counts: np.ndarray):
    """Lines as (text, position), and the mask of those that exist."""
    mask = np.arange(counts.max()) < counts[:, None]
    out = np.zeros((*mask.shape, *values.shape[1:]))
    out[mask] = values
    return out, mask


def _forward_backward(scores: np.ndarray, moves: np.ndarray, counts: np.ndarray):
    """P(good) per line and the expected moves between neighbours."""
    # texts of like numbers of lines go together, so that a long one does not fill up the others
    good, expected = np.empty(len(scores)), np.zeros((2, 2))
    firsts = np.append(0, np.cumsum(counts)[:-1])
    order = np.argsort(counts, kind="stable")
    for some in np.array_split(order, max(1, len(order) // 64)):
        rows = np.concatenate([np.arange(firsts[i], firsts[i] + counts[i]) for i in some])
        s, mask = _padded(scores[rows], counts[some])
        n = s.shape[1]
        ahead, back = np.zeros_like(s), np.zeros_like(s)
        ahead[:, 0] = s[:, 0]
        for t in range(1, n):
            step = np.logaddexp(ahead[:, t - 1, :1] + moves[0], ahead[:, t - 1, 1:] + moves[1])
            ahead[:, t] = np.where(mask[:, t, None], step + s[:, t], ahead[:, t - 1])
        for t in range(n - 2, -1, -1):
            inner = back[:, t + 1] + s[:, t + 1]
            step = np.logaddexp(inner[:, :1] + moves[:, 0], inner[:, 1:] + moves[:, 1])
            back[:, t] = np.where(mask[:, t + 1, None], step, back[:, t])
        both = ahead + back
        good[rows] = (1.0 / (1.0 + np.exp(np.clip(both[..., 0] - both[..., 1], -700, 700))))[mask]
        if n > 1:
            total = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])
            pair = ahead[:, :-1, :, None] + moves + (s + back)[:, 1:, None, :] \
                - total[:, None, None, None]
            expected += np.exp(np.minimum(pair, 0.0))[mask[:, 1:]].sum(axis=0)
    return good, expected


def fit(data: list[bytes], labels: np.ndarray, steps: int = 150, rate: float = 0.1,
        decay: float = 1e-3) -> LineField:
    """Maximum likelihood with every line of a text labelled as the text is, classes balanced."""
    features, counts = line_features(data)
    edges = [np.unique(np.quantile(features[:, i], np.arange(1, BINS) / BINS))
             for i in range(FEATURES)]
    width = 3 * FEATURES * (BINS + 1)
    field = LineField(edges, np.zeros((width, 2)), np.zeros((2, 2)))
    active, counts, _ = field.active(data)
    of_line = np.repeat(labels, counts)
    share = max(1e-3, min(1 - 1e-3, float(of_line.mean())))
    weight = np.where(of_line == 1, 0.5 / share, 0.5 / (1 - share)) / len(of_line)
    want = np.column_stack([1 - of_line, of_line]).astype(np.float64)
    same = np.array([((1 - labels) * (counts - 1)).sum(), (labels * (counts - 1)).sum()])
    first = [np.zeros_like(field.weights), np.zeros_like(field.moves)]
    second = [np.zeros_like(field.weights), np.zeros_like(field.moves)]
    for step in range(1, steps + 1):
        good, expected = _forward_backward(field.weights[active].sum(axis=1), field.moves, counts)
        error = (np.column_stack([1 - good, good]) - want) * weight[:, None]
        slope = np.column_stack([
            np.bincount(active.ravel(), np.repeat(error[:, k], active.shape[1]), width)
            for k in range(2)]) + decay * field.weights
        moves = (expected - np.diag(same)) / len(of_line) + decay * field.moves
        for j, (p, g) in enumerate(((field.weights, slope), (field.moves, moves))):
            first[j] += 0.1 * (g - first[j])
            second[j] += 0.001 * (g * g - second[j])
            p -= rate * (first[j] / (1 - 0.9 ** step)) \
                / (np.sqrt(second[j] / (1 - 0.999 ** step)) + 1e-8)
    return _scaled(field, field.raw(data), labels)


def _scaled(field: LineField, raw: np.ndarray, labels: np.ndarray) -> LineField:
    """Slope (never negative) and offset that make scores probabilities, by Newton's method."""
    a, b = 1.0, 0.0
    x = np.column_stack([raw, np.ones(len(raw))])
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-(a * raw + b)))
        slope = x.T @ (p - labels) + np.array([1e-2 * a, 1e-2 * b])
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        a, b = a - float(np.clip(step[0], -1, 1)), b - float(np.clip(step[1], -3, 3))
    field.slope, field.offset = max(a, 1e-3), b
    return field


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality") -> LineField | None:
    """A field learned from labelled rows that are not held out; None without both labels.

    At most ``SAMPLE_TEXTS`` texts of each label are used, chosen by a hash, and the first
    ``SAMPLE_LINES`` lines of each; only learning is bounded so, scores are of whole texts. Of an
    id's texts the least is used. Classes are drawn alike; the scale of the scores is set for the
    shares that the sample has.
    """
    marks = labels.where(labels[label_col].isin(0, 1)) \
        .select(labels[id_col].alias("id"), labels[label_col].cast("int").alias("label")) \
        .where(~held_out(F.col("id"))).dropDuplicates(["id"])
    chosen = sampled(marks, "label", SAMPLE_TEXTS, F.xxhash64(F.lit("sample"), "id"))
    # one row for each of at most 2 * SAMPLE_TEXTS ids, however often an id is repeated
    rows = docs.select(docs[id_col].alias("id"),
                       F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text")) \
        .join(F.broadcast(chosen.select("id", "label", "mix")), "id") \
        .withColumn("text", F.substring_index("text", "\n", SAMPLE_LINES)) \
        .groupBy("mix", "id", "label").agg(F.min("text").alias("text")) \
        .orderBy("mix", "id").toPandas()
    if rows["label"].nunique() < 2:
        return None
    return fit([t.encode() for t in rows["text"]], rows["label"].to_numpy())


def score(docs: DataFrame, field: LineField | None, id_cols: list[str],
          text_col: str = "text", step: int = 1 << 20) -> DataFrame:
    """Per row the given columns, ``score`` (0 to 1, higher: label 1 likelier) and ``predicted``.

    All lines of the whole text are labelled; null is the empty text, which is one empty line.
    Without a field (no labels to learn from) every score is 0.5. Repeated rows are scored row by
    row. Texts are worked on about ``step`` characters at a time; nothing is shuffled.
    """
    names = [f"c{i}" for i in range(len(id_cols))]

    def run(batches):
        for batch in batches:
            found, group, n = [], [], 0
            for text in [*texts(batch, "text of row"), None]:
                if text is not None:
                    group.append(text.encode())
                    n += len(text)
                if group and (text is None or n >= step):
                    found.append(field.scores(group) if field else np.full(len(group), 0.5))
                    group, n = [], 0
            values = np.concatenate(found) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(names))), pa.array(values, pa.float64()),
                 pa.array((values >= PREDICT_FROM).astype(np.int32), pa.int32())],
                [*names, "score", "predicted"])

    narrow = docs.select(*(docs[c].alias(n) for n, c in zip(names, id_cols)),
                         docs[text_col].cast("string").alias("text of row"))
    schema = ", ".join(f"{n} {narrow.schema[n].dataType.simpleString()}" for n in names)
    return narrow.mapInArrow(run, f"{schema}, score double, predicted int") \
        .toDF(*id_cols, "score", "predicted")
