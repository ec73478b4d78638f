"""Language identification by a byte convolutional network."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from fairstream.llm.common import ROWS_AT_ONCE, sampled, slices, texts

#: Texts of a language that are learned from at most, and windows of each of them.
SAMPLE_TEXTS, SAMPLE_WINDOWS = 400, 3
#: Bytes of a window; widths of the filters, and filters of each width.
WINDOW, WIDTHS, FILTERS = 128, (2, 3, 4), 8
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")


def windows(data: bytes) -> np.ndarray:
    """All windows of a text's bytes, side by side, the last one filled up with 0."""
    n = max(1, -(-len(data) // WINDOW))
    return np.frombuffer(data.ljust(n * WINDOW, b"\0"), np.uint8).reshape(n, WINDOW)


class ByteNetwork:
    """Filters of several widths over bytes, ReLU, max pooling over the window, and softmax.

    A filter of width w has one weight per offset and byte value, so a filter's value is a sum of
    w looked-up numbers.
    """

    def __init__(self, classes: list[str], seed: int = 1):
        rng = np.random.default_rng(seed)
        self.classes = classes
        self.tables = {w: rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS}
        self.bias = {w: np.zeros(FILTERS, np.float32) for w in WIDTHS}
        self.out = rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(classes))).astype(np.float32)
        self.out_bias = np.zeros(len(classes), np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [*self.tables.values(), *self.bias.values(), self.out, self.out_bias]

    def _pooled(self, x: np.ndarray):
        """Pooled values, and where each was largest."""
        values, places = [], []
        for w in WIDTHS:
            n = WINDOW - w + 1
            z = sum(self.tables[w][k][x[:, k:k + n]] for k in range(w))
            place = z.argmax(axis=1)
            values.append(np.take_along_axis(z, place[:, None], 1)[:, 0] + self.bias[w])
            places.append(place)
        return np.concatenate(values, axis=1), places

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 12, batch: int = 256,
            rate: float = 0.01, seed: int = 1) -> "ByteNetwork":
        """Adam on the cross entropy, every class weighing the same."""
        rng = np.random.default_rng(seed)
        counts = np.bincount(y, minlength=len(self.classes))
        weight = (len(y) / (np.maximum(counts, 1) * (counts > 0).sum())).astype(np.float32)
        first = [np.zeros_like(p) for p in self.parameters()]
        second = [np.zeros_like(p) for p in self.parameters()]
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(y))
            for at in range(0, len(y), batch):
                some = order[at:at + batch]
                xb, yb = x[some], y[some]
                values, places = self._pooled(xb)
                hidden = np.maximum(values, 0)
                p = _softmax(hidden @ self.out + self.out_bias)
                p[np.arange(len(yb)), yb] -= 1
                p *= (weight[yb] / len(yb))[:, None]
                back = (p @ self.out.T) * (values > 0)
                tables, bias = [], []
                for i, w in enumerate(WIDTHS):
                    d = back[:, i * FILTERS:(i + 1) * FILTERS]
                    g = np.zeros_like(self.tables[w])
                    for k in range(w):
                        seen = np.take_along_axis(xb, places[i] + k, 1)
                        np.add.at(g[k], (seen, np.arange(FILTERS)[None, :]), d)
                    tables.append(g)
                    bias.append(d.sum(axis=0))
                step += 1
                for j, (q, g) in enumerate(zip(self.parameters(),
                                               [*tables, *bias, hidden.T @ p, p.sum(axis=0)])):
                    first[j] += 0.1 * (g - first[j])
                    second[j] += 0.001 * (g * g - second[j])
                    q -= rate * (first[j] / (1 - 0.9 ** step)) \
                        / (np.sqrt(second[j] / (1 - 0.999 ** step)) + 1e-8)
        return self

    def compiled(self):
        """A function from windows to class probabilities with pairs of bytes looked up at once."""
        pair = {w: [(t[k][:, None, :] + t[k + 1][None, :, :]).reshape(-1, FILTERS)
                    for k in range(0, w - 1, 2)] for w, t in self.tables.items()}

        def probabilities(x: np.ndarray) -> np.ndarray:
            pairs = x[:, :-1].astype(np.int32) * 256 + x[:, 1:]
            values = []
            for w in WIDTHS:
                n = WINDOW - w + 1
                z = np.take(pair[w][0], pairs[:, :n], axis=0)
                for i, t in enumerate(pair[w][1:], 1):
                    z += np.take(t, pairs[:, 2 * i:2 * i + n], axis=0)
                if w % 2:
                    z += np.take(self.tables[w][w - 1], x[:, w - 1:], axis=0)
                values.append(z.max(axis=1) + self.bias[w])
            return _softmax(np.maximum(np.concatenate(values, axis=1), 0) @ self.out
                            + self.out_bias)

        return probabilities


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(docs: DataFrame, usable: Column, text_col: str = "text",
          lang_col: str = "lang") -> ByteNetwork | None:
    """A network learned from rows where ``usable`` holds and language and text are known.

    Of each language, at most ``SAMPLE_TEXTS`` different texts are used, chosen by a hash: copies
    count once, so that no language or text is lost to the copies of another. None if there is no
    such row.
    """
    known = docs.where(usable & docs[lang_col].isNotNull() & docs[text_col].rlike(r"\p{L}"))
    rows = known.select(known[lang_col].cast("string").alias("lang"),
                        known[text_col].cast("string").alias("text"))
    rows = rows.withColumn("mix", F.xxhash64("text", "lang"))
    chosen = sampled(rows.select("lang", "mix").distinct(), "lang", SAMPLE_TEXTS, F.col("mix"))
    # up to SAMPLE_WINDOWS windows of each chosen text are learned
    rows = rows.join(F.broadcast(chosen), ["lang", "mix"]).groupBy("lang", "n") \
        .agg(F.min("text").alias("text")).orderBy("lang", "n").toPandas()
    if not len(rows):
        return None
    classes = sorted(set(rows["lang"]))
    xs, ys = [], []
    for lang, text in zip(rows["lang"], rows["text"]):
        of_text = windows(text.encode())
        some = of_text[np.linspace(0, len(of_text) - 1, min(SAMPLE_WINDOWS, len(of_text)))
                       .astype(int)]
        xs.append(some)
        ys += [classes.index(lang)] * len(some)
    return ByteNetwork(classes).fit(np.concatenate(xs), np.array(ys))


def identify(docs: DataFrame, network: ByteNetwork | None, id_cols: list[str],
             text_col: str = "text", step: int = 1024) -> DataFrame:
    """Per row the given columns, ``lang_pred`` and ``score``.

    All windows of the whole text are classified, ``step`` at a time; the score is the mean
    probability of the predicted language, windows weighing as many bytes as they hold. A text that
    is null or has no letter, and every text if nothing could be learned, is ``und`` with score 0.
    Repeated rows are classified row by row; other columns are not looked at. Nothing is shuffled.
    A text among the given columns goes to Python once, and rows come back ``ROWS_AT_ONCE`` or so at
    a time.
    """

    def run(batches):
        probabilities = network.compiled() if network else None

        def rows(batch, labels, scores):
            kept = [batch.column(i) for i in range(len(id_cols))]
            return pa.RecordBatch.from_arrays(
                [*kept, pa.array(labels, pa.string()), pa.array(scores, pa.float64())],
                [*names, "lang_pred", "score"])

        for batch in batches:
            labels, scores, first = [], [], 0
            values = (v for some in slices([batch]) for v in texts(some, read))
            for group in _groups(values, step):
                if len(labels) >= ROWS_AT_ONCE:
                    yield rows(batch.slice(first, len(labels)), labels, scores)
                    first += len(labels)
                    labels, scores = [], []
                data = [v.encode() if network and _LETTER.search(v) else b"" for v in group]
                of_text = [windows(d) for d in data]
                if not any(data):
                    labels += [UNKNOWN] * len(data)
                    scores += [0.0] * len(data)
                    continue
                x = np.concatenate([w for w, d in zip(of_text, data) if d])
                p = np.concatenate([probabilities(x[i:i + step]) for i in range(0, len(x), step)])
                at = 0
                for w, d in zip(of_text, data):
                    if not d:
                        labels.append(UNKNOWN)
                        scores.append(0.0)
                        continue
                    held = np.full(len(w), WINDOW, np.float64)
                    held[-1] = len(d) - WINDOW * (len(w) - 1)
                    mean = held @ p[at:at + len(w)] / held.sum()
                    at += len(w)
                    labels.append(network.classes[int(mean.argmax())])
                    scores.append(min(1.0, float(mean.max())))
            yield rows(batch.slice(first), labels, scores)

    names = [f"c{i}" for i in range(len(id_cols))]
    narrow = docs.select(*(docs[c].alias(n) for n, c in zip(names, id_cols)),
                         docs[text_col].cast("string").alias("text of row"))
    read = "text of row"
    own = names[id_cols.index(text_col)] if text_col in id_cols else None
    if own and narrow.schema[own].dataType == StringType():
        read, narrow = own, narrow.drop(read)
    schema = ", ".join(f"{n} {narrow.schema[n].dataType.simpleString()}" for n in names)
    found = narrow.mapInArrow(run, f"{schema}, lang_pred string, score double")
    return found.toDF(*id_cols, "lang_pred", "score")


def _groups(values: Iterable[str], step: int):
    """Runs of texts that hold about so many windows together."""
    group, n = [], 0
    for v in values:
        group.append(v)
        n += 1 + len(v) // WINDOW
        if n >= step:
            yield group
            group, n = [], 0
    if group:
        yield group
