"""Stretches of words that repeat with a period, found by block convolution."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fairstream.llm.common import texts

#: A run repeats its period at least so often, and has at least so many words.
REPEATS, LEAST = 4, 6
#: Primes below 2^30 of which p - 1 holds a high power of two, and a primitive root of each.
PRIMES = ((998244353, 3), (469762049, 3), (167772161, 3))
#: Words that are convolved at once, and words of documents that are searched together.
AT_ONCE, GATHERED = 1 << 17, 1 << 18
_M32 = np.uint64(32)


class Transform:
    """Number-theoretic transforms of one power of two, modulo one prime, along the last axis.

    The forward one leaves its values in bit-reversed order, which the inverse one takes. Products
    with fixed factors are reduced by a precomputed quotient; values stay below twice the prime.
    """

    def __init__(self, n: int, prime: int, root: int):
        self.n, self.p, self.p2 = n, np.uint64(prime), np.uint64(2 * prime)
        g = pow(root, (prime - 1) // n, prime)
        self.stages, self.back = [], []
        for stages, w in ((self.stages, g), (self.back, pow(g, -1, prime))):
            half = n // 2
            while half:
                step, row = pow(w, n // (2 * half), prime), [1]
                for _ in range(half - 1):
                    row.append(row[-1] * step % prime)
                factors = np.array(row, np.uint64)
                stages.append((half, factors, (factors << _M32) // self.p))
                half //= 2
        self.back.reverse()
        self.inverse_n = np.uint64(pow(n, -1, prime))

    def _times(self, v, factors, quotients):
        return v * factors - ((v * quotients) >> _M32) * self.p

    def _less(self, v):
        return np.minimum(v, v - self.p2)  # below zero it wraps around to a large number

    def forward(self, x: np.ndarray) -> np.ndarray:
        x = x.copy()
        for half, factors, quotients in self.stages:
            y = x.reshape(*x.shape[:-1], -1, 2, half)
            u, v = y[..., 0, :], y[..., 1, :]
            low = self._less(u + v)
            y[..., 1, :] = self._times(u + self.p2 - v, factors, quotients)
            y[..., 0, :] = low
        return x

    def inverse(self, x: np.ndarray) -> np.ndarray:
        for half, factors, quotients in self.back:
            y = x.reshape(*x.shape[:-1], -1, 2, half)
            u, v = y[..., 0, :].copy(), self._times(y[..., 1, :], factors, quotients)
            y[..., 0, :] = self._less(u + v)
            y[..., 1, :] = self._less(u + self.p2 - v)
        return x % self.p * self.inverse_n % self.p


class Correlator:
    """Compares blocks of words with all windows behind them, by convolution."""

    def __init__(self):
        self._transforms: dict[tuple[int, int], Transform] = {}

    def _of(self, n: int, prime: int, root: int) -> Transform:
        if (n, prime) not in self._transforms:
            self._transforms[n, prime] = Transform(n, prime, root)
        return self._transforms[n, prime]

    def mismatches(self, here: np.ndarray, window: np.ndarray, shifts: int, bound: int):
        """Whether each block differs from its window's words, at the first so many places.

        ``here`` holds blocks of L words, ``window`` 2L words for each; ``shifts`` is at most L + 1.
        The sum of squared differences is two sums of squares less twice the sum of products, all
        modulo as many primes as their product is above any such sum (``bound``).
        """
        rows, size = here.shape
        block = np.zeros((rows, 2 * size), np.uint64)
        block[:, 0] = here[:, 0]
        block[:, :size:-1] = here[:, 1:]  # read backwards, products add up by distance
        differ, room = np.zeros((rows, shifts), bool), 1
        for prime, root in PRIMES:
            t, p = self._of(2 * size, prime, root), np.uint64(prime)
            product = t.forward(block) % p * (t.forward(window) % p) % p
            product = t.inverse(product)[:, :shifts]
            squares = np.zeros((rows, 2 * size + 1), np.uint64)
            np.cumsum(window * window % p, axis=1, out=squares[:, 1:])
            total = squares[:, size:size + shifts] - squares[:, :shifts]
            total += (here * here % p).sum(axis=1, dtype=np.uint64)[:, None]
            differ |= total % p != 2 * product % p
            room *= prime
            if bound < room:
                return differ
        raise ValueError("too many different words for an exact sum")


def distances(size: int) -> np.ndarray:
    """The periods that blocks of ``size`` words are for: of any run of such a period, some block
    lies within, together with its copy one period on. Scales follow each other without a gap."""
    return np.arange(-(-(2 * size - 1) // 3), -(-(4 * size - 1) // 3))


def recurrences(x: np.ndarray, end_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many words on each word of a document is found again, at the nearest and the farthest.

    A word that is not found again is so at no distance: the nearest is past all, the farthest 0.
    """
    place = np.arange(len(x))
    order = np.lexsort((place, x, end_of))
    new = np.ones(len(x), bool)
    new[1:] = (x[order[1:]] != x[order[:-1]]) | (end_of[order[1:]] != end_of[order[:-1]])
    last = np.append(new[1:], True)[:len(x)]
    nearest = np.full(len(x), len(x) + 1)
    nearest[order[:-1][~last[:-1]]] = np.diff(order)[~last[:-1]]
    farthest = np.zeros(len(x), np.int64)
    farthest[order] = order[np.flatnonzero(last)][np.cumsum(new) - 1] - order
    return nearest, farthest


class RunFinder:
    """All runs of documents that are given as arrays of word numbers."""

    def __init__(self):
        self.correlator = Correlator()

    def find(self, docs: list[np.ndarray]) -> list[np.ndarray]:
        """For each document the rows ``start, length, period``, by start and then period."""
        sizes = np.array([len(d) for d in docs], np.int64)
        ends = np.cumsum(sizes)
        x = np.concatenate(docs) if docs else np.zeros(0, np.int64)
        end_of = np.repeat(ends, sizes)  # of the document that a word is in
        again = recurrences(x, end_of)
        runs = np.zeros((0, 3), np.int64)  # start, end, period
        size = 2
        while len(x) and REPEATS * distances(size)[0] <= sizes.max():
            found = self._at_scale(x, end_of, again, size, runs)
            if len(found):
                # a stretch has the least of the periods that it was found with
                every = np.concatenate((runs, found))
                every = every[np.lexsort((every[:, 2], every[:, 1], every[:, 0]))]
                same = (every[1:, :2] == every[:-1, :2]).all(axis=1)
                runs = every[np.concatenate(([True], ~same))]
            size *= 2
        runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
        first = ends - sizes
        owner = np.searchsorted(ends, runs[:, 0], "right")
        rows = np.stack((runs[:, 0] - first[owner], runs[:, 1] - runs[:, 0], runs[:, 2]), axis=1)
        return np.split(rows, np.searchsorted(owner, np.arange(1, len(docs))))

    def _at_scale(self, x, end_of, again, size: int, runs) -> np.ndarray:
        shifts = distances(size)
        starts = np.arange(0, len(x) - size - shifts[0] + 1, size)
        # a block and its nearest copy must be in one document, long enough for a run
        starts = starts[starts + size + shifts[0] <= end_of[starts]]
        # and each of its words must be found again at distances of this scale
        nearest, farthest = again
        apart = np.concatenate(([0], np.cumsum((nearest > shifts[-1]) | (farthest < shifts[0]))))
        starts = starts[apart[starts + size] == apart[starts]]
        if not len(starts):
            return runs[:0]
        bound, ahead = size * int(x.max() + 1) ** 2, shifts[0] + np.arange(2 * size)
        places, periods = [], []
        step = max(1, AT_ONCE // size)
        for i in range(0, len(starts), step):
            s = starts[i:i + step]
            here = x[s[:, None] + np.arange(size)].astype(np.uint64)
            window = x[np.minimum(s[:, None] + ahead, len(x) - 1)].astype(np.uint64)
            equal = ~self.correlator.mismatches(here, window, len(shifts), bound)
            equal &= s[:, None] + size + shifts <= end_of[s][:, None]
            row, column = np.nonzero(equal)
            places.append(s[row])
            periods.append(shifts[column])
        s, d = np.concatenate(places), np.concatenate(periods)
        if len(runs):
            # what lies within a run of a shorter period has that period's multiples as well
            reach = np.maximum.accumulate(runs[:, 1])  # runs are in order of their starts
            before = np.searchsorted(runs[:, 0], s, "right") - 1
            covered = (before >= 0) & (reach[before] >= s + size + d)
            s, d = s[~covered], d[~covered]
        return self._extended(x, end_of, s, d, size)

    def _extended(self, x, end_of, s, d, size: int) -> np.ndarray:
        """The longest stretches around seeds: a block at ``s`` that recurs ``d`` words on."""
        order = np.lexsort((s, d))
        s, d = s[order], d[order]
        # neighbouring blocks with one distance belong to one stretch
        new = np.ones(len(s), bool)
        new[1:] = (d[1:] != d[:-1]) | (s[1:] != s[:-1] + size) | (end_of[s[1:]] != end_of[s[:-1]])
        firsts = np.flatnonzero(new)
        lasts = np.append(firsts[1:], len(s))[:len(firsts)] - 1
        left, right, d = s[firsts], s[lasts] + size, d[firsts]
        end = end_of[left] if len(left) else left
        # the first word of a document is behind the end of the one before
        begin = np.searchsorted(end_of, end, "left")
        right = _reach(x, right, end - d, d, 1)
        left = _reach(x, left - 1, begin - 1, d, -1) + 1
        stop = right + d
        found = np.stack((left, stop, d), axis=1)
        return found[stop - left >= np.maximum(LEAST, REPEATS * d)]


def _reach(x, at, limit, d, way: int) -> np.ndarray:
    """From ``at`` on, forward or backward, the first place before ``limit`` where a word differs
    from the one ``d`` words on, or the limit. Looks further ahead the longer words stay equal."""
    at, open_, look = at.copy(), np.flatnonzero(way * (limit - at) > 0), 8
    while len(open_):
        still = []
        step = max(1, AT_ONCE // look)
        for i in range(0, len(open_), step):
            k = open_[i:i + step]
            place = at[k, None] + way * np.arange(look)
            inside = way * (limit[k, None] - place) > 0
            place = np.where(inside, place, at[k, None])
            equal = inside & (x[place] == x[place + d[k, None]])
            whole = equal.all(axis=1)
            at[k] += way * np.where(whole, look, equal.argmin(axis=1))
            still.append(k[whole & (way * (limit[k] - at[k]) > 0)])
        open_ = np.concatenate(still)
        look = min(2 * look, 1 << 14)
    return at


def numbered(words: list[bytes]) -> np.ndarray:
    """Words as numbers, equal for equal words."""
    seen: dict[bytes, int] = {}
    return np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)


def collapsed(words: list[bytes], runs: np.ndarray) -> str:
    """The text without what a run holds after its first period, words joined by one space."""
    keep = np.ones(len(words), bool)
    for start, length, period in runs.tolist():
        keep[start + period:start + length] = False
    if not keep.all():
        words = [words[i] for i in np.flatnonzero(keep)]
    return b" ".join(words).decode()


def _searched(batch, finder: RunFinder) -> Iterator[tuple[int, list[bytes], np.ndarray]]:
    """Per text its place in the batch, words and runs; texts are searched in groups."""
    group, n = [], 0
    values = texts(batch)
    for i, text in enumerate(values):
        group.append((i, text.encode().split()))  # splits at \x20 and \x09-\x0D
        n += len(group[-1][1])
        if n >= GATHERED or i == len(values) - 1:
            found = finder.find([numbered(words) for _, words in group])
            for (place, words), runs in zip(group, found):
                yield place, words, runs
            group, n = [], 0


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row the id, ``n_words``, ``runs`` and ``collapsed``, the text without repetitions.

    Words are what stands between ASCII white space. A run is a longest stretch of consecutive
    words with smallest period q (words q apart are equal) that holds at least ``REPEATS`` periods
    and ``LEAST`` words. ``runs`` has all of them as ``start``, ``length`` and ``period``, by start
    and then period. ``collapsed`` lacks the words that some run holds after its first q, the rest
    joined by one space.

    At every scale, blocks of 2^k words are compared with all windows at the distances that the
    scale is for, by convolution in exact integers; where no word differs, block and distance are a
    seed that is extended to a whole stretch. Blocks with a word that is not found again at distances
    of the scale match no window and are not convolved. Seeds within a run of a shorter period are
    left out.

    Nothing is shuffled, and a task holds one batch of texts. Null and empty texts have no words,
    no runs and an empty ``collapsed``. A very long text is searched in blocks like any other; the
    transforms go up to 2^23 values, which is enough for about eleven million words.
    Repeated rows give equal rows, a null id stays null, an empty table gives an empty result, and
    other columns are not read.
    """

    def run(batches):
        finder = RunFinder()
        for batch in batches:
            counts, runs, short = [], [], []
            for _, words, found in _searched(batch, finder):
                counts.append(len(words))
                runs.append(found)
                short.append(collapsed(words, found))
            every = np.concatenate(runs) if runs else np.zeros((0, 3), np.int64)
            upto = np.concatenate(([0], np.cumsum([len(r) for r in runs]))).astype(np.int32)
            items = pa.StructArray.from_arrays([pa.array(every[:, k]) for k in range(3)],
                                               ["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(counts, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(upto), items), pa.array(short, pa.string())],
                ["key", "n_words", "runs", "collapsed"])

    rows = docs.select(docs[id_col].alias("key"), docs[text_col].cast("string").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"key {kind}, n_words long, runs array<struct<start: long, length: long, "
             "period: long>>, collapsed string").withColumnRenamed("key", id_col)
