"""Secrets in texts: fixed patterns, and random strings that a tokenizer compresses badly."""

from __future__ import annotations

import base64
import hashlib
import re
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame

from fairstream.llm.common import slices, texts

# The kinds in their order, and the patterns of the first three.
KINDS = ("assign", "access", "hex", "opaque")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")  # a whole run of [0-9a-f] with 24 or more

#: A string of at least so many characters is tested against the tokenizer.
OPAQUE_LENGTH = 20
#: Fewer characters per token than this mark a random string.
OPAQUE_RATIO = 2.4
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % OPAQUE_LENGTH)
_UUID = re.compile(r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
_HEX_ONLY = re.compile(r"[0-9A-Fa-f]+")
_DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)
_PARTS = re.compile(r"[/_=+-]+")
#: Letters without anything between them: below this ratio, and fewer than a third vowels.
LETTERS_RATIO = 2.1
_LETTERS = re.compile(r"[A-Za-z]+")
_VOWELS = re.compile(r"[AEIOUaeiou]")
_FOUND = ["n_assign", "n_access", "n_hex", "n_opaque", "base_sha256", "spans", "redacted"]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, by start and then kind."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text)
                  if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)
                  if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def is_known_form(string: str) -> bool:
    """A digest, UUID, number, word, or identifier made of plain words and numbers.

    Letters alone are a word if at least a third of them are vowels, which few random ones have.
    """
    if _UUID.fullmatch(string):
        return True
    if _HEX_ONLY.fullmatch(string) and len(string) in _DIGEST_LENGTHS:
        return True
    if _LETTERS.fullmatch(string):
        return 3 * len(_VOWELS.findall(string)) >= len(string)
    return all(p.isdigit() or p.isalpha() for p in _PARTS.split(string) if p)


def opaque_spans(text: str, base: list[tuple[int, int, int]], n_tokens) -> list:
    """Long strings of few characters per token that are no known form.

    What base spans leave of a string is tested by itself, where it is long enough.
    """
    found, first = [], 0
    for m in _CANDIDATE.finditer(text):
        while first < len(base) and base[first][2] <= m.start():
            first += 1
        at, parts = m.start(), []
        for start, _, end in islice(base, first, None):
            if start >= m.end():
                break
            parts.append((at, start))
            at = max(at, end)
        for start, end in [*parts, (at, m.end())]:
            string = text[start:end]
            if len(string) < OPAQUE_LENGTH or is_known_form(string):
                continue
            least = LETTERS_RATIO if _LETTERS.fullmatch(string) else OPAQUE_RATIO
            if len(string) / n_tokens(string) < least:
                found.append((start, 3, end))
    return found


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def redacted(text: str, spans, mark: str) -> str:
    """The text with every span, overlapping ones as one, replaced by the mark."""
    out, at = [], 0
    for start, _, end in sorted(spans):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def scan_secrets(docs: DataFrame, ranks_path: str, pattern: str, keep: list[str],
                 text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """Per document the secrets' counts and spans, and the text with them replaced by ``mark``.

    ``ranks_path`` and ``pattern`` give the tokenizer: its file of byte ranks and its splitting
    pattern. Positions are code points, ends exclusive. Columns: those of ``keep``, ``n_assign``,
    ``n_access``, ``n_hex``, ``n_opaque``, ``base_sha256`` (of the joined spans of the fixed
    patterns), ``spans`` (all) and ``redacted``. A null text counts as empty, and is null again in
    ``redacted``; repeated rows are scanned row by row. The vocabulary, of fixed size, is broadcast; nothing is shuffled.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def scan(batches):
        encoding = []

        def n_tokens(string: str) -> int:
            if not encoding:
                import tiktoken
                encoding.append(tiktoken.Encoding("scan", pat_str=pattern, special_tokens={},
                                                  mergeable_ranks=ranks.value))
            return len(encoding[0].encode_ordinary(string))

        for batch in slices(batches):
            counts, digests, joined, kept = [], [], [], []
            for text, null in zip(texts(batch, "text of row"),
                                  batch.column("text of row").is_null().to_pylist()):
                base = base_spans(text)
                every = sorted(base + opaque_spans(text, base, n_tokens))
                counts.append([sum(k == i for _, k, _ in every) for i in range(4)])
                digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                joined.append(_joined(every))
                kept.append(None if null else redacted(text, every, mark))
            by_kind = list(zip(*counts)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(keep))),
                 *(pa.array(c, pa.int64()) for c in by_kind),
                 pa.array(digests, pa.string()), pa.array(joined, pa.string()),
                 pa.array(kept, pa.string())],
                [*names, *_FOUND])

    names = [f"c{i}" for i in range(len(keep))]
    narrow = docs.select(*(docs[c].alias(n) for n, c in zip(names, keep)),
                         docs[text_col].cast("string").alias("text of row"))
    schema = ", ".join(f"{n} {narrow.schema[n].dataType.simpleString()}" for n in names)
    return narrow.mapInArrow(
        scan, f"{schema}, n_assign long, n_access long, n_hex long, n_opaque long, "
              "base_sha256 string, spans string, redacted string").toDF(*keep, *_FOUND)
