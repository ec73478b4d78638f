"""The pairwise-independent hash family behind the sketches."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the modulus of the family. Buckets therefore never exceed 8190, however wide
# the sketch is declared.
PRIME = 8191


class HashRow(NamedTuple):
    """Coefficients (a, b) of one sketch row: Count-Min, Count Sketch, and its sign."""

    cm: tuple[int, int]
    cs: tuple[int, int]
    sign: tuple[int, int]


def _draws(seed: int) -> Iterator[int]:
    """31-bit outputs of the generator documented for ``java.util.Random``."""
    # Multiplier 0x5DEECE66D, increment 0xB, 48-bit state.
    mask = (1 << 48) - 1
    state = (seed ^ 0x5DEECE66D) & mask
    while True:
        state = (state * 0x5DEECE66D + 0xB) & mask
        yield state >> 17


def _below(draws: Iterator[int], bound: int) -> int:
    """An unbiased draw in [0, bound) for a bound that is not a power of two."""
    usable = (1 << 31) // bound * bound
    return next(bits % bound for bits in draws if bits < usable)


def hash_family(d: int, seed: int = 1) -> list[HashRow]:
    """``d`` rows of coefficients, reproducible from the seed."""
    if d < 1:
        raise ValueError("a sketch needs at least one row")
    draws = _draws(seed)

    def pair() -> tuple[int, int]:
        a = 1 + _below(draws, PRIME - 1)
        return a, _below(draws, PRIME)

    return [HashRow(cm=pair(), cs=pair(), sign=pair()) for _ in range(d)]


def residue(item: Column) -> Column:
    """``item mod PRIME`` as an int. Taken once per item; negative items get a valid bucket too."""
    return F.pmod(item, F.lit(PRIME)).cast("int")


def bucket(reduced: Column, coefficients: tuple[int, int], width: int) -> Column:
    """Bucket in [0, width) of an item already reduced by :func:`residue` (fits 32-bit ints)."""
    a, b = coefficients
    return (reduced * F.lit(a) + F.lit(b)) % F.lit(PRIME) % F.lit(width)


def sign(reduced: Column, coefficients: tuple[int, int]) -> Column:
    """-1 or +1."""
    return bucket(reduced, coefficients, 2) * F.lit(2) - F.lit(1)
