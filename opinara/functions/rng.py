"""Arithmetic pseudo-random numbers that any SQL engine can replay from a row id."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MODULUS = 2147483647
MULTIPLIER = 48271
# Carries what lies beyond 31 bits; far from 0 modulo MODULUS, so that ids numbered by partition (partition << 33) do
# not fall on the keys of their neighbours.
HIGH_MULTIPLIER = 1327217885


def lehmer(col: Column, seed: int = 0) -> Column:
    """One multiplicative-congruential step on ``col + seed``, whose high bits are folded in; over [0, MODULUS)."""
    value = col.cast("long") + F.lit(seed).cast("long")
    modulus = F.lit(MODULUS).cast("long")
    high = F.pmod(F.shiftright(value, 31), modulus) * F.lit(HIGH_MULTIPLIER).cast("long")
    start = (value.bitwiseAND(F.lit(MODULUS).cast("long")) + high) % modulus
    return start * F.lit(MULTIPLIER).cast("long") % modulus


# A second modulus below 2 ** 31, prime like the first: the two remainders of a number tell all numbers to 2 ** 61 apart.
SECOND_MODULUS = 2147483629


def wide(col: Column, seed: int = 0) -> Column:
    """A pseudo-random number of 62 bits of a number of 0 or more, for draws among more than 2 ** 31 rows."""
    high = lehmer(lehmer(col, seed))
    low = lehmer(lehmer(col.cast("long") % F.lit(SECOND_MODULUS).cast("long"), seed + 1))
    return high * F.lit(1 << 31).cast("long") + low


def uniform(col: Column, seed: int = 0) -> Column:
    return lehmer(lehmer(col, seed)) / F.lit(float(MODULUS))
