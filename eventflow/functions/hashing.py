"""Polynomial string hash of the bitmap unique-visitor count (SC8).

h = sum_i code(s[i]) * seed^(n-1-i), kept to the low ``bits`` bits. Masking after
every step gives the same low bits as 64-bit wrapping arithmetic followed by one
final mask, because the mask + 1 is a power of two; it also keeps the JVM
expression clear of ANSI overflow errors.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Seed 67, default bitmap of 2^29 bits, 2^27 when size <= 0.
DEFAULT_SEED = 67
DEFAULT_BITS = 29
FALLBACK_BITS = 27


def poly_hash(text: Column | str, seed: int = DEFAULT_SEED, bits: int = DEFAULT_BITS) -> Column:
    """Offset in a 2^bits bitmap for each string; runs JVM-side as a higher-order function."""
    if bits <= 0:
        bits = FALLBACK_BITS
    if bits > 56:  # seed * 2**bits must stay a positive long
        raise ValueError("bits must be <= 56")
    mask = (1 << bits) - 1
    text = F.col(text) if isinstance(text, str) else text
    chars = F.split(text, "")
    return F.aggregate(
        chars, F.lit(0).cast("long"),
        lambda acc, ch: ((acc * F.lit(seed)) + F.ascii(ch).cast("long")).bitwiseAND(F.lit(mask)),
    )


def poly_hash_sql(expr: str, seed: int = DEFAULT_SEED, bits: int = DEFAULT_BITS) -> str:
    """DuckDB form of the same hash, for oracles."""
    if bits <= 0:
        bits = FALLBACK_BITS
    mask = (1 << bits) - 1
    return (f"(list_reduce(list_transform(string_split({expr}, ''), lambda c: ascii(c)::BIGINT), "
            f"lambda a, b: (a * {seed} + b) & {mask}) & {mask})")
