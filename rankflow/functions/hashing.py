"""Integer hashing that any SQL engine can repeat."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A linear congruential step modulo 2**31, and two odd factors that mix its bits.
MODULUS = 2147483648
MULTIPLIER = 1103515245
INCREMENT = 12345
MIXERS = (739982445, 695872825)


def mix(value: Column) -> Column:
    """A bijection of the integers below the modulus that leaves no stride: every bit depends on every other."""
    for factor in MIXERS:
        value = F.pmod(value.bitwiseXOR(F.shiftright(value, 16)) * F.lit(factor).cast("bigint"), F.lit(MODULUS))
    return value.bitwiseXOR(F.shiftright(value, 15))


def shuffle_key(key: Column, seed: Column | int = 0) -> Column:
    """A seeded pseudo-random order of integer ids.

    All steps are bijections below the modulus, so distinct ids there never collide; larger ids may,
    hence callers order by ``(shuffle_key, id)``. No product exceeds 62 bits.
    """
    seed = F.lit(seed).cast("bigint") if isinstance(seed, int) else seed.cast("bigint")
    factor = F.pmod(F.lit(MULTIPLIER) * (seed * 2 + 1), F.lit(MODULUS))
    return mix(F.pmod(F.pmod(key.cast("bigint"), F.lit(MODULUS)) * factor + INCREMENT, F.lit(MODULUS)))


def uniform(key: Column, seed: Column | int = 0) -> Column:
    """A number above 0 and up to 1 for each integer id."""
    return (shuffle_key(key, seed) + 1) / F.lit(float(MODULUS))


def text_bucket(value: Column, buckets: Column) -> Column:
    """Spread strings over ``buckets`` by the leading 32 bits of their MD5 digest."""
    head = F.conv(F.substring(F.md5(value.cast("binary")), 1, 8), 16, 10).cast("bigint")
    return F.pmod(head, buckets.cast("bigint"))
