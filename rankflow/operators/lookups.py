"""Joining a large table with a lookup table."""

from __future__ import annotations

from pyspark.sql import DataFrame


def lookup_join(big: DataFrame, lookup: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """Join on a key that is unique in ``lookup`` and may be badly skewed in ``big``.

    The join is left to the engine: at runtime it broadcasts a side whose measured bytes are small, and
    otherwise splits skewed partitions.
    """
    return big.join(lookup, on, how)
