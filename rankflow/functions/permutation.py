"""Seeded orders of dense row numbers by arithmetic: no sort, no shuffle, no table.

A number below ``n`` is written as a pair, ``(number div b, number mod b)`` on a grid of ``a * b >= n`` cells. In every round one
half moves by a hash of the other, which can be undone, so the grid is mapped onto itself. The few cells beyond ``n`` (the grid
is chosen to have as few as possible) are walked through until the walk is back below ``n``. Rounds over whole Arrow batches
are a few array operations each; as column expressions they would be copied into each other.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.functions.hashing import INCREMENT, MODULUS, MULTIPLIER

HALF_ROUNDS = 6
# The steps of the round keys.
SEED_STEP, ROUND_STEP = 1013904223, 1664525
SHIFT = 16


def round_key(seed: int, number: int) -> int:
    return (seed * SEED_STEP + (number * ROUND_STEP + INCREMENT)) % MODULUS


@dataclass(frozen=True)
class Permutation:
    """Bijections of ``0 .. n - 1``, one for each seed."""

    n: int
    a: int
    b: int

    @staticmethod
    def of(n: int) -> Permutation:
        root = math.isqrt(n)
        sides = np.arange(max(1, min(2, n), root // 2), 2 * root + 2, dtype=np.int64)
        other = -(-n // sides)
        best = int(np.lexsort((sides, sides * other - n))[0])
        return Permutation(n, int(sides[best]), max(1, int(other[best])))

    def _grid(self, cells: np.ndarray, seed: int, back: bool = False) -> np.ndarray:
        halves = [cells // self.b, cells % self.b]
        sizes = (self.a, self.b)
        rounds = range(HALF_ROUNDS)
        for i in reversed(rounds) if back else rounds:
            moved, fixed = i % 2, 1 - i % 2
            y = (halves[fixed] * MULTIPLIER + round_key(seed, i)) % MODULUS
            step = (y * y) >> SHIFT
            halves[moved] = (halves[moved] + (-step if back else step)) % sizes[moved]
        return halves[0] * self.b + halves[1]

    def _walk(self, numbers: np.ndarray, seed: int, back: bool) -> np.ndarray:
        found = self._grid(np.asarray(numbers, dtype=np.int64), seed, back)
        while True:
            beyond = np.flatnonzero(found >= self.n)
            if not len(beyond):
                return found
            found[beyond] = self._grid(found[beyond], seed, back)

    def places(self, numbers: np.ndarray, seed: int) -> np.ndarray:
        """Where each number goes."""
        return self._walk(numbers, seed, back=False)

    def numbers(self, places: np.ndarray, seed: int) -> np.ndarray:
        """Which number goes to each place."""
        return self._walk(places, seed, back=True)

    def with_places(self, df: DataFrame, number: str, name: str, seed: int | str) -> DataFrame:
        """``df`` with the place ``name`` of every ``number``, by a seed or by that in a column."""
        order = self

        @F.arrow_udf("bigint")
        def place(numbers: pa.Array, seeds: pa.Array) -> pa.Array:
            values, own = numbers.to_numpy(zero_copy_only=False), seeds.to_numpy(zero_copy_only=False)
            found = np.empty(len(values), dtype=np.int64)
            for value in np.unique(own):
                rows = own == value
                found[rows] = order.places(values[rows], int(value))
            return pa.array(found)

        seeds = F.lit(seed) if isinstance(seed, int) else F.col(seed)
        return df.withColumn(name, place(F.col(number), seeds.cast("bigint")))
