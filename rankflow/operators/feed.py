"""Rows for training, in an order of their own in every epoch, all read from one written table.

Rows are numbered once, in a seeded order, and written sorted by it. An epoch does not sort them again: a bijection of
the numbers says where each one goes. It moves stripes of consecutive rows, which are random samples already, so a step
reads a bounded number of row ranges and skips the rest of the table; a stripe of one row gives a full permutation.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.functions.hashing import shuffle_key
from rankflow.functions.permutation import Permutation
from rankflow.operators.ordering import OrderedRows, ordered_rows

# A batch is made of at least so many stripes.
BATCH_STRIPES = 64
# Beyond so many ranges a step's rows are found by arithmetic on every row.
MOST_RANGES = 2048


def stripe_rows(*batch_sizes: int) -> int:
    """The largest stripe that cuts every batch into at least ``BATCH_STRIPES`` equal parts, else 1."""
    common = int(np.gcd.reduce(batch_sizes))
    return max((d for d in range(1, common // BATCH_STRIPES + 1) if common % d == 0), default=1)


@dataclass(frozen=True)
class Feed:
    """One table for all epochs; ``total`` rows have a place, those that fill no stripe have none."""

    rows: OrderedRows
    stripe: int
    order: Permutation

    @property
    def total(self) -> int:
        return self.order.n * self.stripe

    def placed(self, seed: int) -> DataFrame:
        """All rows with their ``place``."""
        return self.with_places(self.rows.table.withColumn("_number", self.rows.position()), seed)

    def with_places(self, numbered: DataFrame, seed: int | str) -> DataFrame:
        """Rows with their ``place``, by a seed or by that in a column."""
        striped = numbered.withColumn("_stripe", F.expr(f"_number div {self.stripe}"))
        striped = striped.filter(F.col("_stripe") < self.order.n)
        moved = self.order.with_places(striped, "_stripe", "place", seed)
        within = F.col("_number") % self.stripe
        return moved.withColumn("place", F.col("place") * self.stripe + within).drop("_number", "_stripe", "_part", "_row")

    def slice(self, low: int, high: int, seed: int) -> DataFrame:
        """The rows at places ``low`` up to ``high``, whole stripes."""
        low, high = low // self.stripe, -(-min(high, self.total) // self.stripe)
        if high - low > MOST_RANGES:
            first, last = low * self.stripe, high * self.stripe
            return self.placed(seed).filter(F.col("place").between(first, last - 1)).drop("place")
        stripes = np.sort(self.order.numbers(np.arange(low, max(low, high)), seed))
        return self.rows.slices([(int(i) * self.stripe, int(i + 1) * self.stripe) for i in stripes]).drop("_part", "_row")

    def drop(self) -> None:
        self.rows.drop()


def feed(df: DataFrame, id_col: str, stripe: int = 1) -> Feed:
    rows = ordered_rows(df, [shuffle_key(F.col(id_col)), F.col(id_col)])
    return Feed(rows, stripe, Permutation.of(rows.total // stripe))
