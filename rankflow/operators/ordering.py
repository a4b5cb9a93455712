"""Global sorts, exact row positions and running totals without a single-task window.

Rows are range-partitioned by the whole key, sorted within partitions and written once, each
with its partition number and its place in it. The row count of every partition, one number
per partition, then turns these local places into global ones.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from rankflow.session import cut, cut_at, drop_scratch, scratch_path

LOCAL_BITS = 33
SELECTION_BUCKETS = 2048


def sort_by(df: DataFrame, *keys: str, copies: bool = False) -> DataFrame:
    """Ascending sort over all partitions, nulls first.

    Rows that tie on the keys are ordered by their other columns, so a hot key spreads over
    many partitions. Exact copies still tie. Where a row may have very many of them, ``copies``
    writes the input first and breaks ties by its stable row numbers.
    """
    order = [F.col(key).asc_nulls_first() for key in keys]
    if copies:
        numbered = cut(df, "unsorted").withColumn("_tie", F.monotonically_increasing_id())
        return numbered.orderBy(*order, "_tie").drop("_tie")
    others = [name for name, kind in df.dtypes if name not in keys and "map<" not in kind]
    return df.orderBy(*order, *others)


def sort_by_position(df: DataFrame, *positions: int, copies: bool = False) -> DataFrame:
    """The same, with the keys given as zero-based column positions."""
    return sort_by(df, *[df.columns[position] for position in positions], copies=copies)


@dataclass(frozen=True)
class OrderedRows:
    """A sorted table with ``_part`` and ``_row``, and the rows in front of every partition."""

    table: DataFrame
    starts: list[int]
    total: int
    path: str

    def drop(self) -> None:
        """Deletes the written table; nothing that reads it may be used afterwards."""
        drop_scratch(self.table.sparkSession, self.path)

    def position(self) -> Column:
        return F.get(_constant(self.starts, "bigint"), F.col("_part")) + F.col("_row")

    def slice(self, low: int, high: int) -> DataFrame:
        """The rows at positions ``low`` up to ``high``; other partitions are not read."""
        return self.slices([(low, high)])

    def slices(self, ranges: list[tuple[int, int]]) -> DataFrame:
        """The rows at positions ``low`` up to ``high`` of several ranges that do not overlap."""
        # One text instead of many column objects: a training loop builds this every step.
        by_part: dict[int, list[tuple[int, int]]] = {}
        ends = [*self.starts[1:], self.total]
        for low, high in ranges:
            part = max(bisect_right(self.starts, low) - 1, 0)
            while part < len(self.starts) and self.starts[part] < high:
                first, last = max(low, self.starts[part]), min(high, ends[part])
                if first < last:
                    by_part.setdefault(part, []).append((first - self.starts[part], last - self.starts[part]))
                part += 1
        if not by_part:
            return self.table.filter("false")
        parts = ", ".join(map(str, by_part))
        clauses = [f"(_part = {part} AND ({_row_filter(rows)}))" for part, rows in by_part.items()]
        return self.table.filter(f"_part IN ({parts}) AND ({' OR '.join(clauses)})")


def _row_filter(rows: list[tuple[int, int]]) -> str:
    single = ", ".join(str(low) for low, high in rows if high - low == 1)
    wider = [f"_row >= {low} AND _row < {high}" for low, high in rows if high - low > 1]
    return " OR ".join([*([f"_row IN ({single})"] if single else []), *wider])


def ordered_rows(df: DataFrame, order_by: list[str | Column]) -> OrderedRows:
    """Sort ``df`` by keys that end in a unique tie-break, and number its rows.

    The table is written before anything is counted: the range bounds come from a sample and
    need not be the same in a second run.
    """
    keys = [F.col(key) if isinstance(key, str) else key for key in order_by]
    named = [f"_key{i}" for i in range(len(keys))]
    ranged = (
        df.select("*", *[key.alias(name) for key, name in zip(keys, named)])
        .repartitionByRange(*named)
        .withColumn("_part", F.spark_partition_id())
        .sortWithinPartitions("_part", *named)
        .drop(*named)
        .withColumn("_row", F.monotonically_increasing_id().bitwiseAND((1 << LOCAL_BITS) - 1))
    )
    path = scratch_path(df.sparkSession, "ordered")
    table = cut_at(ranged, path, partition_by=("_part",))
    counts = {row["_part"]: row["rows"] for row in _part_counts(table).collect()}
    starts, total = [], 0
    for part in range(max(counts, default=-1) + 1):
        starts.append(total)
        total += counts.get(part, 0)
    return OrderedRows(table, starts, total, path)


def _part_counts(table: DataFrame) -> DataFrame:
    return table.groupBy("_part").agg(F.count("*").alias("rows"))


def _constant(values: list, kind: str) -> Column:
    """A literal array with one entry per partition, folded by the optimizer."""
    return F.split(F.lit(",".join(repr(v) for v in values or [0])), ",").cast(f"array<{kind}>")


def global_index(df: DataFrame, order_by: list[str | Column], name: str = "position") -> DataFrame:
    """``df`` with the zero-based position of each row in the given order."""
    rows = ordered_rows(df, order_by)
    return rows.table.withColumn(name, rows.position()).drop("_part", "_row")


def running_totals(df: DataFrame, order_by: list[str | Column], sums: dict[str, str]) -> DataFrame:
    """``df`` with cumulative sums; ``sums`` maps new column names to summed columns."""
    rows = ordered_rows(df, order_by)
    totals = {
        row["_part"]: row
        for row in rows.table.groupBy("_part")
        .agg(*[F.sum(F.col(source).cast("double")).alias(name) for name, source in sums.items()])
        .collect()
    }
    window = Window.partitionBy("_part").orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
    columns = []
    for name, source in sums.items():
        before, total = [], 0.0
        for part in range(len(rows.starts)):
            before.append(total)
            total += (totals[part][name] or 0.0) if part in totals else 0.0
        local = F.sum(F.col(source).cast("double")).over(window)
        columns.append((F.get(_constant(before, "double"), F.col("_part")) + local).alias(name))
    return rows.table.select("*", *columns).drop("_part", "_row")


def nth_key(df: DataFrame, key: Column, tie: Column, n: int, span: int):
    """The ``n``-th smallest ``(key, tie)``, counted from 1, or ``None`` if there are fewer rows.

    Both are integers and ``key`` lies in ``[0, span)``. Rows are counted in equal buckets, with partial
    aggregation, and the bucket that holds the ``n``-th row is looked into until it is one key; rows of
    that key are told apart by ``tie`` in the same way. No pass shuffles rows.
    """
    rows = df.select(key.alias("key"), tie.alias("tie"))
    found = _narrow(rows, "key", 0, span, n)
    if found is None:
        return None
    value, left = found
    same = rows.filter(F.col("key") == value)
    low, high = same.agg(F.min("tie"), F.max("tie")).first()
    last, _ = _narrow(same, "tie", low, high - low + 1, left)
    return Row(key=value, tie=last)


def _narrow(rows: DataFrame, name: str, low: int, width: int, n: int) -> tuple[int, int] | None:
    """The ``n``-th smallest value in ``[low, low + width)``, and its place among rows of that value."""
    while True:
        step = -(-width // SELECTION_BUCKETS)
        inside = rows.filter((F.col(name) >= low) & (F.col(name) < low + width))
        bucket = F.floor((F.col(name) - low) / step)
        counts = inside.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("rows")).collect()
        if sum(row["rows"] for row in counts) < n:
            return None
        for row in sorted(counts, key=lambda row: row["bucket"]):
            if n <= row["rows"]:
                break
            n -= row["rows"]
        low, width = low + row["bucket"] * step, step
        if width == 1:
            return low, n
