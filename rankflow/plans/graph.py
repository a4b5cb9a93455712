"""Queries on links, ranks, files and sorts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from rankflow.operators import edges as E
from rankflow.operators.ordering import global_index, sort_by
from rankflow.operators.pagerank import pagerank
from rankflow.plans import tables as T
from rankflow.session import scratch_path
from rankflow.sources.text import (
    read_lines, read_placed_lines, read_raw_table, read_table, write_lines, write_ranks, write_table,
)

ADJACENCY_QUERY_ENTRIES = 64


def _rounded(ranks: DataFrame) -> DataFrame:
    return ranks.select("node", F.round("rank", 6).alias("rank"))


def _ranking(broken: bool = False, **options):
    def query(spark, sf_dir):
        return _rounded(pagerank(T.trade_edges(spark, sf_dir, broken), **options))

    return query


def out_degree(spark, sf_dir):
    return E.out_degree(T.trade_edges(spark, sf_dir))


def adjacency(spark, sf_dir):
    rows = E.adjacency(T.trade_edges(spark, sf_dir), ADJACENCY_QUERY_ENTRIES)
    entry = F.transform("entries", lambda e: F.concat(e.dst, F.lit(":"), e.w.cast("string")))
    return rows.select("src", "chunk", F.concat_ws(",", entry).alias("dsts"), "size")


def initial_ranks(spark, sf_dir):
    return E.initial_ranks(T.trade_edges(spark, sf_dir))


def parse_edges(spark, sf_dir):
    path = scratch_path(spark, "links")
    T.raw_link_lines(spark, sf_dir).write.text(path)
    return E.parse_edges(read_lines(spark, path))


def text_scan(spark, sf_dir):
    path = scratch_path(spark, "customers")
    T.customer_lines(spark, sf_dir).write.text(path)
    return read_lines(spark, path)


def union_sources(spark, sf_dir):
    first, second = scratch_path(spark, "customers"), scratch_path(spark, "suppliers")
    T.customer_lines(spark, sf_dir).write.text(first)
    T.supplier_lines(spark, sf_dir).write.text(second)
    return read_lines(spark, first, second, first)


def _order_table(spark, sf_dir) -> DataFrame:
    path = scratch_path(spark, "orders")
    T.order_text(spark, sf_dir).write.option("header", True).csv(path)
    return read_table(spark, path)


def csv_scan(spark, sf_dir):
    return _order_table(spark, sf_dir)


def sort_two_keys(spark, sf_dir):
    events = T.table(spark, sf_dir, "events").select("event_type", "ts", "event_id")
    return global_index(events, ["event_type", "ts", "event_id"]).drop("ts")


def sort_positional(spark, sf_dir):
    orders = _order_table(spark, sf_dir)
    keys = [orders.columns[2], orders.columns[3], orders.columns[0]]
    return global_index(orders, keys).select("position", *keys)


def ranks_sink(spark, sf_dir):
    """Degrees as rank lines, written to one file and read back."""
    path = scratch_path(spark, "rank_lines")
    write_ranks(E.out_degree(T.trade_edges(spark, sf_dir)), path, single=True)
    return read_lines(spark, path)


def _in_file_order(spark, path: str, value: str = "value") -> DataFrame:
    placed = read_placed_lines(spark, path)
    return global_index(placed, ["place"]).select("position", F.col("value").alias(value))


def table_sink(spark, sf_dir):
    """A sorted table written as one CSV file, and its lines in file order."""
    path = scratch_path(spark, "events")
    events = T.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    write_table(sort_by(events, "event_type", "user_id"), path, single=True)
    return _in_file_order(spark, path)


def lines_sink(spark, sf_dir):
    """Raw lines of a CSV file beside their fields, sorted by two positions, written and read back in file order."""
    source, path = scratch_path(spark, "orders"), scratch_path(spark, "sorted")
    T.order_text(spark, sf_dir).write.option("header", True).csv(source)
    fields = read_raw_table(spark, source)
    write_lines(fields, path, [fields.columns[2], fields.columns[0]], "line")
    return _in_file_order(spark, path)


def file_headers(spark, sf_dir):
    """Raw lines of files with headers of their own, which some of their rows repeat."""
    paths = []
    for number in range(T.HEADER_FILES):
        paths.append(scratch_path(spark, f"file_{number}"))
        write_table(T.titled_customers(spark, sf_dir, number), paths[-1])
    rows = read_raw_table(spark, *paths)
    return rows.select(*[F.col(name).alias(f"field_{i}") for i, name in enumerate(rows.columns)])


def short_rows(spark, sf_dir):
    """Rows that end early get nulls; every seventh line of the customers is cut."""
    path = scratch_path(spark, "customers")
    T.ragged_customers(spark, sf_dir).write.text(path)
    schema = StructType([StructField(name, StringType()) for name in ("key", "name", "segment")])
    return spark.read.schema(schema).csv(path)


QUERIES = {
    "ranks_sink": ranks_sink,
    "table_sink": table_sink,
    "lines_sink": lines_sink,
    "file_headers": file_headers,
    "short_rows": short_rows,
    "pagerank_naive": _ranking(),
    "pagerank_adjacency": _ranking(layout="adjacency"),
    "pagerank_hash_partition": _ranking(layout="adjacency", partitioning="hash"),
    "pagerank_range_partition": _ranking(layout="adjacency", partitioning="range", only_left=True),
    "pagerank_cached": _ranking(layout="adjacency", partitioning="hash", cache=True),
    "pagerank_hash_edges": _ranking(partitioning="hash"),
    "pagerank_only_left": _ranking(broken=True, partitioning="hash", only_left=True),
    "pagerank_keep_zero": _ranking(broken=True, partitioning="hash", ignore_zero_incoming=False),
    "out_degree": out_degree,
    "adjacency": adjacency,
    "initial_ranks": initial_ranks,
    "parse_edges": parse_edges,
    "text_scan": text_scan,
    "union_sources": union_sources,
    "csv_scan": csv_scan,
    "sort_two_keys": sort_two_keys,
    "sort_positional": sort_positional,
}
