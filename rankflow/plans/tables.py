"""Inputs of the registered queries, derived from the given tables row by row."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WIDTH = 64
CLASSES = 10
SIDE = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tagged(tag: str, column: str):
    return F.concat(F.lit(tag), F.col(column).cast("string"))


def trade_edges(spark: SparkSession, sf_dir: str, broken: bool = False) -> DataFrame:
    """Every order line links its order to its part, the part to the supplier, and back.

    ``broken`` drops some links, so that some orders have no in-link and some parts no out-link.
    """
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    order, part, supplier = (
        _tagged("o", "l_orderkey"),
        _tagged("p", "l_partkey"),
        _tagged("s", "l_suppkey"),
    )
    always = F.lit(True)
    links = [
        (order, part, always),
        (part, supplier, F.col("l_partkey") % 7 != 0 if broken else always),
        (supplier, order, F.col("l_orderkey") % 5 != 0 if broken else always),
    ]
    structs = [F.struct(a.alias("src"), b.alias("dst"), keep.alias("keep")) for a, b, keep in links]
    return lines.select(F.inline(F.array(*structs))).filter("keep").select("src", "dst")


def raw_link_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order rows as link lines with every irregularity the cleaning chain knows."""
    orders = table(spark, sf_dir, "orders")
    return orders.select(F.expr(RAW_LINK_SQL).alias("value"))


# The same expression in Spark and in the checking SQL.
RAW_LINK_SQL = """
CASE o_orderkey % 10
  WHEN 0 THEN concat('#', CAST(o_orderkey AS STRING), chr(9), CAST(o_custkey AS STRING))
  WHEN 1 THEN concat('  O', CAST(o_orderkey AS STRING), ' ', chr(9), chr(9), ' C', CAST(o_custkey AS STRING), ' ')
  WHEN 2 THEN concat(chr(9), 'o', CAST(o_orderkey AS STRING), chr(9), 'c', CAST(o_custkey AS STRING))
  WHEN 3 THEN concat('o', CAST(o_orderkey AS STRING), chr(9), 'c', CAST(o_custkey AS STRING), chr(9), o_orderstatus)
  WHEN 4 THEN concat('o', CAST(o_orderkey AS STRING), chr(9), ' ', chr(9), o_orderstatus)
  WHEN 5 THEN concat('o', CAST(o_orderkey AS STRING), ' c', CAST(o_custkey AS STRING))
  WHEN 6 THEN concat('File:o', CAST(o_orderkey AS STRING), chr(9), 'c', CAST(o_custkey AS STRING))
  WHEN 7 THEN concat('Category:', o_orderpriority, chr(9), 'C', CAST(o_custkey AS STRING))
  WHEN 8 THEN concat('o', CAST(o_orderkey AS STRING), chr(11), chr(9), chr(2), 'c', CAST(o_custkey AS STRING))
  ELSE concat('o', CAST(o_orderkey AS STRING), chr(9), 'Talk:c', CAST(o_custkey AS STRING))
END
"""


def customer_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    return customers.select(
        F.concat_ws("\t", F.col("c_custkey").cast("string"), "c_name", "c_mktsegment").alias("value")
    )


HEADER_FILES = 3


def titled_customers(spark: SparkSession, sf_dir: str, number: int) -> DataFrame:
    """The customers of one of ``HEADER_FILES`` files, whose columns are named after it; every 50th row says the same as
    the header."""
    names = [f"key_{number}", f"name_{number}"]
    customers = table(spark, sf_dir, "customer").filter(F.col("c_custkey") % HEADER_FILES == number)
    columns = [F.col("c_custkey").cast("string"), F.col("c_name")]
    repeats = F.col("c_custkey") % 50 == 0
    return customers.select(
        *[F.when(repeats, F.lit(name)).otherwise(column).alias(name) for name, column in zip(names, columns)]
    )


def ragged_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV lines, the last field missing in every seventh."""
    whole = F.concat_ws(",", F.col("c_custkey").cast("string"), "c_name", "c_mktsegment")
    short = F.concat_ws(",", F.col("c_custkey").cast("string"), "c_name")
    customers = table(spark, sf_dir, "customer")
    return customers.select(F.when(F.col("c_custkey") % 7 == 0, short).otherwise(whole).alias("value"))


def supplier_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier")
    return suppliers.select(F.concat_ws("\t", F.col("s_nationkey").cast("string"), "s_name").alias("value"))


def order_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.col("o_custkey").cast("string").alias("o_custkey"),
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("o_orderstatus"),
        F.concat("o_orderpriority", F.lit(", "), "o_orderstatus").alias("o_orderpriority"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id"), F.col("embedding").alias("features"), "label"
    )


def vector_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors(spark, sf_dir).select(
        "vec_id", "label", F.explode(F.col("features").cast("array<double>")).alias("value")
    )


def fixed_params() -> dict[str, np.ndarray]:
    """A fixed model: ``w[j, k] = sin(10 j + k + 1)``, no bias."""
    cells = np.arange(WIDTH)[:, None] * CLASSES + np.arange(CLASSES)[None, :] + 1
    return {"weights": np.sin(cells.astype(float)), "biases": np.zeros(CLASSES)}


def step_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a metric series: the id is the step, a thousand steps make an epoch."""
    events = table(spark, sf_dir, "events")
    return events.select(
        F.col("event_id").alias("step"),
        F.floor(F.col("event_id") / 1000).cast("int").alias("epoch"),
        "value",
        (F.col("event_id") * 0.25).alias("elapsed_s"),
    )
