"""Class ids, dictionaries and label-map lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.functions.text import strip_control
from rankflow.operators.lookups import lookup_join
from rankflow.operators.ordering import global_index

# Label 0 of a dictionary and the separator of its source lines.
BACKGROUND = "background"
NAME_SEPARATOR = "\t"


def class_ids(df: DataFrame, class_col: str) -> DataFrame:
    """``(class_col, class_id)``: distinct names in order, numbered from 0; null is no class."""
    names = df.select(class_col).filter(F.col(class_col).isNotNull()).distinct()
    indexed = global_index(names, [class_col], "class_id")
    return indexed.withColumn("class_id", F.col("class_id").cast("int"))


def with_class_id(df: DataFrame, class_col: str) -> DataFrame:
    """``df`` with ``class_id``; rows without a class stay, with a null id."""
    return lookup_join(df, class_ids(df, class_col), class_col, "left")


def parse_names(lines: DataFrame) -> DataFrame:
    """``(id, name)`` from tab-separated lines of exactly two fields."""
    parts = F.split(strip_control(F.col("value")), NAME_SEPARATOR)
    whole = F.assert_true(F.size(parts) == 2, F.concat(F.lit("not two fields: "), "value"))
    return lines.select(
        F.when(whole.isNull(), F.get(parts, F.lit(0))).alias("id"), F.get(parts, F.lit(1)).alias("name")
    )


def read_ids(spark: SparkSession, *paths: str) -> DataFrame:
    """``(id, place)`` of each line; ``place`` orders lines by file, then as they stand in it."""
    lines = spark.read.text(list(paths)).select(
        strip_control(F.col("value")).alias("id"), "_metadata.file_path", "_metadata.file_block_start",
        F.monotonically_increasing_id().alias("line"),
    )
    return lines.select("id", F.struct("file_path", "file_block_start", "line").alias("place"))


def dictionary(ids: DataFrame, names: DataFrame) -> DataFrame:
    """``(label, name)``: ids numbered from 1, ``background`` as 0.

    Ids are numbered in the order of their files' lines where ``ids`` has a column ``place`` (see
    :func:`read_ids`), and else by value. An id without a name raises an error when the result is read.
    """
    spark = ids.sparkSession
    order = "place" if "place" in ids.columns else "id"
    labels = global_index(ids.select("id", F.col(order).alias("_order")), ["_order"], "_place").drop("_order")
    found = lookup_join(labels, names, "id", "left")
    unknown = F.raise_error(F.concat(F.lit("no name for id: "), "id"))
    named = found.withColumn("name", F.when(F.col("name").isNull(), unknown).otherwise(F.col("name")))
    background = spark.range(1).select(
        F.lit(0).cast("bigint").alias("label"), F.lit(BACKGROUND).alias("name")
    )
    numbered = named.select((F.col("_place") + 1).alias("label"), "name")
    return background.unionByName(numbered)


def label_map_lines(labels: DataFrame) -> DataFrame:
    """``label:name`` lines."""
    return labels.select(
        F.concat(F.col("label").cast("bigint").cast("string"), F.lit(":"), "name").alias("value")
    )


def parse_label_map(lines: DataFrame) -> DataFrame:
    """``(label, name)`` split at the first colon; empty lines are skipped, others must parse."""
    colon = F.instr("value", ":")
    label = F.when(colon == 0, F.raise_error(F.concat(F.lit("no colon: "), "value"))).otherwise(
        F.substring_index("value", ":", 1)
    )
    return lines.filter(F.col("value") != "").select(
        label.cast("bigint").alias("label"),
        F.substr("value", colon + 1).alias("name"),
    )
