"""Label-map files: one ``label:name`` line per class."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rankflow.operators.labels import label_map_lines, parse_label_map
from rankflow.sources.files import Files, publish, published, withdraw

# Fixed value: the file name below the dataset folder.
LABELS_NAME = "labels.txt"


def write_label_map(labels: DataFrame, folder: str, name: str = LABELS_NAME) -> None:
    """Label-map lines below ``folder/name``, published once they are whole; a map that is there is replaced."""
    spark = labels.sparkSession
    withdraw(spark, folder, name)
    label_map_lines(labels).write.mode("overwrite").text(f"{folder}/{name}")
    publish(spark, folder, name)


def read_label_map(spark: SparkSession, folder: str, name: str = LABELS_NAME) -> DataFrame:
    """The files that were published, or a plain file of that name."""
    files = published(spark, folder, name)
    return parse_label_map(spark.read.text(files if files is not None else f"{folder}/{name}"))


def has_label_map(spark: SparkSession, folder: str, name: str = LABELS_NAME) -> bool:
    """Whether there is a published map or a plain file; a folder that a failed write left is none."""
    return published(spark, folder, name) is not None or Files(spark, folder).is_file(f"{folder}/{name}")


def load_or_build(
    spark: SparkSession, folder: str, build: Callable[[], DataFrame], name: str = LABELS_NAME
) -> DataFrame:
    """Read the label map of a dataset; where there is none, build and write it first."""
    if not has_label_map(spark, folder, name):
        write_label_map(build(), folder, name)
    return read_label_map(spark, folder, name)
