"""Image records: labelled folders, split datasets, box lists and a synthetic feed."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.functions.text import parent_folder

# Split names, field defaults, box order and the shape of the synthetic feed.
SPLITS = ("train", "validation")
RECORD_DEFAULTS = {"content": b"", "format": "png", "label": 0}
BOXED_DEFAULTS = {"content": b"", "format": "jpeg", "label": -1, "text": ""}
BOX_TYPE = "array<struct<ymin: float, xmin: float, ymax: float, xmax: float>>"
SYNTHETIC_SHAPE = (256, 256, 3)
SYNTHETIC_CLASSES = 1000
# Fixed value: the folder of rows whose partition column is null.
NO_CLASS = "__HIVE_DEFAULT_PARTITION__"


def read_class_folders(spark: SparkSession, root: str, column: str | None = None) -> DataFrame:
    """``(path, content, class)`` of all files below ``root``; the class is the parent folder.

    Files whose names begin with an underscore or a dot are hidden. ``column`` names the partition column of folders that
    a table was written to: its values are then taken from ``column=value``, and null from the folder of rows without one.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    shown = files.filter(~F.element_at(F.split("path", "/"), -1).rlike("^[_.]"))
    folder = parent_folder(F.col("path"))
    if column is not None:
        value = F.substring_index(folder, f"{column}=", -1)
        folder = F.when(value != NO_CLASS, F.url_decode(F.replace(value, F.lit("+"), F.lit("%2B"))))
    return shown.select("path", "content", folder.alias("class"))


def write_splits(df: DataFrame, path: str) -> None:
    """Parquet below ``split=/shard=`` folders.

    A shard is a contiguous range of an indexed table, so each task writes few folders.
    """
    df.write.partitionBy("split", "shard").parquet(path)


def read_split(spark: SparkSession, path: str, split: str, defaults: dict = RECORD_DEFAULTS) -> DataFrame:
    """One split of a dataset with missing fields filled; other splits are not read."""
    if split not in SPLITS:
        raise ValueError(f"unknown split {split!r}, expected one of {SPLITS}")
    return with_defaults(spark.read.parquet(path).filter(F.col("split") == split), defaults)


def with_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    return df.withColumns(
        {name: F.coalesce(F.col(name), F.lit(value)) for name, value in defaults.items()}
    )


def zip_boxes(ymin: Column, xmin: Column, ymax: Column, xmax: Column) -> Column:
    """Four coordinate lists as one list of boxes."""
    boxes = F.arrays_zip(
        ymin.alias("ymin"), xmin.alias("xmin"), ymax.alias("ymax"), xmax.alias("xmax")
    )
    return boxes.cast(BOX_TYPE)


def synthetic_images(
    spark: SparkSession, batch_num: int, batch_size: int, seed: int = 0, train: bool = True
) -> DataFrame:
    """One normally distributed image and one label, repeated for every requested example.

    The image depends on the seed alone, so the optimizer folds it into a constant. Outside
    training a single example is returned.
    """
    rows = batch_num * batch_size if train else 1
    cells = math.prod(SYNTHETIC_SHAPE)

    def uniform(cell: Column, stream: int) -> Column:
        return (F.pmod(F.xxhash64(cell, F.lit(seed), F.lit(stream)), F.lit(2**40)) + 1) / 2.0**40

    def normal(cell: Column) -> Column:
        radius = F.sqrt(-2.0 * F.log(uniform(cell, 0)))
        return (radius * F.cos(2.0 * math.pi * uniform(cell, 1))).cast("float")

    image = F.transform(F.sequence(F.lit(1), F.lit(cells)), normal)
    label = F.pmod(F.xxhash64(F.lit(seed), F.lit("label")), F.lit(SYNTHETIC_CLASSES))
    return spark.range(rows).select("id", image.alias("image"), label.cast("int").alias("label"))
