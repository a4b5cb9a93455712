"""Text and CSV files."""

from __future__ import annotations

import csv
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rankflow.functions.text import pair_line
from rankflow.operators.ordering import sort_by
from rankflow.sources.files import join_files


def read_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """``value`` per line of all files, folders or globs; a repeated path counts twice."""
    return spark.read.text(list(paths))


def read_table(spark: SparkSession, *paths: str, schema: StructType | None = None) -> DataFrame:
    """CSV with a header in each file; all columns are strings unless a schema is given.

    Quoted commas stay inside their field, and missing trailing fields are null.
    """
    reader = spark.read.option("header", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(list(paths))


PLACE_TYPE = "struct<path: int, file: string, block: bigint, offset: bigint>"


def read_placed_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """``(value, place)`` per line; ``place`` orders lines by path, file and where they stand in it.

    ``offset`` counts bytes from the first line that begins in the file's block. Lines end in a line feed,
    which a carriage return may precede. A repeated path counts twice.
    """
    scans = [_placed(spark, path, number) for number, path in enumerate(paths)]
    united = scans[0]
    for other in scans[1:]:
        united = united.unionByName(other)
    return united


def _placed(spark: SparkSession, path: str, number: int) -> DataFrame:
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A task reads its blocks one after the other, each in the order of its bytes.
        key, reached = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            value, file, block = batch.columns
            ends = np.cumsum(pc.binary_length(value).to_numpy(zero_copy_only=False) + 1)
            changed = pc.or_(pc.not_equal(file[1:], file[:-1]), pc.not_equal(block[1:], block[:-1]))
            starts = np.concatenate([[0], 1 + np.flatnonzero(changed.to_numpy(zero_copy_only=False))])
            before = np.concatenate([[0], ends])[starts]
            if (file[0].as_py(), block[0].as_py()) == key:
                before[0] -= reached
            lengths = np.diff(np.append(starts, batch.num_rows))
            offsets = np.concatenate([[0], ends[:-1]]) - np.repeat(before, lengths)
            key, reached = (file[-1].as_py(), block[-1].as_py()), int(ends[-1] - before[-1])
            place = pa.StructArray.from_arrays(
                [pa.array([number] * batch.num_rows, pa.int32()), file.cast(pa.string()), block, pa.array(offsets, pa.int64())],
                names=["path", "file", "block", "offset"],
            )
            # The carriage return belongs to the line's end, and to its length.
            yield pa.RecordBatch.from_arrays([pc.replace_substring_regex(value, "\\r$", ""), place], names=["value", "place"])

    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", "_metadata.file_path", "_metadata.file_block_start"
    )
    return lines.mapInArrow(measure, f"value string, place {PLACE_TYPE}")


def _column_names(header: str) -> list[str]:
    """The fields of a header line; empty and repeated ones are named by their number."""
    names: list[str] = []
    for i, name in enumerate(next(csv.reader([header]), [])):
        name = name.replace("`", "``")
        names.append(name if name and name not in names else f"_c{i}")
    return names or ["_c0"]


def first_in_file(place: Column) -> Column:
    return (place["block"] == 0) & (place["offset"] == 0)


def read_raw_table(spark: SparkSession, *paths: str, line: str = "line", place: str | None = None) -> DataFrame:
    """The same with each raw line beside its fields; every file's own first line is dropped, whatever it says.

    Fields are named by the header of the first file. A field may not contain a line break here. ``place`` names
    a column for where a line stands (see :func:`read_placed_lines`).
    """
    lines = read_placed_lines(spark, *paths)
    header = lines.filter(first_in_file(F.col("place"))).orderBy("place").first()
    kept = lines.filter(~first_in_file(F.col("place")))
    if header is None:
        return kept.select(F.col("value").alias(line))
    ddl = ", ".join(f"`{name}` string" for name in _column_names(header["value"]))
    parsed = kept.select(F.from_csv("value", F.lit(ddl)).alias("_fields"), "value", "place")
    columns = ["_fields.*", F.col("value").alias(line)] + ([F.col("place").alias(place)] if place is not None else [])
    return parsed.select(*columns)


def write_ranks(ranks: DataFrame, path: str, single: bool = False) -> None:
    """``(node,rank)`` lines."""
    node, rank = ranks.columns
    _write(ranks.select(pair_line(ranks[node], ranks[rank]).alias("value")), path, "text", single)


def write_table(df: DataFrame, path: str, single: bool = False) -> None:
    """CSV with a header. A sorted ``df`` keeps its order over numbered part files."""
    _write(df, path, "csv", single)


def write_lines(
    df: DataFrame, path: str, keys: list[str], line: str, single: bool = False, copies: bool = False
) -> None:
    """The column ``line`` as text, sorted by ``keys`` over numbered part files."""
    ordered = sort_by(df.select(*dict.fromkeys([*keys, line])), *keys, copies=copies)
    _write(ordered.select(F.col(line).alias("value")), path, "text", single)


def _write(df: DataFrame, path: str, form: str, single: bool) -> None:
    """Numbered part files, joined to one by the file system where ``single`` is asked for."""
    header = form == "csv"
    if not single:
        df.write.option("header", header).format(form).save(path)
        return
    parts = f"{path.rstrip('/')}/_parts"
    df.write.option("header", False).format(form).save(parts)
    folders = [parts]
    if header:
        # A table without rows still has its header, in a file of its own.
        folders.insert(0, f"{path.rstrip('/')}/_header")
        df.filter("false").coalesce(1).write.option("header", True).csv(folders[0])
    join_files(df.sparkSession, folders, f"{path.rstrip('/')}/part-00000.{'csv' if header else 'txt'}")
