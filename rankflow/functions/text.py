"""String expressions for link files, label maps and output lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The field separator and the one namespace that counts as a node.
FIELD_SEPARATOR = "\\t+"
KEPT_NAMESPACE = "category:"
COMMENT_PREFIX = "#"

# Everything up to and including the space character, at either end.
CONTROL_EDGES = "^[\\x00-\\x20]+|[\\x00-\\x20]+$"


def strip_control(value: Column) -> Column:
    """Trim spaces and control characters (``F.trim`` removes spaces only)."""
    return F.regexp_replace(value, CONTROL_EDGES, "")


def clean_fields(line: Column) -> Column:
    """Split on tab runs; trim, drop empty fields, lower-case the rest."""
    fields = F.transform(F.split(line, FIELD_SEPARATOR), strip_control)
    return F.transform(F.filter(fields, lambda field: field != ""), F.lower)


def in_main_namespace(field: Column) -> Column:
    return ~F.contains(field, F.lit(":")) | F.startswith(field, F.lit(KEPT_NAMESPACE))


def parent_folder(path: Column) -> Column:
    """Name of the folder that directly holds the file."""
    return F.element_at(F.split(path, "/"), -2)


def pair_line(left: Column, right: Column) -> Column:
    """``(left,right)`` as one line of text."""
    return F.concat(
        F.lit("("), left.cast("string"), F.lit(","), right.cast("string"), F.lit(")")
    )
