"""Awkward documents: nulls, empty and very long texts, ties, repeated rows, columns with clashing names."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

LONG = " ".join(f"word{i % 977}x{i}" for i in range(20_000))
BASE = " ".join(f"tok{i}" for i in range(60))
ROWS = [
    (1, BASE, "en", "a", None),
    (1, BASE, "en", "a", None),
    (2, BASE.upper(), "en", "b", 5),
    (3, BASE.replace("tok7 ", "other "), "en", None, 5),
    (4, None, None, "a", 0),
    (5, "", "de", None, 0),
    (6, " \t\n", "de", "c", 3),
    (7, "x", "en", "c", 1),
    (8, "x", "en", "c", 1),
    (9, "y z", None, "c", 3),
    (None, "no id at all but five words more", "en", "d", None),
    (None, "no id at all but five words more", "en", "d", None),
    (10, LONG, "en", "d", None),
    (11, LONG + " end", "en", "d", None),
    (12, "😀 ünïcödé ▁ sign\r\n\x0b\x0c and\ttabs", "fr", "a", None),
    (13, "a" * 30_000, "en", "b", None),
    (14, "1" * 30_000 + " +" + "2" * 20_000, "en", "b", None),
    (15, "mail a.b@c.example.org or +1 (223) 555-0199, 4111 1111 1111 1111 at 10.0.0.1!", "en", "b", None),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASHES = ["key", "words", "size", "hash", "found", "id", "label", "row", "score", "token", "vector", "spans", "place"]

WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = {i: i + 32 for i in range(65, 91)}


def documents(spark, rows=ROWS):
    made = spark.createDataFrame(rows, SCHEMA).repartition(5)
    return made.select("*", *[F.lit("clash").alias(name) for name in CLASHES])


def words(text):
    return WORD.findall((text or "").translate(_LOWER))


def prose(seed, count, vocabulary=400):
    own = random.Random(seed)
    return " ".join(f"w{own.randrange(vocabulary)}" for _ in range(count))


def tuples(df, *names):
    return [tuple(row) for row in df.select(*names).collect()]
