"""Each document next to its neighbour in the order of ids, with fingerprints of both and of a mixture.

The whole texts are shuffled once, by ranges of descending ids, and read in order: a task sees a row and its
successor. The first and the last row of every partition are kept with their texts, and the last ones meet the
first ones of the following partitions in a second, small pass.

Defined results: the order is by descending id, null ids last, then by a hash of the text. After the last row
comes the first, which for a single row is itself. A null text counts as empty. A range that is one id takes
part in the order by its texts' hashes, so copies of an id spread over partitions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.llm.common import picked
from rankflow.llm.simhash import as_signed, fingerprint
from rankflow.session import cut

FIELDS = "id bigint, n_chars bigint, edited_sha256 string, own bigint, edited bigint, next bigint"
SCHEMA = f"part int, role string, text string, {FIELDS}"
FIRST, LAST, DONE = "first", "last", "done"


def edit(text: str, following: str) -> str:
    """``text`` with its last third replaced by as many characters from the start of ``following``."""
    size = len(text) // 3
    return text[: len(text) - size] + following[:size]


def _finished(doc_id, text: str, own: int, following: str, next_fingerprint: int) -> tuple:
    mixed = edit(text, following)
    digest = hashlib.sha256(mixed.encode("utf-8", "surrogatepass")).hexdigest()
    return doc_id, len(text), digest, as_signed(own), as_signed(fingerprint(mixed)), as_signed(next_fingerprint)


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Finished rows, and the first and last row of the partition with their texts."""
    schema = pa.schema([
        ("part", pa.int32()), ("role", pa.string()), ("text", pa.string()), ("id", pa.int64()),
        ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("own", pa.int64()), ("edited", pa.int64()),
        ("next", pa.int64()),
    ])
    part = TaskContext.get().partitionId()
    held = None
    out: list[tuple] = []
    for batch in batches:
        for doc_id, text in zip(batch.column(0), batch.column(1)):
            doc_id, text = doc_id.as_py(), text.as_py() or ""
            own = fingerprint(text)
            if held is None:
                out.append((part, FIRST, text, doc_id, None, None, as_signed(own), None, None))
            else:
                out.append((part, DONE, None, *_finished(*held, text, own)))
            held = doc_id, text, own
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
        out = []
    if held is not None:
        row = (part, LAST, held[1], held[0], None, None, as_signed(held[2]), None, None)
        yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(row, schema)], schema=schema)


def _join_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            own, following = row["own"] & (1 << 64) - 1, row["next_own"] & (1 << 64) - 1
            rows.append(_finished(row["id"], row["text"], own, row["next_text"], following))
        if rows:
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            names = ["id", "n_chars", "edited_sha256", "own", "edited", "next"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def fingerprints_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_chars, edited_sha256, own, edited, next)`` per row: the edited text's hash, and the fingerprints
    of the text, the edited text and the next text."""
    named = picked(docs, id=id_col, text=text_col).select(F.col("id").cast("bigint").alias("id"), "text")
    keyed = named.withColumn("tie", F.xxhash64("text"))
    order = [F.col("id").desc_nulls_last(), F.col("tie")]
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text")
    walked = cut(ordered.mapInArrow(_walk, SCHEMA), "walked", partition_by=("role",))
    names = ["id", "n_chars", "edited_sha256", "own", "edited", "next"]
    done = walked.filter(F.col("role") == DONE).select(*names)
    firsts = walked.filter(F.col("role") == FIRST)
    # A number for each partition that holds rows.
    parts = sorted(row["part"] for row in firsts.select("part").collect())
    if not parts:
        return done
    following = dict(zip(parts, [*parts[1:], parts[0]]))
    links = docs.sparkSession.createDataFrame(list(following.items()), "part int, to int")
    lasts = walked.filter(F.col("role") == LAST).join(links, "part").select("id", "text", "own", "to")
    met = lasts.join(
        firsts.select(F.col("part").alias("to"), F.col("text").alias("next_text"), F.col("own").alias("next_own")), "to"
    )
    return done.unionByName(met.drop("to").mapInArrow(_join_up, FIELDS))
