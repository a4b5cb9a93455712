"""Quality scores from compression with class dictionaries.

One zstandard dictionary is trained on good and one on bad labelled text. A text is compressed in
blocks of fixed size with each; the difference of the compressed sizes, divided by the text's bytes,
says which class it resembles, and a logistic curve fitted on other labelled texts turns it
into a probability. Blocks keep a long text from becoming its own dictionary, and all of them count.

The dictionaries and the curve are fitted on a bounded sample: per class ``SAMPLE_DOCS`` labelled texts, chosen by
a seeded hash among those of at most ``SAMPLE_BYTES`` bytes. Scores use nothing but the text.

Defined results: a null or empty text has difference 0 and the score that belongs to it. Rows without
a label, with another label than 0 or 1, or with a null id are not learned from; copies of a label
count once. Of several texts with the same id, the one whose hash is the smallest is learned from, and all are scored. Very
long texts are scored whole and not learned from. If a class has no texts, every score is the other class's: 0.0 or 1.0, or 0.5 without any.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.llm.common import picked

SAMPLE_DOCS = 2000
SAMPLE_BYTES = 1 << 16
DICTIONARY_BYTES = 112_640
BLOCK_BYTES = 2048
LEVEL = 3
PREDICT_FROM = 0.7


@dataclass(frozen=True)
class QualityModel:
    good: bytes
    bad: bytes
    slope: float
    offset: float


class Compressor:
    """Compressed size of a text's blocks under one dictionary."""

    def __init__(self, dictionary: bytes):
        if dictionary:
            shared = zstandard.ZstdCompressionDict(dictionary)
            shared.precompute_compress(level=LEVEL)
            self.packer = zstandard.ZstdCompressor(dict_data=shared, level=LEVEL, write_checksum=False)
        else:
            self.packer = zstandard.ZstdCompressor(level=LEVEL)

    def size(self, data: bytes) -> int:
        view = memoryview(data)
        return sum(len(self.packer.compress(view[i : i + BLOCK_BYTES])) for i in range(0, len(data), BLOCK_BYTES))


def difference(text: str | None, good: Compressor, bad: Compressor) -> float:
    """How many bytes of each hundred the good dictionary saves over the bad one."""
    data = (text or "").encode("utf-8", "surrogatepass")
    return 100.0 * (bad.size(data) - good.size(data)) / len(data) if data else 0.0


def train_dictionary(texts: list[str]) -> bytes:
    """A trained dictionary, or the texts themselves where they are too few to train one."""
    samples = []
    for text in texts:
        data = text.encode("utf-8", "surrogatepass")
        samples += [data[i : i + BLOCK_BYTES] for i in range(0, len(data), BLOCK_BYTES)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=512, d=8, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


def logistic(x: np.ndarray, y: np.ndarray, steps: int = 50, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by Newton's method with a small penalty."""
    rows = np.column_stack([x, np.ones_like(x)])
    beta = np.zeros(2)
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(rows @ beta, -30, 30)))
        gradient = rows.T @ (y - p) - ridge * beta
        hessian = (rows * (p * (1 - p))[:, None]).T @ rows + ridge * np.eye(2)
        move = np.clip(np.linalg.solve(hessian, gradient), -5, 5)
        beta = beta + move
        if np.abs(move).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", sample_docs: int = SAMPLE_DOCS, seed: int = 0,
) -> QualityModel:
    """Half of each class's sample trains its dictionary, the other half the curve."""
    named = picked(labels, key=id_col, label=label_col).filter("key IS NOT NULL AND label IN (0, 1)").distinct()
    texts = (
        picked(docs, id=id_col, text=text_col)
        .filter((F.length("text") > 0) & (F.octet_length("text") <= SAMPLE_BYTES))
    )
    order = F.xxhash64(F.lit(seed), "key")
    short = named.join(texts.select("id"), F.col("key") == F.col("id"), "left_semi")
    chosen = None
    for label in (0, 1):
        part = short.filter(F.col("label") == label).select("key", "label", order.alias("place"))
        part = part.orderBy("place", "key").limit(sample_docs)
        chosen = part if chosen is None else chosen.unionByName(part)
    # At most two samples of rows with two numbers each: their size is bounded by a parameter.
    met = texts.join(F.broadcast(chosen), F.col("id") == F.col("key"))
    one = F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")
    sample = met.groupBy("place", "key", "label").agg(one)
    rows = sample.toPandas().sort_values(["place", "key"])
    return fit_sample(rows[rows["label"] == 1]["text"].tolist(), rows[rows["label"] == 0]["text"].tolist())


def fit_sample(good: list[str], bad: list[str]) -> QualityModel:
    if not good or not bad:
        return QualityModel(b"", b"", 0.0, 0.0 if not good and not bad else 1e9 if good else -1e9)
    # The same amount of text for both, so that neither dictionary knows more.
    packed = QualityModel(train_dictionary(good[::2]), train_dictionary(bad[::2]), 0.0, 0.0)
    known_good, known_bad = Compressor(packed.good), Compressor(packed.bad)
    held = [(good[1::2] or good, 1.0), (bad[1::2] or bad, 0.0)]
    x = np.array([difference(t, known_good, known_bad) for texts, _ in held for t in texts])
    y = np.concatenate([np.full(len(texts), label) for texts, label in held])
    slope, offset = logistic(x, y)
    return QualityModel(packed.good, packed.bad, slope, offset)


def score(docs: DataFrame, model: QualityModel, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the probability ``out`` that the text is good."""
    # Plain values: a worker may read them before it can import this package.
    shared = docs.sparkSession.sparkContext.broadcast((model.good, model.bad, model.slope, model.offset))

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        good_bytes, bad_bytes, slope, offset = shared.value
        good, bad = Compressor(good_bytes), Compressor(bad_bytes)
        for batch in batches:
            x = np.array([difference(t, good, bad) for t in batch], dtype=float)
            yield pd.Series(1.0 / (1.0 + np.exp(-np.clip(slope * x + offset, -700, 700))))

    return docs.withColumn(out, scored(F.col(f"`{text_col}`")))
