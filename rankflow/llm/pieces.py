"""SentencePiece encoding by sampled segmentation, and lossless decoding.

Every way to cut a text into pieces of a public vocabulary is a path through its lattice, drawn with a
probability in proportion to the product of its pieces' weights: forward sums are taken from left to
right, then pieces are sampled from right to left. No piece has a space sign after another character, so a
text falls into stretches, each some spaces and the characters after them, and paths of the
stretches are independent. Forward sums are taken once for each distinct stretch of a block.

The vocabulary ranks its pieces but has no probabilities; a piece of rank ``r`` weighs ``(r +
RANK_OFFSET) ** -sharpness``. A character that is no piece becomes its UTF-8 bytes' pieces. Random numbers are a
hash of the seed, the row key and the place in the text: a row's segmentation does not depend on batches,
partitions or attempts.

Defined results: a null text has null ids and decodes to null, an empty text has none and decodes to
the empty text. Rows with the same key and text get the same ids. A null key is a key of its own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StructField, StructType

from rankflow.llm.lattice import (
    SPACE_SIGN, TOKENIZER_PATH, Vocabulary, blocks, forward, laid_out, load_vocabulary, mix64,
)

SHARPNESS = 1.0
RANK_OFFSET = 10.0
BLOCK_CHARS = 300_000
STRETCH = re.compile(f"{SPACE_SIGN}*[^{SPACE_SIGN}]+|{SPACE_SIGN}+")
# A literal space sign in a text must stay apart from a space: a surrogate alone is no character of any text, and no piece.
LITERAL_SIGN = "\ud800"


def piece_weights(vocabulary: Vocabulary, sharpness: float = SHARPNESS) -> np.ndarray:
    """A weight per id, and that of a character spelt in bytes; ids that are no ordinary piece have 0."""
    weights = np.zeros((vocabulary.size + 1, 1))
    kept = np.array(vocabulary.kept)
    weights[kept, 0] = (np.arange(len(kept)) + RANK_OFFSET) ** -sharpness
    weights[vocabulary.size] = (len(kept) + RANK_OFFSET) ** -sharpness
    return weights


class Sampler:
    def __init__(self, tokenizer: str, sharpness: float):
        self.vocabulary = load_vocabulary(tokenizer)
        self.weights = piece_weights(self.vocabulary, sharpness)

    def _lattice(self, stretches: list[str]):
        """Edges sorted by the node where they end, and running totals of their probabilities there."""
        codes, starts, lengths, room = laid_out(stretches)
        edges = self.vocabulary.edges(codes, starts, lengths, room)
        firsts = starts + np.arange(len(starts))
        nodes = len(codes) + len(starts)
        logs = forward(edges, nodes, self.weights)[:, 0]
        share = self.weights[edges.piece, 0] * np.exp(logs[edges.source] - logs[edges.target])
        order = np.lexsort((edges.length, edges.target))
        # Every node's shares sum to one, so a draw at a node lies among its own running totals.
        bounds = np.searchsorted(edges.target[order], np.arange(nodes + 1))
        totals = np.concatenate([[0.0], np.cumsum(share[order])])
        return codes, firsts, lengths, edges.length[order], edges.piece[order], bounds, totals

    def encode_block(self, texts: list[str], keys: list[int]) -> list[np.ndarray]:
        known: dict[str, int] = {}
        which, row, base = [], [], []
        for i, text in enumerate(texts):
            signed = text.replace(SPACE_SIGN, LITERAL_SIGN).replace(" ", SPACE_SIGN)
            at = 0
            for stretch in STRETCH.findall(signed):
                which.append(known.setdefault(stretch, len(known)))
                row.append(i)
                base.append(at)
                at += len(stretch)
        if not known:
            return [np.zeros(0, dtype=np.int32) for _ in texts]
        which, row, base = (np.array(x, dtype=np.int64) for x in (which, row, base))
        codes, firsts, lengths, sizes, pieces, bounds, totals = self._lattice(list(known))
        salt = mix64(np.array(keys, dtype=np.int64).view(np.uint64))[row]
        left, drawn = lengths[which].copy(), []
        live = np.arange(len(which))
        while len(live):
            end = base[live] + left[live]
            node = firsts[which[live]] + left[live]
            low, high = bounds[node], bounds[node + 1]
            draw = mix64(salt[live] ^ mix64(end.astype(np.uint64))) >> np.uint64(11)
            draw = draw.astype(np.float64) / float(1 << 53)
            aim = totals[low] + draw * (totals[high] - totals[low])
            edge = np.clip(np.searchsorted(totals, aim, side="right") - 1, low, high - 1)
            drawn.append((row[live], end, pieces[edge], codes[node - which[live] - 1]))
            left[live] -= sizes[edge]
            live = live[left[live] > 0]
        rows, ends, ids, chars = (np.concatenate(part) for part in zip(*drawn))
        order = np.lexsort((ends, rows))
        rows, ids, chars = rows[order], ids[order], chars[order]
        return self._spelt(rows, ids, chars, len(texts))

    def _spelt(self, rows, ids, chars, count: int) -> list[np.ndarray]:
        """Ids per text; characters that are no piece are spelt in bytes."""
        odd = np.flatnonzero(ids == self.vocabulary.size)
        if len(odd):
            sizes = np.ones(len(ids), dtype=np.int64)
            spelt = {}
            for char in np.unique(chars[odd]).tolist():
                text = SPACE_SIGN if chr(char) == LITERAL_SIGN else chr(char)
                spelt[char] = [self.vocabulary.byte_ids[b] for b in text.encode("utf-8")]
            sizes[odd] = [len(spelt[c]) for c in chars[odd].tolist()]
            firsts = np.cumsum(sizes) - sizes
            out = np.repeat(ids, sizes)
            for place, char in zip(firsts[odd].tolist(), chars[odd].tolist()):
                out[place : place + len(spelt[char])] = spelt[char]
            rows, ids = np.repeat(rows, sizes), out
        return np.split(ids, np.searchsorted(rows, np.arange(1, count)))


def _speller(vocabulary: Vocabulary) -> list[bytes]:
    """The bytes that each id stands for."""
    spelt = [piece.replace(SPACE_SIGN, " ").encode("utf-8") for piece in vocabulary.pieces]
    for byte, i in enumerate(vocabulary.byte_ids):
        spelt[i] = bytes([byte])
    return spelt


def _lists(arrays: list[np.ndarray | None]) -> pa.ListArray:
    sizes = [0 if x is None else len(x) for x in arrays]
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
    held = [x for x in arrays if x is not None and len(x)]
    values = pa.array(np.concatenate(held).astype(np.int32) if held else np.zeros(0, dtype=np.int32))
    return pa.ListArray.from_arrays(offsets, values, mask=pa.array([x is None for x in arrays]))


def encode(
    docs: DataFrame, key_col: str = "doc_id", text_col: str = "text", out: str = "ids",
    tokenizer: str = TOKENIZER_PATH, sharpness: float = SHARPNESS, seed: int = 0, check: str | None = None,
) -> DataFrame:
    """``docs`` with the piece ids ``out`` of one sampled segmentation per row.

    ``check`` names a further column: whether the ids spell the text again. Rows go through a task in blocks of
    about ``BLOCK_CHARS`` characters, so its memory does not grow with their number.
    """
    names = docs.columns
    place, hashed = names.index(text_col), "_" + "_".join(names)
    fields = [*docs.schema.fields, StructField(out, ArrayType(IntegerType()))]
    if check:
        fields.append(StructField(check, BooleanType()))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(tokenizer, sharpness)
        spelt = _speller(sampler.vocabulary)
        for batch in batches:
            sizes = pc.fill_null(pc.utf8_length(batch.column(place)), 0).to_pylist()
            low = 0
            for block in blocks(sizes, lambda n: n + 1, BLOCK_CHARS):
                part = batch.slice(low, len(block))
                low += len(block)
                texts, keys = part.column(place).to_pylist(), part.column(len(names)).to_pylist()
                present = [i for i, t in enumerate(texts) if t is not None]
                ids: list[np.ndarray | None] = [None] * len(texts)
                for i, own in zip(present, sampler.encode_block([texts[i] for i in present], [keys[i] for i in present])):
                    ids[i] = own
                columns = [*part.columns[: len(names)], _lists(ids)]
                if check:
                    columns.append(pa.array([
                        x is None or b"".join(map(spelt.__getitem__, x.tolist())).decode("utf-8") == t
                        for x, t in zip(ids, texts)
                    ], pa.bool_()))
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    keyed = docs.withColumn(hashed, F.xxhash64(F.lit(seed), f"`{key_col}`"))
    return keyed.mapInArrow(encoded, StructType(fields))


def decode(encoded: DataFrame, ids_col: str = "ids", out: str = "decoded", tokenizer: str = TOKENIZER_PATH) -> DataFrame:
    """``encoded`` with the text that its piece ids spell."""

    @F.pandas_udf("string")
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        spelt = _speller(load_vocabulary(tokenizer))
        for batch in batches:
            yield pd.Series([
                None if ids is None else b"".join(map(spelt.__getitem__, ids)).decode("utf-8") for ids in batch
            ], dtype=object)

    return encoded.withColumn(out, decoded(F.col(f"`{ids_col}`")))
