"""Piece lattices over many short texts at once.

A public vocabulary gives the pieces; its file is expected at the same path on every machine. For a block of texts, laid end to end as one array of code
points, the pieces that start at each position are found length by length: a rolling 64-bit
hash of the window is looked up among the hashes of all pieces' prefixes. A character that is no
piece gets an edge of its own, so every text has a segmentation.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np

TOKENIZER_PATH = "/opt/tokenizers/piece_bpe_32k.model"

# The sign for a space, and mixing constants of a 64-bit hash.
SPACE_SIGN = "▁"
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)
FACTOR = np.uint64(0x100000001B3)

NO_PIECE = -1


def mix64(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64) + GOLDEN
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


@dataclass(frozen=True)
class Edges:
    """The pieces of a block of texts, sorted by where in its text a piece ends, then by text and length.

    ``source`` and ``target`` are nodes: a text's node ``t`` stands before its character ``t``. ``piece`` is
    an id, or the vocabulary's size for a character that is no piece. ``bounds[t]`` is the first edge that
    ends at ``t``.
    """

    source: np.ndarray
    target: np.ndarray
    length: np.ndarray
    piece: np.ndarray
    bounds: np.ndarray


class Vocabulary:
    """The ordinary pieces of a SentencePiece model, its byte pieces, and ``size`` ids in all.

    All prefixes of pieces are in one open-addressing hash table, so that a position is given up as soon
    as no piece goes on with its characters.
    """

    def __init__(self, pieces: list[str], kept: list[int], byte_ids: list[int]):
        self.pieces, self.kept, self.byte_ids, self.size = pieces, kept, byte_ids, len(pieces)
        self.longest = max(len(pieces[i]) for i in kept)
        hashes, values = self._prefixes()
        slots = 1 << int(4 * len(hashes)).bit_length()
        self.mask = np.uint64(slots - 1)
        self.keys, self.values = np.zeros(slots, dtype=np.uint64), np.full(slots, NO_PIECE, dtype=np.int32)
        todo, probe = np.arange(len(hashes)), 0
        while len(todo):
            slot = ((hashes[todo] + np.uint64(probe)) & self.mask).astype(np.int64)
            free = self.keys[slot] == 0
            _, first = np.unique(slot, return_index=True)
            placed = np.zeros(len(todo), dtype=bool)
            placed[first] = True
            placed &= free
            self.keys[slot[placed]], self.values[slot[placed]] = hashes[todo[placed]], values[todo[placed]]
            todo, probe = todo[~placed], probe + 1

    def _prefixes(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all prefixes, and the piece that each is, if any."""
        codes, starts, lengths, room = laid_out([self.pieces[i] for i in self.kept])
        mixed, hashes = mix64(codes), np.zeros(len(starts), dtype=np.uint64)
        found, values = [], []
        ids = np.array(self.kept, dtype=np.int32)
        for length in range(1, self.longest + 1):
            live = lengths >= length
            starts, lengths, ids = starts[live], lengths[live], ids[live]
            hashes = hashes[live] * FACTOR + mixed[starts + length - 1]
            found.append(hashes)
            values.append(np.where(lengths == length, ids, NO_PIECE))
        hashes, values = np.concatenate(found), np.concatenate(values)
        order = np.lexsort((-values, hashes))
        unique, first = np.unique(hashes[order], return_index=True)
        return unique, values[order][first]

    def _look_up(self, hashes: np.ndarray) -> np.ndarray:
        """The piece of each hash, ``NO_PIECE`` for a mere prefix, one less for neither."""
        result = np.full(len(hashes), NO_PIECE - 1, dtype=np.int32)
        todo, probe = None, 0
        while todo is None or len(todo):
            own = hashes if todo is None else hashes[todo]
            slot = ((own + np.uint64(probe)) & self.mask).astype(np.int64)
            keys = self.keys[slot]
            hit = keys == own
            more = ~hit & (keys != 0)
            if todo is None:
                result[hit] = self.values[slot[hit]]
                todo = np.flatnonzero(more)
            else:
                result[todo[hit]] = self.values[slot[hit]]
                todo = todo[more]
            probe += 1
        return result

    def edges(self, codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, room: np.ndarray) -> Edges:
        """All pieces in texts that are laid end to end, for :func:`laid_out`'s arrays."""
        text = np.repeat(np.arange(len(starts)), lengths)
        mixed = mix64(codes)
        live, hashes = np.arange(len(codes)), np.zeros(len(codes), dtype=np.uint64)
        sources, sizes, pieces = [], [], []
        for length in range(1, self.longest + 1):
            enough = room[live] >= length
            live, hashes = live[enough], hashes[enough]
            if not len(live):
                break
            hashes = hashes * FACTOR + mixed[live + length - 1]
            found = self._look_up(hashes)
            ids, at = found[found >= 0], live[found >= 0]
            if length == 1:
                ids, at = np.where(found >= 0, found, self.size), live
            sources.append(at)
            sizes.append(np.full(len(at), length, dtype=np.int64))
            pieces.append(ids)
            going = found >= NO_PIECE
            live, hashes = live[going], hashes[going]
        if not sources:
            empty = np.zeros(0, dtype=np.int64)
            return Edges(empty, empty, empty, empty, np.zeros(1, dtype=np.int64))
        source, size, piece = (np.concatenate(x) for x in (sources, sizes, pieces))
        ends = source - starts[text[source]] + size
        order = np.lexsort((size, text[source], ends))
        source, size, piece, ends = source[order], size[order], piece[order], ends[order]
        node = source + text[source]  # a text has one node more than characters
        bounds = np.searchsorted(ends, np.arange(int(lengths.max()) + 2))
        return Edges(node, node + size, size, piece, bounds)


@functools.lru_cache(maxsize=2)
def load_vocabulary(path: str = TOKENIZER_PATH) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    pieces = [model.id_to_piece(i) for i in range(size)]
    odd = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i) for i in range(size)]
    byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    return Vocabulary(pieces, [i for i in range(size) if not odd[i]], byte_ids)


def laid_out(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code points end to end; every text's start and length; what is left from each position."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
    codes = code_points("".join(texts))
    room = np.repeat(starts + lengths, lengths) - np.arange(len(codes))
    return codes, starts, lengths, room


def forward(edges: Edges, nodes: int, weights: np.ndarray) -> np.ndarray:
    """Logs of the forward sums per node and model.

    ``weights`` has a row per id and one for characters that are no piece, a column per model. All texts
    advance together, a character at a time. Sums are taken relative to the node before, so nothing
    vanishes in long texts, however far the models differ.
    """
    logs = np.zeros((nodes, weights.shape[1]))
    for t in range(1, len(edges.bounds) - 1):
        low, high = edges.bounds[t], edges.bounds[t + 1]
        target, source = edges.target[low:high], edges.source[low:high]
        first = np.flatnonzero(np.concatenate([[True], target[1:] != target[:-1]]))
        here = target[first]
        base = logs[here - 1]
        shift = np.exp(logs[source] - np.repeat(base, np.diff(np.append(first, len(target))), axis=0))
        total = np.add.reduceat(weights[edges.piece[low:high]] * shift, first, axis=0)
        logs[here] = base + np.log(total)
    return logs


def log_marginals(vocabulary: Vocabulary, texts: list[str], weights: np.ndarray) -> np.ndarray:
    """Log of the summed weight of all segmentations, per text and model."""
    codes, starts, lengths, room = laid_out(texts)
    edges = vocabulary.edges(codes, starts, lengths, room)
    firsts = starts + np.arange(len(starts))
    logs = forward(edges, len(codes) + len(starts), weights)
    return logs[firsts + lengths]


def blocks(items: Iterable, size, limit: int) -> Iterator[list]:
    """Runs of items whose sizes sum to about ``limit``; a larger item stands alone."""
    held, total = [], 0
    for item in items:
        if held and total + size(item) > limit:
            yield held
            held, total = [], 0
        held.append(item)
        total += size(item)
    if held:
        yield held
