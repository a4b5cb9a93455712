"""Cheapest repair of conversations into an optional system turn and pairs of user and assistant turns.

Every row is kept, given another role or deleted, and rows without text may be inserted anywhere; the letters of these
edits, in order, are the audit. Among the cheapest audits the least in ASCII order wins. A dynamic program over the rows
holds one audit for each of four states: nothing yet, after a system row, after a user row, after an assistant row.

Audits share their prefixes: one is a node with a letter and a link to the node before it, a rolling hash of all its letters
and links to its ancestors at distances of 1, 2, 4, ... A tie in cost is settled by lifting both nodes to the same
length and then up to the first letters that differ, as hashes of prefixes tell, in a logarithmic number of steps. What
lies before these letters is verified letter by letter, unless both are the same node; if hashes lied, the
letters decide.

Rows are numbered in the whole table by ranges of conversation and turn, and cut into segments of at most ``SEGMENT_ROWS``,
so a conversation of any length is repaired by many tasks. A segment gives for every state before it and after it the cheapest
audit. Its last edit is never an insertion, so of two audits of the same rows none is the beginning of another, and ties
between segments are settled by the order of the audits before. What remains per segment is sixteen costs and
places; one pass over these chooses the states in between. Only the hash of a repaired conversation needs its lines in one order:
they stream through one task, which holds one Arrow batch and the state of the hash.

Defined results: rows of one turn go by role, then by a hash of role and text. Null roles and texts are one space before any
damage; a role that begins with none of ``s``, ``u``, ``a``, an empty one too, can't be kept. Null ids are one conversation, null turns
come first and count for no gap. A gap beyond 64 bits is the largest 64-bit number. Repeated rows are duplicates, long texts
are whole, an empty table gives no rows, further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cmp_to_key

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankflow.llm.common import picked
from rankflow.operators.ordering import global_index
from rankflow.session import cut, scratch

SEGMENT_ROWS = 4096
# Costs of edits, white space and the ends of whole sentences.
COSTS = {"K": 0, "R": 2, "D": 3, "I": 2}
TRUNCATED_COST = 1
BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"
SEPARATORS = (" ", ":")

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
# The state that a user or an assistant row leads to, by the state before; a system row may only come first.
AFTER = {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
ROLES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}
NO_FAULT, BLANK, DUPLICATE, TRUNCATED = range(4)
HASH_BASE, HASH_MODULUS = 1_000_003, (1 << 61) - 1


# --- audits ------------------------------------------------------------------------------------


class Audits:
    """All audits of a segment as one tree of letters. Node 0 is the empty audit."""

    def __init__(self):
        self.letter, self.length, self.hash, self.up = [""], [0], [0], [[]]

    def add(self, node: int, letter: str) -> int:
        ups, last = [node], node
        while len(self.up[last]) >= len(ups):
            last = self.up[last][len(ups) - 1]
            ups.append(last)
        self.letter.append(letter)
        self.length.append(self.length[node] + 1)
        self.hash.append((self.hash[node] * HASH_BASE + ord(letter)) % HASH_MODULUS)
        self.up.append(ups)
        return len(self.letter) - 1

    def text(self, node: int) -> str:
        letters = []
        while node:
            letters.append(self.letter[node])
            node = self.up[node][0]
        return "".join(reversed(letters))

    def _lifted(self, node: int, length: int) -> int:
        excess = self.length[node] - length
        while excess:
            step = excess.bit_length() - 1
            node = self.up[node][step]
            excess -= 1 << step
        return node

    def _same(self, a: int, b: int) -> bool:
        """Whether two audits of one length have the same letters, up to a node that they share."""
        while a != b:
            if self.letter[a] != self.letter[b]:
                return False
            a, b = self.up[a][0], self.up[b][0]
        return True

    def compare(self, a: int, b: int) -> int:
        """Negative, zero or positive, as ``a`` comes before, equals or comes after ``b`` in ASCII order."""
        if a == b:
            return 0
        length_a, length_b = self.length[a], self.length[b]
        short = min(length_a, length_b)
        x, y = self._lifted(a, short), self._lifted(b, short)
        if x == y or (self.hash[x] == self.hash[y] and self._same(x, y)):
            return length_a - length_b
        if self.hash[x] != self.hash[y]:
            for step in range(len(self.up[x]) - 1, -1, -1):
                if step < len(self.up[x]):
                    up_x, up_y = self.up[x][step], self.up[y][step]
                    if self.hash[up_x] != self.hash[up_y]:
                        x, y = up_x, up_y
            if self._same(self.up[x][0], self.up[y][0]):
                return ord(self.letter[x]) - ord(self.letter[y])
        # Different prefixes with the same hash: only the letters are left to ask.
        left, right = self.text(a), self.text(b)
        return (left > right) - (left < right)

    def least(self, options: list[tuple[int, int]]) -> tuple[int, int] | None:
        """The cheapest of ``(cost, node)``, the first in ASCII order among equals."""
        best = None
        for option in options:
            if best is None or option[0] < best[0] or (option[0] == best[0] and self.compare(option[1], best[1]) < 0):
                best = option
        return best


def _choose(audits: Audits, options: list[tuple[int, int, str]]) -> tuple[int, int] | None:
    """The best of ``(cost, node, letter)``, with its letter added to its node."""
    if not options:
        return None
    cheapest = min(option[0] for option in options)
    return audits.least([(cost, audits.add(node, letter)) for cost, node, letter in options if cost == cheapest])


def _with_insertions(audits: Audits, heads: list) -> list:
    """The best audits of each state when rows may be inserted after those of ``heads``."""
    cost = COSTS["I"]
    heads = list(heads)
    for state in (USER, ASSISTANT):
        added = [
            (heads[before][0] + cost, heads[before][1], "I")
            for before, after in AFTER.items() if after == state and heads[before] is not None
        ]
        # Costs settle most cases before a node is made.
        if heads[state] is not None:
            added = [option for option in added if option[0] <= heads[state][0]]
        if added:
            made = _choose(audits, added)
            heads[state] = made if heads[state] is None else audits.least([heads[state], made])
    return heads


def segment_audits(rows: list[tuple[str, int]], start: int) -> tuple[Audits, list[tuple[int, int] | None]]:
    """Per state after the rows ``(initial, fault)`` the cheapest ``(cost, node)``, from the state ``start`` before them."""
    audits = Audits()
    heads: list = [None] * 4
    heads[start] = (0, 0)
    for initial, fault in rows:
        ready = _with_insertions(audits, heads)
        options: list[list] = [[] for _ in STATES]
        for state in STATES:
            if ready[state] is None:
                continue
            cost, node = ready[state]
            options[state].append((cost + COSTS["D"], node, "D"))
            if fault in (BLANK, DUPLICATE):
                continue
            cost += TRUNCATED_COST if fault == TRUNCATED else 0
            after = AFTER[state]
            kept = SYSTEM if initial == "s" and state == NOTHING else after if initial == ROLES[after][0] else None
            if kept is not None:
                options[kept].append((cost + COSTS["K"], node, "K"))
            options[after].append((cost + COSTS["R"], node, "R"))
        heads = [_choose(audits, own) for own in options]
    return audits, heads


# What has to be inserted at the end of a conversation, by state.
ENDINGS = {NOTHING: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}


def choose_path(segments: list[tuple[list, list]]) -> tuple[int, list[int], str]:
    """Cost, the choice ``4 * before + after`` in each segment, and the letters at the end.

    A segment is sixteen costs (None: no way) and the places of its audits among those from the same state.
    """
    heads = {NOTHING: (0, 0)}
    back = []
    for costs, places in segments:
        options = []
        for after in STATES:
            ways = [
                (cost + costs[4 * before + after], rank, before)
                for before, (cost, rank) in heads.items() if costs[4 * before + after] is not None
            ]
            if ways:
                cost, rank, before = min(ways)
                options.append(((rank, places[4 * before + after]), after, cost, before))
        options.sort()
        heads = {after: (cost, rank) for rank, (_, after, cost, _) in enumerate(options)}
        back.append({after: before for _, after, _, before in options})
    cost, _, state = min(
        (cost + COSTS["I"] * len(ENDINGS[state]), rank, state) for state, (cost, rank) in heads.items()
    )
    ending, choices = ENDINGS[state], []
    for befores in reversed(back):
        choices.append(4 * befores[state] + state)
        state = befores[state]
    return cost, choices[::-1], ending


# --- tables ------------------------------------------------------------------------------------


def damaged(rows: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, copy)`` after the damage that a checksum of conversation and turn picks."""
    text_of = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    mark = F.pmod(F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn"))), F.lit(20))
    role = F.when(F.col("mark") == 4, "user").otherwise(text_of("role"))
    text = F.when(F.col("mark") == 1, "").when(F.col("mark") == 2, F.translate(text_of("text"), ENDS, ""))
    copies = F.when(F.col("mark") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    marked = rows.withColumn("mark", mark).filter("mark != 0")
    return marked.select(
        "conv_id", "turn", role.alias("role"), text.otherwise(text_of("text")).alias("text"), F.explode(copies).alias("copy")
    )


def _conversation(conv_id: Column) -> Column:
    """A key that is never null."""
    return F.coalesce(F.concat(F.lit("="), conv_id.cast("string")), F.lit(""))


def _faults(rows: DataFrame) -> DataFrame:
    """``(conv, position, initial, fault, same)`` for every row, by ranges of conversation and turn."""
    last = F.rtrim(F.col("text"), F.lit(BLANKS))
    cut_off = ~F.substring(last, -1, 1).isin(*ENDS)
    initial = F.substring("role", 1, 1)
    slim = rows.select(
        "conv", "turn", "role", "same", "copy", F.when(initial.isin("s", "u", "a"), initial).otherwise("-").alias("initial"),
        (last == "").alias("blank"), cut_off.alias("truncated"),
    )
    placed = global_index(slim, ["conv", "turn", "role", "same", "copy"])
    firsts = placed.filter("NOT blank").groupBy("conv", "same").agg(F.min("position").alias("position"))
    # Positions are unique, so a text that fills a conversation is no hot key here.
    seen = placed.join(firsts.select("position", F.lit(True).alias("first")), "position", "left")
    fault = (
        F.when(F.col("blank"), BLANK).when(F.col("first").isNull(), DUPLICATE).when(F.col("truncated"), TRUNCATED)
        .otherwise(NO_FAULT)
    )
    return cut(seen.select("conv", "turn", "position", "same", "initial", fault.cast("int").alias("fault")), "faults")


_SEGMENT = (
    "conv string, block bigint, first bigint, initials string, costs array<int>, places array<int>, "
    "audits array<string>, blank bigint, duplicate bigint, truncated bigint, illegal bigint"
)


def _segment_row(conv: str, block: int, first: int, rows: list[tuple[str, int]], size: int) -> dict:
    initials = "".join(initial for initial, _ in rows)
    row = {
        "conv": conv, "block": block, "first": first, "initials": initials, "costs": [None] * 16, "places": [None] * 16,
        "audits": [None] * 16, "illegal": sum(initials[i : i + 2] not in LEGAL for i in range(len(rows) - 1)),
    }
    for name, fault in (("blank", BLANK), ("duplicate", DUPLICATE), ("truncated", TRUNCATED)):
        row[name] = sum(own == fault for _, own in rows)
    # Only at a border of blocks can a conversation have begun before.
    for start in STATES if first % size == 0 else (NOTHING,):
        audits, heads = segment_audits(rows, start)
        ends = [end for end in STATES if heads[end] is not None]
        ends.sort(key=cmp_to_key(lambda a, b: audits.compare(heads[a][1], heads[b][1])))
        for place, end in enumerate(ends):
            at = 4 * start + end
            row["costs"][at], row["places"][at] = heads[end][0], place
            row["audits"][at] = audits.text(heads[end][1])
    return row


def _batches(rows: Iterator[dict], schema: pa.Schema, most: int) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= most:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _segments(faults: DataFrame) -> DataFrame:
    """One row per conversation and block of ``SEGMENT_ROWS`` positions, with the columns of ``_SEGMENT``."""
    size = SEGMENT_ROWS
    schema = pa.schema([
        ("conv", pa.string()), ("block", pa.int64()), ("first", pa.int64()), ("initials", pa.string()),
        ("costs", pa.list_(pa.int32())), ("places", pa.list_(pa.int32())), ("audits", pa.list_(pa.string())),
        *[(name, pa.int64()) for name in ("blank", "duplicate", "truncated", "illegal")],
    ])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def segments() -> Iterator[dict]:
            key, first, rows = None, 0, []
            for batch in batches:
                for conv, block, position, initial, fault in zip(*(column.to_pylist() for column in batch.columns)):
                    if (conv, block) != key:
                        if rows:
                            yield _segment_row(*key, first, rows, size)
                        key, first, rows = (conv, block), position, []
                    rows.append((initial, fault))
            if rows:
                yield _segment_row(*key, first, rows, size)

        yield from _batches(segments(), schema, 256)

    dealt = faults.select(
        "conv", F.floor(F.col("position") / size).alias("block"), "position", "initial", "fault"
    ).repartition("conv", "block").sortWithinPartitions("conv", "block", "position")
    return cut(dealt.mapInArrow(solve, _SEGMENT), "segments")


def _choices(segments: DataFrame) -> DataFrame:
    """``(conv, block, choice, ending, cost, border)`` for every segment; the cost stands in a conversation's last one."""
    schema = pa.schema([
        ("conv", pa.string()), ("block", pa.int64()), ("choice", pa.int32()), ("ending", pa.string()),
        ("cost", pa.int64()), ("border", pa.int64()),
    ])

    def finish(conv: str, own: list[tuple]) -> Iterator[dict]:
        cost, choices, ending = choose_path([(costs, places) for _, _, _, costs, places in own])
        for i, ((block, head, _, _, _), choice) in enumerate(zip(own, choices)):
            last = i == len(own) - 1
            border = int(i > 0 and own[i - 1][2] + head not in LEGAL)
            yield {
                "conv": conv, "block": block, "choice": choice, "ending": ending if last else "",
                "cost": cost if last else 0, "border": border,
            }

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            conv, own = None, []
            for batch in batches:
                for key, *rest in zip(*(column.to_pylist() for column in batch.columns)):
                    if key != conv:
                        if own:
                            yield from finish(conv, own)
                        conv, own = key, []
                    own.append(tuple(rest))
            if own:
                yield from finish(conv, own)

        yield from _batches(rows(), schema, 4096)

    light = segments.select(
        "conv", "block", F.substring("initials", 1, 1).alias("head"), F.substring("initials", -1, 1).alias("tail"),
        "costs", "places",
    ).repartition("conv").sortWithinPartitions("conv", "block")
    chosen = light.mapInArrow(choose, "conv string, block bigint, choice int, ending string, cost bigint, border bigint")
    return cut(chosen, "choices")


def apply_audit(audit: str, initials: str, state: int) -> Iterator[tuple[int, list[str], bool, str | None]]:
    """For each row ``(number, inserted roles before it, kept, new role)``, and after the last one those at the end."""
    inserted, number = [], 0
    for letter in audit:
        if letter == "I":
            state = AFTER[state]
            inserted.append(ROLES[state])
            continue
        role = None
        if letter == "K":
            state = SYSTEM if state == NOTHING and initials[number] == "s" else AFTER[state]
        elif letter == "R":
            state = AFTER[state]
            role = ROLES[state]
        yield number, inserted, letter != "D", role
        inserted, number = [], number + 1
    if inserted:
        yield number, inserted, False, None


def _acts(pieces: DataFrame) -> DataFrame:
    """``(conv, position, before, kept, role)`` for all rows that stay, and for insertions before others."""
    schema = pa.schema([
        ("conv", pa.string()), ("position", pa.int64()), ("before", pa.string()), ("kept", pa.bool_()), ("role", pa.string())
    ])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            for batch in batches:
                for conv, first, initials, piece, choice in zip(*(column.to_pylist() for column in batch.columns)):
                    for number, inserted, kept, role in apply_audit(piece, initials, choice // 4):
                        if kept or inserted:
                            before = "\n".join(f"{name}:" for name in inserted) if inserted else None
                            yield {"conv": conv, "position": first + number, "before": before, "kept": kept, "role": role}

        yield from _batches(rows(), schema, 4096)

    named = pieces.select("conv", "first", "initials", "piece", "choice")
    return named.mapInArrow(walk, "conv string, position bigint, before string, kept boolean, role string")


def _lines(rows: DataFrame, faults: DataFrame, pieces: DataFrame) -> DataFrame:
    """``(conv, position, line)``: what a row and the insertions before it add to the repaired conversation."""
    acts = cut(_acts(pieces), "acts")
    # What stays was never seen before in its conversation, so conversation and hash name one text.
    kept = acts.filter("kept").withColumnRenamed("role", "new_role").join(faults.select("position", "same"), "position")
    texts = rows.select("conv", "same", "role", "text").dropDuplicates(["conv", "same"])
    line = F.concat(F.coalesce("new_role", "role"), F.lit(":"), F.col("text"))
    whole = kept.join(texts, ["conv", "same"]).select(
        "conv", "position", F.concat_ws("\n", "before", line).alias("line")
    )
    return whole.unionByName(acts.filter("NOT kept").select("conv", "position", F.col("before").alias("line")))


def _hashes(lines: DataFrame) -> DataFrame:
    """``(conv, repaired_sha256)``: lines stream in order through a hash; none is held longer than its batch."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, own = None, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([conv]), pa.array([own.hexdigest()])], names=["conv", "repaired_sha256"])

        for batch in batches:
            for key, line in zip(batch.column(0).to_pylist(), batch.column(1)):
                if own is None or key != conv:
                    if own is not None:
                        yield done()
                    conv, own = key, hashlib.sha256()
                else:
                    own.update(b"\n")
                own.update(line.as_buffer())
        if own is not None:
            yield done()

    # Insertions after a conversation's last row have the position behind it, which is another one's first.
    ordered = lines.repartition("conv").sortWithinPartitions("conv", "position").select("conv", "line")
    return ordered.mapInArrow(digest, "conv string, repaired_sha256 string")


def _gaps(faults: DataFrame) -> DataFrame:
    wide = lambda name: F.col(name).cast("decimal(38,0)")
    spans = faults.groupBy("conv").agg(F.max("turn").alias("high"), F.min("turn").alias("low"), F.count_distinct("turn").alias("turns"))
    gaps = F.least(wide("high") - wide("low") + 1 - wide("turns"), F.lit((1 << 63) - 1).cast("decimal(38,0)"))
    return spans.select("conv", F.coalesce(gaps.cast("bigint"), F.lit(0)).alias("gaps"))


def repair(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    damage=damaged,
) -> DataFrame:
    """``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)`` per conversation.

    ``damage`` is applied to ``(conv_id, turn, role, text)`` first and adds ``copy``, which tells repeated rows apart.
    """
    spark = rows.sparkSession
    named = picked(rows, conv_id=conv_col, turn=turn_col, role=role_col, text=text_col)
    same = F.unhex(F.sha2(F.concat(F.sha2(F.col("role"), 256), F.col("text")), 256))
    with scratch(spark) as own:
        whole = damage(named).withColumn("same", same).withColumn("conv", _conversation(F.col("conv_id")))
        faults = _faults(whole)
        segments = _segments(faults)
        choices = _choices(segments)
        piece = F.concat(F.get("audits", F.col("choice")), F.col("ending"))
        pieces = cut(segments.join(choices, ["conv", "block"]).withColumn("piece", piece).drop("audits", "costs", "places"), "pieces")
        in_order = F.sort_array(F.collect_list(F.struct("block", "piece")))
        counts = pieces.groupBy("conv").agg(
            *[F.sum(name).alias(name) for name in ("blank", "duplicate", "truncated")],
            F.sum(F.col("illegal") + F.col("border")).alias("illegal"), F.sum("cost").alias("cost"),
            F.array_join(F.transform(in_order, lambda x: x["piece"]), "").alias("audit"),
        )
        hashes = _hashes(_lines(whole, faults, pieces))
        ids = named.select("conv_id").distinct().withColumn("conv", _conversation(F.col("conv_id")))
        joined = ids.join(counts, "conv", "left").join(_gaps(faults), "conv", "left").join(hashes, "conv", "left")
        numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
        result = joined.select(
            "conv_id", *[F.coalesce(name, F.lit(0)).cast("bigint").alias(name) for name in numbers],
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
        )
        return own.result(cut(result, "repaired"))
