import hashlib
import itertools
import os
import random
import re
import zlib
from functools import lru_cache

import pytest
from cases import CLASHES
from pyspark.sql import functions as F
from rankflow.llm import repair
from rankflow.session import shared_dir

BLANK_CHARS = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def after_damage(rows):
    made = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        mark = zlib.crc32(key.encode()) % 20
        if mark == 0:
            continue
        text = "" if mark == 1 else re.sub("[.!?]", "", text) if mark == 2 else text
        made += [(conv, turn, "user" if mark == 4 else role, text)] * (2 if mark == 3 else 1)
    return made


def cheapest(rows):
    """``(cost, audit)`` by trying all edits from the back, for ``(initial, fault)`` rows."""

    @lru_cache(None)
    def best(i, state, inserts):
        options = [(0, "")] if i == len(rows) and state in "0a" else []
        follow = {"0": "u", "s": "u", "a": "u", "u": "a"}[state]
        if inserts < 3:
            options.append(plus(2, "I", best(i, follow, inserts + 1)))
        if i < len(rows):
            initial, fault = rows[i]
            options.append(plus(3, "D", best(i + 1, state, 0)))
            if fault not in ("blank", "duplicate"):
                more = int(fault == "truncated")
                if initial == follow or (initial == "s" and state == "0"):
                    options.append(plus(more, "K", best(i + 1, initial, 0)))
                options.append(plus(2 + more, "R", best(i + 1, follow, 0)))
        return min((x for x in options if x), default=None)

    def plus(cost, letter, rest):
        return rest and (cost + rest[0], letter + rest[1])

    return best(0, "0", 0)


def classified(own):
    seen, faults = set(), []
    for _, _, role, text in own:
        bare = text.strip(BLANK_CHARS)
        faults.append(
            "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        )
        seen.add((role, text))
    return faults


def brute(rows):
    order = lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(
        hashlib.sha256(r[2].encode()).hexdigest().encode() + r[3].encode()).digest())
    answers, damaged = [], after_damage(rows)
    for conv in {row[0] for row in rows}:
        own = sorted((row for row in damaged if row[0] == conv), key=order)
        turns = [row[1] for row in own if row[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        faults = classified(own)
        heads = [row[2][:1] for row in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(heads, heads[1:]))
        cost, audit = cheapest(tuple(zip(heads, faults))) if own else (0, "")
        lines, at = [], 0
        for letter in audit:
            expected = "user" if not lines or lines[-1][0] in "sa" else "assistant"
            if letter == "I":
                lines.append(f"{expected}:")
                continue
            if letter != "D":
                lines.append(f"{own[at][2] if letter == 'K' else expected}:{own[at][3]}")
            at += 1
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        counts = [faults.count(name) for name in ("blank", "duplicate", "truncated")]
        answers.append((conv, min(gaps, 2**63 - 1), *counts, illegal, cost, audit, digest))
    return sorted(answers, key=str)


def found(spark, rows):
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    table = table.select("*", *[F.lit("clash").alias(name) for name in (*CLASHES, "conv", "position", "copy", "same")])
    return sorted(map(tuple, repair.repair(table).collect()), key=str)


def conversations(seed, count, longest=14):
    rng, rows = random.Random(seed), []
    roles = ["user", "assistant", "system", "tool", "", None, "superuser", "ua"]
    texts = ["Yes.", "No!", "cut off", " ", "", None, "Why?  ", "a\nb.", "é…", "Ok."]
    for conv in range(count):
        turn = 0
        for _ in range(rng.randrange(longest)):
            turn += rng.choice([0, 1, 1, 1, 1, 3])
            role = rng.choice(roles[:2]) if rng.random() < 0.6 else rng.choice(roles)
            text = rng.choice(texts) if rng.random() < 0.4 else f"text {rng.random()}."
            rows.append((conv, None if rng.random() < 0.03 else turn, role, text))
    return rows


def test_random_conversations(spark):
    rows = conversations(0, 120)
    rows += [(None, 1, "user", "x."), (None, None, "assistant", "y."), (900, 2**63 - 1, "user", "far."), (900, -(2**63), "user", "off.")]
    rows += [(901, i, None, None) for i in range(6)]
    want = brute(rows)
    assert found(spark, rows) == want
    assert sum(row[6] > 0 for row in want) > 60


def test_long_conversation_over_many_segments(spark, monkeypatch):
    monkeypatch.setattr(repair, "SEGMENT_ROWS", 16)
    rng = random.Random(3)
    rows = [(5, i, rng.choice(["user", "assistant", "tool", "system"]), rng.choice(["same.", "cut", f"t {i}."])) for i in range(200)]
    # Nothing but ties: every row needs another role, and both alignments cost the same.
    rows += [(6, i, "tool", f"line {i}.") for i in range(90)]
    rows += conversations(4, 30)
    assert found(spark, rows) == brute(rows)


def test_very_long_text_and_empty_table(spark):
    rows = [(1, 0, "user", "word " * 400_000 + "end."), (1, 1, "assistant", " " * 300_000), (1, 2, "assistant", "x" * 200_000)]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []


@pytest.mark.parametrize("modulus", [(1 << 61) - 1, 5, 1])
def test_audits_compare_like_strings(monkeypatch, modulus):
    # A small modulus makes hashes collide, which only letters can tell.
    monkeypatch.setattr(repair, "HASH_MODULUS", modulus)
    rng = random.Random(1)
    audits, texts = repair.Audits(), [""]
    for _ in range(300):
        parent = rng.randrange(max(0, len(texts) - 40), len(texts))
        letter = rng.choice("DI")
        node = audits.add(parent, letter)
        texts.append(texts[parent] + letter)
        assert audits.text(node) == texts[node]
    for a, b in itertools.product(rng.sample(range(301), 60), repeat=2):
        sign = audits.compare(a, b)
        assert (sign > 0) - (sign < 0) == (texts[a] > texts[b]) - (texts[a] < texts[b])


def test_comparing_long_audits_takes_few_steps(monkeypatch):
    audits, a, b = repair.Audits(), 0, 0
    a, b = audits.add(a, "D"), audits.add(b, "I")
    for _ in range(20_000):
        a, b = audits.add(a, "K"), audits.add(b, "K")
    steps = []
    real = repair.Audits._same
    monkeypatch.setattr(repair.Audits, "_same", lambda self, x, y: steps.append((x, y)) or real(self, x, y))
    assert audits.compare(a, b) < 0 and steps == [(0, 0)]


def test_only_the_result_stays_on_disk(spark):
    folder = shared_dir(spark).removeprefix("file://")
    before = set(os.listdir(folder))
    found(spark, conversations(7, 5))
    assert len([x for x in set(os.listdir(folder)) - before if x.startswith("rankflow-")]) == 1
