import math
import os
import random
import re
from collections import Counter

import pytest
from cases import CLASHES, ROWS, documents, prose, tuples
from pyspark.sql import functions as F
from rankflow.llm import lexical
from rankflow.session import shared_dir

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=50):
    counted = [(i, Counter(terms(text))) for i, text in docs]
    counted = [(i, own, sum(own.values())) for i, own in counted if own]
    n_docs, words = len(counted), sum(n for *_, n in counted)
    df = Counter(term for _, own, _ in counted for term in own)
    asked = {}
    for i, text in items:
        asked.setdefault(i, set()).update(terms(text))
    answers = []
    for item, own in asked.items():
        weights = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in own if t in df}
        scored = []
        for i, counts, n in counted:
            m = 50 + (50 * n * n_docs) // words
            score = sum(w * ((10**9 * counts[t]) // (1000 * counts[t] + 20 * m)) for t, w in weights.items() if counts[t])
            if score > 0:
                scored.append((-score, i is None, i))
        scored.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        answers += [(item, place + 1, i, -minus) for place, (minus, _, i) in enumerate(scored[:k])]
    return answers


def as_table(spark, rows, names):
    made = spark.createDataFrame(rows, f"{names[0]} bigint, {names[1]} string").repartition(3)
    return made.select("*", *[F.lit("clash").alias(name) for name in (*CLASHES, "doc", "slice", "block", "term") if name != "id"])


def found(spark, docs, items, k=50):
    got = lexical.search(docs, as_table(spark, items, ("item_id", "text")), k)
    return sorted(tuples(got, "item_id", "rank", "doc_id", "score"), key=str)


def small(monkeypatch):
    monkeypatch.setattr(lexical, "SLICE_DOCS", 7)
    monkeypatch.setattr(lexical, "BLOCK_ITEMS", 3)
    monkeypatch.setattr(lexical, "PIECE_BYTES", 40)


ITEMS = [(1, "tok1 TOK2, tok3!"), (2, None), (3, ""), (4, "no such terms here zzz"), (5, "word7x7 y z x"), (5, "ünïcödé"),
         (None, "five words 4111"), (6, "tok1 tok1 tok1"), (7, "😀 ▁"), (8, "...")]


def test_awkward_rows(spark, monkeypatch):
    small(monkeypatch)
    want = brute([(row[0], row[1]) for row in ROWS], ITEMS)
    assert found(spark, documents(spark), ITEMS) == sorted(want, key=str) and want


@pytest.mark.parametrize("k", [3, 50])
def test_many_slices_with_pruning(spark, monkeypatch, k):
    small(monkeypatch)
    rng = random.Random(0)
    docs = [(i, prose(i, rng.randrange(1, 60), 80)) for i in range(400)]
    # Copies tie by the hundred, in a word that nearly all documents share.
    docs += [(1000 + i, "w1 w2 w3 common") for i in range(150)] + [(2000 + i, f"common u{i}") for i in range(200)]
    items = [(i, prose(5000 + i, 12, 100) + " common") for i in range(20)]
    got = found(spark, as_table(spark, docs, ("doc_id", "text")), items, k)
    assert got == sorted(brute(docs, items, k), key=str)


def test_bundles_leave_out_what_cannot_win(spark, monkeypatch):
    small(monkeypatch)
    sizes = []
    real = lexical._pass_stage
    monkeypatch.setattr(lexical, "_pass_stage", lambda *a: sizes.append(real(*a)) or sizes[-1])
    kept = []
    real_floors = lexical._floors
    monkeypatch.setattr(
        lexical, "_floors", lambda b, k: kept.append(b.agg(F.sum(F.size("items"))).first()[0]) or real_floors(b, k)
    )
    docs = [(i, "rare strong words" if i < 9 else f"common filler f{i}") for i in range(400)]
    items = [(0, "rare strong words common filler")]
    got = found(spark, as_table(spark, docs, ("doc_id", "text")), items, 5)
    assert got == sorted(brute(docs, items, 5), key=str)
    # Documents with nothing but the two common words never get an accumulator that stays.
    assert max(kept) < 20


def test_empty_tables_and_what_stays(spark):
    none = as_table(spark, [], ("doc_id", "text"))
    assert found(spark, none, ITEMS) == []
    assert found(spark, documents(spark), []) == []
    folder = shared_dir(spark).removeprefix("file://")
    before = set(os.listdir(folder))
    lexical.search(documents(spark), as_table(spark, ITEMS, ("item_id", "text")))
    assert len([x for x in set(os.listdir(folder)) - before if x.startswith("rankflow-")]) == 1


def test_terms_of_long_texts_do_not_depend_on_pieces(monkeypatch):
    text = ("Ab1-c\tdé x " * 50).encode()
    want = Counter(t.encode() for t in terms(text.decode()))
    assert lexical.count_terms(text) == want
    monkeypatch.setattr(lexical, "PIECE_BYTES", 5)
    assert lexical.count_terms(text) == want and lexical.count_terms(b"") == Counter()
