import hashlib
import random

from cases import ROWS, documents, prose, tuples
from rankflow.llm import edited, queries, simhash


def test_rows_next_to_their_neighbours(spark):
    got = tuples(edited.fingerprints_with_edits(documents(spark)), "id", "n_chars", "edited_sha256", "own", "edited", "next")
    assert len(got) == len(ROWS)
    known = [r for r in ROWS if r[0] is not None]
    order = sorted(known, key=lambda r: -r[0]) + [r for r in ROWS if r[0] is None]
    want = []
    for row, after in zip(order, order[1:] + order[:1]):
        text, following = row[1] or "", after[1] or ""
        mixed = edited.edit(text, following)
        size = len(text) // 3
        assert mixed == text[: len(text) - size] + following[:size]
        prints = [simhash.as_signed(simhash.fingerprint(t)) for t in (text, mixed, following)]
        want.append((row[0], len(text), hashlib.sha256(mixed.encode()).hexdigest(), *prints))
    assert sorted(got, key=str) == sorted(want, key=str)


def test_empty_and_single(spark):
    empty = documents(spark).filter("false")
    assert edited.fingerprints_with_edits(empty).count() == 0
    one = documents(spark).filter("doc_id = 9")
    assert tuples(edited.fingerprints_with_edits(one), "id", "n_chars")[0] == (9, 3)


def test_fingerprint_estimates_likeness():
    text = " ".join(f"t{i}" for i in range(300))
    near, far = text.replace("t7 ", "u "), " ".join(f"s{i}" for i in range(300))
    likeness = lambda a, b: 1 - bin(simhash.fingerprint(a) ^ simhash.fingerprint(b)).count("1") / 64
    assert likeness(text, text.upper()) == 1
    assert likeness(text, near) > 0.85 > 0.7 > likeness(text, far)
    assert simhash.fingerprint(None) == simhash.fingerprint("") == simhash.fingerprint(" \n") == 0


def test_block_tables_find_all_within_the_radius(spark):
    own = random.Random(3)
    prints = [own.getrandbits(64) for _ in range(150)]
    for p in prints[:60]:
        flipped = p
        for bit in own.sample(range(64), own.randint(1, 5)):
            flipped ^= 1 << bit
        prints.append(flipped)
    rows = [(simhash.as_signed(p),) for p in prints] + [(None,), (simhash.as_signed(prints[0]),)]
    table = spark.createDataFrame(rows, "fingerprint bigint")
    for radius, agreeing in ((3, 2), (1, 1), (4, 3)):
        got = tuples(simhash.find_near(table, table, radius, agreeing), "query", "fingerprint", "distance")
        want = [
            (simhash.as_signed(a), simhash.as_signed(b), bin(a ^ b).count("1"))
            for a in prints for b in prints if 0 < bin(a ^ b).count("1") <= radius
        ]
        assert sorted(got) == sorted(set(want)) and len(got) == len(set(got))


def test_near_others_counts_documents_that_share_a_print(spark, fresh_dir):
    texts = [f"{prose(7, 300)} end{i}" for i in range(12)]
    rows = [(i, texts[i % 12] if i % 2 else texts[i % 12].upper(), "en", "a", None) for i in range(0, 260, 10)]
    rows += [(i, prose(i, 80), "en", "a", None) for i in (500, 501, 600)] + [(700, "", "en", "a", 0), (701, None, "en", "a", 0)]
    rows += [(None, texts[0], "en", "a", None), (100, texts[1], "en", "a", None)]
    documents(spark, rows).write.parquet(f"{fresh_dir}/documents.parquet")
    got = tuples(queries.op1_simhash(spark, fresh_dir), "doc_id", "near_others")
    prints = [simhash.fingerprint(text) for _, text, *_ in rows]
    want = [
        (row[0], sum(bin(p ^ q).count("1") <= simhash.RADIUS for q in prints) - 1 if row[0] is not None and row[0] % 100 == 0 else None)
        for row, p in zip(rows, prints)
    ]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert dict(got)[700] == 1 and dict(got)[200] > 2
