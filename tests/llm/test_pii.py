import random
import re
import time

from cases import ROWS, documents, tuples
from pyspark.sql import functions as F
from rankflow.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * 2 - 9 * (int(c) > 4) if i % 2 else int(c) for i, c in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def valid(kind, match):
    digits = re.sub(r"\D", "", match)
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def base_spans(text):
    return [
        (k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if valid(k, m[0])
    ]


def listed(rows):
    return [(i, [(pii.KINDS[s["kind"]], s["start"], s["end"]) for s in spans if s["base"]], spans) for i, spans in rows]


def test_base_spans_equal_python(spark):
    own = random.Random(1)
    alphabet = "ab9@..+-() 1234567890%😀ü\n"
    texts = ["".join(own.choice(alphabet) for _ in range(own.randrange(120))) for _ in range(400)]
    texts += ["a@b.com.x%y@z.org", "1.2.3.4.5.6.7.8", "001.2.3.0255", "x" * 5000 + "@y.z", "4111111111111111 " * 600]
    rows = [*ROWS, *[(1000 + i, t, None, None, None) for i, t in enumerate(texts)]]
    got = listed(tuples(pii.find_spans(documents(spark, rows)), "id", "spans"))
    assert sorted((str(i), s) for i, s, _ in got) == sorted((str(r[0]), base_spans(r[1])) for r in rows)
    for _, _, spans in got:
        base = [s for s in spans if s["base"]]
        assert not any(b["start"] < x["end"] and x["start"] < b["end"] for x in spans if not x["base"] for b in base)


def test_the_method_adds_spans_and_masks(spark):
    texts = [f"call +1 ({200 + i}) 555-{1000 + i}, card 4111111111111111, host 10.0.0.{i} and a{i}@b.org" for i in range(60)]
    joined = "call me at +1 (212) 555-0123 4111111111111111 now"
    docs = documents(spark, [*ROWS, *[(100 + i, t, None, None, None) for i, t in enumerate(texts)], (900, joined, None, None, None)])
    assert base_spans(joined) == []
    spans = dict(tuples(pii.find_spans(docs).filter("id = 900"), "id", "spans"))[900]
    assert [pii.KINDS[s["kind"]] for s in spans] == ["card", "phone"]
    masked = tuples(pii.mask_documents(docs), "doc_id", "text")
    assert len(masked) == len(ROWS) + 61
    by_id = dict(masked)
    assert by_id[900] == "call me at [PHONE] [CARD] now" and by_id[4] is None and by_id[5] == ""
    assert by_id[10] == ROWS[12][1] and "[EMAIL]" in by_id[15]


def test_empty_table(spark):
    empty = documents(spark).filter("false")
    assert pii.find_spans(empty).count() == 0 and pii.mask_documents(empty).count() == 0


def test_reliable_labelers_are_told_from_noise():
    own = random.Random(2)
    counts = {}
    for _ in range(4000):
        truth = own.random() < 0.4
        votes = tuple((1 if truth else -1) if own.random() < r else (-1 if truth else 1) for r in (0.95, 0.9, 0.9, 0.5, 0.8))
        counts[votes] = counts.get(votes, 0) + 1
    _, right, _ = pii.expectation_maximisation(list(counts.items()))
    assert right[0] > 0.9 and right[1] > 0.85 and abs(right[3] - 0.5) < 0.08


def test_a_kind_has_reliabilities_of_its_own():
    # A labeler that is right on one kind and always wrong on another.
    own, counts = random.Random(3), {}
    for _ in range(6000):
        kind, truth = own.randrange(2), own.random() < 0.5
        right = [0.95, 0.9, 0.95 if kind == 0 else 0.1, 0.9, 0.85]
        votes = tuple((1 if truth else -1) if own.random() < r else (-1 if truth else 1) for r in right)
        counts[kind, votes] = counts.get((kind, votes), 0) + 1
    likely, right = pii.kind_likelihoods([(kind, votes, n) for (kind, votes), n in counts.items()])
    assert right[0][2] > 0.9 and right[1][2] < 0.2 and right[1][0] > 0.9
    chance = {key: p for key, p in zip(counts, likely)}
    assert chance.get((1, (1, 1, -1, 1, 1)), 1) > 0.9 and chance.get((0, (-1, -1, -1, -1, -1)), 0) < 0.1


def test_scans_equal_running_totals(spark):
    own = random.Random(4)
    for size in (0, 1, 31, 32, 33, 1024, 1025, 5000):
        values = [own.randrange(1000) for _ in range(size)]
        row = spark.createDataFrame([(values,)], "v array<int>").select(
            pii.scan(F.col("v"), pii._sum).alias("sums"), pii.scan(F.col("v"), pii._most).alias("most")
        ).first()
        assert row["sums"] == [sum(values[:i]) for i in range(size)]
        assert row["most"] == [max(values[:i], default=-1) for i in range(size)]


def masked_by_hand(text, spans):
    out, at = [], 0
    for start, end, kind in sorted((s["start"], s["end"], s["kind"]) for s in spans):
        if start >= at:
            out += [text[at:start], f"[{pii.KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def test_very_many_spans_in_one_text(spark):
    own = random.Random(5)
    numbers = " ".join(f"+1 (223) 555-{own.randrange(10**4):04d} é{i}" for i in range(50_000))
    mixed = " ".join(own.choice(["a@b.org", "10.0.0.1", "415-555-0101", "4111 1111 1111 1111", "😀 words", "+4930123456"]) for _ in range(50_000))
    rows = [*ROWS, (700, numbers, None, None, None), (701, mixed, None, None, None)]
    docs = documents(spark, rows)
    started = time.monotonic()
    found = {i: spans for i, spans in tuples(pii.find_spans(docs), "id", "spans")}
    assert len(found[700]) >= 50_000 and len(found[701]) > 30_000
    masked = dict(tuples(pii.mask_documents(docs), "doc_id", "text"))
    assert time.monotonic() - started < 120
    for i, text, *_ in rows:
        if i in (10, 15, 700, 701):
            assert masked[i] == masked_by_hand(text, found[i])
    for i in (700, 701):
        base = [(pii.KINDS[s["kind"]], s["start"], s["end"]) for s in found[i] if s["base"]]
        assert base == base_spans(dict((r[0], r[1]) for r in rows)[i])


def test_no_python_on_the_main_path(spark):
    plan = documents(spark).select(pii.candidates(F.col("text")))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
