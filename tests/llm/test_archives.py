"""WARC archives and URL rules."""

import base64
import gzip
import hashlib
import io

import pytest
from cases import CLASHES, tuples
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from rankflow.llm import urls, warc

PAGES = [
    (1, "http://a.org/x", "<p>one</p>"), (2, "http://b.org/", "<p>one</p>"), (3, None, None), (4, "u\r\nX: y", ""),
    (5, "http://c.org", "ü" * 300_000), (2, "http://b.org/", "<p>one</p>"), (None, "http://n.org", "<p>one</p>"),
    (1, "http://a.org/again", "<p>one</p>"), (None, None, "alone\r\n\r\nWARC/1.1"),
]


def pages(spark, rows=PAGES):
    made = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    return made.select("*", *[F.lit("clash").alias(name) for name in CLASHES])


def expected(rows):
    least = {}
    for i, _, html in rows:
        if i is not None:
            least[html or ""] = min(least.get(html or "", i), i)
    made = []
    for i, _, html in rows:
        data = (html or "").encode()
        copies = [r for r in rows if (r[2] or "") == (html or "")]
        first = least.get(html or "")
        revisit = len(copies) > 1 and first is not None and i != first
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        made.append((i, len(data), digest, "revisit" if revisit else "response", first if revisit else None))
    return made


def test_round_trip(spark, fresh_dir):
    warc.write_archives(warc.page_records(pages(spark)), fresh_dir)
    read = warc.read_archives(spark, fresh_dir)
    page, target = warc.page_of(F.col("record_id")), warc.page_of(F.col("refers_to"))
    got = tuples(read.select(page.alias("page"), "payload_length", "payload_digest", "record_type", target.alias("of")),
                 "page", "payload_length", "payload_digest", "record_type", "of")
    assert sorted(map(str, got)) == sorted(map(str, expected(PAGES)))
    payloads = tuples(read.filter("record_type = 'response'"), "payload_digest", "payload")
    assert all(warc.payload_digest(bytes(body)) == digest for digest, body in payloads)
    bare = warc.read_archives(spark, fresh_dir, payload=False)
    assert {row[0] for row in tuples(bare, "payload")} == {None} and bare.count() == len(PAGES)


def test_empty_archive(spark, fresh_dir):
    warc.write_archives(warc.page_records(pages(spark).filter("false")), fresh_dir)
    assert warc.read_archives(spark, fresh_dir).count() == 0


def test_predicates_reach_the_reader(spark, fresh_dir):
    warc.write_archives(warc.page_records(pages(spark)), fresh_dir)
    setting = "spark.sql.python.filterPushdown.enabled"
    before = spark.conf.get(setting)
    with warc.pushdown(spark):
        some = warc.read_archives(spark, fresh_dir).filter("record_type = 'revisit' AND target_uri LIKE 'http://b%'")
        assert some.count() == 2
        plan = some._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan.split("BatchScan")[0] and spark.conf.get(setting) == before
    again = warc.read_archives(spark, fresh_dir).filter("record_type = 'revisit' AND target_uri LIKE 'http://b%'")
    assert again.count() == 2


def test_the_round_trip_decodes_what_it_wrote(spark, monkeypatch):
    page, target = warc.page_of(F.col("record_id")), warc.page_of(F.col("refers_to"))
    columns = (page.alias("page"), "payload_length", "payload_digest", "record_type", target.alias("of"))

    def found():
        read = warc.round_trip(pages(spark)).select(*columns)
        return sorted(map(str, tuples(read, "page", "payload_length", "payload_digest", "record_type", "of")))

    assert found() == sorted(map(str, expected(PAGES)))
    # Digests in the headers are not what comes out: with wrong ones the responses' are right, and revisits find none.
    real = warc.page_records
    monkeypatch.setattr(warc, "page_records", lambda *a, **k: real(*a, **k).withColumn("payload_digest", F.lit("WRONG")))
    wrong = {row for row in found() if "response" in row}
    assert wrong == {str(row) for row in expected(PAGES) if row[3] == "response"}


def test_unwanted_payloads_are_not_inflated():
    row = dict(record_id="<urn:page:1>", record_type="response", target_uri="u", date="d", payload_digest="x",
               refers_to=None, payload_length=5_000_000, payload=bytes(range(256)) * 19532)
    packed = warc.gzip_member(warc.encode_record(row))
    small = warc.gzip_member(warc.encode_record({**row, "record_type": "request", "payload": b"hi", "payload_length": 2}))

    class Counting(io.BytesIO):
        taken = 0

        def read(self, size=-1):
            data = super().read(size)
            Counting.taken += len(data)
            return data

    stream = Counting(packed + small)
    kept = list(warc.read_records(stream, lambda r: r["record_type"] == "request"))
    assert [r[-1] for r in kept] == [b"hi"]
    assert Counting.taken < len(packed) / 2 or len(packed) < 4 * warc.CHUNK


def some_records(count=4):
    rows = [dict(record_id=f"<urn:page:{i}>", record_type="response", target_uri="u", date="d", payload_digest="x",
                 refers_to=None, payload_length=3000 * i, payload=bytes(range(250)) * 12 * i) for i in range(1, count + 1)]
    return [warc.encode_record(row) for row in rows]


DAMAGE = {
    "junk member": lambda parts: [*parts[:2], gzip.compress(b"junk junk junk"), *parts[2:]],
    "a line break": lambda parts: [*parts[:2], b"\r\n", *parts[2:]],
    "cut file": lambda parts: [*parts[:3], parts[3][:-5]],
    "cut in the headers": lambda parts: [*parts[:3], parts[3][:20]],
    "changed byte": lambda parts: [*parts[:2], parts[2][:200] + bytes([parts[2][200] ^ 1]) + parts[2][201:], parts[3]],
    "lost checksum": lambda parts: [*parts[:3], parts[3][:-8]],
}


@pytest.mark.parametrize("kind", DAMAGE)
@pytest.mark.parametrize("pack", [warc.gzip_member, gzip.compress])
def test_damage_is_an_error(kind, pack):
    whole = [pack(record) for record in some_records()]
    data = b"".join(DAMAGE[kind](whole))
    with pytest.raises(warc.DamagedArchive):
        list(warc.read_records(io.BytesIO(data)))
    if kind in ("junk member", "a line break", "cut file", "cut in the headers"):
        # Records that are passed over do not hide it.
        with pytest.raises(warc.DamagedArchive):
            list(warc.read_records(io.BytesIO(data), lambda row: False))
    assert len(list(warc.read_records(io.BytesIO(b"".join(whole) + b"\r\n\r\n")))) == 4


def test_damage_in_plain_records_is_an_error(spark, fresh_dir):
    records = some_records()
    for data in (b"".join(records)[:-400], records[0] + b"junk\r\n" + records[1], records[0].replace(b"Content-Length: 3", b"Content-Length: 9")):
        with pytest.raises(warc.DamagedArchive):
            list(warc.read_records(io.BytesIO(data)))
    with open(f"{fresh_dir}/bad.warc", "wb") as file:
        file.write(b"".join(records)[:-400])
    with pytest.raises(PySparkException, match="bad.warc"):
        warc.read_archives(spark, fresh_dir).collect()


@pytest.mark.parametrize("packed", [False, True])
def test_foreign_archives(packed):
    """Uncompressed records, and gzip members without a stated length."""
    rows = [dict(record_id=f"<urn:page:{i}>", record_type="response", target_uri="u", date="d", payload_digest="x",
                 refers_to=None, payload_length=3 * i, payload=b"abc" * i) for i in (1, 50_000, 2)]
    records = [warc.encode_record(row) for row in rows]
    data = b"".join(gzip.compress(r) for r in records) if packed else b"".join(records)
    assert [r[-1] for r in warc.read_records(io.BytesIO(data))] == [row["payload"] for row in rows]
    skipped = warc.read_records(io.BytesIO(data), lambda r: r["record_id"] == "<urn:page:2>")
    assert [r[0] for r in skipped] == ["<urn:page:2>"]


URLS = [
    None, "", "no scheme", "http://ORG", "http://x.Org/", "http://example.org/es/1?q", "http://m.example.org/es",
    "https://a.example.org/en/17#z", "http://notexample.org/es/", "http://b.com/fr/x", "http://b.com/de/x",
    "http://b.com/it", "http://b.com?x=://y/z", "ftp://c.net/*/a(b", "http://b.com/fr/x", "http://d.net/a/9/end\nmore",
]
RULES = [
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"),
    ("block", "com/de/"), ("block", "net/a/*/end"), ("allow", "org/"), ("block", None), ("block", "/nohost"),
    ("allow", "b.com/it"), ("block", "b.com/it"), ("block", "*/a(b"),
]


def judged(url):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, rest = rest[:cut], rest[cut:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
        host = host.translate({i: i + 32 for i in range(65, 91)})
    fits = []
    for verdict, rule in RULES:
        own, slash, tail = (rule or "").partition("/")
        if not own or not host:
            continue
        near = own == "*" or host == own or host.endswith("." + own)
        parts = (slash + tail).split("*")
        at, good = 0, path.startswith(parts[0])
        for part in parts:
            at = path.find(part, at)
            good = good and at >= 0
            at += len(part)
        if near and good:
            fits.append((-len(rule), verdict != "block", rule, verdict))
    best = min(fits) if fits else (0, 0, None, "allow")
    return host, path, best[2], best[3]


def test_rules(spark):
    table = spark.createDataFrame([(i, url) for i, url in enumerate([*URLS, *URLS])], "page_id bigint, url string")
    table = table.select("*", *[F.lit("clash").alias(name) for name in [*CLASHES, "host", "path", "rule"]])
    rules = spark.createDataFrame(RULES, "verdict string, rule string")
    got = sorted(tuples(urls.judge_urls(table, rules), "id", "host", "path", "rule", "verdict"))
    assert got == [(i, *judged(url)) for i, url in enumerate([*URLS, *URLS])]
    assert urls.judge_urls(table.filter("false"), rules).count() == 0
    assert {r[0] for r in tuples(urls.judge_urls(table, rules.filter("false")), "verdict")} == {"allow"}


def test_rules_are_filed_under_their_rarest_token(spark):
    rules = urls.compile_rules(spark.createDataFrame([("block", "common.org/rare/")], "verdict string, rule string"))
    tokens = spark.createDataFrame([("h:common",), ("h:common",), ("h:org",), ("h:org",), ("h:org",), ("p:rare",)], "token string")
    assert tuples(urls.index_rules(rules, tokens), "token") == [("p:rare",)]
