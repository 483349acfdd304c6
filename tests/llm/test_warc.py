import random
from collections import Counter

import pytest

from chainsift.llm import warc

from .brute import sha

SCHEMA = "page_id long, url string, html string, block long"


def expected(rows):
    first = {}
    for i, _, html in rows:
        html = html or ""
        if len(html.encode()) >= 100 and i is not None:
            first[html] = min(first.get(html, i), i)
    out = Counter()
    for i, _, html in rows:
        html = html or ""
        seen = first.get(html) if len(html.encode()) >= 100 else i
        other = seen is not None and seen != i
        out[i, len(html.encode()), sha(html), "revisit" if other else "response", seen if other else None] += 1
    return out


def read(df):
    return Counter((r.page_id, r.length if r.kind == "response" else r.payload_bytes, r.digest if r.kind == "response" else r.declared_digest, r.kind, r.refers_to)
                   for r in df.collect())


def pages():
    rng = random.Random(2)
    record = "WARC/1.0\r\nWARC-Type: response\r\nX-Page-Id: 999\r\nContent-Length: {}\r\n\r\n{}\r\n\r\n"
    rows = []
    for i in range(120):
        inner = "".join(rng.choice(["x" * 50, "é", "\r\n\r\n", "WARC/1.0\r\n", "WARC/1.0", record.format(5, "hello"), record.format(10**6, "far"), record.format(900, "mid"), "\n"])
                        for _ in range(rng.randint(0, 9)))
        rows.append((i, f"http://a/{i}\nx", inner))
    return rows + [(500, None, "y" * 100), (300, "u", "y" * 100), (300, "u", "y" * 100), (None, "u", "y" * 100), (None, None, None), (7, "u", ""), (8, "u", "z" * 99), (9, "u", "z" * 99),
                   (1000, "u", "long " * 60_000 + "WARC/1.0\r\n" + "tail " * 20_000)]


@pytest.mark.parametrize("split", ["128m", "1k", "37"])
def test_round_trip_with_version_lines_inside_payloads(spark, split):
    rows = pages()
    if split == "37":
        rows = rows[:25]
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA).repartition(3)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = warc.archived(df)
        assert read(got) == expected(rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_archive_bytes(spark, tmp_path):
    warc.write_archives(spark.createDataFrame([(1, "http://x", "héllo")], "page_id long, url string, html string").coalesce(1), f"{tmp_path}/w")
    raw = b"".join(p.read_bytes() for p in (tmp_path / "w").glob("part-*"))
    head, _, rest = raw.partition(b"\r\n\r\n")
    assert head.startswith(b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: http://x\r\n") and rest == "héllo\r\n\r\n".encode()


def test_empty_and_foreign(spark, tmp_path):
    assert warc.archived(spark.createDataFrame([], SCHEMA)).count() == 0
    (tmp_path / "odd").write_bytes(b"no archive WARC/1.0\r\nContent-Length: 0\r\n\r\n\r\n\r\n")
    assert warc.read_archives(spark, str(tmp_path)).count() == 0


def test_table(spark, sf_small):
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{sf_small}/pages.parquet").collect()]
    assert Counter(map(tuple, warc.op8_warc(spark, sf_small).collect())) == expected(rows)


@pytest.mark.parametrize("split", ["128m", "1k"])
def test_long_headers(spark, split):
    rows = [(k, "data:" + "a/b%20" * 35_000 if k in (0, 3) else f"http://a/{k}", f"page {k} " * 20) for k in range(6)]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = warc.archived(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1))
        assert read(got) == expected(rows)
        assert {(r.page_id, r.uri) for r in got.collect()} == {r[:2] for r in rows}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def foreign(version, fields, body, fold=False):
    lines = [f"WARC/{version}", *fields, f"Content-Length:{' ' if not fold else chr(13) + chr(10) + chr(9)}{len(body)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


@pytest.mark.parametrize("split", ["128m", "64"])
@pytest.mark.parametrize("version", ["1.0", "1.1"])
def test_foreign_archives(spark, tmp_path, version, split):
    bodies = [b"software: x\r\nformat: WARC File Format 1.1\r\n", b"", b"HTTP/1.1 200 OK\r\n\r\n<p>\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n", b"\r\n", b"end\r\nWARC/"]
    raw = b"".join(foreign(version, ["WARC-Type: response", "WARC-Record-ID: <urn:uuid:%d>" % k, "WARC-Target-URI: http://a/WARC/1.0/\r\n  more"], b, k == 2) for k, b in enumerate(bodies))
    (tmp_path / "one").write_bytes(raw)
    (tmp_path / "two").write_bytes(raw)
    (tmp_path / "odd").write_bytes(b"no archive")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = warc.read_archives(spark, str(tmp_path)).orderBy("file", "offset").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [(r.record_id, r.length, r.digest, r.uri) for r in got] == 2 * [(f"<urn:uuid:{k}>", len(b), sha(b.decode()), "http://a/WARC/1.0/ more") for k, b in enumerate(bodies)]


@pytest.mark.parametrize("tail", [b"WARC/1.0\r\nno header\r\n\r\n", b"junk", foreign("1.0", [], b"abc")[:-6], b"WARC/1.0\r\nContent-Length: 99\r\n\r\n"])
def test_broken_archives_are_errors(spark, tmp_path, tail):
    good = foreign("1.0", ["WARC-Type: response"], b"abc")
    (tmp_path / "torn").write_bytes(good + good + tail)
    (tmp_path / "whole").write_bytes(good)
    with pytest.raises(warc.BrokenArchive, match="torn"):
        warc.read_archives(spark, str(tmp_path))
    assert [(r.reached, r.size) for r in warc.broken_archives(spark, str(tmp_path)).collect()] == [(2 * len(good), 2 * len(good) + len(tail))]
    assert warc.read_archives(spark, str(tmp_path), on_broken="keep").count() == 3
    (tmp_path / "torn").write_bytes(tail if tail.startswith(b"WARC") else b"WARC/x" + tail)
    with pytest.raises(warc.BrokenArchive, match="torn"):
        warc.read_archives(spark, str(tmp_path))


def test_mandatory_fields(spark, tmp_path):
    rows = [(1, "http://x/a b\n", "h" * 200), (2, None, "h" * 200)]
    warc.records(spark.createDataFrame(rows, "page_id long, url string, html string"), date="2024-01-31T00:00:00Z").coalesce(1).write.option("lineSep", warc.END).text(f"{tmp_path}/w")
    a, b = sorted(warc.read_archives(spark, f"{tmp_path}/w").collect(), key=lambda r: r.page_id)
    assert a.uri == "http://x/a%20b%0A" and a.kind == "response" and (b.kind, b.refers_to, b.refers_to_record, b.uri) == ("revisit", 1, a.record_id, None)
    raw = b"".join(p.read_bytes() for p in (tmp_path / "w").glob("part-*"))
    assert raw.count(b"WARC-Record-ID: <urn:uuid:") == 2 == raw.count(b"WARC-Date: 2024-01-31T00:00:00Z\r\n") and a.record_id != b.record_id
