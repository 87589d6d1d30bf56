import base64
import gzip
import hashlib
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from statquarry.llm import warc

PAGES = "page_id long, url string, html string, payload string, sha1 string, first long, n int"
ROWS = [
    (5, "http://a/5", "<p>same</p>"), (3, "http://a/3", "<p>same</p>"), (9, None, "<p>same</p>"), (1, "http://a/1", ""), (2, "x", None),
    (4, "bad\r\nWARC-Type: x", "é" * 1000), (None, "http://a/n", "<p>same</p>"), (None, "u", "alone"), (7, "r", "twice"), (7, "r", "twice"),
    (8, "big", "<p>%s</p>" % ("long text " * 300_000)), (10, "tail", "a\r\n\r\nb WARC/1.1\r\n\r\n"),
]


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def plain(rows, least=0):
    first = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= least:
            first[h or ""] = min(first.get(h or "", i), i)
    out = Counter()
    for i, _, h in rows:
        f = first.get(h or "")
        again = f is not None and f != i
        out[i, len((h or "").encode()), digest(h), "revisit" if again else "response", f if again else None] += 1
    return out


@pytest.fixture
def pages(spark):
    return spark.createDataFrame([(i, u, h, "p", "s", 1, 2) for i, u, h in ROWS], PAGES).repartition(3)


def test_round_trip(pages):
    for least in (0, 8):
        assert Counter(tuple(r) for r in warc.round_trip(pages, least).collect()) == plain(ROWS, least)


def test_payloads_come_back_whole_and_comparisons_are_pushed_down(spark, pages, tmp_path):
    path = str(tmp_path / "archive")
    warc.write_pages(pages, path, least_bytes=1 << 30)
    got = Counter((r.page_id, bytes(r.payload)) for r in warc.read_archive(spark, path).where("record_type = 'response'").collect())
    assert got == Counter((i, (h or "").encode()) for i, _, h in ROWS)
    some = warc.read_archive(spark, path).where(F.col("page_id").isin(3, 5))
    assert sorted(r.page_id for r in some.collect()) == [3, 5]
    uris = warc.read_archive(spark, path, payload="false").where("page_id IS NOT NULL AND page_id = 4").collect()
    assert [(r.target_uri, r.payload) for r in uris] == [("bad%0D%0AWARC-Type: x", None)]


def test_reader_takes_header_comparisons_over():
    from pyspark.sql.datasource import EqualTo, GreaterThan, In, IsNotNull

    reader = warc.WarcReader("x", True, True, 1)
    rest = list(reader.pushFilters([EqualTo(("record_type",), "revisit"), In(("page_id",), (1, 2)), GreaterThan(("page_id",), 1), IsNotNull(("date",)), IsNotNull(("payload",))]))
    assert rest == [GreaterThan(("page_id",), 1), IsNotNull(("payload",))] and len(reader.taken) == 3


def test_a_rejected_payload_is_not_decoded(tmp_path):
    """Its member is stepped over: bytes of it that would not inflate do no harm."""
    def rec(kind, block):
        return warc.record([("WARC-Type", kind), ("WARC-Record-ID", f"<{kind}>")], block)

    noise = hashlib.sha512(b"x").digest() * 4000
    broken = bytearray(warc.member(rec("response", os.urandom(300_000) + noise)))
    broken[200_000:200_100] = bytes(100)
    path = tmp_path / "a.warc.gz"
    path.write_bytes(bytes(broken) + warc.member(rec("revisit", b"after")))
    reader = warc.WarcReader(str(path), True, True, 1 << 20)
    reader.taken = [("record_type", "in", {"revisit"})]
    (part,) = reader.partitions()
    assert [r for b in reader.read(part) for r in b.column("record_type").to_pylist()] == ["revisit"]


def test_other_writers_archives(spark, tmp_path):
    body = warc.record([("WARC-Type", "response"), ("WARC-Record-ID", "<1>")], b"HTTP/1.1 200 OK\r\n\r\npayload") + warc.record(
        [("WARC-Type", "resource"), ("WARC-Record-ID", "<2>")], b"x" * 100_000
    ) + warc.record([("WARC-Type", "response"), ("WARC-Record-ID", "<3>")], b"plain block")
    for name, content in (("plain.warc", body), ("one.warc.gz", gzip.compress(body))):
        folder = tmp_path / name.split(".")[0]
        folder.mkdir()
        (folder / name).write_bytes(content)
        got = warc.read_archive(spark, str(folder)).select("record_id", "record_type", "payload").collect()
        assert [(r[0], r[1], bytes(r[2]) if r[2] is not None else None) for r in got] == [
            ("<1>", "response", b"payload"), ("<2>", "resource", None), ("<3>", "response", b"plain block")
        ]


def test_damage_is_reported(tmp_path):
    good = warc.record([("WARC-Type", "response"), ("WARC-Payload-Digest", "sha1:AAAA")], b"x")
    for content in (good, good[:-6], b"no record at all\r\n\r\n"):
        path = tmp_path / "bad.warc"
        path.write_bytes(content)
        reader = warc.WarcReader(str(path), True, True, 1)
        with pytest.raises(ValueError):
            list(reader.read(reader.partitions()[0]))


def test_empty_table(spark, pages):
    assert warc.round_trip(pages.limit(0)).collect() == []
