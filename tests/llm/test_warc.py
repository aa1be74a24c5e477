from __future__ import annotations

import base64
import gzip
import hashlib
import random

import pyarrow as pa
import pytest

from plumbline.llm.common import shared_folder
from plumbline.llm.warc import Members, parsed, read_warc, record, write_warc

SCHEMA = "page_id long, url string, html string"


def plain(rows, least=0):
    out = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        same = [r[0] for r in rows if (r[2] or "") == (html or "")]
        last = max((x for x in same if x is not None), default=None)
        revisit = len(payload) >= least and last is not None and page_id != last
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append(
            (page_id, len(payload), digest, "revisit" if revisit else "response", last if revisit else None)
        )
    return sorted(map(repr, out))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    same = "<p>same</p>" * 50
    out = [(i, f"http://a.example/{i}", f"<html>{rng.random()}" * rng.randint(1, 300)) for i in range(60)]
    out += [(100 + i, "http://b.example/ü \r\nX: y", same) for i in range(30)]
    out += [(200, None, None), (201, "", ""), (202, "u", "é" * 10), (None, "n", same), (None, "n", "alone")]
    out += [(129, "again", same), (300, "big", "z" * 3_000_000), (301, "no payload?", "\r\n\r\n")]
    return out


@pytest.mark.parametrize("split, least", [(1 << 23, 0), (700, 0), (4096, 11 * 50 + 1)])
def test_round_trip(spark, rows, split, least):
    pages = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS sha", "2 AS path", "3 AS bytes")
    archives = write_warc(pages, shared_folder(spark), least, archive_bytes=1500)
    assert archives.count() > 8
    found = read_warc(archives, split).collect()
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found]
    assert sorted(map(repr, got)) == plain(rows, least)
    texts = {r[0]: (r[2] or "").encode() for r in rows if r[0] is not None}
    for r in found:
        if r.page_id is not None and r.record_type == "response":
            assert r.payload == texts[r.page_id]
        elif r.record_type == "revisit":
            assert r.payload is None


def test_records_are_owned_by_the_range_they_start_in():
    members = [gzip.compress(record(i, "u", b"x" * i * 37, None, "d")) for i in range(40)]
    # magic bytes that start no record, whole members of another kind, and a broken end
    noise = b"\x1f\x8b\x08\x00" + gzip.compress(b"not a record") + b"junk"
    raw = noise + b"".join(members) + members[3][:-5]
    file = Members(pa.BufferReader(raw), len(raw))
    for size in (1, 7, 100, 5000, len(raw)):
        found = []
        for start in range(0, len(raw), size):
            found += [at for at, _ in file.within(start, start + size)]
        at, expected = len(noise), []
        for m in members:
            expected.append(at)
            at += len(m)
        assert found == expected


def test_header_cannot_be_broken_by_a_url():
    row = parsed(record(7, "http://x/\r\nX-Page-ID: 8\r\n\r\n", b"p", None, "d"))
    assert row["page_id"] == 7 and row["payload"] == b"p" and "\r" not in row["url"]


def test_empty_table(spark):
    archives = write_warc(spark.createDataFrame([], SCHEMA), shared_folder(spark))
    assert archives.count() == 0 and read_warc(archives).count() == 0


def test_broken_records_are_reported(spark, tmp_path):
    members = [gzip.compress(record(i, "u", random.Random(i).randbytes(900), None, "d")) for i in range(6)]
    raw = b"".join(members[:2]) + members[2][:400] + b"".join(members[3:]) + members[0][:-6]
    (tmp_path / "a.warc.gz").write_bytes(raw)
    places = [sum(map(len, members[:2])), len(raw) - len(members[0]) + 6]
    archives = spark.createDataFrame([(f"{tmp_path}/a.warc.gz", len(raw))], "path string, bytes long")
    for split in (300, 1 << 20):
        assert sorted(r.page_id for r in read_warc(archives, split).collect()) == [0, 1, 3, 4, 5]
        rows = read_warc(archives, split, broken_rows=True).collect()
        assert sorted(r.page_id for r in rows if r.record_type == "response") == [0, 1, 3, 4, 5]
        assert sorted(r.url for r in rows if r.record_type == "broken") == sorted(
            f"{tmp_path}/a.warc.gz#{at}" for at in places
        )


def test_two_attempts_of_a_task_do_not_meet(spark, rows):
    """The same pages written twice to one folder: each listing reads its own archives whole."""
    folder = shared_folder(spark)
    pages = spark.createDataFrame(rows, SCHEMA)
    first = write_warc(pages, folder, archive_bytes=1500)
    second = write_warc(pages.where("page_id < 40"), folder, archive_bytes=1500)
    paths = [r.path for f in (first, second) for r in f.collect()]
    assert len(set(paths)) == len(paths)
    assert read_warc(first).count() == len(rows) and read_warc(second).count() == 40
