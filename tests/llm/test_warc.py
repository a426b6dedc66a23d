import base64
import gzip
import hashlib
import random
import re

import pytest

from arriero.llm import warc
from tests.llm.helpers import tuples

PAGES = "page_id long, url string, html string, record_type string, payload_bytes long"


def b32(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def rows_of(n=60):
    rng = random.Random(1)
    bodies = ["", "<p>é\U0001F600</p>", "same" * 100] + ["".join(chr(rng.randint(32, 600)) for _ in range(rng.randint(0, 3000))) for _ in range(20)]
    rows = [(i, f"http://h/{i}", rng.choice(bodies)) for i in range(n)]
    return rows + [(900, None, None), (901, "http://x/\r\nInjected: 1", "unique"), (902, "u", "WARC/1.1\r\n\r\n"), (903, "u", None)]


def pages(spark, rows):
    return spark.createDataFrame([(*r, "clash", -1) for r in rows], PAGES)


def want(rows):
    last = {}
    for i, _, t in rows:
        last[t or ""] = max(i, last.get(t or "", i))
    return sorted([(i, len((t or "").encode()), b32((t or "").encode()), "response" if last[t or ""] == i else "revisit", None if last[t or ""] == i else last[t or ""]) for i, _, t in rows], key=str)


@pytest.mark.parametrize("split", ["128m", "700"])
def test_round_trip_in_any_byte_ranges(spark, tmp_path, split):
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rows = rows_of()
        assert tuples(warc.archived(pages(spark, rows).coalesce(2), str(tmp_path / "w"))) == want(rows)
        records = warc.read_records(spark, str(tmp_path / "w"))
        assert records.where("not valid").count() == 0
        texts = {r.page_id: bytes(r.payload).decode() for r in records.where("record_type = 'response'").collect()}
        assert all(texts[i] == (t or "") for i, _, t in rows if i in texts)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_archives_are_plain_gzip_of_records(spark, tmp_path):
    warc.write_pages(pages(spark, rows_of(20)), str(tmp_path / "w"))
    text = b"".join(gzip.decompress(p.read_bytes()) for p in sorted((tmp_path / "w").glob("part-*")))
    assert len(re.findall(rb"WARC/1\.1\r\nWARC-Type: ", text)) == 24


@pytest.mark.parametrize("split", ["128m", "60", "9"])
def test_a_chance_magic_does_not_cut_a_record(spark, tmp_path, split):
    """Stored (uncompressed) members whose payloads hold the magic, in ranges that end anywhere."""
    import struct
    import zlib

    def stored(page, payload):
        data = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{page}>\r\nWARC-Payload-Digest: sha1:{b32(payload)}\r\nContent-Length: {len(payload)}\r\n\r\n".encode() + payload + b"\r\n\r\n"
        return warc.MAGIC + b"\0" * 6 + b"\xff" + b"\x01" + struct.pack("<HH", len(data), len(data) ^ 0xFFFF) + data + struct.pack("<II", zlib.crc32(data), len(data))

    payloads = [b"a" + warc.MAGIC + b"b" * 50 + warc.MAGIC * 3, b"", warc.MAGIC, b"x" * 200 + warc.MAGIC + warc.MAGIC[:2], b"end"]
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "a.warc").write_bytes(b"".join(stored(i, p) for i, p in enumerate(payloads)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = {r.page_id: (bytes(r.payload), r.valid) for r in warc.read_records(spark, str(tmp_path / "w")).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == {i: (p, True) for i, p in enumerate(payloads)}


def test_small_payloads_may_stay_responses(spark, tmp_path):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")]
    assert [r[3] for r in tuples(warc.archived(pages(spark, rows), str(tmp_path / "w"), least_bytes=5))] == ["response", "response", "revisit", "response"]


def test_null_and_repeated_ids_and_empty_tables(spark, tmp_path):
    rows = [(None, "u", "ab"), (2, "u", "ab"), (2, "u", "ab"), (None, None, "only")]
    got = tuples(warc.archived(pages(spark, rows), str(tmp_path / "w")).select("page_id", "record_type", "refers_to"))
    assert got == [(2, "response", None), (2, "response", None), (None, "response", None), (None, "revisit", 2)]
    assert warc.archived(pages(spark, rows).where("false"), str(tmp_path / "e")).collect() == []


def test_a_member_cut_short_is_left_out(spark, tmp_path):
    whole = warc.member(1, "u", b"one", None, False), warc.member(2, "u", b"two", None, False), warc.member(3, "u", b"three", None, False)
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "a.warc").write_bytes(whole[0] + whole[1][:-20] + whole[2])
    assert {r.page_id for r in warc.read_records(spark, str(tmp_path / "w")).where("valid").collect()} >= {1, 3}
