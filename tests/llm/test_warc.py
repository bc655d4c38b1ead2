import base64
import hashlib
import os

import pytest
import zstandard

from lodestat.llm.common import new_path
from lodestat.llm.warc import archive_pages, parse_record, read_bundles, read_seek_table

PAGES = [
    (1, "http://a/", "<p>one</p>"), (2, "http://b/ x\ny", "<p>one</p>"), (3, None, "<p>one</p>"), (4, "http://d/", None), (5, "http://e/", ""),
    (6, "http://f/", "é\U0001f426" * 50_000), (6, "http://f/", "é\U0001f426" * 50_000), (7, "http://g/", "alone"), (None, "http://h/", "<p>one</p>"), (None, None, "nameless"), (7, "u", "other under a used id"),
]


def brute(rows, least=0):
    payload = [(i, (h or "").encode()) for i, _, h in rows]
    out = []
    for i, data in payload:
        same = [j for j, d in payload if d == data and j is not None]
        top = max(same) if same and len(data) >= least else i
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((i, len(data), digest, "response" if i == top else "revisit", None if i == top else top))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "'x' AS payload", "'y' AS digest", "'z' AS revisit").repartition(3)


@pytest.mark.parametrize("least, frame", [(0, 1 << 20), (11, 300)])
def test_round_trip(spark, pages, least, frame):
    folder = new_path(spark, "warc-test")
    index = archive_pages(pages, folder, least_bytes=least, frame_bytes=frame)
    got = sorted((tuple(r) for r in read_bundles(index, folder).collect()), key=str)
    assert got == brute(PAGES, least)


def test_bundles_are_seekable_and_plain_zstandard(spark, pages):
    folder = new_path(spark, "warc-test")
    index = archive_pages(pages, folder, frame_bytes=200).collect()
    for file in {r.file for r in index}:
        path = f"{folder}/{file}"
        frames = read_seek_table(path)
        own = [r for r in index if r.file == file]
        assert {(r.frame_at, r.frame_bytes) for r in own} == {(at, packed) for at, packed, _ in frames}
        with open(path, "rb") as f:
            data = f.read()
        whole = b"".join(zstandard.ZstdDecompressor().decompressobj().decompress(data[at : at + packed]) for at, packed, _ in frames)
        assert len(whole) == sum(plain for *_, plain in frames)
        starts = {}
        for at, _, plain in frames:
            starts[at] = sum(starts.get("n", 0) for _ in [0])
            starts["n"] = starts[at] + plain
        for r in own:
            begin = starts[r.frame_at] + r.record_at
            record = parse_record(whole[begin : begin + r.record_bytes])
            assert record["page_id"] == r.page_id
        assert whole.count(b"WARC/1.1\r\n") == len(own)
    assert {r.file for r in index} == set(os.listdir(folder))


def test_payloads_come_back_and_damage_is_noticed(spark, pages):
    folder = new_path(spark, "warc-test")
    index = archive_pages(pages, folder).collect()
    r = next(r for r in index if r.page_id == 6)
    with open(f"{folder}/{r.file}", "rb") as f:
        f.seek(r.frame_at)
        plain = zstandard.ZstdDecompressor().decompress(f.read(r.frame_bytes))
    record = plain[r.record_at : r.record_at + r.record_bytes]
    assert parse_record(record)["payload"].decode() == "é\U0001f426" * 50_000
    with pytest.raises(ValueError):
        parse_record(record.replace("é".encode(), "e\u0301"[0].encode() + b"x", 1))


def test_empty_table(spark):
    folder = new_path(spark, "warc-test")
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert read_bundles(archive_pages(none, folder), folder).isEmpty()
