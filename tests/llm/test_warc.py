import base64
import hashlib
import io
import struct

import pytest
import zstandard

from panelweave.llm import warc

SCHEMA = "page_id long, url string, html string, sha string, refers long"


def b32(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def rows_of(pages):
    last = {}
    for p, _, h in pages:
        if p is not None:
            last[h or ""] = max(p, last.get(h or "", p))
    out = []
    for p, _, h in pages:
        top = last.get(h or "")
        again = p is not None and top != p
        out.append((p, len((h or "").encode()), b32(h), "revisit" if again else "response", top if again else None))
    return sorted(out, key=str)


PAGES = [
    (1, "http://a/", "<p>one</p>"), (2, None, "<p>one</p>"), (3, "http://c/\r\nX: y", "é" * 3000), (4, "http://d/é", None),
    (5, "", ""), (6, "http://f/", "\r\n\r\nWARC/1.1\r\n"), (7, "http://g/", "z" * 400_000), (2, None, "<p>one</p>"),
    (None, "http://h/", "<p>one</p>"), (9, "http://i/", "<p>one</p>"),
]


@pytest.mark.parametrize("archive_bytes", [32 << 20, 100])
def test_round_trip(spark, tmp_path, archive_bytes):
    pages = spark.createDataFrame([(*p, "s", 1) for p in PAGES], SCHEMA)
    manifest = warc.write_archives(pages, f"file://{tmp_path}/a", archive_bytes=archive_bytes)
    assert manifest.agg({"records": "sum"}).first()[0] == len(PAGES)
    back = warc.read_archives(manifest)
    got = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in back.collect()]
    assert sorted(got, key=str) == rows_of(PAGES)
    payloads = {r["page_id"]: r["payload"] for r in back.where("record_type = 'response'").collect()}
    assert payloads[7] == b"z" * 400_000 and payloads[5] == b"" and payloads[3].decode() == "é" * 3000
    assert {r["url"] for r in back.where("page_id in (2, 3)").collect()} == {None, "http://c/%0D%0AX:%20y"}


def test_least_size_and_empty(spark, tmp_path):
    pages = spark.createDataFrame([(*p, "s", 1) for p in PAGES], SCHEMA)
    back = warc.read_archives(warc.write_archives(pages, f"{tmp_path}/b", least=11))
    assert {r["record_type"] for r in back.collect()} == {"response"}
    none = warc.write_archives(pages.limit(0), f"{tmp_path}/c")
    assert none.count() == 0 and warc.read_archives(none).collect() == []


def archive(records, dictionary=b"", packed=False):
    known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    held = zstandard.ZstdCompressor().compress(dictionary) if packed else dictionary
    frames = [zstandard.ZstdCompressor(dict_data=known).compress(r) for r in records]
    return io.BytesIO(struct.pack("<II", warc.DICTIONARY, len(held)) + held + b"".join(frames))


@pytest.mark.parametrize("packed", [False, True])
def test_dictionary_frame(packed):
    records = [warc.record(k, "http://x/", f"text {k} ".encode() * k, None) for k in range(50)]
    dictionary = b"WARC/1.1 http://x/ text " * 40
    assert list(warc.read_archive(archive(records, dictionary, packed))) == records
    skipped = io.BytesIO(archive(records[:2]).getvalue() + struct.pack("<II", 0x184D2A50, 3) + b"abc")
    assert list(warc.read_archive(skipped)) == records[:2]
    assert list(warc.read_archive(io.BytesIO(b""))) == []


def test_broken_archives_are_found():
    good = warc.record(1, "http://x/", b"payload", None)
    whole = archive([good]).getvalue()
    with pytest.raises(ValueError):
        list(warc.read_archive(io.BytesIO(whole[:-3])))
    with pytest.raises(ValueError):
        list(warc.read_archive(io.BytesIO(struct.pack("<II", warc.DICTIONARY, 99) + b"short")))
    for bad in (
        good.replace(b"WARC/1.1", b"WARC/9"), good[:-1], good.replace(b"Content-Length: ", b"Content-Length: 9", 1),
        good.replace(b"WARC-Type: response\r\n", b""), good.replace(b"payload", b"paYload"), good.replace(b"WARC-Date:", b"WARC-Date"),
    ):
        with pytest.raises(ValueError):
            warc.parse(bad)
    assert warc.parse(good)[1].endswith(b"payload")
