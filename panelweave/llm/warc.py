"""WARC archives with Zstandard: one frame for each record, the dictionary in a leading skippable frame.

Archives are real files in the shared folder. A task writes each under a name of
its own and reports it in a manifest, so what a lost or repeated attempt leaves
behind is never read. The reader takes the dictionary from the leading frame,
decodes frame by frame, and checks headers, lengths and digests.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelweave.llm.common import table, utf8, written
from panelweave.session import new_path

#: The magic number of a dictionary's frame, those of other skippable frames, a revisit's profile.
DICTIONARY = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
#: Bytes of payload in an archive, of a dictionary, of a read; pages the dictionary is made from; level.
ARCHIVE, DICT_BYTES, READ, SAMPLE, LEVEL = 32 << 20, 32 << 10, 1 << 16, 500, 3


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page: int | None, url: str | None, payload: bytes, refers: int | None, date: str = DATE) -> bytes:
    """One WARC record: a response with its payload, or a revisit with the response's headers only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'none' if page is None else page}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest_of(payload)}",
        f"WARC-Block-Digest: sha1:{digest_of(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda c: f"%{ord(c[0]):02X}", url))
    if refers is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers}>", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers, in lower case, and block of a record; raises ValueError where it is not sound."""
    head, sep, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not sep or not re.fullmatch(r"WARC/1\.[01]", lines[0]):
        raise ValueError(f"no WARC record: {raw[:40]!r}")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name or name != name.strip():
            raise ValueError(f"bad header line: {line!r}")
        headers[name.lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in headers:
            raise ValueError(f"header {name} is missing")
    if not re.fullmatch(r"\d+", headers["content-length"]):
        raise ValueError("Content-Length is no number")
    n = int(headers["content-length"])
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise ValueError(f"block of {len(rest) - 4} bytes, Content-Length {n}")
    block = rest[:n]
    if headers.get("warc-block-digest", "sha1:" + digest_of(block)) != "sha1:" + digest_of(block):
        raise ValueError("block digest differs")
    return headers, block


def read_archive(file) -> Iterator[bytes]:
    """Records of an open archive, one for each frame; memory for one record and a read."""
    held = file.read(READ)
    dictionary = None
    if len(held) >= 8 and struct.unpack("<I", held[:4])[0] == DICTIONARY:
        n = struct.unpack("<I", held[4:8])[0]
        while len(held) < 8 + n:
            more = file.read(READ)
            if not more:
                raise ValueError("the dictionary is cut off")
            held += more
        found, held = held[8 : 8 + n], held[8 + n :]
        if found[:4] == b"\x28\xb5\x2f\xfd":  # a dictionary may itself be a frame
            found = zstandard.ZstdDecompressor().decompress(found)
        dictionary = zstandard.ZstdCompressionDict(found) if found else None
    decoder = zstandard.ZstdDecompressor(dict_data=dictionary)
    while held or (held := file.read(READ)):
        while len(held) < 8 and (more := file.read(READ)):
            held += more
        if len(held) >= 8 and struct.unpack("<I", held[:4])[0] in SKIPPABLE:
            skip = 8 + struct.unpack("<I", held[4:8])[0]
            while len(held) < skip and (more := file.read(READ)):
                held += more
            if len(held) < skip:
                raise ValueError("a skippable frame is cut off")
            held = held[skip:]
            continue
        frame, parts = decoder.decompressobj(), []
        while not frame.eof:
            if not held and not (held := file.read(READ)):
                raise ValueError("a frame is cut off")
            parts.append(frame.decompress(held))
            held = frame.unused_data if frame.eof else b""
        yield b"".join(parts)


def make_dictionary(pages: DataFrame, html_col: str = "html", sample: int = SAMPLE) -> bytes:
    """A dictionary trained in one task on at most ``sample`` payloads; of too few, their first bytes as they are."""

    def train(rows: pa.Table) -> pa.Table:
        texts = [t[: 1 << 17] for t in utf8(rows["html"].combine_chunks()) if t]
        try:
            found = zstandard.train_dictionary(DICT_BYTES, texts).as_bytes()
        except zstandard.ZstdError:
            found = b"".join(texts)[:DICT_BYTES]
        return pa.table({"found": [found]})

    some = pages.select(F.lit(0).alias("one"), F.col(html_col).alias("html")).where("html <> ''").limit(sample)
    rows = some.groupBy("one").applyInArrow(train, "found binary").collect()
    return bytes(rows[0][0]) if rows else b""


def revisits(pages: DataFrame, id_col: str, html_col: str, least: int = 0) -> DataFrame:
    """(id, sha, refers): rows whose payload, of ``least`` bytes or more, a larger id has too."""
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"),
        F.sha1(F.coalesce(F.col(html_col), F.lit("")).cast("binary")).alias("sha"),
        F.octet_length(F.coalesce(F.col(html_col), F.lit(""))).alias("n"),
    ).where(F.col("id").isNotNull() & (F.col("n") >= least))
    rows = rows.select("id", "sha").distinct()
    last = rows.groupBy("sha").agg(F.max("id").alias("refers"))
    return rows.join(last, "sha").where("id <> refers")


def write_archives(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least: int = 0,
    archive_bytes: int = ARCHIVE,
) -> DataFrame:
    """Writes a record for each row into archives in ``folder``; returns the manifest (path, records).

    Of rows with equal payloads of ``least`` bytes or more the one with the largest
    id is a response and the others revisit it; the rest are responses. A null
    payload is an empty one. Rows without an id are responses. Rows that repeat
    an id and its payload get records of the same type. An empty table gives no archive.
    """
    dictionary = make_dictionary(pages, html_col)
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), html.alias("html"),
        F.sha1(html.cast("binary")).alias("sha"),
    )
    rows = rows.join(revisits(pages, id_col, html_col, least), ["id", "sha"], "left").select(
        "id", "url", "html", "refers"
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        encoder = zstandard.ZstdCompressor(LEVEL, dict_data=known, write_checksum=True, write_content_size=True)
        file, done = None, []
        for batch in batches:
            columns = (batch.column(k).to_pylist() for k in (0, 1, 3))
            for page, url, refers, payload in zip(*columns, utf8(batch.column(2))):
                if file is None:
                    name, n, size = f"{uuid.uuid4().hex}.warc.zst", 0, 0
                    file = store.open_output_stream(f"{base}/{name}", compression=None)
                    file.write(struct.pack("<II", DICTIONARY, len(dictionary)) + dictionary)
                file.write(encoder.compress(record(page, url, payload, refers)))
                n, size = n + 1, size + len(payload)
                if size >= archive_bytes:
                    file.close()
                    done.append((f"{folder}/{name}", n))
                    file = None
        if file is not None:
            file.close()
            done.append((f"{folder}/{name}", n))
        if done:
            yield pa.RecordBatch.from_pylist([{"path": p, "records": n} for p, n in done])

    return written(rows.mapInArrow(write, "path string, records long"), "warc-manifest")


RECORDS = (
    "page_id long, url string, record_type string, refers_to long, "
    "payload_bytes long, payload_digest string, payload binary"
)


def read_archives(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of all archives in ``manifest(path, ...)``; payloads of responses if asked for.

    A record that is not sound, or whose payload is not what its header says, ends the job with a ValueError.
    """

    def page_of(name: str | None) -> int | None:
        found = re.fullmatch(r"<urn:page:(-?\d+)>", name or "")
        return int(found[1]) if found else None

    def rows_of(path: str) -> Iterator[dict]:
        store, at = FileSystem.from_uri(path)
        with store.open_input_stream(at, compression=None) as file:
            for raw in read_archive(file):
                headers, block = parse(raw)
                http, _, payload = block.partition(b"\r\n\r\n")
                length = int(re.search(rb"(?im)^Content-Length: *(\d+)", http)[1])
                kind, sha = headers["warc-type"], headers["warc-payload-digest"].removeprefix("sha1:")
                if kind == "response" and (len(payload) != length or digest_of(payload) != sha):
                    raise ValueError(f"payload of {headers['warc-record-id']} differs from its header")
                yield {
                    "page_id": page_of(headers["warc-record-id"]),
                    "url": headers.get("warc-target-uri"),
                    "record_type": kind,
                    "refers_to": page_of(headers.get("warc-refers-to")),
                    "payload_bytes": length,
                    "payload_digest": sha,
                    "payload": payload if payloads and kind == "response" else None,
                }

    kinds = pa.schema(
        [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
         ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, size = [], 0
                for row in rows_of(path):
                    rows.append(row)
                    size += 256 + len(row["payload"] or b"")
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, kinds)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, kinds)

    archives = max(1, manifest.count())
    return manifest.select("path").repartition(min(archives, 10_000), "path").mapInArrow(read, RECORDS)


def op2_warc(spark: SparkSession, sf: str) -> DataFrame:
    manifest = write_archives(table(spark, sf, "pages"), new_path(spark, "warc"))
    return read_archives(manifest, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


SQL = """
with hashed as (
  select page_id, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as hex from pages),
last as (select hex, max(page_id) as top from hashed group by hex)
select page_id, cast(payload_bytes as bigint) as payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((
         ((strpos('0123456789abcdef', substr(h.hex, cast((5 * i) // 4 + 1 as bigint), 1)) - 1) * 16
          + greatest(strpos('0123456789abcdef', substr(h.hex, cast((5 * i) // 4 + 2 as bigint), 1)) - 1, 0))
         >> (3 - (5 * i) % 4)) & 31), 1)), '') as payload_digest,
       case when page_id = top then 'response' else 'revisit' end as record_type,
       case when page_id <> top then top end as refers_to
from hashed h join last l on h.hex = l.hex
"""
