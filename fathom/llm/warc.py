"""WARC archives compressed record by record with a dictionary of their own.

An archive starts with a skippable frame that holds a Zstandard dictionary built
from the archive's records; every record is then a frame of its own, compressed
with that dictionary. Spark deals the rows out; each task fills archives of a
bounded size in the folder that all executors share and returns their paths. Files
of failed attempts are in no returned row, so a lost executor leaves no double.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathom.llm._stage import cut, scratch

#: Fixed values of the formats: frames that hold a dictionary, and ordinary frames.
DICTIONARY_FRAME, ZSTD_FRAME = 0x184D2A5D, 0xFD2FB528
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_ID = "urn:page:"
#: Uncompressed bytes after which an archive is closed, and of its dictionary.
ARCHIVE_BYTES, DICTIONARY_BYTES, SAMPLE_BYTES = 16_000_000, 16_384, 800_000
#: Payloads that repeat up to which their digests are broadcast (about 30 bytes each), so that no html is shuffled.
BROADCAST_PAYLOADS = 1_000_000


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(page_id, url, payload: bytes, refers_to, revisit: bool, spare: str) -> bytes:
    digest = base32_sha1(payload)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{RECORD_ID}{spare if page_id is None else page_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if url:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{RECORD_ID}{refers_to}>"]
    head = "\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""]).encode()
    return head + block + b"\r\n\r\n"


def _archive(records: list[bytes], level: int) -> bytes:
    """The records as one compressed archive, led by a dictionary made from them.

    It is trained on records at even steps, about SAMPLE_BYTES in all and the first
    64 KiB of each; where these are too few or too plain to train on, the beginnings
    of the samples themselves are the dictionary (raw content).
    """
    import zstandard

    step, samples, taken = max(1, sum(map(len, records)) // SAMPLE_BYTES), [], 0
    for r in records[::step]:
        samples.append(r[:65_536])
        taken += len(samples[-1])
        if taken > 2 * SAMPLE_BYTES:
            break
    try:
        if len(samples) < 16 or taken < 8 * DICTIONARY_BYTES:
            raise zstandard.ZstdError("too few samples")
        made = zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8)
    except zstandard.ZstdError:
        made = zstandard.ZstdCompressionDict(b"".join(samples)[:DICTIONARY_BYTES], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    writer = zstandard.ZstdCompressor(level=level, dict_data=made, write_checksum=True)
    raw = made.as_bytes()
    return b"".join([struct.pack("<II", DICTIONARY_FRAME, len(raw)), raw, *(writer.compress(r) for r in records)])


def _file_system(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write_archives(pages: DataFrame, folder: str | None = None, revisit_from: int = 0, level: int = 3) -> DataFrame:
    """Archive every row of ``pages`` (``page_id``, ``url``, ``html``) as one WARC record.

    The payload is the html in UTF-8 (null: empty). Of equal payloads of at least
    ``revisit_from`` bytes the row with the smallest page_id is a response and the
    others are revisits of it; rows that repeat that page_id with that payload are
    responses too. A null page_id comes after all others. Other columns are not
    read. Returns one row per archive: path, records, bytes.
    """
    spark = pages.sparkSession
    folder = folder or scratch(spark, "warc")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        "url",
        F.coalesce(F.col("html"), F.lit("")).alias("html"),
    ).withColumn("sha", F.unhex(F.sha1("html")))
    least = rows.filter(F.octet_length("html") >= revisit_from).groupBy("sha")
    least = cut(least.agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").select("sha", "first"))
    joined = rows.join(F.broadcast(least) if least.count() <= BROADCAST_PAYLOADS else least, "sha", "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _file_system(folder)
        fs.create_dir(base, recursive=True)
        records, held, made = [], 0, []

        def close() -> None:
            nonlocal records, held
            name = f"{uuid.uuid4().hex}.warc.zst"
            body = _archive(records, level)
            with fs.open_output_stream(f"{base}/{name}") as out:
                out.write(body)
            made.append((f"{folder}/{name}", len(records), len(body)))
            records, held = [], 0

        for batch in batches:
            columns = [batch.column(n) for n in ("page_id", "url", "html", "first", "revisit")]
            for i in range(batch.num_rows):
                page_id, url, html, first, again = (c[i].as_py() for c in columns)
                records.append(_record(page_id, url, html.encode(), first, again, uuid.uuid4().hex))
                held += len(records[-1]) + len(html) * again
                if held >= ARCHIVE_BYTES:
                    close()
        if records:
            close()
        names = ("path", "records", "bytes")
        kinds = (pa.string(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made), kinds)] if made else [pa.array([], k) for k in kinds], names=list(names))

    out = joined.select("page_id", "url", "html", "first", revisit.alias("revisit"))
    return cut(out.mapInArrow(write, "path string, records long, bytes long"))


def _frame_end(data: memoryview, at: int) -> int:
    """Where the frame that starts at ``at`` ends, from its own block sizes."""
    descriptor = data[at + 4]
    single, sizes = descriptor >> 5 & 1, (0, 2, 4, 8)[descriptor >> 6]
    at += 5 + (not single) + (0, 1, 2, 4)[descriptor & 3] + (sizes or single)
    while True:
        head = data[at] | data[at + 1] << 8 | data[at + 2] << 16
        at += 3 + (1 if head >> 1 & 3 == 1 else head >> 3)
        if head & 1:
            return at + 4 * (descriptor >> 2 & 1)


def _records(body: bytes) -> Iterator[bytes]:
    import zstandard

    data, at, made = memoryview(body), 0, None
    if len(body) >= 8 and struct.unpack_from("<I", body)[0] == DICTIONARY_FRAME:
        size = struct.unpack_from("<I", body, 4)[0]
        made, at = zstandard.ZstdCompressionDict(body[8 : 8 + size]), 8 + size
    reader = zstandard.ZstdDecompressor(dict_data=made)
    while at < len(body):
        if struct.unpack_from("<I", body, at)[0] != ZSTD_FRAME:
            raise ValueError(f"no Zstandard frame at byte {at}")
        end = _frame_end(data, at)
        yield reader.decompress(data[at:end])
        at = end


def _parsed(record: bytes) -> dict:
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?i)content-length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or base32_sha1(payload) != digest):
        raise ValueError(f"{fields['WARC-Record-ID']}: the payload isn't the one that was archived")
    number = lambda name: int(x) if (x := fields.get(name, "").strip("<>").removeprefix(RECORD_ID)).lstrip("-").isdigit() and len(x) < 20 else None
    return {
        "page_id": number("WARC-Record-ID"),
        "url": fields.get("WARC-Target-URI"),
        "record_type": kind,
        "refers_to": number("WARC-Refers-To"),
        "payload_digest": digest,
        "payload_bytes": size,
        "payload": payload if kind == "response" else None,
    }


FIELDS = {
    "page_id": ("long", pa.int64()),
    "url": ("string", pa.string()),
    "record_type": ("string", pa.string()),
    "refers_to": ("long", pa.int64()),
    "payload_digest": ("string", pa.string()),
    "payload_bytes": ("long", pa.int64()),
    "payload": ("binary", pa.binary()),
}


def read_archives(archives: DataFrame, columns: tuple[str, ...] = tuple(FIELDS)) -> DataFrame:
    """The records of the archives named in ``path``; payloads are checked against their digests.

    A revisit has a null payload; its length and digest are those of the full
    payload. Unknown page ids are null. No archives give no rows.
    """
    parts = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                fs, name = _file_system(path)
                with fs.open_input_stream(name) as source:
                    body = source.read()
                rows, held = [], 0
                for record in _records(body):
                    rows.append(_parsed(record))
                    held += len(record)
                    if held > 4_000_000:
                        yield as_batch(rows)
                        rows, held = [], 0
                if rows:
                    yield as_batch(rows)

    def as_batch(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], FIELDS[c][1]) for c in columns], names=list(columns))

    schema = ", ".join(f"{c} {FIELDS[c][0]}" for c in columns)
    return archives.select("path").repartition(parts).mapInArrow(read, schema)
