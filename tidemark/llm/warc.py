"""WARC archives with a dictionary: one Zstandard frame a record, the dictionary in front.

Each archive's dictionary is built from its own records, spread over the archive and bounded in size, and stands in a
skippable frame at its start, so a file can be read by itself. Payloads that occur more than once are
stored once; the others are revisit records. Tasks write archives of bounded size to the shared folder,
under names of their attempt; the manifest of the attempts that succeeded says which files count.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import freeze
from tidemark.session import scratch_uri

# Fixed values of the format: the skippable frame that holds a dictionary, and a Zstandard frame's first bytes.
DICTIONARY_FRAME = 0x184D2A5D
FRAME = b"\x28\xb5\x2f\xfd"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
MANIFEST = "archive string, records bigint, bytes bigint"
READ = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def record(page_id, url: str | None, payload: bytes, digest: str, first, date: str) -> bytes:
    """One WARC record. `first` is the page that has the payload, if this is a revisit."""
    target = "".join(c if 32 < ord(c) != 127 else f"%{ord(c):02X}" for c in url or f"urn:page:{page_id}")
    http = HTTP.format(len(payload)).encode()
    block = http + (payload if first is None else b"")
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if first is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{page_id}>",
        f"WARC-Date: {date}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if first is not None:
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: <urn:page:{first}>"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def dictionary(records: list[bytes], size: int, sample: int) -> bytes:
    """A dictionary from records spread evenly over the archive, `sample` bytes of them at most.

    Where there is too little to train on, the sample itself serves."""
    import zstandard

    step = max(1, sum(map(len, records)) // max(1, sample))
    parts = [r[: 1 << 16] for r in records[::step]]
    try:
        return zstandard.train_dictionary(size, parts, k=200, d=8, level=3).as_bytes()
    except zstandard.ZstdError:
        return b"".join(parts)[:size]


def archive_bytes(records: list[bytes], level: int, size: int, sample: int) -> Iterator[bytes]:
    import zstandard

    words = dictionary(records, size, sample)
    packed = zstandard.ZstdCompressor(level=level).compress(words)
    yield struct.pack("<II", DICTIONARY_FRAME, len(packed)) + packed
    writer = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(words) if words else None)
    for r in records:
        yield writer.compress(r)


def read_records(stream) -> Iterator[bytes]:
    """Records of an open archive, one after the other; holds one record and one read at a time."""
    import zstandard

    magic, length = struct.unpack("<II", stream.read(8))
    if magic != DICTIONARY_FRAME:
        raise ValueError("no dictionary frame")
    words = zstandard.ZstdDecompressor().decompress(stream.read(length))
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(words) if words else None)
    rest = b""
    while True:
        data = rest or stream.read(1 << 20)
        if not data:
            return
        frame, parts, rest = reader.decompressobj(), [], b""
        while True:
            parts.append(frame.decompress(data))
            if frame.eof:
                rest = frame.unused_data
                break
            data = stream.read(1 << 20)
            if not data:
                raise ValueError("archive ends inside a record")
        yield b"".join(parts)


def parse(raw: bytes) -> dict:
    """Headers (names in lower case) with the payload, and what HTTP says of its length."""
    head, _, block = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    out = {k.lower(): v for k, v in (line.split(": ", 1) for line in lines[1:])}
    block = block[: int(out["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(x.split(b": ")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length: "))
    return out | {"payload": payload, "length": length}


def _number(urn: str) -> int | None:
    said = urn.removeprefix("<urn:page:").removesuffix(">")
    return None if said == "None" else int(said)


def write_archives(
    pages: DataFrame, uri: str, date: str = "2024-01-01T00:00:00Z", least_bytes: int = 0, archive_bytes_most: int = 32 << 20,
    level: int = 3, dictionary_bytes: int = 64 << 10, sample_bytes: int = 1 << 20,
) -> DataFrame:
    """Write each row of page_id, url and html as a record below `uri`; returns the manifest.

    A null html is an empty payload; a null url is named by the page. Of equal payloads of `least_bytes`
    at least, the smallest page_id's is the response; rows that repeat it are responses too. Rows with a null page_id come
    last. An archive's records before compression are at most `archive_bytes_most`, or one record. `sample_bytes` bounds
    what a dictionary is built from. Other columns are not read. An empty table gives an empty manifest."""
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("sha1", F.sha1("payload"))
    keys = freeze(rows.select("page_id", "sha1", F.octet_length("payload").alias("n")), "payloads")
    firsts = keys.groupBy("sha1").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("times")).filter("times > 1")
    # Narrow rows meet on the digest, which many may share; payloads move by page. Read from a table, both
    # sides of the join are plain exchanges, of which a crowded digest is split.
    firsts = freeze(firsts, "firsts")
    revisits = keys.filter(F.col("n") >= least_bytes).join(firsts, "sha1").filter(
        F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    ).select(F.col("page_id").alias("_page"), F.col("sha1").alias("_sha1"), "first").distinct()
    same = rows["page_id"].eqNullSafe(revisits["_page"]) & (rows["sha1"] == revisits["_sha1"])
    ready = rows.join(revisits, same, "left").select("page_id", "url", "payload", "sha1", "first")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        from pyspark import TaskContext

        task = TaskContext.get()
        files, folder = fs.FileSystem.from_uri(uri)
        files.create_dir(folder, recursive=True)
        made = 0

        def close(records: list[bytes]) -> pa.RecordBatch:
            nonlocal made
            name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}-{made:04d}.warc.zst"
            made += 1
            size = 0
            with files.open_output_stream(f"{folder}/{name}", compression=None) as out:
                for data in archive_bytes(records, level, dictionary_bytes, sample_bytes):
                    out.write(data)
                    size += len(data)
            return pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([len(records)], pa.int64()), pa.array([size], pa.int64())],
                names=["archive", "records", "bytes"],
            )

        records, size = [], 0
        for batch in batches:
            for page, url, payload, sha1, first in zip(*(c.to_pylist() for c in batch.columns)):
                digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                one = record(page, url, payload, digest, first, date)
                if records and size + len(one) > archive_bytes_most:
                    yield close(records)
                    records, size = [], 0
                records.append(one)
                size += len(one)
        if records:
            yield close(records)

    # The written manifest names the files of the attempts that succeeded; others are never read.
    return freeze(ready.mapInArrow(write, MANIFEST), "manifest")


def read_archives(manifest: DataFrame, uri: str, check: bool = True) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to of every record of the manifest's archives.

    With `check`, a response whose payload doesn't have its digest raises."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        files, folder = fs.FileSystem.from_uri(uri)

        def rows(records: list[dict]) -> pa.RecordBatch:
            columns = [
                pa.array([_number(r["warc-record-id"]) for r in records], pa.int64()),
                pa.array([r["warc-target-uri"] for r in records], pa.string()),
                pa.array([r["length"] for r in records], pa.int64()),
                pa.array([r["warc-payload-digest"].removeprefix("sha1:") for r in records], pa.string()),
                pa.array([r["warc-type"] for r in records], pa.string()),
                pa.array([_number(r["warc-refers-to"]) if "warc-refers-to" in r else None for r in records], pa.int64()),
            ]
            return pa.RecordBatch.from_arrays(
                columns, names=["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
            )

        for batch in batches:
            for name, expected in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                some, seen = [], 0
                with files.open_input_stream(f"{folder}/{name}", compression=None) as stream:
                    for raw in read_records(stream):
                        one = parse(raw)
                        payload = one.pop("payload")
                        if check and one["warc-type"] == "response":
                            digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                            if len(payload) != one["length"] or f"sha1:{digest}" != one["warc-payload-digest"]:
                                raise ValueError(f"{name}: a payload of {one['warc-record-id']} is damaged")
                        some.append(one)
                        seen += 1
                        if len(some) == 1000:
                            yield rows(some)
                            some = []
                if seen != expected:
                    raise ValueError(f"{name}: {seen} records of {expected}")
                if some:
                    yield rows(some)

    spread = manifest.select("archive", "records").repartition(max(1, manifest.count()), "archive")
    return spread.mapInArrow(read, READ)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write a table's archives to the shared folder and read them back."""
    uri = scratch_uri(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, uri), uri)
