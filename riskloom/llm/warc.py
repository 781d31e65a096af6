"""Dictionary-compressed web archives: one Zstandard frame per record, the dictionary in front.

An archive is a ``.warc.zst`` file: a skippable frame with the dictionary, then every record as a
frame of its own, so that a reader can start at any record. The dictionary is trained on records as
they will be archived. Records with equal payloads are stored once; the others are revisits.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.base import slices, stored
from riskloom.sources.scratch import new_folder

REVISIT_BYTES = 1000
#: Magic number of the skippable frame that holds a dictionary in .warc.zst files (fixed value of the format).
DICTIONARY_FRAME = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2026-01-01T00:00:00Z"
#: Sample for the dictionary: about this many records of at most this many payload bytes, by hash of the page.
SAMPLE_RECORDS, SAMPLE_BYTES, DICTIONARY_BYTES = 400, 65_536, 65_536
ARCHIVE_BYTES = 1 << 30
LEVEL = 3
_RECORDS = "page_id long, url string, payload binary, payload_digest string, payload_bytes long, record_type string, refers_to long"


def payloads(pages: DataFrame) -> DataFrame:
    """``page_id, url, payload, payload_digest, payload_bytes`` for every row of ``pages``; the payload is the html in UTF-8, empty where null."""
    payload = F.coalesce(F.col("html").cast("string").cast("binary"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    return rows.withColumn("payload_digest", F.sha1("payload")).withColumn("payload_bytes", F.octet_length("payload").cast("long"))


def classified(rows: DataFrame) -> DataFrame:
    """The rows of `payloads` with ``record_type`` and ``refers_to``.

    Payloads of at least `REVISIT_BYTES` that are
    equal (length and SHA-1) have one response, the largest page_id; its repeated rows are responses too.
    Rows without page_id among equal payloads revisit the largest id; where no row has one all are responses.
    Short payloads meet nobody: they get join keys of their own, so that empty pages do not gather in a task.
    Owners are found on digests alone (partial maxima); html moves once, to its verdict, where equal
    payloads of one digest are left to skew splitting.
    """
    long_ = F.col("payload_bytes") >= REVISIT_BYTES
    equal = F.concat_ws(":", "payload_digest", "payload_bytes")
    owners = rows.where(long_).groupBy(equal.alias("key")).agg(F.max("page_id").alias("owner"), F.count("*").alias("n")).where("n > 1").drop("n")
    alone = F.concat(F.lit("page "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(" "), F.substring("payload_digest", 1, 8))
    rows = rows.withColumn("key", F.when(long_, equal).otherwise(alone)).join(owners, "key", "left")
    revisit = F.col("owner").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("owner"))
    return rows.select("page_id", "url", "payload", "payload_digest", "payload_bytes",
                       F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("owner")).alias("refers_to"))


def _urn(*parts) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, ' '.join(map(str, parts)))}>"


def record(row: dict) -> bytes:
    """One WARC/1.1 record with its HTTP block. Own fields carry the page ids and the payload's length; addresses are percent-encoded where needed."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % row["payload_bytes"]
    revisit = row["record_type"] == "revisit"
    block = http if revisit else http + row["payload"]
    digest = base64.b32encode(bytes.fromhex(row["payload_digest"])).decode()
    head = ["WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: {_urn('record', row['page_id'], row['payload_digest'])}",
            f"WARC-Date: {DATE}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
            f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {row['payload_bytes']}"]
    if row["url"] is not None:
        head.append(f"WARC-Target-URI: {quote(row['url'], safe=_PLAIN)}")
    if row["page_id"] is not None:
        head.append(f"X-Page-Id: {row['page_id']}")
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_urn('record', row['refers_to'], row['payload_digest'])}",
                 f"X-Refers-To-Page-Id: {row['refers_to']}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


_PLAIN = "".join(chr(c) for c in range(33, 127))


def dictionary(rows: DataFrame) -> bytes:
    """A dictionary trained on a bounded sample of `payloads` as response records; empty where they are too few to train on."""
    mark = F.xxhash64(F.lit("warc"), "page_id", "payload_digest")
    # One row in so many, so that what reaches the driver does not grow with the tasks.
    share = max(1, rows.count() // SAMPLE_RECORDS)
    few = rows.where((F.pmod(mark, F.lit(share)) == 0) & (F.col("payload_bytes") <= SAMPLE_BYTES)).limit(2 * SAMPLE_RECORDS).collect()
    sample = [record(r.asDict() | {"record_type": "response"}) for r in sorted(few, key=lambda r: (r["payload_digest"], r["page_id"] or 0))]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sample).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def _filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def write(rows: DataFrame, folder: str, trained_on: bytes = b"") -> DataFrame:
    """Archive classified rows under ``folder`` (any address pyarrow knows) with a dictionary, if any; returns ``path, records, bytes`` per archive.

    A task writes its rows as they come, one at a time, to archives of at most about `ARCHIVE_BYTES`.
    Names are new for every attempt, and only the archives in the returned (stored) table count: what
    a lost or repeated attempt leaves behind is never read. No rows give no archives.
    """
    shared = rows.sparkSession.sparkContext.broadcast(trained_on)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, root = _filesystem(folder)
        out, done = None, []
        trained = zstandard.ZstdCompressionDict(shared.value) if shared.value else None
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_checksum=True)

        def close() -> None:
            nonlocal out
            if out is not None:
                out.close()
                out = None

        for batch in slices(batches, "payload"):
            for row in batch.to_pylist():
                if out is None:
                    path = f"{root}/{uuid.uuid4().hex}.warc.zst"
                    out = filesystem.open_output_stream(path, compression=None)
                    out.write(struct.pack("<II", DICTIONARY_FRAME, len(shared.value)) + shared.value)
                    done.append([path.removeprefix(root), 0, 8 + len(shared.value)])
                frame = packer.compress(record(row))
                out.write(frame)
                done[-1][1] += 1
                done[-1][2] += len(frame)
                if done[-1][2] >= ARCHIVE_BYTES:
                    close()
        close()
        if done:
            names, counts, sizes = zip(*done)
            yield pa.RecordBatch.from_arrays([pa.array([folder + n for n in names]), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())],
                                             names=["path", "records", "bytes"])

    _, root = _filesystem(folder)
    _filesystem(folder)[0].create_dir(root, recursive=True)
    return stored(rows.mapInArrow(run, "path string, records long, bytes long"), "warc-archives")


def records(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The records of one archive, one at a time: the dictionary from the leading frame, then frame after frame."""
    head = stream.read(8)
    if len(head) < 8 or struct.unpack("<I", head[:4])[0] != DICTIONARY_FRAME:
        raise ValueError("no dictionary frame in front")
    trained = stream.read(struct.unpack("<I", head[4:])[0])
    unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(trained) if trained else None)
    held = b""
    while True:
        held = held or stream.read(chunk)
        if not held:
            return
        frame, parts = unpacker.decompressobj(), []
        while not frame.eof:
            parts.append(frame.decompress(held))
            held = frame.unused_data if frame.eof else stream.read(chunk)
            if not held and not frame.eof:
                raise ValueError("archive ends inside a record")
        yield b"".join(parts)


def parsed(raw: bytes) -> dict:
    """A record's fields and payload; a response whose payload does not match its digest is an error."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    kind = fields["WARC-Type"]
    if kind == "response" and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != int(fields["X-Payload-Length"])):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    number = lambda name: int(fields[name]) if name in fields else None
    return {"page_id": number("X-Page-Id"), "url": fields.get("WARC-Target-URI"), "payload": payload if kind == "response" else None,
            "payload_digest": digest, "payload_bytes": int(fields["X-Payload-Length"]), "record_type": kind, "refers_to": number("X-Refers-To-Page-Id")}


def read(archives: DataFrame, bodies: bool = True) -> DataFrame:
    """The records of archives ``(path)``: what `classified` held, the payload only of responses (or of none).

    Archives are dealt out evenly, read as streams and parsed record by record; payload digests are checked.
    """
    names = [f.split(" ")[0] for f in _RECORDS.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.binary(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds)], names=names)

        for batch in batches:
            for uri in batch.column("path").to_pylist():
                filesystem, path = _filesystem(uri)
                rows, held = [], 0
                with filesystem.open_input_stream(path, compression=None) as stream:
                    for raw in records(stream):
                        rows.append(parsed(raw))
                        held += len(raw)
                        if not bodies:
                            rows[-1]["payload"] = None
                        if held > 8 << 20 or len(rows) >= 5000:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    spread = archives.select("path").repartition("path")
    return spread.mapInArrow(run, _RECORDS)


def archived(pages: DataFrame) -> DataFrame:
    """Classify, write under the shared folder, and return the table of archives."""
    rows = payloads(pages)
    return write(classified(rows), new_folder(pages.sparkSession, "warc"), dictionary(rows))
