"""WARC archives in Zstandard: one frame per record, the dictionary in a leading skippable frame."""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from telemill.llm.words import in_small_batches, kept
from telemill.sources.scratch import scratch_dir

#: Magic numbers of the dictionary's skippable frame and of a Zstandard frame.
DICTIONARY_MAGIC, FRAME_MAGIC = 0x184D2A5D, b"\x28\xb5\x2f\xfd"
DICTIONARY_BYTES = 64 << 10
#: Records at the start of an archive that its dictionary is trained on, and their bytes at most.
TRAINING_RECORDS, TRAINING_BYTES = 400, 8 << 20
ARCHIVE_BYTES = 256 << 20
READ_BYTES = 4 << 10
#: The tables have no time of capture; the format asks for one.
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORDS = (
    "page_id long, target_uri string, record_type string, refers_to long, payload_digest string,"
    " payload_bytes long, payload binary, record_id string, refers_to_id string"
)
ARCHIVES = "path string, records long, bytes long"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(page_id: int | None, uri: str | None, refers_to: int | None, payload: bytes, digest: str) -> bytes:
    """One record; with ``refers_to`` a revisit, which leaves the payload out."""
    name = lambda n: f"<urn:page:{'none' if n is None else n}>"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {name(page_id)}"]
    if uri is not None:
        clean = "".join(c if c > " " else f"%{ord(c):02X}" for c in uri)
        head.append(f"WARC-Target-URI: {clean}")
    head += [f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: {name(refers_to)}", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def header_fields(lines: list[str]) -> dict[str, str]:
    """Fields of a header by lower-case name; folded lines belong to the one before, the first of a name counts."""
    fields: dict[str, str] = {}
    key = None
    for line in lines:
        if line[:1] in (" ", "\t") and key is not None:
            fields[key] += " " + line.strip()
            continue
        key, colon, value = line.partition(":")
        key = key.strip().lower()
        if not colon or not key:
            raise ValueError(f"broken header line {line!r}")
        if key in fields:
            key = f"{key} again"
        fields.setdefault(key, value.strip())
    return fields


def size_of(fields: dict[str, str], name: str) -> int | None:
    """``content-length``, if present; raises ``ValueError`` unless it is a number."""
    text = fields.get("content-length")
    if text is not None and not (text.isascii() and text.isdigit()):
        raise ValueError(f"{name}: content-length is {text!r}")
    return None if text is None else int(text)


def parse_record(data: bytes) -> dict:
    """Columns of ``RECORDS`` of a record of any kind; raises ``ValueError`` for broken headers, lengths or digests.

    Of HTTP messages the payload is what follows the HTTP header, of other records (``warcinfo``,
    ``metadata``, ``resource`` ...) the whole block; revisits have none. A payload digest in SHA-1 is
    verified, one that is missing is worked out, another kind is taken as it stands. ``page_id`` and
    ``refers_to`` are null unless the ids have the form that ``record_bytes`` writes.
    """
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not gap or not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC header: {data[:60]!r}")
    fields = header_fields(lines[1:])
    for key in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if key not in fields:
            raise ValueError(f"record without {key}")
    name, kind, size = fields["warc-record-id"], fields["warc-type"], size_of(fields, fields["warc-record-id"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError(f"{name}: block is not {size} bytes long")
    payload, length = rest[:size], size
    if fields.get("content-type", "").lower().replace(" ", "").startswith("application/http"):
        http, gap, payload = payload.partition(b"\r\n\r\n")
        if not gap and not http.endswith(b"\r\n"):
            raise ValueError(f"{name}: no HTTP header")
        message = header_fields([x for x in http.decode("latin-1").split("\r\n")[1:] if x])
        told = size_of(message, name)
        if kind != "revisit" and told is not None and told != len(payload) and "transfer-encoding" not in message:
            raise ValueError(f"{name}: payload is not {told} bytes long")
        length = told if kind == "revisit" else len(payload)
    digest = fields.get("warc-payload-digest")
    if digest is None and kind != "revisit":
        digest = digest_of(payload)
    elif digest is not None and digest[:5].lower() == "sha1:":
        digest = digest[5:]
        if kind != "revisit" and digest_of(payload) != digest.upper():
            raise ValueError(f"{name}: payload does not match its digest")
    return {
        "page_id": _page(name),
        "target_uri": fields.get("warc-target-uri"),
        "record_type": kind,
        "refers_to": _page(fields.get("warc-refers-to")),
        "payload_digest": digest,
        "payload_bytes": length,
        "payload": None if kind == "revisit" else payload,
        "record_id": name,
        "refers_to_id": fields.get("warc-refers-to"),
    }


def _page(name: str | None) -> int | None:
    """The page of a record id as ``record_bytes`` forms it."""
    number = (name or "").removeprefix("<urn:page:").removesuffix(">")
    sign = number[1:] if number[:1] == "-" else number
    return int(number) if name == f"<urn:page:{number}>" and sign.isascii() and sign.isdigit() else None


def _store(path: str) -> tuple[fs.FileSystem, str]:
    """The shared store that holds ``path``; Arrow and Spark name one of them differently."""
    path = path.replace("s3a://", "s3://", 1)
    return fs.FileSystem.from_uri(path) if ":" in path.split("/")[0] else (fs.LocalFileSystem(), path)


def train(samples: list[bytes]):
    """A dictionary, or None where there is too little to train one on."""
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples)
    except zstandard.ZstdError:
        return None


def write_archive(path: str, records: Iterator[bytes], limit: int = ARCHIVE_BYTES) -> tuple[int, int]:
    """Write records until the archive has ``limit`` bytes or none are left; records, bytes."""
    import zstandard

    first, size = [], 0
    for record in records:
        first.append(record)
        size += len(record)
        if len(first) >= TRAINING_RECORDS or size >= TRAINING_BYTES:
            break
    dictionary, count, written = train(first), 0, 0
    compressor = zstandard.ZstdCompressor(level=3, dict_data=dictionary, write_checksum=True)
    store, name = _store(path)
    store.create_dir(name.rpartition("/")[0], recursive=True)
    with store.open_output_stream(name, compression=None) as out:
        if dictionary:
            packed = zstandard.ZstdCompressor(level=3).compress(dictionary.as_bytes())
            written += out.write(struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed)
        for source in (first, records):
            for record in source:
                written += out.write(compressor.compress(record))
                count += 1
                if source is records and written >= limit:
                    return count, written
    return count, written


def read_archive(path: str) -> Iterator[bytes]:
    """Records of an archive, one frame at a time, in bounded memory."""
    import zstandard

    store, name = _store(path)
    with store.open_input_stream(name, compression=None) as file:
        start, dictionary = file.read(8), None
        if len(start) == 8 and struct.unpack("<I", start[:4])[0] == DICTIONARY_MAGIC:
            packed = file.read(struct.unpack("<I", start[4:])[0])
            plain = zstandard.ZstdDecompressor().decompress(packed) if packed.startswith(FRAME_MAGIC) else packed
            dictionary, start = zstandard.ZstdCompressionDict(plain), b""
        decompressor = zstandard.ZstdDecompressor(dict_data=dictionary)
        data = start or file.read(READ_BYTES)
        while data:
            frame, parts = decompressor.decompressobj(), []
            while not frame.eof:
                if not data and not (data := file.read(READ_BYTES)):
                    raise ValueError(f"{path}: the last frame is cut short")
                try:
                    parts.append(frame.decompress(data))
                except zstandard.ZstdError as e:
                    raise ValueError(f"{path}: a frame cannot be decoded") from e
                data = frame.unused_data if frame.eof else b""
            yield b"".join(parts)
            data = data or file.read(READ_BYTES)


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Write a record for each row of ``pages`` (``page_id, url, html``); ``path, records, bytes``.

    Of rows with equal payloads of ``least_bytes`` or more that with the largest id is a response
    and the others are revisits of it, null ids among them; smaller payloads are all responses.
    Repeated rows of the largest id are all responses. Null html is an empty payload, a null url
    gives no target. Archives of failed attempts stay unlisted: read only what the list names.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = in_small_batches(pages).select("page_id", "url", payload.alias("payload"), F.unhex(F.sha1(payload)).alias("sha1"))
    # ids only: groups of copies shrink to one row in each map task
    latest = rows.groupBy("sha1").agg(F.max("page_id").alias("latest"))
    differs = ~F.col("page_id").eqNullSafe(F.col("latest")) & (F.length("payload") >= least_bytes)
    rows = rows.join(latest, "sha1").withColumn("refers_to", F.when(differs, F.col("latest")))
    sent = rows.select("page_id", "url", "refers_to", "payload", "sha1")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()

        def records() -> Iterator[bytes]:
            for batch in batches:
                for row in zip(*(c.to_pylist() for c in batch.columns)):
                    yield record_bytes(*row[:4], base64.b32encode(row[4]).decode())

        pending, n = records(), 0
        for record in pending:
            path = f"{folder}/archive-{task.partitionId():05d}-{task.taskAttemptId()}-{n}.warc.zst"
            done = write_archive(path, _chain([record], pending))
            n += 1
            yield pa.RecordBatch.from_pylist([{"path": path, "records": done[0], "bytes": done[1]}])

    return kept(sent.mapInArrow(write, ARCHIVES), "archives")


def _chain(first: Iterable[bytes], rest: Iterator[bytes]) -> Iterator[bytes]:
    yield from first
    yield from rest


def read_archives(archives: DataFrame) -> DataFrame:
    """Records (``RECORDS``) of the archives named in ``path``; each archive is read as a stream."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("page_id", pa.int64()), ("target_uri", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
            + [("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())]
            + [("record_id", pa.string()), ("refers_to_id", pa.string())]
        )
        for batch in batches:
            for path in batch["path"].to_pylist():
                rows, size = [], 0
                for record in read_archive(path):
                    rows.append(parse_record(record))
                    size += len(record)
                    if size >= 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    # a number of its own keeps the few small rows from being merged into one task
    tasks = max(archives.count(), 1)
    return archives.select("path").repartition(tasks, "path").mapInArrow(read, RECORDS)


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write all pages to archives in the shared folder and read their records back."""
    return read_archives(write_archives(pages, scratch_dir(spark, "warc")))


SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS payload_bytes, sha1(b) AS h FROM p),
x AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS latest FROM d)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(
         (((instr('0123456789abcdef', substr(h, CAST((i * 5) // 4 + 1 AS INT), 1)) - 1) * 16
           + greatest(0, instr('0123456789abcdef', substr(h, CAST((i * 5) // 4 + 2 AS INT), 1)) - 1))
          // CAST(power(2, 3 - (i * 5) % 4) AS INT)) % 32 + 1 AS INT), 1)), '') AS payload_digest,
       CASE WHEN page_id = latest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> latest THEN latest END AS refers_to
FROM x
"""
