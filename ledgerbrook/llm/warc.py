"""WARC archives in Zstandard form: one frame per record, the dictionary in a leading skippable frame.

``write_archives`` lays the rows of a table into archives of bounded size, each
task into files of its own in the shared folder, and returns a manifest of the
files that belong to finished tasks; what a lost or repeated attempt left behind is
not in it. ``read_archives`` goes through the files of a manifest: it loads the
dictionary from the skippable frame, walks the frames by their block headers,
decodes each and checks the version line, the fields, the length of the block, the
closing blank lines and the payload digest.

Payloads that occur more than once are written once: the row with the largest
page_id is the ``response``, the others are ``revisit`` records that refer to it.

Defined cases: a null html is an empty payload. Rows without page_id are never
referred to; if a payload has only such rows, all are responses. Repeated rows of
the largest page_id are all responses. A null url is left out, control characters
in it are escaped. Extra columns are ignored, an empty table gives an empty result.
Fewer pages than a dictionary can be trained on are written without one; the reader
takes both forms. A frame or record that breaks the format is an error that names
the file and the position.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerbrook.llm.common import first_by, keep
from ledgerbrook.session import run_dir

ARCHIVE_BYTES = 32 << 20
DICTIONARY_BYTES = 64 << 10
SAMPLE_PAGES = 400
SAMPLE_BYTES = 8 << 20
LEVEL = 3
LEAST_BYTES = 0

#: Fixed values of the formats.
DICTIONARY_FRAME = 0x184D2A5D
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

MANIFEST = "path string, records long, bytes long"
RECORD = "page_id long, url string, record_type string, refers_to long, payload_digest string, payload binary"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def encode_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record; a revisit has the HTTP head only."""
    fields = [("WARC-Type", "response" if refers_to is None else "revisit")]
    fields.append(("WARC-Record-ID", f"<urn:x-page:{'none' if page_id is None else page_id}>"))
    fields.append(("WARC-Date", DATE))
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="".join(map(chr, range(0x21, 0x7F))))))
    fields.append(("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}"))
    if refers_to is not None:
        fields += [("WARC-Refers-To", f"<urn:x-page:{refers_to}>"), ("WARC-Profile", PROFILE)]
    block = HTTP_HEAD + (payload if refers_to is None else b"")
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    head = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return f"{VERSION}\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


def decode_record(data: bytes) -> dict:
    """Fields and payload of one record; ValueError where it breaks the format."""
    end = data.find(b"\r\n\r\n")
    if end < 0:
        raise ValueError("the header does not end")
    lines = data[:end].decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/1."):
        raise ValueError(f"version line {lines[0][:20]!r}")
    found: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name or name != name.strip():
            raise ValueError(f"field {line[:40]!r}")
        found[name.lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in found:
            raise ValueError(f"no {name}")
    if not found["content-length"].isdigit():
        raise ValueError("content-length is no number")
    block = data[end + 4 : end + 4 + int(found["content-length"])]
    if len(block) != int(found["content-length"]) or data[end + 4 + len(block) :] != b"\r\n\r\n":
        raise ValueError("content-length and block differ")
    http, gap, payload = block.partition(b"\r\n\r\n")
    if not gap or not http.startswith(b"HTTP/"):
        raise ValueError("the block is no HTTP message")
    digest = found.get("warc-payload-digest", "").partition(":")[2]
    kind = found["warc-type"]
    if kind == "response" and digest != payload_digest(payload):
        raise ValueError("the payload has another digest")
    if kind == "revisit" and "warc-refers-to" not in found:
        raise ValueError("a revisit refers to nothing")

    def number(uri: str | None) -> int | None:
        tail = (uri or "").strip("<>").rpartition(":")[2]
        return int(tail) if tail.lstrip("-").isdigit() else None

    return {
        "page_id": number(found["warc-record-id"]),
        "url": found.get("warc-target-uri"),
        "record_type": kind,
        "refers_to": number(found.get("warc-refers-to")),
        "payload_digest": digest,
        "payload": payload,
    }


def dictionary_frame(dictionary: bytes) -> bytes:
    packed = zstandard.ZstdCompressor(level=19).compress(dictionary)
    return struct.pack("<II", DICTIONARY_FRAME, len(packed)) + packed


def read_dictionary(data: bytes) -> tuple[bytes | None, int]:
    """The dictionary of an archive and where its records begin."""
    if len(data) < 8 or struct.unpack_from("<I", data)[0] != DICTIONARY_FRAME:
        return None, 0
    size = struct.unpack_from("<I", data, 4)[0]
    held = data[8 : 8 + size]
    if len(held) != size:
        raise ValueError("the dictionary frame is cut off")
    return (zstandard.ZstdDecompressor().decompress(held) if held.startswith(FRAME_MAGIC) else held), 8 + size


def frame_end(data: bytes, at: int) -> int:
    """Where the frame that begins at ``at`` ends, by its block headers."""
    head = data[at : at + 18]
    if not head.startswith(FRAME_MAGIC):
        raise ValueError("no frame begins here")
    end = at + zstandard.frame_header_size(head)
    while True:
        if end + 3 > len(data):
            raise ValueError("the frame is cut off")
        block = int.from_bytes(data[end : end + 3], "little")
        # a run-length block holds one byte whatever its size
        end += 3 + (1 if block >> 1 & 3 == 1 else block >> 3)
        if block & 1:
            break
    end += 4 if zstandard.get_frame_parameters(head).has_checksum else 0
    if end > len(data):
        raise ValueError("the frame is cut off")
    return end


def records(data: bytes) -> Iterator[dict]:
    """The records of one archive in order."""
    dictionary, at = read_dictionary(data)
    held = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    decoder = zstandard.ZstdDecompressor(dict_data=held)
    while at < len(data):
        end = frame_end(data, at)
        try:
            frame = data[at:end]
            if zstandard.get_frame_parameters(frame).content_size == zstandard.CONTENTSIZE_UNKNOWN:
                raise ValueError("a frame without its content size")
            yield decode_record(decoder.decompress(frame))
        except (ValueError, zstandard.ZstdError) as broken:
            raise ValueError(f"record at byte {at}: {broken}") from broken
        at = end


def train_dictionary(pages: DataFrame) -> bytes:
    """A dictionary from at most ``SAMPLE_PAGES`` pages, the first by a hash of page_id; empty if too few."""
    rows = pages.where("html IS NOT NULL AND octet_length(html) < 100000").select("page_id", "url", "html")
    samples, total = [], 0
    for row in first_by(rows, F.xxhash64("page_id"), SAMPLE_PAGES).orderBy("page_id", "html").collect():
        samples.append(encode_record(row["page_id"], row["url"], row["html"].encode(), None))
        total += len(samples[-1])
        if total > SAMPLE_BYTES:
            break
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _write(folder: str, dictionary: bytes, archive_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        store, place = _store(folder)
        store.create_dir(place, recursive=True)
        held = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        encoder = zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_checksum=True, write_content_size=True)
        done: list[tuple[str, int, int]] = []
        out = None
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    # the attempt is part of the name: no two attempts share a file; the
                    # frames are made here, so the store must not compress by the name
                    name = f"{task.partitionId():06d}-{task.taskAttemptId()}-{len(done):04d}.warc.zst"
                    out, count, size = store.open_output_stream(f"{place}/{name}", compression=None), 0, 0
                    if dictionary:
                        out.write(dictionary_frame(dictionary))
                payload = (row["html"] or "").encode()
                frame = encoder.compress(encode_record(row["page_id"], row["url"], payload, row["refers_to"]))
                out.write(frame)
                count, size = count + 1, size + len(frame)
                if size >= archive_bytes:
                    out.close()
                    done.append((f"{folder}/{name}", count, size))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{folder}/{name}", count, size))
        if done:
            paths, counts, sizes = zip(*done, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(paths), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())],
                names=["path", "records", "bytes"],
            )

    return run


def with_references(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """``pages`` (page_id, url, html) with ``refers_to``, null for the rows that hold their payload."""
    html = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    keyed = pages.select("page_id", "url", "html", F.sha1(html).alias("_sha1"), F.octet_length(html).alias("_bytes"))
    groups = keyed.where(F.col("_bytes") >= least_bytes).groupBy("_sha1", "_bytes")
    held = groups.agg(F.max("page_id").alias("_held"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    out = keyed.join(held, ["_sha1", "_bytes"], "left")
    own = F.col("_held").eqNullSafe(F.col("page_id")) | F.col("_held").isNull()
    return out.select("page_id", "url", "html", F.when(~own, F.col("_held")).alias("refers_to"))


def write_archives(rows: DataFrame, dictionary: bytes, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write rows (page_id, url, html, refers_to); the manifest of the archives."""
    folder = run_dir(rows.sparkSession, "warc")
    return keep(rows.mapInArrow(_write(folder, dictionary, archive_bytes), MANIFEST), "manifest")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
         ("payload_digest", pa.string()), ("payload", pa.binary())]
    )
    for batch in batches:
        for path in batch.column(0).to_pylist():
            store, place = _store(path)
            with store.open_input_stream(place, compression=None) as stream:
                data = stream.read()
            held: list[dict] = []
            try:
                for record in records(data):
                    held.append(record)
                    if len(held) >= 500:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held = []
            except ValueError as broken:
                raise ValueError(f"{path}: {broken}") from broken
            if held:
                yield pa.RecordBatch.from_pylist(held, schema)


def read_archives(manifest: DataFrame) -> DataFrame:
    """The records of the archives named in ``path``, one archive at a time in a task."""
    spark = manifest.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    # a fixed number of partitions: the rows are few, what stands behind them is not
    return manifest.select("path").repartition(tasks, "path").mapInArrow(_read, RECORD)


def round_trip(pages: DataFrame) -> DataFrame:
    """Per page, from the archives read back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    pages = pages.select(F.col("page_id").cast("long"), "url", "html")
    manifest = write_archives(with_references(pages), train_dictionary(pages))
    found = read_archives(manifest).withColumn("_own", F.octet_length("payload").cast("long")).drop("payload", "url")
    found = keep(found, "records")
    responses = found.where("record_type = 'response'").groupBy("page_id", "payload_digest")
    sizes = responses.agg(F.max("_own").alias("_size")).withColumnsRenamed({"page_id": "_page", "payload_digest": "_digest"})
    met = (F.col("refers_to") == F.col("_page")) & (F.col("payload_digest") == F.col("_digest"))
    revisits = found.where("record_type = 'revisit'").join(sizes, met, "left").withColumn("_own", F.col("_size"))
    columns = ["page_id", F.col("_own").alias("payload_bytes"), "payload_digest", "record_type", "refers_to"]
    return found.where("record_type = 'response'").select(*columns).union(revisits.select(*columns))
