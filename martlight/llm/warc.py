"""WARC archives in Zstandard, one frame a record, with a shared dictionary in front."""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

# Fixed values of the formats: a skippable frame that holds a dictionary, an empty skippable
# frame, the marks of a dictionary and of a frame, and the profile of a revisit.
DICTIONARY_FRAME = 0x184D2A5D
EMPTY_FRAME = struct.pack("<II", 0x184D2A50, 0)
DICTIONARY_MARK = struct.pack("<I", 0xEC30A437)
FRAME_MARK = struct.pack("<I", 0xFD2FB528)
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# The dictionary: its size, and the sample of records that it is built from.
DICTIONARY_BYTES = 112_640
SAMPLE_RECORDS = 1000
SAMPLE_BYTES = 16_384
# An archive is closed once it holds so many bytes; it is one row for Spark's writer and readers.
ARCHIVE_BYTES = 1 << 25
_HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_BATCH_BYTES = 1 << 25


def build_dictionary(pages: DataFrame, payload: str) -> bytes:
    """A dictionary from about SAMPLE_RECORDS different payloads, chosen by their hash.

    The share of hash values that are chosen falls as the table grows; copies are one payload, and
    never more than twice SAMPLE_RECORDS are fetched, the first SAMPLE_BYTES of each. The
    sample sets how well records compress and nothing else. Where it is too small to be trained on,
    its text itself is the dictionary; without records it is empty.
    """
    share = min(1.0, SAMPLE_RECORDS / max(1, pages.count()))
    text = F.coalesce(F.col(payload), F.lit(""))
    rows = (
        pages.select(F.shiftrightunsigned(F.xxhash64(text), 11).alias("hash"), F.substring(text, 1, SAMPLE_BYTES).alias("head"))
        .where(F.col("hash") < int(share * (1 << 53)))
        .groupBy("hash")
        .agg(F.min("head").alias("head"))
        .limit(2 * SAMPLE_RECORDS)
        .collect()
    )
    samples = [_HTTP_HEAD + r["head"].encode() for r in sorted(rows)]
    if not samples:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES]


def _dictionary(content: bytes) -> zstandard.ZstdCompressionDict | None:
    if not content:
        return None
    full = content.startswith(DICTIONARY_MARK)
    return zstandard.ZstdCompressionDict(
        content, dict_type=zstandard.DICT_TYPE_FULLDICT if full else zstandard.DICT_TYPE_RAWCONTENT
    )


def _field(value: str) -> str:
    """A header value on one line."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record_id(key: object, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{key}:{digest}')}>"


def record(
    key: object, url: str | None, payload: bytes | None, digest: str, length: int, first: object, date: str
) -> bytes:
    """One record; a ``payload`` of None makes a revisit of the record with key ``first``."""
    lines = ["WARC/1.1", f"WARC-Type: {'response' if payload is not None else 'revisit'}"]
    lines += [f"WARC-Record-ID: {record_id(key, digest)}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_field(url)}")
    if key is not None:
        lines.append(f"Page-Key: {key}")
    lines += [f"WARC-Payload-Digest: sha1:{digest}", f"Payload-Length: {length}"]
    if payload is None:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(first, digest)}"]
        lines.append(f"Refers-To-Page-Key: {first}")
        block = _HTTP_HEAD
    else:
        block = _HTTP_HEAD + payload
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def mark_revisits(pages: DataFrame, key: str = "page_id", payload: str = "html") -> DataFrame:
    """Add payload_bytes, sha1 (hex) and first_key, the response a page revisits (null: it is one).

    Of pages with equal payloads the one of the least key is the response. Rows that share
    that key are all responses; a null key is the greatest, and without any other key all
    its rows are responses. A null payload is an empty one.
    """
    text = F.coalesce(F.col(payload), F.lit(""))
    rows = pages.withColumns({"payload_bytes": F.octet_length(text).cast("long"), "sha1": F.sha1(text)})
    least = rows.groupBy("sha1").agg(F.min(key).alias("first_key"), F.count(F.lit(1)).alias("copies"))
    # Payloads that stand alone need no look-up.
    least = least.where("copies > 1").drop("copies")
    later = F.coalesce(F.col(key) > F.col("first_key"), F.col("first_key").isNotNull() & F.col(key).isNull())
    return rows.join(least, "sha1", "left").withColumn("first_key", F.when(later, F.col("first_key")))


def write_archives(
    pages: DataFrame,
    path: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    date: str = "2024-01-01T00:00:00Z",
    archive_bytes: int = ARCHIVE_BYTES,
    level: int = 3,
) -> None:
    """Write a record for every page into archives of about ``archive_bytes`` below ``path``.

    An archive is closed by the record that brings it to ``archive_bytes``, so it is larger by less than
    one compressed record. Each starts with the dictionary's frame. It travels as one text line, written to a
    file of its own, whose end is an empty skippable frame, which every reader passes over; so
    Spark's own writer commits the files, on any store, and a task that is lost is written anew.
    """
    columns = [F.col(key).alias("key"), F.col(url).alias("url"), F.col(payload).alias("payload")]
    rows = mark_revisits(pages.select(*columns), "key", "payload")
    body = F.when(F.col("first_key").isNull(), F.coalesce("payload", F.lit("")))
    rows = rows.select("key", "url", body.alias("body"), "sha1", "payload_bytes", "first_key")
    content = build_dictionary(pages, payload)
    head = struct.pack("<II", DICTIONARY_FRAME, len(content)) + content

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=level, dict_data=_dictionary(content), write_checksum=True)
        archive = bytearray()
        for batch in batches:
            for row in zip(*batch.columns):
                key, url, body, sha1, size, first = (v.as_py() for v in row)
                digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                payload = None if body is None else body.encode()
                if not archive:
                    archive += head
                archive += packer.compress(record(key, url, payload, digest, size, first, date))
                if len(archive) >= archive_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([bytes(archive)], type=pa.binary())], names=["archive"])
                    archive = bytearray()
        if archive:
            yield pa.RecordBatch.from_arrays([pa.array([bytes(archive)], type=pa.binary())], names=["archive"])

    archives = rows.mapInArrow(compress, "archive binary").select(F.col("archive").cast("string").alias("value"))
    archives.write.options(lineSep=EMPTY_FRAME.decode(), maxRecordsPerFile=1).text(path)


def frame_end(raw: bytes, at: int) -> int:
    """Where the frame that starts at ``at`` ends."""
    if raw[at : at + 4] != FRAME_MARK:
        return at + 8 + struct.unpack_from("<I", raw, at + 4)[0]
    head = raw[at : at + 18]
    end = at + zstandard.frame_header_size(head)
    last = False
    while not last:
        block = int.from_bytes(raw[end : end + 3], "little")
        last, kind, size = bool(block & 1), block >> 1 & 3, block >> 3
        end += 3 + (1 if kind == 1 else size)
    return end + 4 * zstandard.get_frame_parameters(head).has_checksum


def read_frames(raw: bytes) -> Iterator[bytes]:
    """The records of one archive."""
    at, unpacker = 0, zstandard.ZstdDecompressor()
    while at < len(raw):
        end = frame_end(raw, at)
        if struct.unpack_from("<I", raw, at)[0] == DICTIONARY_FRAME:
            unpacker = zstandard.ZstdDecompressor(dict_data=_dictionary(raw[at + 8 : end]))
        elif raw[at : at + 4] == FRAME_MARK:
            yield unpacker.decompress(raw[at:end])
        at = end


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields of a record and its payload, checked against its length and digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    if fields["WARC-Type"] == "response":
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if fields["WARC-Payload-Digest"] != f"sha1:{digest}" or int(fields["Payload-Length"]) != len(payload):
            raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    return fields, payload


RECORDS = StructType(
    [
        StructField("page_key", StringType()),
        StructField("record_type", StringType()),
        StructField("record_id", StringType()),
        StructField("target_uri", StringType()),
        StructField("payload_digest", StringType()),
        StructField("payload_bytes", LongType()),
        StructField("refers_to_key", StringType()),
        StructField("payload", BinaryType()),
    ]
)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives below ``path``; a revisit's payload is empty."""

    kinds = [pa.string()] * 5 + [pa.int64(), pa.string(), pa.binary()]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows, held = [], 0

                def flush():
                    arrays = [pa.array(c, type=k) for c, k in zip(zip(*rows), kinds)]
                    return pa.RecordBatch.from_arrays(arrays, names=RECORDS.names)

                for raw in read_frames(content.as_py()):
                    fields, payload = parse_record(raw)
                    rows.append(
                        (
                            fields.get("Page-Key"),
                            fields["WARC-Type"],
                            fields["WARC-Record-ID"],
                            fields.get("WARC-Target-URI"),
                            fields["WARC-Payload-Digest"].removeprefix("sha1:"),
                            int(fields["Payload-Length"]),
                            fields.get("Refers-To-Page-Key"),
                            payload,
                        )
                    )
                    held += len(payload)
                    if held >= _BATCH_BYTES:
                        yield flush()
                        rows, held = [], 0
                if rows:
                    yield flush()

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(parse, RECORDS)
