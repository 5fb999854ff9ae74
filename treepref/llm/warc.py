"""Operator 10, WARC: dictionary-compressed writer and its reader.

A dictionary is trained from a bounded sample of the records to be archived
(``SAMPLE`` records of at most ``SAMPLE_BYTES`` each, those whose id hashes
lowest; the bounds concern the dictionary alone, every record is archived).
Each file begins with a skippable frame that holds it, and then has one
Zstandard frame for each record, so that a record can be read from its own
offset.  Equal payloads are stored once: the record with the largest id is the
response, the others are revisit records that name it.

Payloads meet by their SHA-1: copies are counted by a partial aggregate before
the shuffle, and only (id, digest) rows take part.  The pages are shuffled once, by
(id, digest).

Defined results: one record for every row.  A null payload is an empty one; a null
url is written as ``urn:x-none``; a record with a null id has no page header and
reads as a null id.  Of rows with equal id and payload one is the response, if no larger
id has that payload, and the others revisit it.  Rows with a null id revisit the
largest id that has their payload; where none has one, they are all responses.  An
empty table writes nothing and reads as no rows.
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
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from treepref.llm.files import make_folder, write_file

#: Fixed value: the skippable frame that holds the dictionary.
SKIPPABLE = 0x184D2A5D
SAMPLE = 1000
SAMPLE_BYTES = 16_384
DICTIONARY_BYTES = 65_536
FILE_BYTES = 32 << 20
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(page: int | None, digest: str, copy: int = 0) -> str:
    """Name of the record of a page's payload; ``copy`` counts rows that repeat."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page}:{digest}:{copy}')}>"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, copy: int = 0) -> bytes:
    """A response record, or a revisit record that keeps the HTTP head only."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
            ).encode()
    block = http if refers_to is not None else http + payload
    # A url may hold line ends; a header may not.
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else "urn:x-none"
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {record_id(page, digest, copy)}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}",
            f"WARC-Payload-Digest: sha1:{digest}", *([] if page is None else [f"WARC-Page-Id: {page}"]),
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if refers_to is not None:
        head[6:6] = [f"WARC-Refers-To: {record_id(refers_to, digest)}", f"WARC-Refers-To-Page-Id: {refers_to}",
                     f"WARC-Profile: {_PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, block) of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    return fields, rest[:int(fields["Content-Length"])]


def train(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary from records; where there are too few to train on, their text itself."""
    try:
        return zstandard.train_dictionary(size, samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def frame(dictionary: bytes) -> bytes:
    """The dictionary, compressed, as a skippable frame."""
    data = zstandard.ZstdCompressor().compress(dictionary)
    return struct.pack("<II", SKIPPABLE, len(data)) + data


def records(data: bytes) -> Iterator[bytes]:
    """The records of a file."""
    magic, size = struct.unpack_from("<II", data)
    if magic != SKIPPABLE:
        raise ValueError("no dictionary at the head of the file")
    dictionary = zstandard.ZstdDecompressor().decompress(data[8:8 + size])
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
    rest = memoryview(data)[8 + size:]
    while rest:
        one = reader.decompressobj()
        yield one.decompress(rest)
        rest = memoryview(one.unused_data)


def _with_roles(pages: DataFrame, least: int, parts: int) -> DataFrame:
    """(page, url, html, refers_to, again) with the response of equal payloads for its revisits, dealt into ``parts``.

    ``again``: the row is one of several that could be the response; they lie in one part."""
    html = F.coalesce("html", F.lit(""))
    # A null id is a name of its own, so that it joins.
    named = pages.withColumns({"name": F.coalesce(F.col("page").cast("string"), F.lit("")),
                               "d": F.unhex(F.sha1(html.cast("binary")))})
    held = named.where(F.octet_length(html) >= least).groupBy("name", "page", "d").agg(F.count("*").alias("c"))
    top = held.groupBy("d").agg(F.max("page").alias("top"), F.sum("c").alias("all")).where(F.col("all") > 1).drop("all")
    roles = held.join(top, "d").where(F.col("top").isNotNull() & (F.col("page").isNull() | (F.col("page") != F.col("top")) | (F.col("c") > 1)))
    roles = roles.select("name", "d", F.col("top").alias("refers_to"), F.col("page").eqNullSafe(F.col("top")).alias("again"))
    return named.repartition(parts, "name", "d").join(roles, ["name", "d"], "left").select("page", "url", "html", "refers_to", "again")


def write_warcs(df: DataFrame, folder: str, id: str = "page_id", url: str = "url", html: str = "html", least: int = 0,
                file_bytes: int = FILE_BYTES) -> None:
    """Archive every row as files of ``folder``; payloads of at least ``least`` bytes are stored once."""
    make_folder(df.sparkSession, folder)
    pages = df.select(F.col(id).cast("long").alias("page"), F.col(url).alias("url"), F.col(html).alias("html"))
    size, rows_n = pages.agg(F.sum(F.octet_length("html")), F.count("*")).first()
    if not rows_n:
        return
    chosen = [r[0] for r in pages.select("page").orderBy(F.xxhash64("page")).limit(SAMPLE).collect()]
    sample = pages.where(F.col("page").isin(chosen)).select(
        "page", "url", F.substring("html", 1, SAMPLE_BYTES).alias("html")).limit(2 * SAMPLE).collect()
    samples = []
    for r in sample:
        payload = (r["html"] or "").encode()[:SAMPLE_BYTES]
        samples.append(record(r["page"], r["url"], payload, sha1_base32(payload), None))
    dictionary = train(samples)
    head = frame(dictionary)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out, size, n = TaskContext.get().partitionId(), [], 0, 0
        seen: dict[tuple[int, str], int] = {}
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary))

        def flush() -> None:
            nonlocal out, size, n
            if out:
                write_file(folder, f"pages-{part:06d}-{n:06d}.warc.zst", head + b"".join(out))
                out, size, n = [], 0, n + 1

        for b in batches:
            for page, address, text, refers, again in zip(*(c.to_pylist() for c in b.columns)):
                payload = (text or "").encode()
                digest, copy = sha1_base32(payload), 0
                if again:
                    copy = seen[page, digest] = seen.get((page, digest), -1) + 1
                    refers = refers if copy else None
                out.append(packer.compress(record(page, address, payload, digest, refers, copy)))
                size += len(payload)
                if size >= file_bytes:
                    flush()
        flush()
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["files"])

    roles = _with_roles(pages, least, max(1, -(-int(size or 0) // file_bytes)))
    roles.mapInArrow(write, "files long").agg(F.sum("files")).collect()


def read_warcs(spark: SparkSession, folder: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, url, file) of every record.

    A response's payload is checked against its digest.
    """
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, data in zip(b.column(0).to_pylist(), b.column(1)):
                out = []
                for raw in records(data.as_buffer().to_pybytes()):
                    head, block = parse(raw)
                    http, _, payload = block.partition(b"\r\n\r\n")
                    length = int(re.search(rb"\nContent-Length: (\d+)", http)[1])
                    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                    if head["WARC-Type"] == "response" and (len(payload) != length or sha1_base32(payload) != digest):
                        raise ValueError(f"{name}: payload and digest differ")
                    page, refers = head.get("WARC-Page-Id"), head.get("WARC-Refers-To-Page-Id")
                    out.append((page and int(page), length, digest, head["WARC-Type"],
                                refers and int(refers), head["WARC-Target-URI"], name.rpartition("/")[2]))
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 7, kinds)],
                    ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "file"])

    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder).select("path", "content")
    return found.mapInArrow(rows, "page_id long, payload_bytes long, payload_digest string, record_type string, "
                                  "refers_to long, url string, file string")
