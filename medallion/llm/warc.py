"""WARC archives compressed with Zstandard, one frame per record.

An archive starts with a skippable frame that holds the dictionary its frames were
compressed with; then comes one frame per record.  Reading loads the dictionary, finds
each frame's end from its block headers, decodes it by itself and validates it: the frame's
checksum, the record's version line and headers, the block's and the payload's length,
and the digest of what the record carries.

Archives are bounded in size, so a task holds one at a time.  A task that is repeated
writes under a new name, and only the files that successful tasks name are read.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator, Sequence
from urllib.parse import quote, urlsplit

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.llm.common import map_rows, same
from medallion.sources.scratch import Scratch

VERSION = b"WARC/1.1"
# Fixed values of the public file format: the skippable frame of a dictionary, the frame
# magic, and the profile of revisits.
DICTIONARY_FRAME = 0x184D2A5D
FRAME = 0xFD2FB528
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LINE = b"\r\n"
REVISIT_FROM = 1000  # bytes; smaller payloads are always stored
ARCHIVE_BYTES = 32 << 20  # of payload; an archive is closed when it has so many
SAMPLE_BYTES = 1 << 20  # of payload, the dictionary's training sample
DICTIONARY_BYTES = 16 << 10
LEVEL = 3


class CorruptArchive(ValueError):
    """An archive, a frame or a record that does not keep to the format."""


# --- one record ---------------------------------------------------------------------


def record_id(page_id: int | None, digest: str) -> str:
    return uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id} {digest}").urn


def make_record(page_id, url: str | None, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """A ``response`` with the payload, or a ``revisit`` of page ``refers_to`` without it."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<{record_id(page_id, digest)}>"),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{hashlib.sha1(block).hexdigest()}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if page_id is not None:
        headers.append(("X-Page-ID", str(page_id)))
    if url is not None:  # a header is one line of printable characters
        headers.append(("WARC-Target-URI", quote(url, safe="%/:?#[]@!$&'()*+,;=~-._")))
    if refers_to is not None:
        headers += [
            ("WARC-Profile", REVISIT),
            ("WARC-Refers-To", f"<{record_id(refers_to, digest)}>"),
            ("X-Refers-To-Page-ID", str(refers_to)),
        ]
    head = LINE.join([VERSION, *(f"{k}: {v}".encode() for k, v in headers)])
    return head + LINE + LINE + block + LINE + LINE


def _headers(block: bytes) -> dict[str, str]:
    found = {}
    for line in block.split(LINE):
        name, mark, value = line.decode("utf-8").partition(":")
        if not mark or not name.strip():
            raise CorruptArchive(f"no header: {line[:80]!r}")
        found[name.strip().lower()] = value.strip()
    return found


def parse_record(raw: bytes) -> dict:
    """Validated: version, headers, block length, block digest, payload length and digest."""
    head, mark, rest = raw.partition(LINE + LINE)
    version, _, lines = head.partition(LINE)
    if not mark or version != VERSION:
        raise CorruptArchive(f"not a {VERSION.decode()} record: {raw[:40]!r}")
    h = _headers(lines)
    if missing := {"warc-type", "warc-record-id", "warc-date", "content-length", "warc-payload-digest"} - h.keys():
        raise CorruptArchive(f"missing headers {sorted(missing)}")
    length = int(h["content-length"])
    block = rest[:length]
    if len(block) != length or rest[length:] != LINE + LINE:
        raise CorruptArchive(f"block of {length} bytes does not end its record")
    if "warc-block-digest" in h and h["warc-block-digest"] != f"sha1:{hashlib.sha1(block).hexdigest()}":
        raise CorruptArchive("block digest differs")
    http, mark, payload = block.partition(LINE + LINE)
    if not mark or not http.startswith(b"HTTP/"):
        raise CorruptArchive("no HTTP headers")
    size, digest = int(_headers(http.partition(LINE)[2])["content-length"]), h["warc-payload-digest"].removeprefix("sha1:")
    kind = h["warc-type"]
    if kind == "response":
        if len(payload) != size or hashlib.sha1(payload).hexdigest() != digest:
            raise CorruptArchive("payload length or digest differs")
    elif kind != "revisit" or payload or "x-refers-to-page-id" not in h:
        raise CorruptArchive(f"bad {kind} record")
    return {
        "page_id": int(h["x-page-id"]) if "x-page-id" in h else None,
        "url": h.get("warc-target-uri"),
        "payload": payload if kind == "response" else None,
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": int(h["x-refers-to-page-id"]) if kind == "revisit" else None,
    }


# --- one archive --------------------------------------------------------------------


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """Empty (no dictionary) if the samples are too few or too alike to train on."""
    if sum(map(len, samples)) < 8 * size or len(samples) < 8:
        return b""
    try:
        return zstandard.train_dictionary(size, samples, d=8, k=256, steps=1).as_bytes()
    except zstandard.ZstdError:
        return b""


def build_archive(records: list[bytes], dictionary: bytes, level: int = LEVEL) -> bytes:
    with_dictionary = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
    compressor = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True, **with_dictionary)
    lead = struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary
    return lead + b"".join(map(compressor.compress, records))


def frame_end(data: memoryview, start: int) -> int:
    """Where the frame at ``start`` ends, from its header and its blocks' headers."""
    if len(data) - start < 6 or int.from_bytes(data[start : start + 4], "little") != FRAME:
        raise CorruptArchive(f"no frame at byte {start}")
    try:
        at = start + zstandard.frame_header_size(data[start : start + 18])
        checksum = zstandard.get_frame_parameters(data[start : start + 18]).has_checksum
    except zstandard.ZstdError as error:
        raise CorruptArchive(f"bad frame header at byte {start}") from error
    last = False
    while not last:
        if at + 3 > len(data):
            raise CorruptArchive("the last frame is cut off")
        header = int.from_bytes(data[at : at + 3], "little")
        last, kind, size = bool(header & 1), header >> 1 & 3, header >> 3
        at += 3 + (1 if kind == 1 else size)  # a run-length block stores one byte
    at += 4 if checksum else 0
    if at > len(data):
        raise CorruptArchive("the last frame is cut off")
    return at


def read_archive(content: bytes) -> Iterator[dict]:
    """The records of an archive, in order; anything malformed raises ``CorruptArchive``."""
    if len(content) < 8:
        raise CorruptArchive("no dictionary frame")
    magic, size = struct.unpack_from("<II", content)
    if magic != DICTIONARY_FRAME or 8 + size > len(content):
        raise CorruptArchive("no dictionary frame")
    data, at = memoryview(content), 8 + size
    dictionary = bytes(data[8:at])
    if dictionary[:4] == struct.pack("<I", FRAME):  # the dictionary itself may be a frame
        dictionary = zstandard.ZstdDecompressor().decompress(dictionary)
    with_dictionary = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
    decompressor = zstandard.ZstdDecompressor(**with_dictionary)
    while at < len(data):
        end = frame_end(data, at)
        try:
            raw = decompressor.decompress(data[at:end])
        except zstandard.ZstdError as error:
            raise CorruptArchive(f"frame at byte {at}: {error}") from error
        yield parse_record(raw)
        at = end


# --- tables -------------------------------------------------------------------------


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` as a URI; without a scheme it lies in Spark's default file system."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    default = hadoop.FileSystem.getDefaultUri(spark._jsc.hadoopConfiguration())
    return hadoop.Path(path).makeQualified(default, hadoop.Path("/")).toUri().toString()


def located(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a URI, and the path in it; for tasks."""
    scheme = urlsplit(uri).scheme
    if scheme in ("s3a", "s3n"):  # names of other clients of the same store
        uri = "s3" + uri[len(scheme):]
    return pyarrow.fs.FileSystem.from_uri(uri)


def decide(pages: DataFrame, revisit_from: int = REVISIT_FROM) -> DataFrame:
    """Pages (id, url, body) with ``digest`` and ``refers_to`` (null: store the payload).

    Of equal payloads of at least ``revisit_from`` bytes, those with the largest id are
    stored.  Only digests and ids are grouped; digests that occur once drop out before the join.
    """
    hashed = pages.withColumn("digest", F.sha1(F.col("body").cast("binary")))
    large = hashed.filter(F.octet_length("body") >= revisit_from).select("digest", "id")
    repeated = large.groupBy("digest").agg(F.count("*").alias("n"), F.max("id").alias("largest")).filter("n > 1")
    refers = F.when(~same(F.col("id"), F.col("largest")), F.col("largest"))
    return hashed.join(repeated, "digest", "left").select("id", "url", "body", "digest", refers.alias("refers_to"))


def write_archives(
    pages: DataFrame, folder: str, date: str, id_col: str = "page_id", url_col: str = "url", body_col: str = "html",
    revisit_from: int = REVISIT_FROM, archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Writes ``*.warc.zst`` below ``folder``; one row (path, n_records, size) per archive.

    ``folder`` must be one that every executor reaches, as a URI or an absolute path; without
    a scheme it lies in Spark's default file system, and the paths returned are URIs in any case.
    Each evaluation of the result writes the archives; store the rows, and read only the
    archives they name.  A null body is an empty payload; a null url or id has no header.
    """
    target = qualified(pages.sparkSession, folder)
    picked = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.coalesce(F.col(body_col), F.lit("")).alias("body")
    )
    decided = decide(picked, revisit_from)

    def make(rows: Iterator[dict]) -> Iterator[tuple]:
        system, root = located(target)
        system.create_dir(root, recursive=True)
        held: list[bytes] = []
        samples: list[bytes] = []
        size = sampled = 0

        def close() -> tuple:
            name = f"{uuid.uuid4().hex}.warc.zst"
            content = build_archive(held, train_dictionary(samples))
            with system.open_output_stream(f"{root}/{name}", compression=None) as out:
                out.write(content)
            return f"{target}/{name}", len(held), len(content)

        for row in rows:
            payload = row["body"].encode("utf-8", "surrogatepass")
            record = make_record(row["id"], row["url"], payload, row["digest"], row["refers_to"], date)
            held.append(record)
            size += len(record)
            if sampled < SAMPLE_BYTES:
                samples.append(record[: 64 << 10])
                sampled += len(samples[-1])
            if size >= archive_bytes:
                yield close()
                held, samples, size, sampled = [], [], 0, 0
        if held:
            yield close()

    return map_rows(decided, "path string, n_records long, size long", make)


def read_archives(spark: SparkSession, archives: DataFrame | Sequence[str]) -> DataFrame:
    """One row per record of the named archives; a malformed or missing one fails the job.

    ``archives`` has the archives' URIs in its column ``path``, as ``write_archives`` returns them.
    The rows are dealt to tasks, which open one archive after the other: neither the names nor a
    listing of the folder pass through the driver.
    """
    schema = (
        "page_id long, url string, payload binary, payload_bytes long, payload_digest string,"
        " record_type string, refers_to long"
    )
    if not isinstance(archives, DataFrame):
        archives = spark.createDataFrame([(qualified(spark, path),) for path in archives], "path string")
    tasks = min(archives.count(), int(spark.conf.get("spark.sql.shuffle.partitions")))
    files = archives.select("path").repartition(max(tasks, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.rsplit(" ", 1)[0].strip() for c in schema.split(",")]
        types = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()]

        def batch(held):
            return pa.RecordBatch.from_arrays(
                [pa.array([r[n] for r in held], t) for n, t in zip(names, types, strict=True)], names
            )

        for files_ in batches:
            for path in files_.column(0).to_pylist():
                system, name = located(path)
                with system.open_input_stream(name, compression=None) as opened:
                    content = opened.read()
                held, size = [], 0
                for record in read_archive(content):
                    held.append(record)
                    size += len(record["payload"] or b"")
                    if len(held) >= 5_000 or size >= 8 << 20:
                        yield batch(held)
                        held, size = [], 0
                if held:
                    yield batch(held)

    return files.mapInArrow(run, schema)


def round_trip(
    pages: DataFrame, date: str = "2025-01-01T00:00:00Z", id_col: str = "page_id", url_col: str = "url", body_col: str = "html",
) -> DataFrame:
    """Writes ``pages`` as archives into the session's scratch folder and reads them back.

    One row per input row, as ``read_archives`` gives it.  Repeated rows are records of
    their own; those with the largest id of their payload are all stored.  A null id is
    smaller than any other.  An empty table gives an empty result.
    """
    spark = pages.sparkSession
    scratch = Scratch(spark, "warc")
    written = scratch.keep(write_archives(pages, scratch.location("archives"), date, id_col, url_col, body_col), "manifest")
    return read_archives(spark, written)


# What op6_warc returns, for DuckDB over the table ``pages``.
ORACLE = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS body, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
    sha1(coalesce(html, '')) AS payload_digest FROM pages
), largest AS (
  SELECT *, max(page_id) OVER (PARTITION BY body) AS top FROM payloads
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM top THEN top END AS refers_to
FROM largest
"""
