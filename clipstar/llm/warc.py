"""WARC archives of dictionary-compressed records.

Each archive is a ``.warc.zst`` file: a skippable frame that holds a Zstandard dictionary, then one Zstandard frame per
record, compressed with that dictionary.  The dictionary is built from the archive's own first records (at most
``SAMPLE_BYTES`` of them), so a reader needs the file alone, and records stay independent of each other.

Of records with equal payloads the one with the smallest page_id is a response, the others are revisits that name it by
record id and carry no payload.  Groups are found by SHA-1 and length in an aggregate with a map-side part; only the
groups of two and more come back to the pages by a join, whose skewed keys are split.

A task writes one archive after the other, ``ARCHIVE_BYTES`` of records each, under names of its own; only the
archives of committed attempts get into the manifest table, so a lost executor or a repeated task leaves at
most files that nobody reads.  Files are opened through pyarrow's file systems on the folder in spark.checkpoint.dir or
the given one, which all executors must share.  Reading streams frame by frame.

Defined cases: a null html is an empty payload; a null url gives a record without target; a null page_id is written as a
record without a page number, which is a response only if no row with the same payload has one; rows that repeat both
page_id and payload of the smallest id are all responses; an empty table gives no archive and an empty result; line
breaks in urls are percent-encoded; other columns are not read.
"""
from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipstar.llm.common import Saved, prepare

DICTIONARY_MAGIC = 0x184D2A5D  # the skippable frame of a dictionary
DICTIONARY_BYTES = 64 << 10
SAMPLE_BYTES = 2 << 20
ARCHIVE_BYTES = 256 << 20
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_MANIFEST = "path string, records long, record_bytes long, file_bytes long, dictionary_bytes long"
_RECORDS = ("page_id long, target_uri string, payload_bytes long, payload_digest string, record_type string, "
            "refers_to long, payload binary")


def file_system(uri: str):
    """The file system of a folder and the folder's path there."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def make_record(page_id: int | None, url: str | None, payload: bytes, revisit: bool, refers_to: int | None) -> bytes:
    digest = base32_sha1(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() if revisit else http.encode() + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page_id, digest)),
              ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    fields += [("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", str(len(payload)))]
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, digest)),
                   ("X-Refers-To-Page-ID", str(refers_to))]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple:
    """A row of ``_RECORDS``; raises ValueError if lengths or the digest don't fit."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    size = int(fields["Content-Length"])
    if lines[0] != "WARC/1.1" or rest[size:] != b"\r\n\r\n":
        raise ValueError("not a whole WARC record")
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    payload = None
    if kind == "response":
        payload = rest[:size].partition(b"\r\n\r\n")[2]
        if len(payload) != int(fields["X-Payload-Length"]) or base32_sha1(payload) != digest:
            raise ValueError("a payload differs from its digest")
    page, refers = fields.get("X-Page-ID"), fields.get("X-Refers-To-Page-ID")
    return (page and int(page), fields.get("WARC-Target-URI"), int(fields["X-Payload-Length"]), digest, kind,
            refers and int(refers), payload)


def build_dictionary(samples: list[bytes]):
    """A trained dictionary, or the samples themselves as one where they are too few to train on."""
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(samples)[-DICTIONARY_BYTES:],
                                             dict_type=zstandard.DICT_TYPE_RAWCONTENT)


class ArchiveWriter:
    """One archive; the first records wait for the dictionary that is built from them."""

    def __init__(self, stream):
        self.stream, self.waiting, self.compressor = stream, [], None
        self.records = self.record_bytes = self.file_bytes = self.dictionary_bytes = self.waiting_bytes = 0

    def _write(self, data: bytes) -> None:
        self.stream.write(data)
        self.file_bytes += len(data)

    def _start(self) -> None:
        import zstandard

        dictionary = build_dictionary(self.waiting)
        body = dictionary.as_bytes()
        self.dictionary_bytes = len(body)
        self._write(struct.pack("<II", DICTIONARY_MAGIC, len(body)) + body)
        dictionary.precompute_compress(level=LEVEL)
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_checksum=True)
        for record in self.waiting:
            self._write(self.compressor.compress(record))
        self.waiting = []

    def add(self, record: bytes) -> None:
        self.records += 1
        self.record_bytes += len(record)
        if self.compressor is not None:
            self._write(self.compressor.compress(record))
            return
        self.waiting.append(record)
        if self.record_bytes >= SAMPLE_BYTES:
            self._start()

    def close(self) -> None:
        if self.compressor is None:
            self._start()
        self.stream.close()


def _write(folder: str, archive_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = file_system(folder)
        path, writer = "", None

        def done() -> pa.RecordBatch:
            writer.close()
            row = (path, writer.records, writer.record_bytes, writer.file_bytes, writer.dictionary_bytes)
            return pa.RecordBatch.from_pylist(
                [dict(zip(("path", "records", "record_bytes", "file_bytes", "dictionary_bytes"), row))])

        for batch in batches:
            html = batch.column("html").cast(pa.binary())
            rows = zip(batch.column("page_id").to_pylist(), batch.column("url").to_pylist(), html,
                       batch.column("revisit").to_pylist(), batch.column("refers_to").to_pylist())
            for page_id, url, payload, revisit, refers_to in rows:
                if writer is None:
                    path = f"{root}/{uuid.uuid4().hex}.warc.zst"
                    writer = ArchiveWriter(system.open_output_stream(path, compression=None))
                writer.add(make_record(page_id, url, payload.as_py(), revisit, refers_to))
                if writer.record_bytes >= archive_bytes:
                    yield done()
                    writer = None
        if writer is not None:
            yield done()
    return run


def read_records(stream) -> Iterator[bytes]:
    """The records of an open archive, one after the other."""
    import zstandard

    magic, size = struct.unpack("<II", stream.read(8))
    if magic != DICTIONARY_MAGIC:
        raise ValueError("no dictionary at the head of the archive")
    body = stream.read(size)
    trained = body[:4] == b"\x37\xa4\x30\xec"
    dictionary = zstandard.ZstdCompressionDict(
        body, dict_type=zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT)
    decompressor = zstandard.ZstdDecompressor(dict_data=dictionary)
    data = stream.read(1 << 16)
    while data:
        frame, out = decompressor.decompressobj(), []
        while True:
            out.append(frame.decompress(data))
            if frame.eof:
                break
            data = stream.read(1 << 16)
            if not data:
                raise ValueError("the archive ends within a record")
        data = frame.unused_data or stream.read(1 << 16)
        yield b"".join(out)


def _read(folder: str, with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = file_system(folder)
        names = [f.split()[0] for f in _RECORDS.split(", ")]
        types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

        def table(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows, held = [], 0
                with system.open_input_stream(path, compression=None) as stream:
                    for data in read_records(stream):
                        row = parse_record(data)
                        rows.append(row if with_payload else (*row[:-1], None))
                        held += len(data) if with_payload else 100
                        if held >= 4 << 20:
                            yield table(rows)
                            rows, held = [], 0
                if rows:
                    yield table(rows)
    return run


def with_revisits(pages: DataFrame, saved: Saved, least_bytes: int = 0) -> DataFrame:
    """page_id, url, html (binary in UTF-8), revisit, refers_to; payloads under ``least_bytes`` are never revisits."""
    rows = pages.select("page_id", "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("html")) \
        .withColumn("sha", F.sha1("html")).withColumn("size", F.octet_length("html"))
    first = saved.small(rows.where(F.col("size") >= least_bytes).groupBy("sha", "size").agg(
        F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and first is not null").select("sha", "size", "first"))
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(first, ["sha", "size"], "left").select(
        "page_id", "url", "html", revisit.alias("revisit"), F.when(revisit, F.col("first")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, saved: Saved, least_bytes: int = 0,
                   archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record per row of ``pages(page_id, url, html)``; the manifest of the archives in ``folder``."""
    system, root = file_system(folder)
    system.create_dir(root, recursive=True)
    records = with_revisits(pages, saved, least_bytes)
    return saved.table(records.mapInArrow(_write(folder, archive_bytes), _MANIFEST))


def read_archives(manifest: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """A row per record of the manifest's archives: page_id, target_uri, payload_bytes, payload_digest, record_type,
    refers_to, payload (null for revisits)."""
    # An archive to a task: by bytes, the few rows of paths would all go to one.
    archives = max(1, manifest.count())
    return manifest.select("path").repartition(archives).mapInArrow(_read(folder, with_payload), _RECORDS)


def archive_round_trip(spark: SparkSession, pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write all pages, read all archives back without the payloads, which are checked against their digests."""
    prepare(spark)
    saved = Saved(spark, "warc")
    folder = folder or saved.path("archives")
    return read_archives(write_archives(pages, folder, saved), folder, with_payload=False)
