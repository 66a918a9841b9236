import base64
import hashlib
import io
import random

import zstandard

from clipstar.llm import warc
from clipstar.llm.common import Saved, prepare

SCHEMA = "page_id long, url string, html string, sha string, size string, first string, revisit string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], SCHEMA)


def brute(rows):
    out = []
    for i, _, h in rows:
        same = [j for j, _, g in rows if (g or "") == (h or "") and j is not None]
        b = (h or "").encode()
        first = min(same) if same else None
        revisit = first is not None and i != first
        out.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(),
                    "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


def cases():
    rng = random.Random(1)
    rows = [(i, f"http://h{i % 5}.example.com/{i}", "<p>" + " ".join(rng.choice("abé") * 9 for _ in range(rng.randint(1, 60))))
            for i in range(300)]
    rows += [(1000 + i, "http://copy", rows[i % 20][2]) for i in range(60)]
    return rows + [(2000, None, None), (2001, "a\r\nb", ""), (None, "x", rows[0][2]), (None, "y", "only null id"),
                   (2002, "z", "w" * 300_000), (5, "http://h0.example.com/5", rows[5][2]), (2003, "q", "a\r\n\r\nb\r\n\r\n")]


def test_round_trip(spark):
    prepare(spark)
    rows = cases()
    saved = Saved(spark, "warc-test")
    folder = saved.path("archives")
    manifest = warc.write_archives(frame(spark, rows), folder, saved, archive_bytes=20_000)
    got = warc.read_archives(manifest, folder).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) \
        == brute(rows)
    payloads = {(i, (h or "").encode()) for i, _, h in rows}
    assert all((r.page_id, bytes(r.payload)) in payloads for r in got if r.record_type == "response")
    assert all(r.payload is None for r in got if r.record_type == "revisit")
    assert manifest.count() > 4 and manifest.agg({"records": "sum"}).first()[0] == len(rows)
    assert {r.target_uri for r in got if r.page_id == 2001} == {"a%0D%0Ab"}


def test_empty_table_and_least_bytes(spark):
    assert warc.archive_round_trip(spark, frame(spark, [])).collect() == []
    saved = Saved(spark, "warc-test")
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")]
    got = warc.with_revisits(frame(spark, rows), saved, least_bytes=3).collect()
    assert {r.page_id: r.refers_to for r in got} == {1: None, 2: None, 3: None, 4: 3}


class Kept(io.BytesIO):
    def close(self):
        self.data = self.getvalue()


def test_archive_is_a_dictionary_frame_and_one_frame_per_record():
    records = [warc.make_record(i, f"http://example.com/{i}", f"<html><body>page {i} ".encode() * 50, False, None)
               for i in range(3000)]
    out = Kept()
    writer = warc.ArchiveWriter(out)
    for r in records:
        writer.add(r)
    writer.close()
    assert out.data[:4] == (0x184D2A5D).to_bytes(4, "little")
    size = int.from_bytes(out.data[4:8], "little")
    assert out.data[8:12] == b"\x37\xa4\x30\xec" and writer.dictionary_bytes == size
    d = zstandard.ZstdCompressionDict(out.data[8:8 + size])
    first = zstandard.ZstdDecompressor(dict_data=d).decompressobj()
    assert first.decompress(out.data[8 + size:]) == records[0]
    assert list(warc.read_records(io.BytesIO(out.data))) == records


def test_damage_is_noticed():
    record = warc.make_record(1, "u", b"payload", False, None)
    for bad in (record.replace(b"payload", b"Payload"), record[:-1]):
        try:
            warc.parse_record(bad)
            raise AssertionError
        except ValueError:
            pass
