import hashlib
import io
import struct

import pytest
import zstandard

from medallion.llm import queries, warc
from verification.compare import connect, differences

DATE = "2025-01-01T00:00:00Z"
SCHEMA = "page_id long, url string, html string, digest string"


def archive(n=20, dictionary=True):
    payloads = [f"<html>{'common words of all pages ' * 60}{i * 977}</html>".encode() for i in range(n)]
    records = [warc.make_record(i, f"http://x/{i}", p, hashlib.sha1(p).hexdigest(), None, DATE) for i, p in enumerate(payloads)]
    return payloads, warc.build_archive(records, warc.train_dictionary(records, 1024) if dictionary else b"")


@pytest.mark.parametrize("dictionary", [True, False])
def test_records_come_back(dictionary):
    payloads, content = archive(dictionary=dictionary)
    assert (struct.unpack_from("<I", content, 4)[0] > 0) == dictionary
    read = list(warc.read_archive(content))
    assert [r["payload"] for r in read] == payloads
    assert [r["url"] for r in read] == [f"http://x/{i}" for i in range(len(payloads))]


def test_another_reader_agrees():
    """The library's own frame-crossing reader sees the same records, one frame each."""
    payloads, content = archive()
    size = struct.unpack_from("<I", content, 4)[0]
    context = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content[8 : 8 + size]))
    whole = context.stream_reader(io.BytesIO(content[8 + size :]), read_across_frames=True).read()
    assert whole.count(b"WARC/1.1\r\n") == len(payloads)
    at, ends = 8 + size, []
    while at < len(content):
        at = warc.frame_end(memoryview(content), at)
        ends.append(at)
    assert len(ends) == len(payloads) and ends[-1] == len(content)


def test_a_compressed_dictionary_is_loaded():
    payloads, content = archive()
    size = struct.unpack_from("<I", content, 4)[0]
    packed = zstandard.ZstdCompressor().compress(content[8 : 8 + size])
    again = struct.pack("<II", warc.DICTIONARY_FRAME, len(packed)) + packed + content[8 + size :]
    assert [r["payload"] for r in warc.read_archive(again)] == payloads


def test_damage_is_found():
    _, content = archive()
    start = 8 + struct.unpack_from("<I", content, 4)[0]
    for bad in (b"", content[:7], content[8:], content[:-1], content[: start + 3], content + b"x"):
        with pytest.raises(warc.CorruptArchive):
            list(warc.read_archive(bad))
    for at in range(start, len(content), 37):
        flipped = bytearray(content)
        flipped[at] ^= 0x40
        with pytest.raises((warc.CorruptArchive, zstandard.ZstdError)):
            list(warc.read_archive(bytes(flipped)))


def test_malformed_records_are_refused():
    payload = b"some payload"
    good = warc.make_record(1, "u", payload, hashlib.sha1(payload).hexdigest(), None, DATE)
    assert warc.parse_record(good)["payload"] == payload
    for old, new in [
        (b"WARC/1.1", b"WARC/9.9"), (b"WARC-Date", b"X-Date"), (b"some payload", b"same payload"),
        (b"some payload", b"some payload!"), (b"Type: response", b"Type: revisit"), (b"\r\n\r\n", b"\n\n"),
        (b"WARC-Target-URI: u", b"no colon here"),
    ]:
        with pytest.raises(warc.CorruptArchive):
            warc.parse_record(good.replace(old, new, 1))


def test_query_equals_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    with connect(sf_dir) as connection:
        assert differences(queries.op6_warc(spark, sf_dir), connection, warc.ORACLE) == ""


def test_revisits_nulls_and_repeats(spark):
    long, short = "é" * 500, "s" * 999
    rows = [
        (1, "http://a\r\nb c", long, "x"), (5, None, long, "x"), (3, "u", long, "x"), (None, "u", long, "x"),
        (2, "u", short, "x"), (7, "u", short, "x"), (8, "u", None, "x"), (9, "u", "", "x"),
        (20, "u", long + "!", "x"), (20, "u", long + "!", "x"), (None, "u", "n" * 2000, "x"), (None, "u", "n" * 2000, "x"),
    ]
    read = warc.round_trip(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    got = sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in read), key=repr)
    assert got == sorted(
        [
            (1, 1000, "revisit", 5), (5, 1000, "response", None), (3, 1000, "revisit", 5), (None, 1000, "revisit", 5),
            (2, 999, "response", None), (7, 999, "response", None), (8, 0, "response", None), (9, 0, "response", None),
            (20, 1001, "response", None), (20, 1001, "response", None), (None, 2000, "response", None), (None, 2000, "response", None),
        ],
        key=repr,
    )
    digest = hashlib.sha1(long.encode()).hexdigest()
    assert {r.payload_digest for r in read if r.payload_bytes == 1000} == {digest}
    assert all((r.payload is None) == (r.record_type == "revisit") for r in read)
    assert {r.url for r in read if r.page_id == 1} == {"http://a%0D%0Ab%20c"}


def test_archives_are_bounded_and_named(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", f"{i} " * 4000, "x") for i in range(40)], SCHEMA).coalesce(1)
    made = warc.write_archives(pages, str(tmp_path / "w"), DATE, archive_bytes=100_000).collect()
    assert len(made) > 3 and sum(r.n_records for r in made) == 40
    assert warc.read_archives(spark, [r.path for r in made]).count() == 40


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_folder_without_a_scheme_lies_in_the_default_file_system(spark):
    hadoop = spark._jsc.hadoopConfiguration()
    before = hadoop.get("fs.defaultFS")
    try:
        hadoop.set("fs.defaultFS", "hdfs://somewhere:8020")
        assert warc.qualified(spark, "/data/w") == "hdfs://somewhere:8020/data/w"
        assert warc.qualified(spark, "file:/data/w").startswith("file:/")
        assert warc.qualified(spark, "s3a://bucket/w") == "s3a://bucket/w"
    finally:
        hadoop.set("fs.defaultFS", before)
    assert warc.qualified(spark, "/data/w") == "file:///data/w"


def test_writers_and_readers_use_the_qualified_folder(spark, tmp_path):
    """Also with blanks in its name; files that no row names are not read, a missing one fails."""
    pages = spark.range(30).selectExpr("id AS page_id", "'u' AS url", "repeat('abc', 500) AS html")
    folder = tmp_path / "a b%20c"
    made = warc.write_archives(pages, str(folder), DATE, archive_bytes=10_000).collect()
    assert all(r.path.startswith("file:///") for r in made) and len(list(folder.iterdir())) == len(made) > 1
    (folder / "left-over.warc.zst").write_bytes(b"half")
    named = spark.createDataFrame(made).drop("size")
    assert sorted(r.page_id for r in warc.read_archives(spark, named).collect()) == list(range(30))
    with pytest.raises(Exception, match="FileNotFound|No such file"):
        warc.read_archives(spark, [made[0].path + "x"]).collect()
