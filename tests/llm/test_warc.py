import struct

from martforge.llm import warc
from martforge.session import new_work_dir


def pages(spark):
    return spark.createDataFrame(
        [(1, "http://a", "abc", "x"), (2, None, "abc", "x"), (2, "x\r\ny%", "abc", None), (None, "q", "abc", "x"),
         (3, "a", None, "x"), (None, "a", "", "x"), (7, "z", "é" * 1_000_000, "x")],
        "page_id bigint, url string, html string, bundle string")


def test_round_trip_and_random_access(spark):
    path = new_work_dir(spark, "warc-test")
    warc.write_archives(pages(spark).coalesce(2), path, frame_bytes=400, bundle_bytes=300)
    index = warc.read_archives(spark, path)
    rows = {(r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in index.collect()}
    assert rows == {(1, 3, "response", None), (2, 3, "revisit", 1), (None, 3, "revisit", 1), (3, 0, "response", None),
                    (None, 0, "revisit", 3), (7, 2_000_000, "response", None)}
    assert index.count() == 7 and index.select("bundle").distinct().count() > 2
    got = warc.fetch_records(spark, path, index, index.filter("page_id = 7 or page_id = 1").select("record_id"))
    assert {bytes(r.payload) for r in got.collect()} == {b"abc", ("é" * 1_000_000).encode()}


def test_small_payloads_can_all_be_stored(spark):
    path = new_work_dir(spark, "warc-test")
    warc.write_archives(pages(spark), path, min_revisit_bytes=4)
    assert {r.record_type for r in warc.read_archives(spark, path).collect()} == {"response"}


def test_bundle_is_a_chain_of_frames_with_a_seek_table():
    writer = warc.BundleWriter("b", 1000, warc.DATE)
    records = [warc.page_record(i, f"u{i}", bytes([65 + i]) * 700, None) for i in range(5)]
    for r in records:
        writer.add(r)
    bundle = writer.close()
    table = warc.seek_table(bundle)
    frames = [warc.read_frame(bundle, e) for e in table]
    assert len(frames) > 3 and b"".join(frames).endswith(b"".join(records))
    magic, size = struct.unpack_from("<II", bundle, table[-1][0] + table[-1][1])
    assert magic == 0x184D2A5E and size == len(bundle) - table[-1][0] - table[-1][1] - 8
    # every frame opens alone and starts with a record
    assert all(f.startswith(b"WARC/1.1\r\n") for f in frames)
    headers, block, _ = warc.parse_record(frames[1], 0)
    assert warc.page_of(headers["WARC-Record-ID"]) == 1 or headers["WARC-Type"] == "response"
    assert warc.http_parts(block)[0] == 700


def test_empty_table(spark):
    assert warc.archive_pages(pages(spark).limit(0)).count() == 0
