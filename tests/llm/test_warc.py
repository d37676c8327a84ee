import base64
import gzip
import hashlib

import pytest

from wayfare.llm.warc import chunked, dechunked, parse_records, read_archives, resolve, write_archives

SCHEMA = "page_id bigint, url string, html string, record_type string, digest string, payload string"
ROWS = [
    (1, "http://a/1", "same" * 9000),
    (2, "http://a/2", "same" * 9000),
    (None, "http://a/none", "same" * 9000),
    (3, None, None),
    (4, "http://a/4\nwith a line\r\n%41", ""),
    (5, "http://a/5", "é\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" * 3000),
    (6, "http://a/6", "x"),
    (6, "http://a/6", "x"),
    (7, "http://a/7", "y" * 40_000),
    (7, "http://a/7", "y" * 40_000),
]


def pages(spark, rows=ROWS):
    return spark.createDataFrame([(*r, None, None, None) for r in rows], SCHEMA)


def written(spark, tmp_path, rows=ROWS, **options):
    folder = str(tmp_path / "archives")
    write_archives(pages(spark, rows), folder, **options)
    return folder


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.mark.parametrize("size", [1, 3, 4096])
def test_chunks_round_trip(size):
    for payload in (b"", b"a", b"abc" * 100, b"0\r\n\r\n"):
        assert dechunked(chunked(payload, size)) == payload
    assert dechunked(b"3;x=1\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"
    with pytest.raises(ValueError):
        dechunked(b"5\r\nabc\r\n0\r\n\r\n")


@pytest.mark.parametrize("segment_bytes", [200, 16 << 10, 1 << 20])
def test_pages_come_back_whole(spark, tmp_path, segment_bytes):
    folder = written(spark, tmp_path, segment_bytes=segment_bytes)
    records = read_archives(spark, folder)
    html = {r[0]: r[2] or "" for r in ROWS}
    for r in records.collect():
        assert r.problem is None
        assert (r.payload is None) == (r.record_type == "revisit")
        if r.payload is not None:
            assert bytes(r.payload).decode() == html[r.page_id]
    found = sorted(((r.page_id, r.url, r.digest, r.record_type, r.target_page, r.payload_bytes) for r in resolve(records).collect()), key=str)
    best = {1: 2, None: 2, 3: 4}
    expected = [
        (i, u, sha(h), "revisit" if i in best else "response", best.get(i), len((h or "").encode())) for i, u, h in ROWS
    ]
    assert found == sorted(expected, key=str)


def test_small_payloads_are_all_responses(spark, tmp_path):
    folder = written(spark, tmp_path, minimum_bytes=2)
    kinds = [(r.page_id, r.record_type) for r in read_archives(spark, folder).collect() if r.page_id in (3, 4)]
    assert sorted(kinds) == [(3, "response"), (4, "response")]


def test_archives_are_plain_warc(spark, tmp_path):
    folder = written(spark, tmp_path, segment_bytes=1000)
    kinds = set()
    for path in (tmp_path / "archives").glob("part-*"):
        for fields, _ in parse_records(gzip.decompress(path.read_bytes())):
            kinds.add(fields["warc-type"])
            assert fields["warc-record-id"].startswith("<urn:uuid:") and "warc-date" in fields
            if fields["warc-type"] == "continuation":
                assert int(fields["warc-segment-number"]) > 1 and "warc-segment-origin-id" in fields
    assert folder and kinds == {"response", "revisit", "continuation"}


def test_missing_segments_are_reported(spark, tmp_path):
    written(spark, tmp_path, [(1, "u", "z" * 5000), (2, "v", "short")], segment_bytes=1000)
    (tmp_path / "broken").mkdir()
    parts = [gzip.decompress(p.read_bytes()) for p in (tmp_path / "archives").glob("part-*")]
    records = [r for p in parts for r in p.split(b"WARC/1.1\r\n")[1:]]
    kept = [r for r in records if b"WARC-Segment-Number: 3" not in r]
    assert len(kept) == len(records) - 1
    (tmp_path / "broken" / "a.warc").write_bytes(b"".join(b"WARC/1.1\r\n" + r for r in kept))
    found = {r.page_id: r for r in read_archives(spark, str(tmp_path / "broken")).collect()}
    assert found[1].payload is None and "missing" in found[1].problem
    assert bytes(found[2].payload) == b"short"


def test_a_page_repeated_a_thousand_times(spark, tmp_path):
    rows = [(7, "http://a/7", "z" * 3000)] * 1000 + [(5, "http://a/5", "z" * 3000), (9, "http://a/9", "other " * 2000)]
    folder = written(spark, tmp_path, rows, segment_bytes=1000)
    records = read_archives(spark, folder)
    found = resolve(records).collect()
    assert len(found) == 1002 and len({r.record_id for r in found}) == 1002 and not any(r.problem for r in found)
    assert [(r.record_type, r.target_page, r.payload_bytes) for r in found if r.page_id == 5] == [("revisit", 7, 3000)]
    assert {(r.record_type, r.target_page, r.payload_bytes) for r in found if r.page_id == 7} == {("response", None, 3000)}
    assert records.filter("page_id = 7").selectExpr("count(distinct payload)", "count(payload)").first()[:] == (1, 1000)


def test_a_very_long_page(spark, tmp_path):
    html = "".join(f"<p>line {i} é</p>\r\n\r\n" for i in range(200_000))
    folder = written(spark, tmp_path, [(1, "u", html), (2, "v", "short")])
    found = {r.page_id: r for r in read_archives(spark, folder).collect()}
    assert bytes(found[1].payload).decode() == html and found[1].problem is None and bytes(found[2].payload) == b"short"


def test_empty_table(spark, tmp_path):
    folder = str(tmp_path / "archives")
    write_archives(pages(spark).limit(0), folder)
    assert resolve(read_archives(spark, folder)).count() == 0
