import hashlib
import zlib
from collections import defaultdict

import pytest
from odd import whole

from noteloom.llm import warc

SMALL = "/root/testdata/sf0.001"


def record(n, size=50):
    return warc.record_bytes(n, f"http://x/{n}", bytes([65 + n % 26]) * size, None)


def read(data):
    found = list(warc.salvage(data))
    pages = [warc._page_of(f[0]["warc-record-id"]) for f in found if len(f) == 2]
    return pages, [f for f in found if len(f) == 3]


def test_clean_file_has_no_gap():
    data = b"".join(warc.member(record(n)) for n in range(5))
    assert read(data) == ([0, 1, 2, 3, 4], [])


@pytest.mark.parametrize("plain", [False, True])
def test_later_records_survive_damage(plain):
    pack = (lambda r: r) if plain else warc.member
    parts = [pack(record(n, 300)) for n in range(6)]
    bad = bytearray(parts[2])
    bad[len(bad) // 2] ^= 0xFF
    data = b"".join([*parts[:2], bytes(bad), *parts[3:]])
    pages, gaps = read(data)
    assert pages == [0, 1, 3, 4, 5]
    start = len(parts[0]) + len(parts[1])
    assert [(a, b) for a, b, _ in gaps] == [(start, start + len(bad))]


def test_garbage_lost_bytes_and_a_cut_end():
    parts = [warc.member(record(n, 300)) for n in range(6)]
    data = b"junk" + parts[0] + parts[1][7:] + parts[2] + b"\x1f\x8b\x08no member" + parts[3] + parts[4][:-9]
    pages, gaps = read(data)
    # Of the last one only the end of the member is missing; the record is whole.
    assert pages == [0, 2, 3, 4]
    assert len(gaps) == 4 and gaps[-1][1] == len(data)
    before = len(data) - len(parts[4][:-9])
    assert sum(b - a for a, b, _ in gaps[:3]) + sum(map(len, (parts[0], parts[2], parts[3]))) == before


@pytest.mark.parametrize("missing", [1, 4, 8])
def test_record_of_a_member_without_its_end(missing):
    parts = [warc.member(noisy(n)) for n in range(2)]
    data = parts[0] + parts[1][:-missing]
    pages, gaps = read(data)
    assert pages == [0, 1]
    assert [why for *_, why in gaps] == [warc.CUT] and gaps[0][0] <= gaps[0][1] == len(data)


def test_member_cut_in_its_record():
    parts = [warc.member(noisy(n)) for n in range(2)]
    pages, gaps = read(parts[0] + parts[1][:-100])
    assert pages == [0]
    assert [(a, b) for a, b, _ in gaps] == [(len(parts[0]), len(parts[0]) + len(parts[1]) - 100)]


def test_member_and_plain_record_mixed():
    assert read(warc.member(record(1)) + record(2) + warc.member(record(3)))[0] == [1, 2, 3]


def noisy(n, size=3000):
    return warc.record_bytes(n, f"http://x/{n}", hashlib.shake_128(b"%d" % n).hexdigest(size).encode(), None)


def test_damaged_record_of_a_member_of_several():
    records = [noisy(n) for n in range(6)]
    bad = records[2].replace(records[2][-20:-10], b"!" * 10)
    pages, gaps = read(warc.member(b"".join([*records[:2], bad, *records[3:]])) + warc.member(record(9)))
    assert pages == [0, 1, 3, 4, 5, 9]
    assert len(gaps) == 1 and "block digest differs" in gaps[0][2]


def test_bad_checksum_and_cut_member_of_several():
    squeezed = warc.member(b"".join(noisy(n) for n in range(6)))
    bad = bytearray(squeezed)
    bad[-6] ^= 0xFF
    pages, gaps = read(bytes(bad) + warc.member(record(9)))
    assert pages == [0, 1, 2, 3, 4, 5, 9] and len(gaps) == 1
    for rest in (b"", warc.member(record(9))):
        pages, gaps = read(squeezed[: len(squeezed) * 3 // 4] + rest)
        assert pages == [0, 1, 2, 3, *([9] if rest else [])]
        assert len(gaps) == 1 and gaps[0][0] < gaps[0][1]


def test_bad_byte_in_a_compressed_member_of_several():
    squeezed = warc.member(b"".join(noisy(n) for n in range(6)))
    for at in range(len(squeezed) // 2, len(squeezed) // 2 + 200, 10):
        bad = bytearray(squeezed)
        bad[at] ^= 0xFF
        pages, gaps = read(bytes(bad) + warc.member(record(9)))
        assert pages[:2] == [0, 1] and pages[-1] == 9 and gaps
        assert len(pages) == len(set(pages))


def test_stored_member_of_several_is_not_read_twice():
    squeeze = zlib.compressobj(0, zlib.DEFLATED, 31)
    stored = squeeze.compress(b"".join(noisy(n, 300) for n in range(6))) + squeeze.flush()
    assert read(stored[:-20])[0] == [0, 1, 2, 3, 4]


def test_nothing_valid():
    assert read(b"x" * 1000) == ([], [(0, 1000, "no version line")])
    assert read(b"") == ([], [])


def test_payload_that_looks_like_a_record_is_not_read_as_one():
    inner = record(9)
    data = warc.record_bytes(1, None, inner, None)
    assert read(data)[0] == [1]


def expected(rows):
    groups = defaultdict(list)
    for page_id, html in rows:
        payload = (html or "").encode()
        if len(payload) >= 1000:
            groups[payload].append(page_id)
    result = []
    for page_id, html in rows:
        payload = (html or "").encode()
        ids = [i for i in groups.get(payload, [page_id]) if i is not None]
        last = max(ids, default=None)
        refers = None if last == page_id else last
        kind = "response" if refers is None else "revisit"
        result.append((page_id, len(payload), hashlib.sha1(payload).hexdigest(), kind, refers))
    return sorted(result, key=repr)


def test_query(spark):
    found = sorted((tuple(r) for r in warc.op10_warc(spark, SMALL).collect()), key=repr)
    assert found == expected(whole(SMALL, "page_id, html", "pages"))


def test_odd_pages(spark, tmp_path):
    big = "<p>é" + "y" * 1200
    rows = [
        (1, "http://a/1 b\n", big), (2, None, big), (2, None, big), (3, "u", None), (4, "u", ""), (5, "u", "short"), (6, "u", "short"),
        (None, "u", big), (7, "u", "z" * 200_000), (None, None, None), (8, "u", "x" * 1000), (9, "u", "x" * 1000), (10, "u", "x" * 999),
    ]
    pages = spark.createDataFrame([(*r, "extra", 5) for r in rows], "page_id long, url string, html string, digest string, n int")
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    found = sorted((tuple(r) for r in warc.op10_warc(spark, str(tmp_path)).collect()), key=repr)
    assert found == expected([(r[0], r[2]) for r in rows])


def test_no_pages(spark, tmp_path):
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert warc.op10_warc(spark, str(tmp_path)).collect() == []


def test_gaps_are_rows(spark, tmp_path):
    data = warc.member(record(1)) + b"broken" + warc.member(record(2))
    path = tmp_path / "x.warc.gz"
    path.write_bytes(data)
    manifest = spark.createDataFrame([(f"file://{path}", len(data), 2)], warc.MANIFEST)
    rows = warc.read_archives(manifest).collect()
    assert sorted(r["page_id"] for r in rows if r["record_type"] == "response") == [1, 2]
    (gap,) = [r for r in rows if r["record_type"] == "gap"]
    assert (gap["gap_start"], gap["gap_end"]) == (len(warc.member(record(1))), len(warc.member(record(1))) + 6)


@pytest.mark.parametrize("least", [0, 1000])
def test_sql_gives_the_same_rows(spark, tmp_path, least):
    import duckdb

    rows = [(i, "u", "x" * (995 + i % 10)) for i in range(40)] + [(100, "u", None), (None, "u", "x" * 1002)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").where(f"page_id is null or page_id >= {least}")
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    want = connection.execute(f"SELECT page_id, payload_bytes, payload_digest, record_type, refers_to FROM ({warc.ORACLE})").fetchall()
    found = [tuple(r) for r in warc.op10_warc(spark, str(tmp_path)).collect()]
    assert sorted(found, key=repr) == sorted(want, key=repr)
