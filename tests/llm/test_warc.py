import gzip
import random
import time

import pytest

from hourstar.llm.queries import op8_warc
from hourstar.llm.warc import digest, member, parse_record, read_archives, record, salvage, write_archives

SF_DIR = "/root/testdata/sf0.01"


def plain(pages):
    first = {}
    for page, html in pages:
        key = (html or "").encode()
        if page is not None:
            first[key] = min(page, first.get(key, page))
    out = []
    for page, html in pages:
        body = (html or "").encode()
        refers = first.get(body)
        refers = None if refers is None or refers == page else refers
        out.append((page, len(body), digest(body), "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


def test_query_over_the_whole_table(spark):
    pages = [(r.page_id, r.html) for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()]
    rows = op8_warc(spark, SF_DIR).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, rows), key=str) == plain(pages)


ROWS = [
    (1, "http://a/", "<p>x"), (2, None, "<p>x"), (3, "http://b\r\nX: y", None), (4, "", ""), (5, "u", "WARC/1.0\r\nWARC-Type: fake\r\n\r\n" * 3),
    (None, "u", "<p>x"), (None, "u", "alone"), (1, "http://a/", "<p>x"), (9, "ü", "zero\0byte é"), (10, "long", "ab€" * 6_000_000),
]


def test_awkward_rows_make_the_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(*r, "k") for r in ROWS], "page_id long, url string, html string, key string")
    write_archives(df.repartition(2), str(tmp_path / "w"), records_per_file=3)
    records, gaps = read_archives(spark, str(tmp_path / "w"))
    assert gaps.count() == 0
    found = records.collect()
    rows = [(int(r.page_id) if r.page_id else None, r.payload_bytes, r.payload_digest, r.record_type, int(r.refers_to) if r.refers_to else None) for r in found]
    assert sorted(rows, key=str) == plain([(r[0], r[2]) for r in ROWS])
    bodies = {r.page_id: bytes(r.payload) for r in found if r.record_type == "response"}
    assert bodies["10"].decode() == ROWS[-1][2] and bodies["9"].decode() == ROWS[-2][2]
    files = list((tmp_path / "w").rglob("part-*"))
    assert len(files) > 3
    for file in files:
        with gzip.open(file) as opened:  # an ordinary gzip reader takes it, too
            opened.read()


def test_archives_are_bounded_by_bytes(spark, tmp_path):
    rng = random.Random(3)
    rows = [(k, "u", "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=size))) for k, size in enumerate([4_000] * 60 + [90_000] + [4_000] * 60)]
    write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2), str(tmp_path / "w"), archive_bytes=20_000)
    sizes = sorted(f.stat().st_size for f in (tmp_path / "w").rglob("part-*"))
    assert len(sizes) > 10 and sizes[-2] <= 20_000 < sizes[-1]
    records, gaps = read_archives(spark, str(tmp_path / "w"), strict=True)
    assert sorted((int(r.page_id), r.payload.decode()) for r in records.collect()) == [(k, text) for k, _, text in rows]
    assert gaps.count() == 0


def test_a_strict_reader_fails_on_a_gap(spark, tmp_path):
    parts = archive()
    (tmp_path / "a.warc.gz").write_bytes(parts[0] + b"\x1f\x8b\x08garbage" + parts[1])
    assert read_archives(spark, str(tmp_path))[0].count() == 2
    assert [(r.start, r.end) for r in read_archives(spark, str(tmp_path))[1].collect()] == [(len(parts[0]), len(parts[0]) + 10)]
    with pytest.raises(Exception, match="a.warc.gz: bytes"):
        read_archives(spark, str(tmp_path), strict=True)[0].count()


def test_empty_table(spark, tmp_path):
    write_archives(spark.createDataFrame([], "page_id long, url string, html string"), str(tmp_path / "w"))
    assert read_archives(spark, str(tmp_path / "w"))[0].count() == 0


def archive(packed=True):
    rng = random.Random(8)
    records = [record(str(k), "u", bytes(rng.choices(b"abcdefgh <>", k=rng.randint(0, 3000))), None) for k in range(30)]
    return [member(r) if packed else r for r in records]


def test_damage_costs_only_what_it_touches():
    for packed in (True, False):
        parts = archive(packed)
        starts = [sum(map(len, parts[:k])) for k in range(31)]
        whole = b"".join(parts)
        assert len(salvage(whole)[0]) == 30 and salvage(whole)[1] == []
        rng = random.Random(1)
        for _ in range(120):
            at, length = rng.randrange(len(whole) - 40), rng.randint(1, 40)
            bad = whole[:at] + bytes(rng.randrange(256) for _ in range(length)) + whole[at + length :]
            found, gaps = salvage(bad)
            hit = {k for k in range(30) if starts[k] < at + length and at < starts[k + 1]}
            names = [f.page_id for f in found]
            missing = {k for k in range(30) if str(k) not in names}
            assert missing <= hit, (packed, at)
            assert all(0 <= g.start < g.end <= len(bad) and g.reason for g in gaps)
            if missing:
                assert gaps
        cut = salvage(whole[: starts[20] + 5])
        assert len(cut[0]) == 20 and cut[1][0].start == starts[20]
        lost = salvage(whole[:starts[3]] + whole[starts[4] :])
        assert len(lost[0]) == 29


def test_garbage_between_members_is_logged():
    parts = archive()
    found, gaps = salvage(parts[0] + b"\x1f\x8b\x08garbage" + parts[1])
    assert len(found) == 2 and gaps == [(len(parts[0]), len(parts[0]) + 10, gaps[0].reason)]
    assert salvage(b"") == ([], [])
    assert salvage(b"nothing here")[0] == []


def test_revisit_has_the_full_payloads_digest():
    entry, _ = parse_record(record("2", "u", b"abc", "1"))
    assert (entry.payload, entry.payload_bytes, entry.payload_digest, entry.refers_to) == (b"", 3, digest(b"abc"), "1")


def test_time_is_in_proportion_to_the_members():
    rng = random.Random(8)
    one = [member(record(str(k), "u", rng.randbytes(20_000), None)) for k in range(1000)]
    seconds = []
    for times in (1, 4):
        data = b"".join(one) * times
        start = time.perf_counter()
        found, gaps = salvage(data)
        seconds.append(time.perf_counter() - start)
        assert len(found) == 1000 * times and not gaps
    assert seconds[1] < 10 * seconds[0]
