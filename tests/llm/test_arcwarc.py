"""ARC parsing, conversion and the WARC read back."""

import hashlib
import io

import pytest

from tidemark.llm import arcwarc
from tidemark.llm.common import written

SCHEMA = "page_id long, url string, html string"


def _brute(rows):
    out, first = [], {}
    for i, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        b = (html or "").encode()
        d = hashlib.sha256(b).hexdigest()
        if len(b) >= 100 and d in first:
            out.append((i, len(b), d, "revisit", first[d]))
        else:
            first.setdefault(d, i)
            out.append((i, len(b), d, "response", None))
    return sorted(out, key=str)


def _got(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=str)


def test_round_trip_matches_brute_force(spark):
    long = "é<p>" + "x\r\n\r\nWARC/1.0\n" * 5000
    rows = [(i, f"http://h/{i} ü", "same page " * 20) for i in range(40, 60)]
    rows += [(1, "http://a/", "short"), (2, "http://b/", "short"), (3, None, None), (4, "", ""), (5, "http://c", long), (6, "http://c", long)]
    rows += [(7, "http://d", "HTTP/1.1 200 OK\r\n\r\nnot a header"), (8, "u", "a" * 100), (9, "u", "a" * 100), (10, "u", "b" * 99), (11, "u", "b" * 99)]
    got = arcwarc.round_trip(spark.createDataFrame(rows, SCHEMA))
    assert _got(got) == _brute(rows)


def test_repeated_rows_null_ids_and_extra_columns(spark):
    rows = [(5, "u", "y" * 200)] * 3 + [(None, "u", "y" * 200), (7, "u", "z" * 200)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as digest", "2 as archive", "'x' as record_type")
    kinds = sorted((str(r.page_id), r.record_type, r.refers_to) for r in arcwarc.round_trip(df).collect())
    assert kinds == sorted([("5", "response", None), ("5", "revisit", 5), ("5", "revisit", 5), ("None", "revisit", 5), ("7", "response", None)])


def test_empty_table(spark):
    out = arcwarc.round_trip(spark.createDataFrame([], SCHEMA))
    assert out.count() == 0


def test_archives_are_cut_and_both_versions_read(spark):
    rows = [(i, f"http://h/{i}", f"{i} " * 400) for i in range(40)]
    arcs = arcwarc.write_arc(spark.createDataFrame(rows, SCHEMA).coalesce(1), archive_bytes=4000)
    assert arcs.count() > 4
    index = arcwarc.index_arc(arcs)
    assert {r.page_id: r.digest for r in index.collect()} == {i: hashlib.sha256(h.encode()).hexdigest() for i, _, h in rows}
    warcs = arcwarc.convert(arcs)
    assert warcs.count() == arcs.count()
    assert written(arcwarc.read_warc(warcs), "t").count() == 40


@pytest.mark.parametrize("version", ["1", "2"])
def test_header_lines_by_version(version):
    head = arcwarc.arc_version_block("n.arc", version, "19970101000000")
    bodies = [b"", b"line\nline\n\nhttp://x 1 2 3 4\n", bytes(range(256))]
    data, offset = head, len(head)
    for i, body in enumerate(bodies):
        rec = arcwarc.arc_record(f"http://h/{i}", "19970203040506", "image/gif", body, version, "n.arc", offset)
        data += rec
        offset += len(rec)
    got = list(arcwarc.parse_arc(io.BytesIO(data)))
    assert [r.body for r in got] == bodies
    assert got[1].fields["mime"] == "image/gif" and got[1].fields["date"] == "19970203040506"
    assert data[got[2].offset :].startswith(b"http://h/2 ")
    if version == "2":
        assert got[2].fields["status"] == "200" and int(got[2].fields["offset"]) == got[2].offset


def test_bad_archives_raise():
    with pytest.raises(ValueError, match="unknown ARC version"):
        list(arcwarc.parse_arc(io.BytesIO(arcwarc.arc_version_block("n", "1", "1997").replace(b"\n1 0 ", b"\n9 0 "))))
    cut = arcwarc.arc_version_block("n", "1", "1997") + b"http://h 0.0.0.0 1997 text/html 50\nshort"
    with pytest.raises(ValueError, match="declares 50 bytes"):
        list(arcwarc.parse_arc(io.BytesIO(cut)))


def test_payload_and_dates():
    assert arcwarc.ArcRecord({}, 0, b"HTTP/1.0 200 OK\nA: b\n\nbody").payload() == (b"HTTP/1.0 200 OK\nA: b\n\n", b"body")
    assert arcwarc.ArcRecord({}, 0, b"\x89PNG").payload() == (b"", b"\x89PNG")
    assert arcwarc.warc_date("19970203040506") == "1997-02-03T04:05:06Z"
    assert arcwarc.warc_date("1997") == "1997-01-01T00:00:00Z"
